"""Registered queries over the given tables, and the SQL that checks them."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

import oracle_queries  # noqa: E402
from flightlens import fixtures as fx, schemas, sources  # noqa: E402
from flightlens.operators import contains_join, total_by, union_by_position  # noqa: E402
from flightlens.plans import delays, focus, models, seasons, traffic, trends, weather  # noqa: E402
from flightlens.plans.constants import (  # noqa: E402
    CLUSTER_COLUMNS, DELAY_CAUSES, FIRST_MAP_BOX, LAST_MAP_BOX, REGRESSION_CANDIDATES, REGRESSION_LABEL,
)
from flightlens.session import scratch_path  # noqa: E402

try:  # the training-data operators are an optional part
    from flightlens.llm.queries import ORACLES as LLM_ORACLES, QUERIES as LLM_QUERIES  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("flightlens.llm", "flightlens.llm.queries", "corpus_pipeline"):
        raise
    LLM_ORACLES, LLM_QUERIES = {}, {}

Query = Callable[[SparkSession, str], DataFrame]

FOCUS, FIRST, LAST = fx.FOCUS, fx.FIRST, fx.LAST
CODES = ("originCode", "destinationCode", "flights", "fly_date")
CITIES = ("origin_city", "destination_city", "flights", "fly_date")
DAY = ("Year", "Month", "DayofMonth")
AIRPORT_FLIGHTS = (*DAY, "DepDelay", "ArrDelay", "Cancelled", "CancellationCode", "Origin", "Dest")
ROUTE = ("origin_city", "destination_city", "distance")
CLUSTERED = ("Cancelled", "Month", "Origin")
FACTS = (*DAY, "DepTime", "ArrDelay", "DepDelay", "Origin", "Dest", "Cancelled", "CancellationCode", "TailNum", *DELAY_CAUSES)
EDGES = ("originCode", "destinationCode", "origin_city", "destination_city", "passengers", "seats", "flights",
         "distance", "fly_date", "origin_population", "destination_population")


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Sums of doubles depend on their order in the last digits; both engines compare rounded."""
    return df.withColumns({name: F.round(name, digits) for name in names})


def _on_edges(report: Callable[..., DataFrame], columns: tuple[str, ...], *args, years=None, rounded=None, **kwargs) -> Query:
    """A report on flight edges, given the columns it reads."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = report(fx.flight_edges(spark, sf_dir, columns, years), *args, **kwargs)
        return _rounded(out, *rounded) if rounded else out
    return run


def _on_facts(report: Callable[..., DataFrame], columns: tuple[str, ...], *args, rounded=None) -> Query:
    """A report on single flights, given the columns it reads."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = report(fx.flight_facts(spark, sf_dir, columns), *args)
        return _rounded(out, *rounded) if rounded else out
    return run


def _bubbles(year: int, box: dict[str, float]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        edges = fx.flight_edges(spark, sf_dir, CODES, [year])
        return _rounded(traffic.airport_bubbles(edges, fx.airports(spark, sf_dir), year, box), 6, "bubble_size")
    return run


def _located(spark: SparkSession, sf_dir: str, slices=schemas.STATION_SLICES) -> DataFrame:
    return weather.weather_with_location(fx.weather_observations(spark, sf_dir), fx.stations(spark, sf_dir, slices))


def _wide(spark: SparkSession, sf_dir: str, slices=schemas.STATION_SLICES) -> DataFrame:
    return weather.temperature_and_rain(fx.weather_observations(spark, sf_dir), fx.stations(spark, sf_dir, slices))


def _stored_by_year(spark: SparkSession, sf_dir: str, columns: tuple[str, ...]) -> DataFrame:
    """The facts' copy by year: written once, so that no later scan opens a year it does not need."""
    path = scratch_path(spark, "facts-by-year")
    sources.write_by_year(fx.flight_facts(spark, sf_dir, columns), path)
    return sources.read_by_year(spark, path)


def _union_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One frame per year, each the scan of its own folder, put together by position."""
    columns = (*DAY, "Origin", "Dest", "DepDelay", "ArrDelay", "Cancelled")
    stored = _stored_by_year(spark, sf_dir, columns).select(*columns)
    return union_by_position(stored.filter(F.col("Year") == year) for year in range(FIRST, LAST + 1))


def _delays_in_busiest_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored_by_year(spark, sf_dir, ("Year", "Month", "ArrDelay", "Cancelled"))
    return delays.delays_in_busiest_years(stored, fx.flight_edges(spark, sf_dir, ("passengers", "fly_date")))


def _through_file(view: Callable[[SparkSession, str], DataFrame], write: Callable[[DataFrame, str], None],
                  read: Callable[..., DataFrame], **options) -> Query:
    """A view written in its file format and read back, what can't be read put aside."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made, path = view(spark, sf_dir), scratch_path(spark, "files")
        write(made, path)
        back = read(spark, path, keep_unreadable=True, **options)
        return sources.quarantine(back, f"{path}-unreadable").select(*(made.columns if len(made.columns) > 1 else back.columns[:-1]))
    return run


def _departures_with_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = weather.airport_readings(
        fx.weather_observations(spark, sf_dir), fx.airports(spark, sf_dir), fx.stations(spark, sf_dir)
    )
    facts = fx.flight_facts(spark, sf_dir, (*DAY, "DepTime", "Origin", "Dest", "DepDelay"))
    return _rounded(delays.departures_with_readings(facts, readings, calendar_day=True), 6, "temperature")


def _contains_join_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = total_by(fx.flight_edges(spark, sf_dir, ("origin_city", "flights")), "origin_city")
    return contains_join(totals, "origin_city", fx.airports(spark, sf_dir), "City", expand="rows")


def _route_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.route_lines(fx.flight_edges(spark, sf_dir, CODES), fx.airports(spark, sf_dir))


def _flights_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delays.flights_at_airports(fx.flight_facts(spark, sf_dir, AIRPORT_FLIGHTS), fx.airports(spark, sf_dir))


def _delays_with_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    temperatures = weather.airport_temperatures(
        fx.weather_observations(spark, sf_dir), fx.airports(spark, sf_dir), fx.stations(spark, sf_dir)
    )
    facts = fx.flight_facts(spark, sf_dir, (*DAY, "Origin", "Dest", "ArrDelay"))
    return delays.delays_with_temperatures(facts, temperatures, calendar_day=True)


def _clustering_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fx.flight_facts(spark, sf_dir, CLUSTERED), fx.airports(spark, sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    """Traffic of every city and month on the smallest tables."""
    return queries()["traffic_by_city_month"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    regression = (*REGRESSION_CANDIDATES, REGRESSION_LABEL)
    by_city_month = traffic.traffic_by_city_month
    calendar = seasons.flights_by_calendar_month
    month_columns = ("flights", "fly_date")
    model_features = ("origin_population", "distance", "passengers")
    return LLM_QUERIES | {
        # sources and projections
        "station_locations": fx.stations,
        "station_locations_reference_slices":
            lambda spark, sf_dir: fx.stations(spark, sf_dir, schemas.REFERENCE_STATION_SLICES),
        "edges_with_period": lambda spark, sf_dir: fx.flight_edges(spark, sf_dir, EDGES),
        "union_years": _union_years,
        "facts_from_files": _through_file(
            lambda spark, sf_dir: fx.flight_facts(spark, sf_dir, FACTS), sources.write_flight_facts, sources.read_flight_facts
        ),
        "edges_from_files": _through_file(
            lambda spark, sf_dir: fx.flight_edges(spark, sf_dir, EDGES).drop("fly_year", "fly_month"),
            sources.write_flight_edges, sources.read_flight_edges,
        ),
        "airports_from_files": _through_file(fx.airports, sources.write_airports, sources.read_airports),
        "weather_from_files": _through_file(fx.weather_observations, sources.write_weather, sources.read_weather),
        "stations_from_files": _through_file(
            fx.station_lines, lambda lines, path: lines.write.text(path), sources.read_stations
        ),
        # weather
        "weather_with_location": _located,
        "weather_daily_wide": _wide,
        "weather_daily_wide_reference_slices": lambda spark, sf_dir: _wide(spark, sf_dir, schemas.REFERENCE_STATION_SLICES),
        "airports_near_stations": lambda spark, sf_dir: weather.airports_near_stations(
            fx.airports(spark, sf_dir), fx.stations(spark, sf_dir)
        ),
        "nearest_station": lambda spark, sf_dir: _rounded(
            weather.nearest_station(fx.airports(spark, sf_dir), fx.stations(spark, sf_dir)), 6, "distance"
        ),
        # delays
        "avg_arrival_delay_by_year": _on_facts(
            delays.avg_arrival_delay_by_year, ("Year", "ArrDelay"), rounded=(6, "avg_arrival_delay")
        ),
        "avg_departure_delay_by_year": _on_facts(
            delays.avg_departure_delay_by_year, ("Year", "DepDelay"), rounded=(6, "avg_departure_delay")
        ),
        "flights_at_airports_in_box": _flights_in_box,
        "delay_causes": _on_facts(delays.delay_causes, DELAY_CAUSES),
        "cancellation_reasons": _on_facts(delays.cancellation_reasons, ("Cancelled", "CancellationCode")),
        "plane_use": _on_facts(delays.plane_use, ("TailNum", *DAY)),
        "flights_by_day": _on_facts(delays.flights_by_period, (*DAY, "Cancelled"), "day"),
        "flights_by_week": _on_facts(delays.flights_by_period, (*DAY, "Cancelled"), "week"),
        "flights_by_year": _on_facts(delays.flights_by_period, (*DAY, "Cancelled"), "year"),
        "delays_with_temperatures": lambda spark, sf_dir: _rounded(
            _delays_with_temperatures(spark, sf_dir), 6, "origin_temperature", "destination_temperature"
        ),
        "delay_temperature_model": lambda spark, sf_dir: _rounded(
            _rounded(models.delay_temperature_model(_delays_with_temperatures(spark, sf_dir)), 9, "coefficient"),
            6, "mae",
        ),
        "delays_in_busiest_years": lambda spark, sf_dir: _rounded(
            _delays_in_busiest_years(spark, sf_dir), 6, "avg_arrival_delay"
        ),
        "departures_with_readings": _departures_with_readings,
        # one airport
        "focus_flights_by_year": _on_edges(focus.flights_by_year, CODES, FOCUS),
        "focus_flights_by_month": _on_edges(focus.flights_by_month, CODES, FOCUS, top=20),
        "focus_month_histogram": _on_edges(focus.month_histogram, CODES, FOCUS),
        "focus_month_series": _on_edges(focus.month_series, CODES, FOCUS),
        "focus_inbound_city_year": _on_edges(focus.inbound_by_city_year, (*CODES, "origin_city"), FOCUS),
        "focus_inbound_city": _on_edges(focus.inbound_by_city, (*CODES, "origin_city"), FOCUS),
        "focus_outbound_city_year": _on_edges(focus.outbound_by_city_year, (*CODES, "destination_city"), FOCUS),
        "focus_outbound_city": _on_edges(focus.outbound_by_city, (*CODES, "destination_city"), FOCUS),
        "focus_inbound_city_year_first_last": _on_edges(
            focus.inbound_by_city_year, (*CODES, "origin_city"), FOCUS, None, (FIRST, LAST), years=(FIRST, LAST)
        ),
        "focus_outbound_city_year_first_last": _on_edges(
            focus.outbound_by_city_year, (*CODES, "destination_city"), FOCUS, None, (FIRST, LAST), years=(FIRST, LAST)
        ),
        # traffic, maps, routes
        "traffic_by_city_month": _on_edges(by_city_month, CITIES),
        "traffic_by_same_city_month": _on_edges(by_city_month, CITIES, same_name=True),
        "busiest_city_months": _on_edges(by_city_month, CITIES, top=20),
        "least_travelled_city_months": _on_edges(by_city_month, CITIES, top=20, descending=False),
        "ranked_city_months": _on_edges(by_city_month, CITIES, rank=True),
        "ranked_routes": _on_edges(traffic.routes_by_distance, ROUTE, rank=True),
        "airport_traffic_first_year": _on_edges(traffic.airport_traffic, CODES, FIRST, years=[FIRST]),
        "airport_traffic_last_year": _on_edges(traffic.airport_traffic, CODES, LAST, years=[LAST]),
        "airport_bubbles_first_year": _bubbles(FIRST, FIRST_MAP_BOX),
        "airport_bubbles_last_year": _bubbles(LAST, LAST_MAP_BOX),
        "contains_join_airports": _contains_join_airports,
        "routes_longest": _on_edges(traffic.routes_by_distance, ROUTE, top=20),
        "routes_shortest": _on_edges(traffic.routes_by_distance, ROUTE, top=20, descending=False),
        "route_lines": _route_lines,
        # seasons and load
        "flights_by_calendar_month": _on_edges(calendar, month_columns),
        "flights_by_calendar_month_first_year": _on_edges(calendar, month_columns, FIRST, years=[FIRST]),
        "flights_by_calendar_month_last_year": _on_edges(calendar, month_columns, LAST, years=[LAST]),
        "calendar_months_by_total_first_year":
            _on_edges(calendar, month_columns, FIRST, years=[FIRST], by_total=True),
        "calendar_months_by_total_last_year":
            _on_edges(calendar, month_columns, LAST, years=[LAST], by_total=True),
        "passengers_by_year": _on_edges(delays.passengers_by_year, ("passengers", "fly_date")),
        "passengers_per_flight_by_year": _on_edges(
            seasons.passengers_per_flight_by_year, ("passengers", "flights", "fly_date"),
            rounded=(6, "passengers_per_flight"),
        ),
        "seats_filled_by_year": _on_edges(
            seasons.seats_filled_by_year, ("passengers", "seats", "fly_date"),
            rounded=(6, "fraction_seats_filled", "percent_seats_filled"),
        ),
        "load_series": _on_edges(
            seasons.load_series, ("passengers", "seats", "flights", "fly_date"), rounded=(6, "value")
        ),
        # trends
        "seasonal_spikes": _on_edges(trends.seasonal_spikes, CITIES, rounded=(6, "avg_change")),
        "trend_breaks": _on_edges(trends.trend_breaks, CITIES, rounded=(6, "usual_change", "z_score")),
        "trend_spans": _on_edges(trends.trend_spans, CITIES, 1.0, rounded=(6, "departure", "largest_z")),
        "travel_trend": _on_edges(trends.travel_trend, CITIES, rounded=(6, "yearly_change")),
        "travel_stepwise": _on_edges(
            trends.travel_stepwise,
            ("origin_population", "destination_population", "distance", "seats", "flights", "passengers"),
            "passengers", 3, rounded=(6, "r_squared"),
        ),
        "travel_change": _on_edges(trends.travel_change, CITIES, FIRST, LAST, years=(FIRST, LAST)),
        "population_travel_correlation": _on_edges(
            trends.population_travel_correlation,
            ("origin_population", "destination_population", "passengers", "flights"), rounded=(9, "correlation"),
        ),
        # models
        "lr_feature_search": _on_edges(models.flight_count_search, regression, rounded=(6, "mae")),
        "lr_best_features": _on_edges(models.best_flight_count_features, regression, rounded=(6, "mae")),
        "lr_model_fit": lambda spark, sf_dir: _rounded(_rounded(models.flight_count_model(
            fx.flight_edges(spark, sf_dir, (*model_features, REGRESSION_LABEL)), model_features
        ), 9, "coefficient"), 6, "mae"),
        "scaled_features": lambda spark, sf_dir: _rounded(
            models.scaled_flights(*_clustering_inputs(spark, sf_dir)), 6,
            "scaled_Cancelled", "scaled_Month", "scaled_Latitude",
        ),
        "kmeans_predictions": lambda spark, sf_dir: models.flight_predictions(*_clustering_inputs(spark, sf_dir)),
        "kmeans_silhouette": lambda spark, sf_dir: _rounded(
            models.flight_clusters(*_clustering_inputs(spark, sf_dir)).silhouette(), 6, "silhouette"
        ),
        "kmeans_centers": lambda spark, sf_dir: _rounded(
            models.flight_clusters(*_clustering_inputs(spark, sf_dir)).centers(), 6,
            *CLUSTER_COLUMNS, *(f"scaled_{name}" for name in CLUSTER_COLUMNS),
        ),
        "kmeans_cluster_sizes": lambda spark, sf_dir: models.flight_clusters(*_clustering_inputs(spark, sf_dir)).sizes(),
    }


def oracle_sql() -> dict[str, str]:
    return LLM_ORACLES | oracle_queries.oracle_sql()
