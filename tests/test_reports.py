"""Rules of single reports on hand-made rows, and the shape of all physical plans."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from flightlens import session as session_module
from flightlens.operators import clustering, joins
from flightlens.plans import delays, focus, seasons, traffic, trends, weather
from flightlens.session import materialize, shared_folder

EDGE = "originCode STRING, destinationCode STRING, origin_city STRING, destination_city STRING, " \
       "flights INT, distance DOUBLE, fly_date STRING, fly_year INT, fly_month INT"
AIRPORT = "IATA STRING, AirportName STRING, City STRING, Country STRING, Latitude DOUBLE, Longitude DOUBLE"


def _edges(spark, *rows):
    made = [(o, d, oc, dc, n, far, date, int(date[:4]), int(date[4:])) for o, d, oc, dc, n, far, date in rows]
    return spark.createDataFrame(made, EDGE)


@pytest.fixture()
def edges(spark):
    return _edges(
        spark,
        ("SAT", "DFW", "San Antonio", "Dallas", 5, 247.0, "199001"),
        ("DFW", "SAT", "Dallas", "San Antonio", 7, 247.0, "199001"),
        ("DFW", "SAT", "Dallas", "San Antonio", 9, 247.0, "199002"),
        ("SAT", "SAT", "San Antonio", "San Antonio", 2, 0.0, "200812"),
        ("HOU", "DFW", "Houston", "Dallas", 1, 239.0, "200812"),
    )


def test_focus_reports(edges):
    assert [tuple(r) for r in focus.flights_by_year(edges, "SAT").collect()] == [(1990, 21), (2008, 2)]
    assert [tuple(r) for r in focus.flights_by_month(edges, "SAT").collect()] == [("199001", 12), ("199002", 9), ("200812", 2)]
    assert [tuple(r) for r in focus.inbound_by_city(edges).collect()] == [("Dallas", 16), ("San Antonio", 2)]
    assert [tuple(r) for r in focus.outbound_by_city(edges, top=1).collect()] == [("Dallas", 5)]


def test_traffic_joins_arrivals_of_the_same_month_only(edges):
    got = {(r.origin_city, r.fly_date): r.flights for r in traffic.traffic_by_city_month(edges).collect()}
    assert got == {("San Antonio", "199001"): 12, ("Dallas", "199001"): 12, ("San Antonio", "200812"): 4}


def test_traffic_takes_up_contained_names(spark):
    edges = _edges(
        spark,
        ("A", "B", "New York North", "York", 3, 1.0, "199001"), ("B", "A", "York", "New York North", 4, 1.0, "199001"),
    )
    got = sorted((r.origin_city, r.flights) for r in traffic.traffic_by_city_month(edges).collect())
    assert got == [("New York North", 6), ("New York North", 7), ("York", 7)]
    same = traffic.traffic_by_city_month(edges, same_name=True).collect()
    assert sorted((r.origin_city, r.flights) for r in same) == [("New York North", 7), ("York", 7)]


def test_bubbles_drop_airports_with_any_null(spark, edges):
    airports = spark.createDataFrame([
        ("SAT", "San Antonio Intl", "San Antonio", "US", 29.5, -98.5),
        ("DFW", "Dallas", "Dallas", None, 32.9, -97.0),
        ("HOU", "Hobby", "Houston", "US", 29.6, -131.0),
    ], AIRPORT)
    rows = traffic.airport_bubbles(edges, airports, 1990, {"west": -130.0}).collect()
    assert [tuple(r) for r in rows] == [(-98.5, 29.5, 21.0, 21 / 20000 + 5.0)]


def test_routes_longest_first(edges):
    rows = traffic.routes_by_distance(edges).collect()
    assert [(r.origin_city, r.destination_city) for r in rows][:2] == [("Dallas", "San Antonio"), ("San Antonio", "Dallas")]
    assert [r.distance for r in rows] == [247.0, 247.0, 239.0, 0.0]
    assert traffic.routes_by_distance(edges, descending=False, top=1).first().distance == 0.0


def test_calendar_months_by_total(edges):
    assert [r.fly_month for r in seasons.flights_by_calendar_month(edges, 1990, by_total=True).collect()] == [2, 1]


def test_travel_change_counts_places_of_one_year_only(edges):
    got = {r.city: (r.first_year_flights, r.last_year_flights, r.change) for r in trends.travel_change(edges).collect()}
    assert got == {"San Antonio": (21, 4, -17), "Dallas": (21, 1, -20), "Houston": (0, 1, 1)}


def test_weather_needs_a_time_and_pairs_all_readings(spark):
    observations = spark.createDataFrame([
        ("S1", 20070101, "TOBS", 50, 700), ("S1", 20070101, "TOBS", 50, 700), ("S1", 20070101, "TOBS", 52, 800),
        ("S1", 20070101, "PRCP", 1, 700), ("S1", 20070101, "PRCP", 2, 800), ("S1", 20070101, "PRCP", 3, None),
        ("S2", 20070101, "TOBS", 60, 700), ("S2", 20070101, "PRCP", 0, 700), ("S3", 20070101, "TOBS", 1, 1),
    ], "stationCode STRING, doy INT, observationType STRING, observationVal INT, observationTime INT")
    stations = spark.createDataFrame([("S1", 30.0, -98.0), ("S2", 30.0, -131.0)], "stationCode STRING, lat DOUBLE, long DOUBLE")
    assert weather.weather_with_location(observations, stations).count() == 6
    wide = weather.temperature_and_rain(observations, stations)
    assert sorted((r.temperature, r.precip) for r in wide.collect()) == [(50, 1), (50, 2), (52, 1), (52, 2)]
    assert wide.columns == ["stationCode", "doy", "precip", "temperature", "lat", "long"]


def test_delays_with_temperatures(spark):
    facts = spark.createDataFrame([
        (2007, 1, 2, "SAT", "DFW", "10"), (2007, 1, 2, "SAT", "DFW", "NA"), (2007, 1, 3, "SAT", "DFW", "5"),
    ], "Year INT, Month INT, DayofMonth INT, Origin STRING, Dest STRING, ArrDelay STRING")
    temperatures = spark.createDataFrame(
        [("SAT", 20070102, 50.0), ("SAT", 20080102, 60.0), ("DFW", 20070102, 40.0)], "IATA STRING, doy INT, temperature DOUBLE"
    )
    exact = delays.delays_with_temperatures(facts, temperatures).collect()
    assert [(r.delay, r.origin_temperature, r.destination_temperature) for r in exact] == [(10.0, 50.0, 40.0)]
    any_year = delays.delays_with_temperatures(facts, temperatures, calendar_day=True).collect()
    assert [(r.delay, r.origin_temperature) for r in any_year] == [(10.0, 55.0)]


def test_materialize_writes_to_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    kept = materialize(spark.range(10).withColumn("x", F.col("id") * 2), "numbers")
    assert kept.agg(F.sum("x")).first()[0] == 90
    assert all(path.startswith(f"file://{folder}/numbers-") for path in kept.inputFiles())


LIBRARY = sorted(set(registered.queries()) - set(registered.LLM_QUERIES))
MATERIALIZING = (joins, clustering, traffic, weather)


@pytest.mark.parametrize("name", LIBRARY)
def test_plans(spark, tables, name, monkeypatch):
    """No cross product, no nested loop and no Python in any query of the library, nor below its summaries."""
    seen = []

    def noted(df, label):
        kept = materialize(df, label)
        seen.append(df)
        return kept

    for module in MATERIALIZING:
        monkeypatch.setattr(module, "materialize", noted)
    out = registered.queries()[name](spark, tables)
    out.write.format("noop").mode("overwrite").save()
    for df in (*seen, out):
        df.count()
        plan = df._jdf.queryExecution().executedPlan().toString()
        for word in ("Cartesian", "NestedLoop", "Python", "ArrowEval", "InPandas"):
            assert word not in plan


def test_every_user_of_materialize_is_inspected():
    import flightlens
    users = {p.stem for p in Path(flightlens.__file__).parent.rglob("*.py") if "llm" not in p.parts and "materialize(" in p.read_text()}
    assert users - {"session"} == {module.__name__.rpartition(".")[2] for module in MATERIALIZING}


@pytest.mark.parametrize("name", ["traffic_by_city_month", "weather_daily_wide", "nearest_station", "delays_with_temperatures", "kmeans_cluster_sizes"])
def test_same_rows_without_a_shared_folder(spark, tables, name, monkeypatch):
    query = registered.queries()[name]
    wanted = sorted(map(str, query(spark, tables).collect()))
    for module in (session_module,):
        monkeypatch.setattr(module, "shared_folder", lambda spark: None)
    got = query(spark, tables)
    assert sorted(map(str, got.collect())) == wanted
    spark.catalog.clearCache()


def test_summaries_read_the_weather_once(spark, tables, monkeypatch):
    seen = []
    monkeypatch.setattr(weather, "materialize", lambda df, label: seen.append((label, df)) or materialize(df, label))
    out = registered.queries()["weather_daily_wide"](spark, tables)
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("events.parquet")
    assert [label for label, _ in seen] == ["complete-stations", "located-readings"]
    assert [scans(df) for _, df in seen] == [1, 1] and scans(out) == 0


# departures and readings

FACT = "Year INT, Month INT, DayofMonth INT, DepTime INT, Origin STRING, Dest STRING, DepDelay STRING"
READING = "IATA STRING, doy INT, observationTime INT, temperature DOUBLE"


def test_departures_take_the_last_reading_of_their_day(spark):
    facts = spark.createDataFrame([
        (2008, 1, 5, 701, "SAT", "DFW", "3"), (2008, 1, 5, 659, "SAT", "DFW", "4"), (2008, 1, 5, 2359, "SAT", "DFW", "5"),
        (2008, 1, 6, 900, "SAT", "DFW", "6"), (2008, 1, 5, 800, "DFW", "SAT", "7"), (2008, 1, 5, 800, "SAT", "DFW", "NA"),
        (2008, 1, 5, 2460, "SAT", "DFW", "8"), (2008, 1, 5, None, "SAT", "DFW", "9"),
    ], FACT)
    readings = spark.createDataFrame([
        ("SAT", 20080105, 700, 10.0), ("SAT", 20080105, 700, 20.0), ("SAT", 20080105, 1800, 30.0), ("SAT", 20080105, 2500, 99.0),
        ("SAT", 20070106, 100, 7.0), ("SAT", 20080106, 100, 9.0),
    ], READING)
    found = {r.delay: (r.reading_minute, r.temperature) for r in delays.departures_with_readings(facts, readings, how="left").collect()}
    assert found == {3.0: (420, 15.0), 4.0: (None, None), 5.0: (1080, 30.0), 6.0: (60, 9.0), 7.0: (None, None)}
    inner = delays.departures_with_readings(facts, readings, calendar_day=True).collect()
    assert {r.delay: r.temperature for r in inner} == {3.0: 15.0, 5.0: 30.0, 6.0: 8.0}


# trends over years and spans

def test_travel_trend_slope_and_jump(spark):
    edges = _edges(spark, *((
        "A", "B", "Atown", "Btown", n, 1.0, f"{year}01"
    ) for year, n in ((1990, 10), (1991, 20), (1992, 10), (1994, 500), (1995, 490))), ("C", "C", "Ctown", "Ctown", 1, 1.0, "199001"))
    got = {r.city: r for r in trends.travel_trend(edges).collect()}
    assert (got["Atown"].jump_year, got["Atown"].jump, got["Atown"].years, got["Atown"].flights) == (1991, 10, 5, 1030)
    assert got["Ctown"].jump is None and got["Ctown"].yearly_change is None and got["Ctown"].flights == 2
    assert got["Btown"].yearly_change == pytest.approx(np.polyfit([1990, 1991, 1992, 1994, 1995], [10, 20, 10, 500, 490], 1)[0])


def test_trend_spans_join_neighbouring_months(spark):
    usual = [(year, month, 100 + 10 * (month % 2)) for year in range(1990, 2000) for month in range(1, 13)]
    odd = {(1995, 6): 900, (1997, 3): 800}
    edges = _edges(spark, *(
        ("A", "B", "Atown", "Btown", odd.get((year, month), n), 1.0, f"{year}{month:02d}") for year, month, n in usual
    ))
    got = [(r["from"], r["to"], r.months) for r in trends.trend_spans(edges).filter("city = 'Atown'").orderBy("from").collect()]
    # Up and down again in neighbouring months: one span each, whatever the direction.
    assert got == [("199506", "199507", 2), ("199703", "199704", 2)]


def test_ranked_reports_number_their_rows(spark, edges):
    rows = traffic.routes_by_distance(edges, rank=True).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    plain = traffic.routes_by_distance(edges).collect()
    assert [(r.origin_city, r.distance) for r in rows] == [(r.origin_city, r.distance) for r in plain]
    top = traffic.traffic_by_city_month(edges, rank=True, top=2).collect()
    assert sorted(r["rank"] for r in top) == [1, 2]
