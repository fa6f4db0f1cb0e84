"""Traffic of cities and airports, the airport maps, and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flightlens.functions import in_box, in_years
from flightlens.operators import contains_join, distinct_ranked, place_traffic, ranked
from flightlens.plans.constants import BUBBLE_BASE, BUBBLE_DIVISOR
from flightlens.session import materialize


def _both_ends(traffic: DataFrame, place: str, *shared: str, same_name: bool = False) -> DataFrame:
    """Places as origins joined to places as destinations whose name their own name contains.

    With ``same_name`` only to themselves, which needs no join. Otherwise the two roles of the
    summary are two branches of one plan; writing the summary first keeps the edges from being
    read once per branch.
    """
    flights = (F.col("flightsFrom") + F.col("flightsTo")).alias("flights")
    columns = (place, *shared, "flightsFrom", "flightsTo", flights)
    if same_name:
        both = traffic.filter(F.col("departs") & F.col("arrives")).na.drop(subset=["place", *shared])
        return both.withColumnRenamed("place", place).select(*columns)
    summary = materialize(traffic, "place-traffic")
    origins = summary.filter("departs").select(F.col("place").alias(place), *shared, "flightsFrom")
    ends = [F.col(name).alias(f"to_{name}") for name in shared]
    destinations = summary.filter("arrives").select(F.col("place").alias("to_place"), *ends, "flightsTo")
    pairs = contains_join(
        origins, place, destinations, "to_place", equal=[(name, f"to_{name}") for name in shared],
        expand="values" if shared else "rows",
    )
    return pairs.select(*columns)


def traffic_by_city_month(
    edges: DataFrame, *, top: int | None = None, descending: bool = True, same_name: bool = False, rank: bool = False
) -> DataFrame:
    """Departures plus arrivals per city and month, busiest first.

    A city also takes up the arrivals of every city whose name is part of its own, unless
    ``same_name`` asks for equal names. Months are six
    characters on both sides, where containment is equality, so they join as an equal key.
    """
    months = place_traffic(edges, "origin_city", "destination_city", "fly_date")
    joined = _both_ends(months, "origin_city", "fly_date", same_name=same_name)
    rows = joined.select("origin_city", "fly_date", "flights")
    return ranked(rows, "flights", "origin_city", "fly_date", descending=descending, top=top, rank=rank)


def airport_traffic(edges: DataFrame, year: int) -> DataFrame:
    """Flights from and to every airport in one year."""
    codes = place_traffic(edges.filter(in_years([year])), "originCode", "destinationCode")
    return _both_ends(codes, "originCode").withColumnRenamed("originCode", "airportCode")


def airport_bubbles(edges: DataFrame, airports: DataFrame, year: int, box: dict[str, float]) -> DataFrame:
    """Map points: position, flights in the year and bubble size of every airport in a box.

    Airports with a null in any column, used here or not, are left out.
    """
    traffic = airport_traffic(edges, year).select("airportCode", "flights")
    placed = contains_join(traffic, "airportCode", airports, "IATA", expand="rows")
    kept = placed.filter(in_box("Latitude", "Longitude", **box)).na.drop()
    size: Column = F.col("flights") / BUBBLE_DIVISOR + BUBBLE_BASE
    return kept.select("Longitude", "Latitude", F.col("flights").cast("double"), size.alias("bubble_size"))


def routes_by_distance(edges: DataFrame, *, descending: bool = True, top: int | None = None, rank: bool = False) -> DataFrame:
    """Distinct routes, longest or shortest first."""
    return distinct_ranked(
        edges, ("origin_city", "destination_city", "distance"), "distance", descending=descending, top=top, rank=rank
    )


def route_lines(edges: DataFrame, airports: DataFrame) -> DataFrame:
    """Flights per route and year with the coordinates of both ends, for drawing lines.

    The edges are added up before they meet the airports.
    """
    routes = edges.groupBy("originCode", "destinationCode", "fly_year").agg(F.sum("flights").alias("flights"))

    def located(code: str, prefix: str) -> DataFrame:
        return airports.select(
            F.col("IATA").alias(code),
            F.col("Latitude").alias(f"{prefix}_lat"),
            F.col("Longitude").alias(f"{prefix}_long"),
        )

    return (
        routes.join(located("originCode", "origin"), "originCode")
        .join(located("destinationCode", "destination"), "destinationCode")
    )
