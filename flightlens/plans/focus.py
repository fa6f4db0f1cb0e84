"""Reports on one airport."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from flightlens.functions import in_years
from flightlens.operators import numbered, ranked, total_by, with_ticks
from flightlens.plans.constants import FOCUS_AIRPORT, TICK_EVERY, TICK_HEIGHT


def touching(airport: str) -> Column:
    """Edges that start or end at the airport."""
    return (F.col("originCode") == airport) | (F.col("destinationCode") == airport)


def flights_by_year(edges: DataFrame, airport: str = FOCUS_AIRPORT) -> DataFrame:
    return total_by(edges.filter(touching(airport)), "fly_year").orderBy("fly_year")


def _monthly(edges: DataFrame, airport: str) -> DataFrame:
    return total_by(edges.filter(touching(airport)), "fly_date")


def flights_by_month(edges: DataFrame, airport: str = FOCUS_AIRPORT, top: int | None = None) -> DataFrame:
    """Flights per month, busiest month first."""
    return ranked(_monthly(edges, airport), "number_of_flights", "fly_date", top=top)


def month_histogram(edges: DataFrame, airport: str = FOCUS_AIRPORT) -> DataFrame:
    """Flights per month in order of time: the bars of a histogram."""
    return _monthly(edges, airport).orderBy("fly_date")


def month_series(
    edges: DataFrame, airport: str = FOCUS_AIRPORT, *, tick: float = TICK_HEIGHT, every: int = TICK_EVERY
) -> DataFrame:
    """Chart data: flights per month numbered from 0, and a tick of fixed height every year."""
    months = numbered(_monthly(edges, airport), "fly_date")
    return with_ticks(months, "month_index", "number_of_flights", every=every, tick=tick)


def _cities(
    edges: DataFrame, end: str, airport: str, top: int | None, years: Iterable[int] | None, *keys: str
) -> DataFrame:
    kept = edges.filter(F.col(end) == airport)
    if years is not None:
        kept = kept.filter(in_years(years))
    return ranked(total_by(kept, *keys), "number_of_flights", *keys, top=top)


def inbound_by_city_year(
    edges: DataFrame, airport: str = FOCUS_AIRPORT, top: int | None = None, years: Iterable[int] | None = None
) -> DataFrame:
    """Flights to the airport by city of origin and year; ``years`` keeps some years only."""
    return _cities(edges, "destinationCode", airport, top, years, "origin_city", "fly_year")


def inbound_by_city(
    edges: DataFrame, airport: str = FOCUS_AIRPORT, top: int | None = None, years: Iterable[int] | None = None
) -> DataFrame:
    """Flights to the airport by city of origin."""
    return _cities(edges, "destinationCode", airport, top, years, "origin_city")


def outbound_by_city_year(
    edges: DataFrame, airport: str = FOCUS_AIRPORT, top: int | None = None, years: Iterable[int] | None = None
) -> DataFrame:
    """Flights from the airport by city of destination and year."""
    return _cities(edges, "originCode", airport, top, years, "destination_city", "fly_year")


def outbound_by_city(
    edges: DataFrame, airport: str = FOCUS_AIRPORT, top: int | None = None, years: Iterable[int] | None = None
) -> DataFrame:
    """Flights from the airport by city of destination."""
    return _cities(edges, "originCode", airport, top, years, "destination_city")
