"""Calendar months, and how full the flights are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from flightlens.functions import in_years
from flightlens.operators import ratio_by, total_by


def flights_by_calendar_month(edges: DataFrame, year: int | None = None, *, by_total: bool = False) -> DataFrame:
    """Flights per calendar month, over all years or in one, by month, or numbered by total (fewest first)."""
    kept = edges if year is None else edges.filter(in_years([year]))
    totals = total_by(kept, "fly_month", name="total_flights")
    if not by_total:
        return totals.orderBy("fly_month")
    order = Window.partitionBy(F.lit(0)).orderBy("total_flights", "fly_month")  # of twelve rows
    return totals.withColumn("place", F.row_number().over(order)).orderBy("place")


def passengers_per_flight_by_year(edges: DataFrame) -> DataFrame:
    per_year = ratio_by(edges, "fly_year", passengers_per_flight=("passengers", "flights"))
    return per_year.orderBy("fly_year")


def seats_filled_by_year(edges: DataFrame) -> DataFrame:
    """Share of seats filled per year, as a fraction and in percent."""
    per_year = ratio_by(edges, "fly_year", fraction_seats_filled=("passengers", "seats"))
    percent = F.col("fraction_seats_filled") * 100
    return per_year.withColumn("percent_seats_filled", percent).orderBy("fly_year")


def load_series(edges: DataFrame) -> DataFrame:
    """Chart data: passengers per flight and percent of seats filled, from one aggregation."""
    both = ratio_by(
        edges, "fly_year",
        passengers_per_flight=("passengers", "flights"), fraction_seats_filled=("passengers", "seats"),
    )
    wide = both.select(
        "fly_year", "passengers_per_flight",
        (F.col("fraction_seats_filled") * 100).alias("percent_seats_filled"),
    )
    return wide.unpivot("fly_year", ["passengers_per_flight", "percent_seats_filled"], "series", "value")
