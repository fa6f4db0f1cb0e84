"""Seasonal changes of a place and changes over the years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flightlens.functions import in_years
from flightlens.operators import change_from_previous, place_traffic, runs_of_months
from flightlens.operators.regression import stepwise
from flightlens.plans.constants import FIRST_YEAR, LAST_YEAR

POPULATIONS = ("origin_population", "destination_population")
TRAVEL = ("passengers", "flights")
TRAVEL_CANDIDATES = (*POPULATIONS, "distance", "seats", "flights")


def _monthly_change(edges: DataFrame) -> DataFrame:
    """Change of each city's traffic from the month before, null where that month has no traffic."""
    months = place_traffic(edges, "origin_city", "destination_city", "fly_date")
    flights = F.coalesce("flightsFrom", F.lit(0)) + F.coalesce("flightsTo", F.lit(0))
    totals = months.select(F.col("place").alias("city"), "fly_date", flights.alias("flights"))
    changes = change_from_previous(totals, "city", "fly_date", "flights")
    return changes.withColumn("fly_month", F.substring("fly_date", 5, 2).try_cast("int"))


def seasonal_spikes(edges: DataFrame) -> DataFrame:
    """Average change from the month before, per city and calendar month, largest rise first."""
    spikes = _monthly_change(edges).na.drop(subset=["change"]).groupBy("city", "fly_month").agg(
        F.avg("change").alias("avg_change"), F.count("*").alias("years")
    )
    return spikes.orderBy(F.desc("avg_change"), "city", "fly_month")


def trend_breaks(edges: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Months whose change is at least ``threshold`` standard deviations off the usual one.

    The usual change is that of the same city and calendar month over all years.
    """
    season = Window.partitionBy("city", "fly_month")
    scored = _monthly_change(edges).withColumns({
        "usual_change": F.avg("change").over(season),
        "deviation": F.stddev_samp("change").over(season),
    })
    z = F.try_divide(F.col("change") - F.col("usual_change"), F.col("deviation"))
    scored = scored.select("city", "fly_date", "change", "usual_change", z.alias("z_score"))
    return scored.filter(F.abs("z_score") >= threshold)


def trend_spans(edges: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Spans of neighbouring months that all leave the usual trend, one row each, the largest departure first.

    ``departure`` is the sum of what the changes of the span's months lie above or below the usual ones.
    """
    spans = runs_of_months(
        trend_breaks(edges, threshold), "city", "fly_date",
        departure=F.sum(F.col("change") - F.col("usual_change")), largest_z=F.max(F.abs("z_score")),
    )
    return spans.orderBy(F.desc(F.abs("departure")), "city", "from")


def travel_trend(edges: DataFrame) -> DataFrame:
    """Per city the gradual gain or loss, as flights a year, and the biggest jump from one year to the next.

    The gain is the slope of a line through the yearly totals. A jump is a change between two years that follow one another, the
    biggest is that of the largest amount (the earlier of equals); null where no two such years have traffic.
    """
    ends = place_traffic(edges, "origin_city", "destination_city", "fly_year").filter(F.col("fly_year").isNotNull())
    flights = F.coalesce("flightsFrom", F.lit(0)) + F.coalesce("flightsTo", F.lit(0))
    years = ends.select(F.col("place").alias("city"), "fly_year", flights.alias("flights"))
    in_time = Window.partitionBy("city").orderBy("fly_year")  # as many rows as there are years
    follows = F.col("fly_year") - F.lag("fly_year").over(in_time) == 1
    jumped = years.withColumn("jump", F.when(follows, F.col("flights") - F.lag("flights").over(in_time)))
    biggest = F.when(F.col("jump").isNotNull(), F.struct(F.abs("jump"), -F.col("fly_year")))
    trends = jumped.groupBy("city").agg(
        F.count("*").alias("years"), F.sum("flights").alias("flights"),
        F.regr_slope(F.col("flights").cast("double"), F.col("fly_year").cast("double")).alias("yearly_change"),
        F.max_by("fly_year", biggest).alias("jump_year"), F.max_by("jump", biggest).alias("jump"),
    )
    return trends.orderBy(F.desc("yearly_change"), "city")


def travel_stepwise(edges: DataFrame, label: str = "passengers", steps: int | None = None) -> DataFrame:
    """Which fields, populations among them, explain travel, in the order in which each adds most."""
    return stepwise(edges, [name for name in TRAVEL_CANDIDATES if name != label], label, steps)


def travel_change(edges: DataFrame, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """Traffic per city in two years and the difference, biggest gain first."""
    years = place_traffic(
        edges.filter(in_years((first, last))), "origin_city", "destination_city", "fly_year"
    )
    flights = F.coalesce("flightsFrom", F.lit(0)) + F.coalesce("flightsTo", F.lit(0))

    def in_year(year: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("fly_year") == year, flights)), F.lit(0))

    totals = years.groupBy(F.col("place").alias("city")).agg(
        in_year(first).alias("first_year_flights"), in_year(last).alias("last_year_flights")
    )
    change = F.col("last_year_flights") - F.col("first_year_flights")
    return totals.withColumn("change", change).orderBy(F.desc("change"), "city")


def population_travel_correlation(edges: DataFrame) -> DataFrame:
    """Correlation of both populations with travel, all pairs in one pass."""
    pairs = [(population, measure) for population in POPULATIONS for measure in TRAVEL]
    row = edges.agg(*(
        F.struct(
            F.lit(population).alias("population"), F.lit(measure).alias("measure"),
            F.corr(population, measure).alias("correlation"),
        ).alias(f"{population}_{measure}")
        for population, measure in pairs
    ))
    return row.select(F.inline(F.array(*(f"{population}_{measure}" for population, measure in pairs))))
