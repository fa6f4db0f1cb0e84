from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from flightlens.functions import as_number, ratio_of_sums
from flightlens.operators.series import row_numbers


def total_by(df: DataFrame, *keys: str, measure: str = "flights", name: str = "number_of_flights") -> DataFrame:
    """sum(measure) per key. Spark adds up inside each task first, so a hot key moves few rows."""
    return df.groupBy(*keys).agg(F.sum(measure).alias(name))


def average_by(df: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    """avg(measure) per key; text such as ``NA`` counts as missing."""
    return df.groupBy(key).agg(F.avg(as_number(measure)).alias(name))


def ratio_by(df: DataFrame, key: str, **ratios: tuple[str, str]) -> DataFrame:
    """name=(top, bottom): sum(top)/sum(bottom) per key, all ratios in one aggregation."""
    return df.groupBy(key).agg(*(ratio_of_sums(*sides).alias(name) for name, sides in ratios.items()))


def ranked(
    df: DataFrame, measure: str, *ties: str, descending: bool = True, top: int | None = None, rank: bool = False
) -> DataFrame:
    """Order by a measure with named tie-breaks; ``top`` keeps the first rows only.

    ``rank`` adds each row's place as a column, for a result of any length and without a single partition.
    """
    first: Column = F.desc(measure) if descending else F.asc(measure)
    if rank:
        numbered = row_numbers(df, first, *ties)
        return numbered if top is None else numbered.filter(F.col("rank") <= top)
    out = df.orderBy(first, *ties)
    return out if top is None else out.limit(top)


def distinct_ranked(df: DataFrame, columns: Iterable[str], measure: str, *, descending: bool = True,
                    top: int | None = None, rank: bool = False) -> DataFrame:
    """Distinct rows of some columns, then ordered (the other way round loses the order)."""
    columns = list(columns)
    ties = [name for name in columns if name != measure]
    return ranked(df.select(*columns).distinct(), measure, *ties, descending=descending, top=top, rank=rank)


def union_by_position(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL of frames from different sources, matched by column position.

    Yearly files of one kind need no union: the readers take all their paths in one scan.
    """
    return reduce(DataFrame.union, frames)


def place_traffic(edges: DataFrame, origin: str, destination: str, *shared: str) -> DataFrame:
    """Flights from and to every place, in one pass over the edges.

    Each edge counts once for its origin and once for its destination, so the facts are read and
    shuffled once where two separate totals would do so twice. ``departs`` and ``arrives`` tell
    whether the place occurs on that end at all.
    """
    def end(column: str, departs: bool) -> Column:
        return F.struct(
            F.col(column).alias("place"),
            F.lit(departs).alias("departs"),
            F.col("flights").cast("long").alias("amount"),
        )

    ends = edges.select(*shared, F.inline(F.array(end(origin, True), end(destination, False))))
    return ends.groupBy("place", *shared).agg(
        F.sum(F.when(F.col("departs"), F.col("amount"))).alias("flightsFrom"),
        F.sum(F.when(~F.col("departs"), F.col("amount"))).alias("flightsTo"),
        F.bool_or(F.col("departs")).alias("departs"),
        F.bool_or(~F.col("departs")).alias("arrives"),
    )
