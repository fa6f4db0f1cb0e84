from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flightlens.session import materialize


def row_numbers(df: DataFrame, *order: str | Column, name: str = "rank", start: int = 1) -> DataFrame:
    """Number all rows in an order, without bringing them into one partition.

    The rows are range-partitioned and sorted, and each notes its partition and its place there. A count per
    partition, the only thing that reaches the driver, gives by prefix sums how many rows come before a partition;
    that is added to the place. Sort expressions may be descending. Rows that tie in the whole order are numbered
    as they come, so name tie-breaks. The sorted rows are written once, as another evaluation could set the
    borders of the ranges elsewhere.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number holds the partition in its upper bits and the place in the lower 33.
    placed = materialize(spread.withColumn("_at", F.monotonically_increasing_id()), "in-order")
    part = F.shiftright("_at", 33)
    before, offsets = 0, {}
    for row in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():
        offsets[row["part"]] = before
        before += row["n"]
    if not offsets:
        return placed.select(*df.columns, F.lit(None).cast("long").alias(name))
    starts = F.array(*(F.lit(offsets.get(i, 0)).cast("long") for i in range(max(offsets) + 1)))
    number = F.element_at(starts, (part + 1).cast("int")) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + start
    return placed.select(*df.columns, number.alias(name))


def numbered(series: DataFrame, order: str, name: str = "month_index") -> DataFrame:
    """Number the rows of a series from 0."""
    return row_numbers(series, order, name=name, start=0).withColumn(name, F.col(name).cast("int"))


def runs_of_months(rows: DataFrame, key: str, month: str, **totals: Column) -> DataFrame:
    """Months (yyyymm text) of a key that follow one another, as one row each: first, last, number, and aggregates.

    Months of one run differ from their place in the sorted months by the same number. Months that are not
    numbers are left out; the months of a key, each there once, are bounded by the calendar.
    """
    number = F.substring(month, 1, 4).try_cast("int") * 12 + F.substring(month, 5, 2).try_cast("int")
    known = rows.withColumn("_month", number).filter(F.col("_month").isNotNull())
    island = F.col("_month") - F.row_number().over(Window.partitionBy(key).orderBy("_month"))
    return known.withColumn("_run", island).groupBy(key, "_run").agg(
        F.min(month).alias("from"), F.max(month).alias("to"), F.count("*").alias("months"),
        *(total.alias(name) for name, total in totals.items()),
    ).drop("_run")


def with_ticks(
    series: DataFrame, index: str, value: str, *, every: int, tick: float, label: str = "series"
) -> DataFrame:
    """Two chart series in one frame: the values, and a constant at every n-th index."""
    def row(name: str, height: Column) -> Column:
        return F.struct(F.lit(name).alias(label), height.cast("double").alias("value"))

    point = row(value, F.col(value))
    mark = row("tick", F.lit(tick))
    rows = F.when(F.col(index) % every == 0, F.array(point, mark)).otherwise(F.array(point))
    kept = [name for name in series.columns if name != value]
    return series.select(*kept, F.inline(rows))


def change_from_previous(series: DataFrame, key: str, month: str, value: str, name: str = "change") -> DataFrame:
    """Difference from the month before, for a row per key and month (yyyymm text).

    Null where the key has no row for the month before, the first one included, and where the
    month is not a number.
    """
    number = F.substring(month, 1, 4).try_cast("int") * 12 + F.substring(month, 5, 2).try_cast("int")
    by_month = Window.partitionBy(key).orderBy(number)
    follows = number - F.lag(number).over(by_month) == 1
    return series.withColumn(name, F.when(follows, F.col(value) - F.lag(value).over(by_month)))
