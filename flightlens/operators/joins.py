"""Joins without an equality key, rewritten so that Spark can hash and sort them.

Neither join builds a cross product, and neither hints a broadcast: which side is small enough is
left to Spark, which compares file sizes, and at run time measured shuffle sizes, with
``spark.sql.autoBroadcastJoinThreshold``. Beyond it the plans are sort-merge joins on the keys
made here, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import product
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from flightlens.functions import pieces
from flightlens.session import materialize

# Cells are wider than the band by this factor, so that rounding in the division below can never
# put two points closer than the band more than one cell apart.
CELL_MARGIN = 1.000001


def contains_join(
    long_df: DataFrame, long_col: str, short_df: DataFrame, short_col: str, *,
    equal: Sequence[tuple[str, str]] = (), lengths: Iterable[int] | None = None,
    expand: str = "values",
) -> DataFrame:
    """Inner join where the text ``long_col`` contains the text ``short_col``.

    A text contains another exactly when one of its distinct substrings equals it, so the join
    becomes an equality join on substrings. An empty short text matches every text that is not
    null; null matches nothing. ``equal`` adds pairs of columns that must be equal.

    expand="values" finds the matching pairs of distinct values first and joins both frames
    through them: for frames that repeat their values in many rows.
    expand="rows" cuts up every row of ``long_df``: for a list of places, each there once. Facts
    joined to it as ``short_df`` are neither copied nor read a second time.
    ``lengths`` limits the substrings to the lengths that short texts can have, if known.

    All columns of both frames are kept; their names must differ.
    """
    also = [(left, right) for left, right in equal]
    if expand == "rows":
        cut = long_df.withColumn("_piece", F.explode(pieces(long_col, lengths)))
        return _equi_join(cut, short_df, [("_piece", short_col), *also]).drop("_piece")
    if expand != "values":
        raise ValueError("expand is 'values' or 'rows'")

    keys = short_df.select(F.col(short_col).alias("_short")).distinct()
    found = (
        long_df.select(F.col(long_col).alias("_long")).distinct()
        .select("_long", F.explode(pieces("_long", lengths)).alias("_short"))
        .join(keys, "_short", "left_semi")
    )
    with_keys = _equi_join(long_df, found, [(long_col, "_long")]).drop("_long")
    return _equi_join(with_keys, short_df, [("_short", short_col), *also]).drop("_short")


def _equi_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    return left.join(right, [F.col(a) == F.col(b) for a, b in pairs])


def band_join(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], width: float,
) -> DataFrame:
    """Inner join where every pair of columns in ``on`` differs by less than ``width``.

    Both sides are put on a grid of cells one band wide; ``right``, which should be the smaller
    side, is entered in its own and all adjacent cells. Two points within the band therefore meet
    in exactly one cell, and the exact test is part of the join condition.
    """
    step = width * CELL_MARGIN

    def cell(column: str) -> Column:
        return F.floor(F.col(column) / step)

    names = [f"_cell{i}" for i in range(len(on))]
    gridded = left.withColumns({name: cell(a) for name, (a, _) in zip(names, on)})
    around = [
        F.struct(*(
            (cell(b) + shift).alias(f"_near{i}") for i, ((_, b), shift) in enumerate(zip(on, shifts))
        ))
        for shifts in product((-1, 0, 1), repeat=len(on))
    ]
    spread = right.select("*", F.inline(F.array(*around)))
    nears = [f"_near{i}" for i in range(len(on))]
    same_cell = [F.col(a) == F.col(b) for a, b in zip(names, nears)]
    inside = [F.abs(F.col(a) - F.col(b)) < width for a, b in on]
    return gridded.join(spread, same_cell + inside).drop(*names, *nears)


def nearest(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], width: float, *,
    key: str, candidate: str, widest: float = 1024.0,
) -> DataFrame:
    """For each ``key`` of ``left``, the small side, the closest ``candidate``, ties going to the smaller one.

    Points lie on grids of several levels at once: cells of the width, of twice the width, and so on until
    beyond ``widest``. One join asks, on all levels, which cells around a key hold a point, of which each
    cell keeps one; the least distance to those bounds the key's nearest. All points within the bound
    lie in the cells around the key on the first level that is as wide as the bound, and a second
    join compares just these. So there are two joins whatever the distances, and no job runs before
    the result is asked for. Candidates farther than the last level are not found; keys or
    candidates with a null coordinate are left out.
    """
    widths = [width]
    while widths[-1] <= widest:
        widths.append(2 * widths[-1])
    axes = range(len(on))
    cells = [f"_c{i}" for i in axes]
    keys = left.na.drop(subset=[a for a, _ in on]).select(F.col(key).alias("_key"), *(F.col(a).alias(f"_a{i}") for i, (a, _) in enumerate(on)))
    points = right.na.drop(subset=[b for _, b in on]).select(
        F.col(candidate).alias("_candidate"), *(F.col(b).alias(f"_b{i}") for i, (_, b) in enumerate(on)),
    )

    def in_cells(df: DataFrame, prefix: str) -> DataFrame:
        # Levels double the width, so the product is exact and the same on both sides.
        step = F.lit(width * CELL_MARGIN) * F.pow(F.lit(2.0), F.col("_level"))
        return df.select("*", *(F.floor(F.col(f"{prefix}{i}") / step).alias(cells[i]) for i in axes))

    def on_levels(df: DataFrame, prefix: str) -> DataFrame:
        return in_cells(df.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(widths) - 1))).alias("_level")), prefix)

    def around(df: DataFrame) -> DataFrame:
        for cell in cells:
            shifted = F.explode(F.sequence(F.col(cell) - 1, F.col(cell) + 1)).alias(cell)
            df = df.select(*(name for name in df.columns if name != cell), shifted)
        return df

    gaps = [F.col(f"_a{i}") - F.col(f"_b{i}") for i in axes]
    apart = F.sqrt(reduce(add, (gap * gap for gap in gaps)))
    filled = on_levels(points, "_b").groupBy("_level", *cells).agg(*(F.first(f"_b{i}").alias(f"_b{i}") for i in axes))
    near = around(on_levels(keys, "_a")).join(filled, ["_level", *cells])
    bounded = near.groupBy("_key", *(f"_a{i}" for i in axes)).agg(F.min(apart).alias("_bound"))
    level = reduce(lambda wider, k: F.when(F.col("_bound") <= widths[k], k).otherwise(wider), range(len(widths) - 2, -1, -1), F.lit(len(widths) - 1))
    sought = around(in_cells(bounded.withColumn("_level", level), "_a"))
    pairs = on_levels(points, "_b").join(sought, ["_level", *cells]).select("_key", "_candidate", apart.alias("_distance"))
    best = pairs.filter(F.col("_distance") < widths[-1]).groupBy("_key").agg(F.min(F.struct("_distance", "_candidate")).alias("_best"))
    return best.select(F.col("_key").alias(key), F.col("_best._distance").alias("distance"), F.col("_best._candidate").alias(candidate))


def many_to_many(left: DataFrame, right: DataFrame, on: Sequence[str], *, block: int = 4096) -> DataFrame:
    """Inner join of two frames that both repeat their keys, where one key alone may make very many pairs.

    The rows of every key are counted on both sides first. A key with more than ``block`` * ``block`` pairs is
    cut on both sides into blocks of about ``block`` rows, by a hash of the row; each block of the one side meets
    each block of the other under a key of its own, so the pairs are made by as many tasks as there are pairs of
    blocks. Rows of other keys are neither copied nor tagged. Adaptive execution splits a hot key on one side,
    by the bytes it has shuffled; it does not see the pairs.

    Rows equal in all columns stay in one block. Columns other than ``on`` must differ in name.
    """
    shared = set(left.columns) & set(right.columns) - set(on)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    counts = left.groupBy(*on).agg(F.count("*").alias("_left")).join(right.groupBy(*on).agg(F.count("*").alias("_right")), list(on))
    blocks = {name: F.ceil(F.col(name) / block).cast("int") for name in ("_left", "_right")}
    hot = materialize(counts.filter(F.col("_left") * F.col("_right") > block * block).select(*on, *(n.alias(name) for name, n in blocks.items())), "hot-keys")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        found = df.join(hot, list(on), "left")
        rows = found.withColumn("_own", F.coalesce(F.pmod(F.xxhash64(*df.columns), F.col(own)).cast("int"), F.lit(0)))
        others = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        pair = ("_own", "_other") if own == "_left" else ("_other", "_own")
        return rows.select(*df.columns, "_own", F.explode(others).alias("_other")).select(
            *df.columns, *(F.col(name).alias(f"_block{i}") for i, name in enumerate(pair)),
        )

    joined = dealt(left, "_left", "_right").join(dealt(right, "_right", "_left"), [*on, "_block0", "_block1"])
    return joined.drop("_block0", "_block1")


def as_of(
    left: DataFrame, right: DataFrame, on: Sequence[str], time: str, right_time: str, *, until: int, bucket: int, how: str = "inner",
) -> DataFrame:
    """Each row of ``left`` with the row of ``right`` of equal ``on`` that is last in time, not later than its own.

    ``right`` is the small side: of rows at the same time the greatest counts. Its rows are ordered by time, each is valid
    until the next one, and is entered in every bucket of time that it is valid in. So facts meet a row or two each under
    (``on``, bucket), an equality key that Spark can broadcast or split, and are neither sorted nor gathered by key:
    a key with a third of all facts is no slower than others.

    Times are whole numbers from 0 to below ``until`` (a minute of the day, say, with the day among ``on``), ``bucket`` of
    them in a bucket; rows at other times have no partner. how="left" keeps rows without an earlier reading, with nulls.
    """
    values = [name for name in right.columns if name not in on]
    shared = set(values) & set(left.columns)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    known = right.na.drop(subset=[*on, right_time]).filter((F.col(right_time) >= 0) & (F.col(right_time) < until))
    rest = [name for name in values if name != right_time]
    single = known.groupBy(*on, right_time).agg(F.max(F.struct(*rest)).alias("_row")) if rest else known.distinct()
    order = Window.partitionBy(*on).orderBy(right_time)
    span = single.withColumn("_next", F.lead(right_time).over(order))
    last = F.coalesce(F.col("_next") - 1, F.lit(until - 1))
    at = lambda moment: F.floor(moment / bucket)
    buckets = F.explode(F.sequence(at(F.col(right_time)), at(last))).alias("_bucket")
    valid = span.select(*on, F.col(right_time).alias("_from"), "_next", *(["_row"] if rest else []), buckets)
    right_side = valid.select(*(F.col(name).alias(f"_on{i}") for i, name in enumerate(on)), "_from", "_next", "_bucket", *(["_row"] if rest else []))
    same = [F.col(name) == F.col(f"_on{i}") for i, name in enumerate(on)] + [at(F.col(time)) == F.col("_bucket")]
    fits = (F.col("_from") <= F.col(time)) & (F.col("_next").isNull() | (F.col(time) < F.col("_next")))
    joined = left.join(right_side, reduce(and_, [*same, fits]), how)
    return joined.select(*left.columns, F.col("_from").alias(right_time), *(F.col("_row")[name].alias(name) for name in rest))
