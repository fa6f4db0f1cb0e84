"""Mixing sources to target weights along a curriculum that changes over training time.

Each source has a weight schedule: a piecewise linear share over training time from 0 to 1. The words a
source gives up to time t are its target times the integral of its schedule to t, over the whole
integral. Within a source, documents come in a fixed pseudo-random order (MD5 of doc_id), pass after
pass. A document's copy begins at a known count of its source's words, and inverting the integral at
that count, a quadratic in closed form, gives its position in training. Sorting by position over
ranges then yields the training order of all sources at once.

Counts before a document are sums over slices of the order (one row per source and slice) plus a window
within a slice, so a source with any share of the rows is spread over ``SLICES`` windows. What runs in
one partition is one row per source. No text is shuffled.

Defined cases: a null text has no words; null is a source of its own, after all others; documents
without words, and all documents of a source without words, take nothing and stand at their source's
place with copies empty; repeated rows and ties are documents of their own in any order; an empty
table gives no rows; ``rest`` names further columns to carry, which may not begin with two underscores.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from flightlens.llm.common import WORD, documents, whole, written

MAX_PASSES = 3
SLICES = 1024
# (time, relative weight) knots. By default even sources rise and odd ones fall, by place in the order of names.
RISING = ((0.0, 0.5), (1.0, 1.5))
FALLING = ((0.0, 1.5), (0.5, 0.75), (1.0, 0.75))


def word_count(text: str = "text") -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, max_passes: int = MAX_PASSES, cycle: int = 3) -> DataFrame:
    """Targets of sources (source, source_size), weighing 1 to ``cycle`` in order of their names.

    Together they are the sum of all sizes. A target stops at ``max_passes`` times its size and what
    it leaves goes to the others by weight. Those that stop are the first by size over weight, so
    one ordered pass over the sources finds them: it is one row per source, never the documents.
    """
    everything = Window.partitionBy(F.lit(0))
    named = sizes.withColumn(
        "place", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1,
    ).withColumn("weight", F.col("place") % cycle + 1)
    by_need = everything.orderBy((F.col("source_size") / F.col("weight")), "place")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    open_from = named.select(
        "*", F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum(F.col("source_size") * max_passes).over(before), F.lit(0)).alias("stopped"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("open_weight"),
    ).withColumn(
        # If this source and all after it are open, do they stay under their own limit?
        "fits", (F.col("total") - F.col("stopped")) * F.col("weight") <= F.col("source_size") * max_passes * F.col("open_weight"),
    )
    first_open = F.min(F.when(F.col("fits"), F.struct("stopped", "open_weight"))).over(everything)
    share = (F.col("total") - F.col("cut.stopped")) * F.col("weight") / F.col("cut.open_weight")
    limit = F.col("source_size") * max_passes
    fair = F.when(
        (F.col("total") - F.col("cut.stopped")) * F.col("weight") <= limit * F.col("cut.open_weight"), share,
    ).otherwise(limit.cast("double"))
    return open_from.withColumn("cut", first_open).select("source", "source_size", "place", fair.alias("target"))


def _pieces(knots: Sequence[tuple[float, float]]) -> Column:
    """Linear pieces of a schedule: start time, length, weight at both ends, integral before; all over the integral."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    total = sum(areas)
    return F.array(*(
        F.struct(F.lit(t0).alias("t"), F.lit(t1 - t0).alias("span"), F.lit(w0 / total).alias("w0"),
                 F.lit(w1 / total).alias("w1"), F.lit(sum(areas[:i]) / total).alias("before"))
        for i, ((t0, w0), (t1, w1)) in enumerate(zip(knots, knots[1:]))
    ))


def position_of(share: Column, pieces: Column) -> Column:
    """The training time by which a schedule has given ``share`` of its words: its integral inverted."""
    def invert(piece: Column) -> Column:
        slope = (piece["w1"] - piece["w0"]) / piece["span"]
        need = share - piece["before"]
        # w0 x + slope x^2 / 2 = need, in the form that also holds for slope 0
        root = F.sqrt(F.greatest(piece["w0"] * piece["w0"] + 2 * slope * need, F.lit(0.0)))
        return piece["t"] + F.least(F.coalesce(F.try_divide(2 * need, piece["w0"] + root), F.lit(0.0)), piece["span"])

    return F.aggregate(pieces, F.lit(0.0), lambda acc, piece: F.when(share > piece["before"], invert(piece)).otherwise(acc))


def assign_positions(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    schedules: Mapping[str, Sequence[tuple[float, float]]] | None = None, rest: Sequence[str] = (),
    max_passes: int = MAX_PASSES, slices: int = SLICES,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, then ``rest``.

    copies: array of (copy, words, position). The copy at which a source's target ends gives only its
    first words; all others are whole. ``schedules`` by source name replace the default ones.
    """
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    sized = written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
        key.alias("__order"), F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * slices / F.lit(1 << 32)).cast("int").alias("__slice"),
        *rest,
    ), "sized")
    slice_sizes = written(sized.groupBy("source", "__slice").agg(F.sum("size").alias("__sum")), "slices")
    targets = source_targets(slice_sizes.groupBy("source").agg(F.sum("__sum").alias("source_size")), max_passes)
    upto = Window.partitionBy("source").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    ahead = slice_sizes.withColumn("__ahead", F.coalesce(F.sum("__sum").over(upto), F.lit(0)))
    known = ahead.join(targets.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).select(
        F.col("source").alias("__source"), F.col("__slice").alias("__of"), "__ahead", "source_size", "place", "target",
    )
    here = Window.partitionBy("source", "__slice").orderBy("__order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("__here", F.coalesce(F.sum("size").over(here), F.lit(0))).join(
        written(known, "known"), F.col("source").eqNullSafe(F.col("__source")) & (F.col("__slice") == F.col("__of")),
    ).withColumn("__start", F.col("__ahead") + F.col("__here"))

    pieces = F.when(F.col("place") % 2 == 0, _pieces(RISING)).otherwise(_pieces(FALLING))
    for name, knots in (schedules or {}).items():
        pieces = F.when(F.col("source") == name, _pieces(knots)).otherwise(pieces)
    wanted = F.floor("target")

    def copy(number: Column) -> Column:
        begins = number * F.col("source_size") + F.col("__start")
        return F.struct(
            number.cast("int").alias("copy"),
            F.greatest(F.least(F.col("size"), wanted - begins), F.lit(0)).cast("long").alias("words"),
            position_of(F.try_divide(begins.cast("double"), F.col("target")), F.col("__pieces")).alias("position"),
        )

    copies = F.filter(F.transform(F.sequence(F.lit(0), F.lit(max_passes - 1)), copy), lambda c: c["words"] > 0)
    return placed.withColumn("__pieces", pieces).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), *rest,
    )


def training_order(assigned: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per copy taken, sorted by position over ranges: partitions in order are the training order."""
    copies = assigned.select("*", F.explode("copies").alias("__copy")).select(
        *(c for c in assigned.columns if c != "copies"), "__copy.copy", "__copy.words", "__copy.position",
    )
    spread = ["position", "doc_id", "copy"]
    ranged = copies.repartitionByRange(partitions, *spread) if partitions else copies.repartitionByRange(*spread)
    return ranged.sortWithinPartitions(*spread)


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, and the place of its first copy in billionths of the training."""
    mixed = assign_positions(documents(spark, sf_dir))
    first = F.aggregate("copies", F.lit(None).cast("double"), lambda least, c: F.least(least, c["position"]))
    rows = mixed.select(
        "doc_id", "size", "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda taken, c: taken + c["words"]).alias("taken"),
        F.floor(first * 1e9).alias("first_place"),
    )
    return rows.repartitionByRange("first_place", "doc_id").sortWithinPartitions("first_place", "doc_id")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(doc_id::VARCHAR) AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source
), w AS (SELECT *, place % 3 + 1 AS weight, sum(source_size) OVER ()::BIGINT AS total FROM s
), c AS (
  SELECT *, coalesce(sum(3 * source_size) OVER before, 0)::BIGINT AS stopped,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS open_weight
  FROM w WINDOW before AS (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), cut AS (
  SELECT stopped, open_weight FROM c WHERE (total - stopped) * weight <= 3 * source_size * open_weight ORDER BY stopped, open_weight LIMIT 1
), t AS (
  SELECT source, source_size, place,
         CASE WHEN (total - cut.stopped) * weight <= 3 * source_size * cut.open_weight
              THEN ((total - cut.stopped) * weight)::DOUBLE / cut.open_weight::DOUBLE ELSE (3 * source_size)::DOUBLE END AS target
  FROM c, cut
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.place,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, list_sum([greatest(least(size, floor(target)::BIGINT - n * source_size - begins), 0) FOR n IN [0, 1, 2]])::BIGINT AS taken,
         begins / target AS share
  FROM p
)
SELECT doc_id, size::BIGINT AS size, source_size, target, taken,
       CASE WHEN taken > 0 THEN floor(1e9 * CASE
         WHEN place % 2 = 0 THEN
           CASE WHEN share > 0 THEN least(2 * share / (0.5::DOUBLE + sqrt(greatest(0.5::DOUBLE * 0.5::DOUBLE + 2 * 1.0::DOUBLE * share, 0))), 1.0::DOUBLE) ELSE 0 END
         WHEN share > 0.6 THEN 0.5::DOUBLE + least(2 * (share - 0.6::DOUBLE) / (0.8::DOUBLE + sqrt(0.8::DOUBLE * 0.8::DOUBLE)), 0.5::DOUBLE)
         WHEN share > 0 THEN least(2 * share / (1.6::DOUBLE + sqrt(greatest(1.6::DOUBLE * 1.6::DOUBLE + 2 * ((0.8::DOUBLE - 1.6::DOUBLE) / 0.5::DOUBLE) * share, 0))), 0.5::DOUBLE)
         ELSE 0 END)::BIGINT END AS first_place
FROM e
"""
