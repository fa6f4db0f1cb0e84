"""Best-fit packing of token pieces into sequences, planned on the counts of lengths.

A piece above a third of the capacity can share its sequence with at most one other such piece. These
large pieces are paired first: from the longest down, each with the longest that still fits beside it.
Smaller pieces then go, longest first, into the tightest gap that holds them, and open a sequence only
where no gap does.

Pieces of one length are alike, so the plan needs how many there are of each, at most ``capacity``
numbers, whatever the number of documents. It comes as runs: so many pieces of a length, from such a
rank on, go to consecutive sequences at one offset. Their number is bounded by the capacity as well.
Pieces are numbered within their length by counts per slice of the documents and a window within slice
and length, so a length that many pieces share is spread over ``SLICES`` windows; then each piece
looks up its run. Token ids are not shuffled; ``cut`` can carry them for ``sequences``.

Defined cases: a null text is empty and packs its end id alone; null doc_ids and repeated rows are packed
like any others, each row by itself; ties take any order; an empty table gives no rows; texts of any
length are cut into pieces of the capacity, the last of them the rest.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from flightlens.llm.common import documents, id_and_text, written
from flightlens.llm.tokens import END_ID, encoder, vocabulary_path

CAPACITY = 4096
SLICES = 256
PIECES = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"


def cut(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    vocabulary: str | None = None, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """One row per piece of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32 (and ids)."""
    vocabulary = vocabulary or vocabulary_path()
    names = [field.split()[0] for field in PIECES.split(", ")] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:len(names)]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        for batch in batches:
            keys = iter(batch.column("doc_id").to_pylist())
            for whole, stops in words.runs(batch.column("text"), end_id):
                raw, rows, start = whole.tobytes(), [], 0
                for stop, key in zip((4 * stops).tolist(), keys):
                    for i, begin in enumerate(range(start, stop, 4 * capacity)):
                        ids = raw[begin:min(begin + 4 * capacity, stop)]
                        rows.append((key, i, (begin - start) // 4, len(ids) // 4, zlib.crc32(ids), ids)[:len(names)])
                    start = stop
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds)], names=names)

    return id_and_text(docs, id_col, text_col).mapInArrow(pieces, PIECES + ", ids BINARY" * with_ids)


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, pieces, first sequence, offset), and the number of sequences.

    Sequences with equal gaps are kept together as stretches of ids, so a step moves many at once.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    left, used = dict(counts), {length: 0 for length in counts}
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: stretches (first sequence, how many)
    sizes: list[int] = []  # the gaps there are, ascending
    sequences = 0

    def put(length: int, first: int, n: int, offset: int) -> None:
        runs.append((length, used[length], n, first, offset))
        used[length] += n
        left[length] -= n

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, n))

    large = sorted(length for length in counts if 3 * length > capacity and counts[length])
    for length in reversed(large):
        while left[length]:
            at = bisect.bisect_right(large, min(length, capacity - length)) - 1
            while at >= 0 and (not left[large[at]] or large[at] == length and left[length] < 2):
                at -= 1
            if at < 0:
                n = left[length]
                put(length, sequences, n, 0)
                leave(capacity - length, sequences, n)
            else:
                other = large[at]
                n = left[length] // 2 if other == length else min(left[length], left[other])
                put(length, sequences, n, 0)
                put(other, sequences, n, length)
                leave(capacity - length - other, sequences, n)
            sequences += n

    for length in sorted((x for x in counts if 3 * x <= capacity and counts[x]), reverse=True):
        while left[length]:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                fit = capacity // length
                n, fit = (left[length] // fit, fit) if left[length] >= fit else (1, left[length])
                for i in range(fit):
                    put(length, sequences, n, i * length)
                leave(capacity - fit * length, sequences, n)
                sequences += n
                continue
            gap = sizes[at]
            first, n = gaps[gap].pop()
            take = min(n, left[length])
            if take < n:
                gaps[gap].append((first + take, n - take))
            elif not gaps[gap]:
                del gaps[gap], sizes[at]
            put(length, first, take, capacity - gap)
            leave(gap - length, first, take)
    return np.array(sorted(runs), np.int64).reshape(-1, 5), sequences


def pack(pieces: DataFrame, capacity: int = CAPACITY, slices: int = SLICES) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset."""
    stored = written(pieces.withColumn("__slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)).cast("int")), "pieces")
    counts = stored.groupBy("length", "__slice").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    ahead = written(counts.withColumn("__ahead", F.coalesce(F.sum("__n").over(before), F.lit(0))), "lengths")
    lengths = ahead.groupBy("length").agg(F.sum("__n").alias("n")).collect()  # at most one row per length
    runs, _ = plan({row["length"]: row["n"] for row in lengths}, capacity)
    table = pieces.sparkSession.sparkContext.broadcast(runs)

    here = Window.partitionBy("__slice", "length").orderBy("doc_id", "piece")
    ranked = stored.withColumn("__here", F.row_number().over(here) - 1).join(
        ahead.select("length", "__slice", "__ahead"), ["length", "__slice"],
    ).select(*pieces.columns, (F.col("__here") + F.col("__ahead")).alias("__rank"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs = table.value
        keys = runs[:, 0] << 44 | runs[:, 1]
        for batch in batches:
            rank = batch.pop("__rank").to_numpy(np.int64)
            run = runs[np.searchsorted(keys, batch["length"].to_numpy(np.int64) << 44 | rank, "right") - 1]
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            yield batch.assign(sequence_id=run[:, 3] + rank - run[:, 1], offset=run[:, 4])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInPandas(place, f"{fields}, sequence_id BIGINT, offset BIGINT")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from packed pieces with their ids: at most ``capacity`` ids in a row."""
    in_order = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(in_order, F.lit(b""), lambda acc, piece: F.concat(acc, piece["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(cut(documents(spark, sf_dir)))
