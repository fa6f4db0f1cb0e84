"""Token ids in files of bit-plane blocks.

Documents are encoded in ascending order of doc_id, each range of ids by one task, and the ids of a range
(a shard) are cut into blocks of ``BLOCK_IDS`` wherever documents end. A block is transposed into byte
planes (or single-bit planes): all lowest bytes, then all second ones, and so on. Planes are compressed
one by one with zstandard; a plane of zeros takes no bytes.

A folder of such blocks is a Parquet dataset with one row per block, so that Spark's committers write it
to any store and lost tasks leave nothing behind. The payload is the planes back to back. The other
columns are the chunk index: shard, block, the block's first id in its shard, its number of ids, the
plane lengths, and which stretch of it belongs to which document. Reading an index never touches a
payload, and any block decodes by itself.

Defined cases: a null text is empty, a null doc_id comes first; repeated rows and ties are written each,
in order of text; an empty table makes an empty dataset; a text of any length runs through as many
blocks as it needs; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from flightlens.llm.common import documents, id_and_text, new_path
from flightlens.llm.tokens import END_ID, encoder, vocabulary_path

BLOCK_IDS = 1 << 16
LEVEL = 3
BLOCKS = (
    "shard INT, block INT, first BIGINT, n_ids INT, plane_bytes ARRAY<INT>, "
    "parts ARRAY<STRUCT<doc_no: INT, doc_id: BIGINT, part: INT, at: INT, n: INT>>, payload BINARY"
)
BLOCK_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()), ("plane_bytes", pa.list_(pa.int32())),
    ("parts", pa.list_(pa.struct([("doc_no", pa.int32()), ("doc_id", pa.int64()), ("part", pa.int32()), ("at", pa.int32()), ("n", pa.int32())]))),
    ("payload", pa.binary()),
])
PARTS = "shard INT, doc_no INT, doc_id BIGINT, part INT, first BIGINT, n INT, ids BINARY"


def to_planes(ids: np.ndarray, bits: bool = False, level: int = LEVEL) -> list[bytes]:
    """A block's compressed planes, lowest first: 4 byte planes, or 32 bit planes with ``bits``."""
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        rows = np.unpackbits(rows, axis=1, bitorder="little")
        planes = [np.packbits(rows[:, i], bitorder="little") for i in range(32)]
    else:
        planes = [np.ascontiguousarray(rows[:, i]) for i in range(4)]
    pack = zstandard.ZstdCompressor(level=level)
    return [pack.compress(plane.tobytes()) if plane.any() else b"" for plane in planes]


def from_planes(payload: bytes, plane_bytes: list[int], n_ids: int) -> np.ndarray:
    """The ids of a block; the number of planes tells bytes from bits."""
    unpack, at, planes = zstandard.ZstdDecompressor(), 0, []
    bits = len(plane_bytes) == 32
    size = (n_ids + 7) // 8 if bits else n_ids
    for length in plane_bytes:
        raw = unpack.decompress(payload[at:at + length], max_output_size=size) if length else bytes(size)
        planes.append(np.frombuffer(raw, np.uint8))
        at += length
    if bits:
        columns = [np.unpackbits(plane, bitorder="little")[:n_ids] for plane in planes]
        return np.packbits(np.stack(columns, axis=1), axis=1, bitorder="little").reshape(-1).view("<u4")
    ids = np.zeros(n_ids, "<u4")
    for i, plane in enumerate(planes):
        if plane_bytes[i]:
            ids |= plane.astype("<u4") << np.uint32(8 * i)
    return ids


def write_tokens(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    end_id: int = END_ID, block_ids: int = BLOCK_IDS, bits: bool = False, level: int = LEVEL,
) -> None:
    """Encode ``docs`` in order of doc_id, ``end_id`` after each, and write the blocks to ``path``."""
    vocabulary = vocabulary or vocabulary_path()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, words = TaskContext.get().partitionId(), encoder(vocabulary)
        held, size, parts = [], 0, []  # the open block: stretches of ids, their count, whose they are
        block = doc_no = 0

        def close() -> pa.RecordBatch:
            planes = to_planes(np.concatenate(held), bits, level)
            row = (shard, block, block * block_ids, size, [len(p) for p in planes], parts, b"".join(planes))
            return pa.RecordBatch.from_arrays([pa.array([value], field.type) for value, field in zip(row, BLOCK_SCHEMA)], schema=BLOCK_SCHEMA)

        for batch in batches:
            keys = iter(batch.column("doc_id").to_pylist())
            for ids, stops in words.runs(batch.column("text"), end_id):
                done = 0
                for stop, key in zip(stops.tolist(), keys):
                    part = 0
                    while done < stop:
                        n = min(stop - done, block_ids - size)
                        parts.append({"doc_no": doc_no, "doc_id": key, "part": part, "at": size, "n": n})
                        held.append(ids[done:done + n])
                        size, done, part = size + n, done + n, part + 1
                        if size == block_ids:
                            yield close()
                            held, size, parts, block = [], 0, [], block + 1
                    doc_no += 1
        if size:
            yield close()

    ordered = id_and_text(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(blocks, BLOCKS).write.option("compression", "uncompressed").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document and block: shard, doc_no in it, doc_id, part, first id's place in the shard, n, ids."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, first, n_ids, planes, payload = (batch.column(name)[row].as_py() for name in ("shard", "first", "n_ids", "plane_bytes", "payload"))
                raw = from_planes(payload, planes, n_ids).tobytes()
                doc_no, doc_id, part, at, n = batch.column("parts")[row].values.flatten()
                starts, sizes = at.to_pylist(), n.to_pylist()
                columns = [
                    pa.repeat(pa.scalar(shard, pa.int32()), len(at)), doc_no, doc_id, part, pc.add(at.cast(pa.int64()), first), n,
                    pa.array([raw[4 * a:4 * (a + size)] for a, size in zip(starts, sizes)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "doc_no", "doc_id", "part", "first", "n", "ids"])

    return spark.read.schema(BLOCKS).parquet(path).mapInArrow(parts, PARTS)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, base): how many ids all shards before it have. From the index alone; one row per shard."""
    totals = spark.read.schema(BLOCKS).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def join_crc32(parts: pd.Series) -> pd.Series:
    """CRC-32 of stretches in a row from (part, n, crc) of each: CRCs are affine in the state before."""
    import zlib

    def of(row) -> int:
        whole = 0
        for i, part in enumerate(row):
            zeros = bytes(4 * part["n"])
            whole = part["crc"] if i == 0 else zlib.crc32(zeros, whole) ^ zlib.crc32(zeros) ^ part["crc"]
        return whole

    return parts.map(of)


def op2_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents, then describe each from what the files hold."""
    path = new_path(spark, "tokens")
    write_tokens(documents(spark, sf_dir), path)
    crc = F.pandas_udf(join_crc32, "long")
    parts = read_tokens(spark, path).select("shard", "doc_no", "doc_id", "part", "first", "n", F.crc32("ids").alias("crc"))
    whole = parts.groupBy("shard", "doc_no", "doc_id").agg(
        F.min("first").alias("first"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("part", "n", "crc"))).alias("parts"),
    )
    return whole.join(shard_starts(spark, path), "shard").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", crc("parts").alias("ids_crc32"),
    )
