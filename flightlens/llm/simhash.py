"""SimHash near-duplicates by deletion-variant signatures, and the components that links form.

Two 64-bit fingerprints that differ in at most ``distance`` bits differ in at most one bit of one of
``distance // 2 + 1`` segments. So each distinct fingerprint is indexed under every segment with every
single bit of it left out; linked fingerprints meet under an equal variant, and the whole distance is
then verified. Three bits need two segments of 32 bits and 64 entries per distinct fingerprint, where
equal segments alone would need four of 16 bits, each shared by far more strangers.

Entries are shuffled and sorted by variant, and a task streams through the runs of equal ones. From a run
it emits the links of a spanning forest, found by growing components: members once reached are not
compared again, so a dense run of copies costs little and never yields all its pairs. A run longer than
``RUN`` is passed on and worked off by pairs of blocks, in tasks of bounded size. No link between
fingerprints is lost to a cap.

Components are found with large-star and small-star steps (Kiveris et al., 2014) on tables written to the
shared folder; neither links nor fingerprints come to the driver. Copies of a fingerprint, however many,
are one node.

Defined cases: null and empty texts have fingerprint zero, linked like any other; a null doc_id is a
document whose id never counts as the smallest (a component of such alone has null); repeated rows come
out each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flightlens.llm.common import documents, id_and_text, written

WORDS = 3
DISTANCE = 3
SEED = 42
RUN = 1 << 16
SHINGLES = 1 << 16  # hashed at a time
SHORT = 8  # runs up to this length are compared pair by pair


def shingle_hashes(text: str | None, words: int = WORDS) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of words in order, repeats included, some at a time; A-Z in lower case."""
    split = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not split:
        return
    joined = b" ".join(split)
    ends = np.cumsum([len(word) + 1 for word in split])
    starts = np.concatenate([[0], ends[:-1]]).tolist()
    stops = (ends[min(words, len(split)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(stops), SHINGLES):
        some = stops[at:at + SHINGLES]
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + SHINGLES], some)], np.uint64)


def ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def majority(ones: np.ndarray, total: int) -> int:
    """The fingerprint as a signed 64-bit integer: the bits that over half of the hashes have."""
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def simhash(text: str | None, words: int = WORDS) -> int:
    """The fingerprint as a signed 64-bit integer."""
    count, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, words):
        count += ones(hashes)
        total += len(hashes)
    return majority(count, total)


def fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
) -> DataFrame:
    """(doc_id, fp), written."""
    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: simhash(text if isinstance(text, str) else None, words)).astype("int64")

    return written(id_and_text(docs, id_col, text_col).select("doc_id", fingerprint("text").alias("fp")), "fingerprints")


def variants(fp: Column, distance: int = DISTANCE) -> Column:
    """The keys of a fingerprint: number of segment and bit, and the segment without that bit."""
    segments = max(2, distance // 2 + 1)
    edges = [64 * i // segments for i in range(segments + 1)]
    keys = []
    for low, high in zip(edges, edges[1:]):
        part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for bit in range(high - low):
            without = part.bitwiseAND(F.lit(((1 << (high - low)) - 1) ^ (1 << bit)))
            keys.append(without.bitwiseOR(F.lit((low + bit) << 32)))
    return F.array(*keys)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b).view(np.uint64))


def forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever links of at most ``distance`` bits connect among ``fps``."""
    left, a, b = fps, [], []
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            here = reached.pop()
            near = _apart(left, here) <= distance
            if near.any():
                new = left[near]
                a.append(np.full(len(new), here))
                b.append(new)
                reached.extend(new)
                left = left[~near]
    return np.concatenate([*a, fps[:0]]), np.concatenate([*b, fps[:0]])


def links(distinct: DataFrame, distance: int = DISTANCE, run: int = RUN) -> DataFrame:
    """(a, b), a < b: links between distinct fingerprints (fp) that leave all components connected."""
    def in_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, fps, hot = np.empty(0, np.int64), np.empty(0, np.int64), None

        def work(keys: np.ndarray, fps: np.ndarray) -> Iterator[pd.DataFrame]:
            """Whole runs of equal keys."""
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(starts, len(keys)))
            a, b = [], []
            size = np.repeat(sizes, sizes)
            some = np.flatnonzero((size > 1) & (size <= SHORT))
            k, f = keys[some], fps[some]
            for step in range(1, SHORT):
                near = (k[step:] == k[:-step]) & (_apart(f[step:], f[:-step]) <= distance)
                a.append(f[:-step][near] if len(f) > step else f[:0])
                b.append(f[step:][near] if len(f) > step else f[:0])
            for at in np.flatnonzero(sizes > SHORT):
                x, y = forest(fps[starts[at]:starts[at] + sizes[at]], distance)
                a.append(x)
                b.append(y)
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):
                pairs = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()
                yield pairs.assign(hot=pd.array([None] * len(pairs), "Int64"))

        for batch in batches:
            keys, fps = np.append(keys, batch["key"].to_numpy(np.int64)), np.append(fps, batch["fp"].to_numpy(np.int64))
            if not len(keys):
                continue
            open_from = np.searchsorted(keys, keys[-1], "left")
            if hot is not None:  # the run that was passed on may go on
                rest = np.searchsorted(keys, hot, "right")
                yield pd.DataFrame({"a": fps[:rest], "b": fps[:rest], "hot": pd.array(keys[:rest], "Int64")})
                keys, fps, open_from = keys[rest:], fps[rest:], max(0, open_from - rest)
                hot = hot if not len(keys) else None
            if open_from:
                yield from work(keys[:open_from], fps[:open_from])
                keys, fps = keys[open_from:], fps[open_from:]
            if len(keys) > run:
                hot = int(keys[0])
                yield pd.DataFrame({"a": fps, "b": fps, "hot": pd.array(keys, "Int64")})
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            yield from work(keys, fps)

    entries = distinct.select("fp", F.explode(variants(F.col("fp"), distance)).alias("key"))
    found = written(
        entries.repartition("key").sortWithinPartitions("key").mapInPandas(in_runs, "a BIGINT, b BIGINT, hot BIGINT"), "links",
    )
    return found.where("hot IS NULL").select("a", "b").unionByName(_hot_links(found, distance, run)).distinct()


def _hot_links(found: DataFrame, distance: int, run: int) -> DataFrame:
    """Links in runs that were passed on: every pair of blocks of such a run is one group."""
    hot = found.where("hot IS NOT NULL").select("hot", F.col("a").alias("fp"))
    blocks = hot.groupBy("hot").agg(F.ceil(2 * F.count("*") / F.lit(run)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    paired = hot.join(blocks, "hot").withColumn("own", own).select(
        "hot", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select("hot", "fp", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = forest(rows["fp"].to_numpy(np.int64), distance)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return paired.groupBy("hot", "x", "y").applyInPandas(group, "a BIGINT, b BIGINT")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link in ``edges`` (a, b)."""
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(hashed: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The columns of ``hashed``, written fingerprints (doc_id, fp), then root and component_id."""
    distinct = written(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), distance))
    labelled = written(
        distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "roots",
    )
    least = written(labelled.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    known = written(labelled.join(least, "root").select("fp", "root", "component_id"), "components")
    return hashed.join(known, "fp").select(*hashed.columns, "root", "component_id")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(fingerprints(documents(spark, sf_dir)))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
