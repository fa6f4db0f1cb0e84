"""Near duplicates down to a Jaccard similarity of 0.8: SimHash links and MinHash bands for candidates, texts for the decision.

Rows are candidates where their SimHashes of the same shingles differ in three bits or fewer, as ``simhash.links`` finds:
the two ends of a link share a key, and so do all that are linked to one fingerprint and rows of equal ones. Three bits
end at a similarity of about 0.98; bands reach the rest.

A text has ``BANDS * ROWS`` minima of its shingles' hashes, each under another permutation. Two texts of
similarity s agree in all minima of a band with chance s ** ROWS, so they meet under the key of some band
with chance 1 - (1 - s ** ROWS) ** BANDS: 0.9994 at 0.8, more above, and a half at 0.6.

Rows that share a key are worked off in rounds. A round streams through the runs of equal keys, rows that are known to
stay first, the others in the order of a hash. The first row leads; rows after it whose sketches (a byte of every
minimum) agree with it by ``LOOSE`` follow it and are paired with it, the next one that follows nobody leads, and
so on. So a row is compared with leaders alone, and a run of n copies gives n - 1 pairs, not n * n.

Texts of up to ``SHORT`` shingles carry the hashes of these, by which unlike rows are told apart at once; a sketch
of so few shingles says little.

- All pairs are compared by their texts' shingles. A pair that is unlike is not made again.
- A row that is in no pair as a follower stays: it is unlike all rows that stay and share a key with it.
- A row similar to one that stays is dropped. A row similar to an undecided one waits for it, and runs again
  only if all that it waits for are dropped. The others run again, with sixteen times as many leaders to try.

The first of the rows that run can only be paired with rows that stay, so every round decides something; the order is
that of a hash, so chains of rows that wait for each other are short. A key with more than ``BLOCK``
rows is cut into blocks that run by themselves; what does not wait then meets in another round, and so on, until no key is
cut; only then rows are found to stay. Rows are dropped only for a similar row that stays, and no two that stay share
a key and are similar.

Defined cases: null and empty texts are alike (1.0); a null doc_id is an id of its own; rows that repeat doc_id and
text are one and decided alike; texts of any length are compared whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from flightlens.llm.common import id_and_text, whole, written
from flightlens.llm.simhash import WORDS, links, majority, ones, shingle_hashes

BANDS = 40
ROWS = 8
LOOSE = 0.7  # of the sketch; four and a half standard deviations under 0.8
SHORT = 256  # shingles of a text whose hashes are kept beside its sketch
BLOCK = 4096
HASHED = 1024  # shingles under all permutations at a time
_RANDOM = np.random.default_rng(42)
_ODD = (_RANDOM.integers(0, 1 << 31, BANDS * ROWS).astype(np.uint32) * np.uint32(2) + np.uint32(1))
_FLIP = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, np.uint64).astype(np.uint32)


def minima(text: str | None, words: int) -> tuple[np.ndarray, bytes | None, int]:
    """The least hash of the text's shingles under each permutation, the largest number where it has none;
    the hashes of up to ``SHORT`` shingles themselves; and the SimHash."""
    least = np.full(len(_ODD), np.iinfo(np.uint32).max)
    short: np.ndarray | None = np.empty(0, np.uint32)
    count, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, words):
        count += ones(hashes)
        total += len(hashes)
        upper = (hashes >> np.uint64(32)).astype(np.uint32)
        short = None if short is None or len(upper) > 8 * SHORT else np.unique(np.concatenate([short, upper]))
        short = None if short is None or len(short) > SHORT else short
        for at in range(0, len(upper), HASHED):
            mixed = (upper[at:at + HASHED] ^ _FLIP[:, None]) * _ODD[:, None]
            np.minimum(least, (mixed ^ mixed >> np.uint32(15)).min(axis=1), out=least)
    return least, None if short is None else short.tobytes(), majority(count, total)


def sketches(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tie, node, keys, sketch, short, fp), written: the keys of the bands, a byte of every minimum, short texts'
    hashes, the SimHash."""
    @F.pandas_udf("keys array<bigint>, sketch binary, short binary, fp bigint")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        keys, bytes_, shorts, fps = [], [], [], []
        for text in texts:
            least, short, fp = minima(text if isinstance(text, str) else None, words)
            shorts.append(short)
            fps.append(fp)
            bands = least.reshape(BANDS, ROWS)
            keys.append(np.array([xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(bands)], np.uint64).view(np.int64))
            bytes_.append((least * _ODD[0] >> np.uint32(24)).astype(np.uint8).tobytes())
        return pd.DataFrame({"keys": keys, "sketch": bytes_, "short": shorts, "fp": pd.Series(fps, dtype="int64")})

    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64(whole()).alias("tie"), sketch("text").alias("s"))
    return written(rows.select("doc_id", "tie", F.xxhash64("doc_id", "tie").alias("node"), "s.keys", "s.sketch", "s.short", "s.fp"), "sketches")


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (key, node), sorted by both, of keys that more than one node has; equal rows once."""
    before = None
    for batch in batches:
        rows = batch if before is None else pd.concat([before, batch])
        rows = rows.drop_duplicates(["key", "node"])
        last = rows["key"].to_numpy()[-1] if len(rows) else None
        # The last row waits for the next batch; a row whose key has been given out already is marked.
        key, out = rows["key"].to_numpy(), rows["out"].to_numpy()
        again = np.zeros(len(key), bool)
        again[1:] |= key[1:] == key[:-1]
        again[:-1] |= key[1:] == key[:-1]
        yield rows[again & ~out][["key", "node"]]
        before = rows[-1:].assign(out=again[-1:] | out[-1:]) if last is not None else None


def _unlike(a: bytes | None, b: bytes | None, similar: float) -> bool:
    """Whether the hashes of two short texts show that they are not similar."""
    if a is None or b is None:
        return False
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    shared = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
    return shared < similar * (len(x) + len(y) - shared)


def _follow(sketch: np.ndarray, kept: int, tries: int, apart) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Places (followers, leaders) in a run: the first ``kept`` rows lead, and so does who follows nobody.

    ``apart`` tells of two places whether they are known not to be similar.
    """
    need, follows = LOOSE * sketch.shape[1], np.zeros(len(sketch), np.int64)
    left, a, b = np.arange(kept, len(sketch)), [], []
    for i in range(len(sketch)):
        if follows[i]:
            continue
        left = left[left > i]
        if not len(left):
            break
        near = left[(sketch[left] == sketch[i]).sum(axis=1) >= need]
        near = near[[not apart(i, r) for r in near.tolist()]] if len(near) else near
        if len(near):
            follows[near] += 1
            a.append(near)
            b.append(np.full(len(near), i))
            left = left[follows[left] < tries]
    return a, b


def _in_runs(tries: int, similar: float):
    """Pairs (a, b) of a follower and its leader from rows sorted by key, block, whether open, and node."""
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        node, open_ = rows["node"].to_numpy(np.int64), rows["open"].to_numpy(bool)
        starts = np.flatnonzero(_new(rows))
        ends = np.append(starts[1:], len(rows))
        sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
        tried = [None if known is None or not len(known) else set(known) for known in rows["tried"]]
        short = rows["short"].tolist()

        def apart(leader: int, row: int) -> bool:
            return tried[row] is not None and node[leader] in tried[row] or _unlike(short[leader], short[row], similar)

        two = starts[(ends - starts == 2) & open_[ends - 1]]
        near = two[(sketch[two] == sketch[two + 1]).sum(axis=1) >= LOOSE * sketch.shape[1]]
        near = np.array([i for i in near.tolist() if not apart(i, i + 1)], np.int64)
        a, b = [near + 1], [near]
        for start, end in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist()):
            here = lambda i, r, at=start: apart(at + i, at + r)
            found = _follow(sketch[start:end], int((~open_[start:end]).sum()), tries, here)
            a += [start + places for places in found[0]]
            b += [start + places for places in found[1]]
        return pd.DataFrame({"a": node[np.concatenate(a)], "b": node[np.concatenate(b)]}).drop_duplicates()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            begins = np.flatnonzero(_new(batch))
            same = bool(held) and batch["key"].iloc[0] == held[-1]["key"].iloc[-1] and batch["block"].iloc[0] == held[-1]["block"].iloc[-1]
            if same and len(begins) == 1:  # one run goes on through the whole batch
                held.append(batch)
                continue
            cut = begins[-1]
            whole_runs = pd.concat([*held, batch[:cut]], ignore_index=True)
            if len(whole_runs):
                yield work(whole_runs)
            held = [batch[cut:]]
        if held:
            yield work(pd.concat(held, ignore_index=True))

    return run


def _new(rows: pd.DataFrame) -> np.ndarray:
    new = np.ones(len(rows), bool)
    new[1:] = False
    for name in ("key", "block"):
        column = rows[name].to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return new


def simhash_keys(sketched: DataFrame) -> DataFrame:
    """(key, node): a key for each SimHash that some row has, of its rows and of those linked to it.

    Keys follow links, not components, so rows under a key are all near its fingerprint, however long links chain on.
    """
    fps = written(sketched.groupBy("fp").agg(F.count("*").alias("rows")), "fps")
    linked = written(links(fps.select("fp")), "linked")
    ends = linked.select(F.inline(F.array(*(F.struct(F.col(x).alias("centre"), F.col(y).alias("fp")) for x in "ab" for y in "ab"))))
    ends = ends.unionByName(fps.where("rows > 1").select(F.col("fp").alias("centre"), "fp")).distinct()
    return sketched.select("fp", "node").join(ends, "fp").select(F.xxhash64(F.lit("simhash"), "centre").alias("key"), "node")


def shared_keys(sketched: DataFrame) -> DataFrame:
    """(key, node), written: keys of SimHash links and of bands that more than one row has."""
    entries = sketched.select(F.explode("keys").alias("key"), "node").unionByName(simhash_keys(sketched))
    entries = entries.repartition("key").sortWithinPartitions("key", "node")
    return written(entries.withColumn("out", F.lit(False)).mapInPandas(_shared, "key BIGINT, node BIGINT"), "shared")


def pairs(entries: DataFrame, active: DataFrame, kept: DataFrame | None, tries: int, block: int | None, similar: float) -> tuple[DataFrame, bool]:
    """Pairs (a, b) of rows of ``active`` and their leaders, written, and whether a key was cut into blocks."""
    mine = entries.join(active.select("node", "sketch", "short", "tried"), "node").withColumn("open", F.lit(True))
    theirs = None
    if kept is not None:
        theirs = entries.join(kept, "node").join(mine.select("key").distinct(), "key", "left_semi").select(
            "key", "node", "sketch", "short", F.lit(None).cast("array<bigint>").alias("tried"), F.lit(False).alias("open"),
        )
    hot = None
    if block is not None:
        hot = written(mine.groupBy("key").count().where(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "hot")
        hot = None if hot.isEmpty() else hot
    if hot is None:
        mine = mine.withColumn("block", F.lit(0))
        theirs = None if theirs is None else theirs.withColumn("block", F.lit(0))
    else:
        blocks = F.coalesce("blocks", F.lit(1))
        mine = mine.join(hot, "key", "left").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).drop("blocks")
        if theirs is not None:  # rows that stay meet every block, once each
            theirs = theirs.join(hot, "key", "left").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("blocks")
    columns = ["key", "block", "open", "node", "sketch", "short", "tried"]
    rows = mine.select(*columns) if theirs is None else mine.select(*columns).unionByName(theirs.select(*columns))
    runs = rows.repartition("key", "block").sortWithinPartitions("key", "block", "open", "node")
    return written(runs.mapInPandas(_in_runs(tries, similar), "a BIGINT, b BIGINT").distinct(), "pairs"), hot is not None


def _distinct(text: str, words: int) -> np.ndarray:
    return np.unique(np.concatenate([*shingle_hashes(text, words), np.empty(0, np.uint64)]))


def _jaccard(x: np.ndarray, y: np.ndarray) -> float:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared / max(1, len(x) + len(y) - shared) if len(x) or len(y) else 1.0


def similarity(words: int):
    """Jaccard similarity of the shingles of two columns of texts, repeats once."""
    @F.pandas_udf("double")
    def of(a: pd.Series, b: pd.Series) -> pd.Series:
        leader = lru_cache(maxsize=16)(lambda text: _distinct(text, words))  # the same for many rows on end
        return pd.Series([_jaccard(_distinct(x, words), leader(y)) for x, y in zip(a, b)], dtype="float64")

    return of


def similar_to_kept(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similar: float = 0.8, block: int = BLOCK,
) -> DataFrame:
    """(doc_id, tie) of rows to drop, each similar to a row that stays; ``tie`` is XXH64 of the text."""
    sketched = sketches(docs, words, id_col, text_col)
    entries = shared_keys(sketched)
    some = sketched.join(entries.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    left = written(some.select("node", "sketch", "short", F.array().cast("array<bigint>").alias("tried"), F.lit(False).alias("waits")), "open")
    texts = id_and_text(docs, id_col, text_col).select(F.xxhash64("doc_id", F.xxhash64(whole())).alias("node"), whole().alias("text"))
    texts = written(texts.join(left.select("node"), "node", "left_semi").dropDuplicates(["node"]), "texts")
    a_text, b_text = (texts.select(F.col("node").alias(name), F.col("text").alias(f"{name}_text")) for name in "ab")
    kept = dropped = waits_for = None
    tries, size, before = 1, block, None
    while not left.isEmpty():
        active = left.where("NOT waits")
        n = active.count()
        if before is not None and 2 * n > before:
            size = None  # most rows lead, so blocks no longer help: one run for each key
        found, cut = pairs(entries, active, kept, tries, size, similar)
        size, before = (block, n) if cut else (block, None)
        compared = found.join(a_text, "a").join(b_text, "b").sortWithinPartitions("b").select("a", "b", similarity(words)("a_text", "b_text").alias("s"))
        compared = written(compared, "compared")
        alike = compared.where(F.col("s") >= similar).select("a", "b")
        waits_for = alike if waits_for is None else waits_for.unionByName(alike)
        if not cut:
            leads = written(active.join(found.select(F.col("a").alias("node")).distinct(), "node", "left_anti").select("node", "sketch", "short"), "leads")
            kept = leads if kept is None else kept.unionByName(leads)
        decided = None if kept is None else kept.select("node")
        if kept is not None:
            gone = written(waits_for.join(kept.select(F.col("node").alias("b")), "b", "left_semi").select(F.col("a").alias("node")).distinct(), "gone")
            dropped = gone if dropped is None else dropped.unionByName(gone)
            decided = decided.unionByName(dropped)
            waits_for = waits_for.join(dropped.select(F.col("node").alias("a")), "a", "left_anti").join(dropped.select(F.col("node").alias("b")), "b", "left_anti")
        waits_for = written(waits_for, "links")
        unlike = compared.where(F.col("s") < similar).groupBy(F.col("a").alias("node")).agg(F.collect_set("b").alias("more"))
        waiting = waits_for.select(F.col("a").alias("node"), F.lit(True).alias("waiting")).distinct()
        rest = left if decided is None else left.join(decided, "node", "left_anti")
        more = F.coalesce("more", F.array().cast("array<bigint>"))
        left = written(rest.join(unlike, "node", "left").join(waiting, "node", "left").select(
            "node", "sketch", "short", F.concat("tried", more).alias("tried"), F.coalesce("waiting", F.lit(False)).alias("waits"),
        ), "open")
        tries *= 16
    out = sketched.select("doc_id", "tie", "node")
    if dropped is None:
        return out.where(F.lit(False)).select("doc_id", "tie")
    return out.join(dropped, "node", "left_semi").select("doc_id", "tie").distinct()
