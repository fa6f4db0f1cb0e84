"""Collocations from a weighted de Bruijn graph of words.

1. Sieve. One pass hashes every phrase of one to ``ORDER`` words into a table of 2 ** ``SIEVE_BITS`` counters, per task,
   and adds the tables up. What is counted less than ``min_count`` there is certainly rarer than that; the
   reverse need not hold, so the sieve saves work and decides nothing. It has a fixed size (one bit a counter,
   8 MB) whatever the corpus; where a corpus is so large that all its counters are full, everything passes.
2. Edges. A second pass takes from every word on the longest phrase that the sieve lets through: an edge of ``ORDER``
   words between two nodes of ``ORDER`` - 1 words that overlap, or, where a piece ends or nothing frequent goes on, a
   shorter one, the correction for occurrences that leave the graph there. Both are added up by their
   text in the task and again by Spark; an edge that turns out rare becomes a correction of its first node.
3. Paths. Nodes with one edge in and one out are compacted away: edges in a row become one path with an array of
   weights, by pointer doubling, in as many rounds as the longest path has binary digits. Edges on a circle of such
   nodes stay alone.
4. Counts. The flow out of a node, summed over paths, with its corrections is the count of its phrase; the flow of all nodes
   that begin with a shorter phrase, with that one's corrections, is the shorter phrase's count, and so on down to
   words. All counts of phrases that pass the sieve are exact.
5. Scores. A candidate is cut at each place; the lowest score counts. Candidates inside a longer one that takes up
   nearly all of their occurrences are dropped.

No phrase is compared with another but by joins on equal text, no group is gathered, and only the sieve comes to the driver.

Defined cases: a null text is empty; a null language is ``und``; repeated rows count each; a text of any length is one text;
ties are ordered by phrase; an empty table gives no rows; ids and other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from flightlens.llm.common import documents, ship, whole, written
from flightlens.llm.windows import mix

ORDER = 4
MIN_COUNT = 30
PERCENT = 80  # of a phrase's occurrences inside a longer one, from which on it is dropped
TOP = 2000
SIEVE_BITS = 26
CHUNK_BITS = 18
FAN_IN = 256  # tables added up by one task
SOME_BYTES = 8 << 20  # of text worked on at a time
SCALE = 2_000_000

_END = b"\xff"  # the end of a piece; no UTF-8 text has this byte
_LOWER = bytes.maketrans(bytes(range(65, 91)) + b"\t.,;:!?\n\x0b\x0c\r", bytes(range(97, 123)) + b" " + _END * 10)
_STEP = np.uint64(0x9E3779B97F4A7C15)
GRAMS = "lang STRING, gram STRING, words INT, n BIGINT"


class _Words:
    """The words of some texts in a row by number, 0 for the end of a piece. Texts are not kept, and a word is kept once."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[_END]
        self.codes: dict[str, int] = {}
        self.parts: list[np.ndarray] = []
        self.lang_of: list[int] = []
        self.size = 0  # bytes of text

    def add(self, text: bytes, lang: str) -> None:
        tokens = text.translate(_LOWER).replace(_END, b" \xff ").split()
        tokens.append(_END)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens)))
        self.lang_of.append(self.codes.setdefault(lang, len(self.codes)))
        self.size += len(text)

    def close(self) -> "_Words":
        self.number = np.concatenate(self.parts)
        self.lang = np.repeat(np.array(self.lang_of, np.int32), [len(part) for part in self.parts])
        self.known, self.langs = list(self.numbers), list(self.codes)
        del self.parts, self.lang_of, self.numbers
        return self

    def phrases(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1 to ``order`` words: a hash of the phrase from each place, and whether it lies within a piece."""
        hashed = np.array([xxhash.xxh64_intdigest(word) for word in self.known], np.uint64)
        seeds = np.array([xxhash.xxh64_intdigest(lang.encode(), 1) for lang in self.langs], np.uint64)
        hashes, alive = mix(hashed[self.number] ^ seeds[self.lang]), self.number != 0
        yield hashes, alive
        for k in range(1, order):
            with np.errstate(over="ignore"):
                hashes = hashes[:-1] * _STEP
                hashes += hashed[self.number[k:]]
            hashes, alive = mix(hashes), alive[:-1] & (self.number[k:] != 0)
            yield hashes, alive


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[_Words]:
    words = _Words()
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang")):
            words.add(text.as_py(), lang.as_py())
            if words.size >= SOME_BYTES:
                yield words.close()
                words = _Words()
    if words.parts:
        yield words.close()


def _count_into(order: int, bits: int, least: int):
    """Per task: (chunk, part, counts), the chunks of its table of counters, none above ``least``."""
    kind = np.min_scalar_type(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shift = np.zeros(1 << bits, kind), np.uint64(64 - bits)
        for words in _slices(batches):
            for hashes, alive in words.phrases(order):  # one length at a time bounds what is held
                slots, counts = np.unique((hashes[alive] >> shift).astype(np.uint32), return_counts=True)
                table[slots] = np.minimum(table[slots] + counts, least)
        yield from _as_rows({i: chunk for i, chunk in enumerate(table.reshape(-1, 1 << min(bits, CHUNK_BITS)))}, TaskContext.get().partitionId())

    return run


def _as_rows(chunks: dict[int, np.ndarray], part: int) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for i, chunk in chunks.items():
        if chunk.any():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([i], pa.int32()), "part": pa.array([part], pa.int64()), "counts": [pack.compress(chunk.tobytes())]})


def _add_up(bits: int, least: int):
    """Rows (chunk, part, counts) of some chunks and parts added up, one table at a time."""
    kind = np.min_scalar_type(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, sums = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for i, part, packed in zip(*(batch.column(name).to_pylist() for name in ("chunk", "part", "counts"))):
                counts = np.frombuffer(unpack.decompress(packed), kind)
                held = sums.get((i, part))
                sums[i, part] = counts if held is None else np.minimum(held.astype(np.uint64) + counts, least).astype(kind)
        for (i, part), counts in sums.items():
            yield from _as_rows({i: counts}, part)

    return run


def sieve(rows: DataFrame, order: int, min_count: int, bits: int) -> np.ndarray:
    """Bits of the slots that some phrases fill at least ``min_count`` times: 2 ** (bits - 3) bytes, on the driver."""
    schema = "chunk INT, part BIGINT, counts BINARY"
    tables = written(rows.mapInArrow(_count_into(order, bits, min_count), schema), "sieve")
    parts = (tables.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        parts = -(-parts // FAN_IN)  # no task adds up more than FAN_IN tables at once
        dealt = tables.withColumn("part", F.col("part") % parts).repartition("chunk", "part")
        tables = written(dealt.mapInArrow(_add_up(bits, min_count), schema), "sieve")
        if parts == 1:
            break
    kind, size = np.min_scalar_type(min_count), 1 << min(bits, CHUNK_BITS)

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.frombuffer(zstandard.decompress(c), kind) for c in batch.column("counts").to_pylist()]
            found = pa.array([np.packbits(c >= min_count, bitorder="little").tobytes() for c in counts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), found], names=["chunk", "full"])

    out = np.zeros((1 << bits) // 8, np.uint8).reshape(-1, size // 8)
    for row in tables.mapInArrow(full, "chunk INT, full BINARY").toLocalIterator():
        out[row["chunk"]] = np.frombuffer(row["full"], np.uint8)
    return out.reshape(-1)


def _longest(order: int, bits: int, passing: Broadcast):
    """(lang, gram, words, n): from each word on the longest phrase that passes; rows of no words count all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, shift = passing.value, np.uint64(64 - bits)
        for words in _slices(batches):
            n = len(words.number)
            deep, best = np.zeros(n, np.int8), np.zeros(n, np.uint64)
            for k, (h, alive) in enumerate(words.phrases(order)):
                at = np.flatnonzero(alive & (deep[:len(h)] == k))
                slots = h[at] >> shift
                at = at[(full[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1).astype(bool)]
                deep[at] = k + 1
                best[at] = h[at]
            at = np.flatnonzero(deep)
            at = at[np.argsort(best[at])]
            del best, h, alive
            new = np.zeros(len(at), bool)
            new[:1] = True
            columns = [words.lang[at], *(np.where(deep[at] > k, words.number[np.minimum(at + k, n - 1)], 0) for k in range(order))]
            for column in columns:
                new[1:] |= column[1:] != column[:-1]
            # Equal hashes of different phrases only part a run; Spark adds up by text.
            first = np.flatnonzero(new)
            rows = np.column_stack([column[first] for column in columns])
            counts, deep = np.diff(np.append(first, len(at))), deep[at[first]].astype(np.int64)
            del columns, new, at
            known = words.known
            grams = [b" ".join([known[w] for w in row[1:k + 1]]) for row, k in zip(rows.tolist(), deep.tolist())]
            langs = [words.langs[i] for i in rows[:, 0]]
            all_words = np.bincount(words.lang[words.number != 0], minlength=len(words.langs))
            yield pa.RecordBatch.from_arrays([
                pa.array(langs + words.langs, pa.string()), pa.array(grams + [b""] * len(words.langs), pa.binary()).cast(pa.string()),
                pa.array(np.append(deep, np.zeros(len(words.langs), np.int64)), pa.int32()), pa.array(np.append(counts, all_words), pa.int64()),
            ], names=["lang", "gram", "words", "n"])

    return run


def edges_and_ends(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", order: int = ORDER, min_count: int = MIN_COUNT,
    sieve_bits: int = SIEVE_BITS,
) -> DataFrame:
    """(lang, gram, words, n), written: edges of ``order`` words, corrections of fewer, and all words of a language (0)."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(whole(F.col(text_col)).cast("binary").alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    passing = spark.sparkContext.broadcast(sieve(rows, order, min_count, sieve_bits))
    found = rows.mapInArrow(_longest(order, sieve_bits, passing), GRAMS)
    return written(found.groupBy("lang", "gram", "words").agg(F.sum("n").alias("n")), "grams")


def _front(words: int, gram: str | Column = "gram") -> Column:
    return F.substring_index(gram, " ", words)


def _back(words: int, gram: str | Column = "gram") -> Column:
    return F.substring_index(gram, " ", -words)


def paths(edges: DataFrame, order: int = ORDER) -> DataFrame:
    """Edges (lang, gram, n) compacted: (lang, path, weights), the words of a path and the weight of each of its edges."""
    ends = edges.select("lang", F.inline(F.array(
        F.struct(_back(order - 1).alias("node"), F.lit(True).alias("comes"), F.col("gram")),
        F.struct(_front(order - 1).alias("node"), F.lit(False).alias("comes"), F.col("gram")),
    )))
    nodes = ends.groupBy("lang", "node").agg(
        F.count_if("comes").alias("comes"), F.count_if(~F.col("comes")).alias("goes"),
        F.max(F.when(F.col("comes"), F.col("gram"))).alias("before"), F.max(F.when(~F.col("comes"), F.col("gram"))).alias("gram"),
    )
    links = nodes.where((F.col("comes") == 1) & (F.col("goes") == 1) & (F.col("before") != F.col("gram"))).select("lang", "gram", "before")
    linked = edges.select("lang", "gram", "n").join(links, ["lang", "gram"], "left")
    # before: an edge further to the front, null at the first; steps: edges up to there.
    state = written(linked.select("lang", "gram", "n", F.coalesce("before", "gram").alias("head"), F.isnull("before").alias("done"),
                                  F.when(F.isnull("before"), 0).otherwise(1).cast("bigint").alias("steps")), "chains")
    open_edges = state.where("NOT done").count()
    while open_edges:
        there = state.select("lang", F.col("gram").alias("head"), F.col("head").alias("on"), F.col("done").alias("ends"), F.col("steps").alias("more"))
        moved = state.where("NOT done").join(there, ["lang", "head"]).select(
            "lang", "gram", "n", F.col("on").alias("head"), F.col("ends").alias("done"), (F.col("steps") + F.col("more")).alias("steps"),
        )
        state = written(state.where("done").unionByName(moved), "chains")
        left = state.where("NOT done").count()
        if left == open_edges:  # what is left runs in circles
            break
        open_edges = left
    alone = ~F.col("done")
    placed = state.select("lang", F.when(alone, F.col("gram")).otherwise(F.col("head")).alias("head"), F.when(alone, 0).otherwise(F.col("steps")).alias("steps"), "gram", "n")
    # The edges of a path are its own text; a path is as long as what texts share.
    rows = placed.groupBy("lang", "head").agg(F.array_sort(F.collect_list(F.struct("steps", "gram", "n"))).alias("edges"))
    more = F.transform(F.slice("edges", 2, F.greatest(F.size("edges") - 1, F.lit(0))), lambda edge: _back(1, edge["gram"]))
    return rows.select("lang", F.concat(F.split("head", " "), more).alias("path"), F.col("edges.n").alias("weights"))


def counts(grams: DataFrame, *, order: int = ORDER, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, gram, words, f), written: exact counts of all phrases that occur at least ``min_count`` times."""
    heavy = (F.col("words") == order) & (F.col("n") >= min_count)
    edges = grams.where(heavy)
    corrections = grams.where(~heavy & (F.col("words") > 0)).select(
        "lang", _front(order - 1).alias("gram"), F.least("words", F.lit(order - 1)).alias("words"), "n",
    )
    compact = written(paths(edges, order), "paths")
    starts = F.posexplode("weights").alias("at", "n")
    flow = compact.select("lang", "path", starts).select(
        "lang", F.concat_ws(" ", F.slice("path", F.col("at") + 1, order - 1)).alias("gram"), "n",
    )
    found = [edges.select("lang", "gram", "words", F.col("n").alias("f"))]
    for words in range(order - 1, 0, -1):
        ended = corrections.where(F.col("words") == words).select("lang", "gram", "n")
        nodes = written(flow.unionByName(ended).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "nodes")
        found.append(nodes.where(F.col("n") >= min_count).select("lang", "gram", F.lit(words).alias("words"), F.col("n").alias("f")))
        flow = nodes.select("lang", _front(words - 1).alias("gram"), "n")
    return written(reduce(DataFrame.unionByName, found), "counts")


def scored(grams: DataFrame, *, order: int = ORDER, min_count: int = MIN_COUNT, percent: int = PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all candidates that no longer one takes up."""
    known = counts(grams, order=order, min_count=min_count)
    candidates = known.where("words >= 2").select("lang", F.col("gram").alias("phrase"), "words", F.col("f").alias("a"))
    split = F.split("phrase", " ")
    inner = [(words, at) for words in range(2, order) for at in range(1, order - words + 2)]
    parts = F.array(*(
        F.when(F.col("words") >= at + words - 1, F.when(F.col("words") > words, F.concat_ws(" ", F.slice(split, at, words)))) for words, at in inner
    ))
    inside = candidates.select("lang", F.col("a").alias("longer"), F.explode(F.array_compact(parts)).alias("phrase"))
    longest = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    big = lambda name: F.col(name).cast("decimal(20,0)")
    taken_up = F.coalesce(big("longer") * 100 >= big("a") * percent, F.lit(False))
    stay = candidates.join(longest, ["lang", "phrase"], "left").where(~taken_up).select("lang", "phrase", "words", "a")
    cut = stay.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    part = lambda start, size: F.concat_ws(" ", F.slice(split, start, size))
    cut = cut.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"),
                     part(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    side = lambda name, count: known.select("lang", F.col("gram").alias(name), F.col("f").alias(count))
    cut = cut.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"])
    score = F.expr(f"cast(a AS decimal(20,0)) * {SCALE} div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))")
    lowest = cut.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("at"))
    sizes = grams.where("words = 0").select("lang", F.col("n").alias("all_words"))
    return lowest.join(sizes, "lang").select("lang", "phrase", "at.a", "at.l", "at.r", F.col("all_words").alias("n"), "at.score")


def best(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language with their rank; parts of a language are cut to ``top`` before they meet."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slots = F.lit(int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), slots)).orderBy(*order)
    few = phrases.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best(scored(edges_and_ends(documents(spark, sf_dir))))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), sizes AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM split GROUP BY lang
), spans AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split
), grams AS (
  SELECT lang, array_to_string(words[i:i + k - 1], ' ') AS gram, k FROM spans, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(words)
), known AS (
  SELECT lang, gram, k, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
  SELECT lang, gram AS phrase, string_split(gram, ' ') AS w, k AS words, f AS a FROM known WHERE k >= 2
), inside AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS s)
  WHERE m < words AND s + m - 1 <= words GROUP BY ALL
), stay AS (
  SELECT c.* FROM candidates c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 80 * c.a
), cuts AS (
  SELECT s.lang, s.phrase, s.a, x.k, l.f AS l, r.f AS r, (2000000 * s.a) // (l.f + r.f) AS score
  FROM stay s JOIN (SELECT unnest([1, 2, 3]) AS k) x ON x.k < s.words
  JOIN known l ON l.lang = s.lang AND l.gram = array_to_string(s.w[1:x.k], ' ')
  JOIN known r ON r.lang = s.lang AND r.gram = array_to_string(s.w[x.k + 1:s.words], ' ')
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM cuts
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM lowest WHERE o = 1
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
