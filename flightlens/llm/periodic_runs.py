"""Periodic runs of words, by branching tandem repeats in an enhanced suffix array.

A run is a longest stretch of words that repeats with some period, the smallest one it has. Its last square
(two equal halves of ``d`` words) branches: the suffixes at its two halves agree in exactly ``d`` words. So
both lie in one LCP interval of depth ``d``, in different children of it. For every boundary of the
LCP array the interval around it is split there in two; each suffix of the smaller side is asked
whether the suffix ``d`` words after or before it lies on the other side, by its place in the inverse suffix
array. That is O(n log n) questions, and each branching square answers one. Intervals are pairs of numbers from a
scan with a stack; no tree is built.

A square found is rotated to the left as far as words go on repeating, which gives the run that it ends. Squares whose
half is itself a repetition give the same stretch again with a larger period; the smallest is kept.

Texts are worked on many at a time, one after another in one array with a word of its own after each, so
that no stretch reaches over the end of a text. Suffixes are sorted by doubled prefixes, ties alone from the second
round on. The ranks of each round stay, and give the LCP and the rotations in as many steps. A text
longer than ``SOME_WORDS`` is worked on alone, whole, with about 60 + 4 log2(longest repeat) bytes a word.

Defined cases: a null text has no words and no runs; a null doc_id is kept; repeated rows and ties come out each; a text
without white space is one word; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flightlens.llm.common import WORD, documents, id_and_text, whole

MIN_LENGTH = 6  # words of a run, and
MIN_EXPONENT = 4  # periods of a run, at least
SOME_WORDS = 1 << 17  # words worked on at a time
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Suffixes:
    """Suffix array, inverse and LCP of an array of small numbers; ``levels[k]`` ranks stretches of 2 ** k places."""

    def __init__(self, numbers: np.ndarray):
        n = len(numbers)
        order = np.argsort(numbers, kind="stable")
        sizes = np.bincount(numbers)
        rank = (np.cumsum(sizes) - sizes)[numbers]  # the first place of all that are equal so far
        self.levels, tied, width = [rank], order[(sizes > 1)[numbers[order]]], 1
        while len(tied):
            # Rank of what follows; past the end comes first.
            follows = np.where(tied + width < n, rank[np.minimum(tied + width, n - 1)], -1)
            by = np.argsort(rank[tied] * (n + 1) + follows + 1, kind="stable")
            tied, follows = tied[by], follows[by]
            old = rank[tied]
            new_group = np.concatenate([[True], old[1:] != old[:-1]])
            new_run = new_group | np.concatenate([[True], follows[1:] != follows[:-1]])
            at = np.arange(len(tied))
            place = old + at - np.maximum.accumulate(np.where(new_group, at, 0))
            order[place] = tied
            rank = rank.copy()
            rank[tied] = place[np.maximum.accumulate(np.where(new_run, at, 0))]
            alone = new_run & np.append(new_run[1:], True)
            tied, width = tied[~alone], 2 * width
            self.levels.append(rank)
        self.order, self.place = order, rank
        self.common = np.zeros(n, np.int64)  # of a suffix and the one before it in order
        same = np.flatnonzero(self.levels[0][order[1:]] == self.levels[0][order[:-1]]) + 1
        self.common[same] = self.agree(order[same - 1], order[same])

    def agree(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """How many places agree from a and b on, or with ``back`` before them (a < b)."""
        n, found = len(self.order), np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            step, level = 1 << k, self.levels[k]
            if back:
                x, y = a - found - step, b - found - step
                fits = x >= 0
            else:
                x, y = a + found, b + found
                fits = np.maximum(x, y) < n
            fits[fits] = level[x[fits]] == level[y[fits]]
            found += fits * step
        return found


def _splits(common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every boundary k with something in common: k, and the interval [left, right) that it splits there.

    All in [left, right) agree in common[k] places, and no suffix before k agrees with one after in more.
    """
    inner = np.flatnonzero(common > 0)
    if not len(inner):
        return inner, inner, inner
    first = np.concatenate([[True], inner[1:] != inner[:-1] + 1])
    last = np.append(first[1:], True)
    left, right = inner - 1, inner + 1
    longer = np.flatnonzero(~(first & last))  # boundaries that stand alone split just two suffixes
    if len(longer):
        depth = common[inner[longer]].tolist()
        starts = first[longer].tolist()
        lefts, rights = [0] * len(depth), [0] * len(depth)
        stack: list[int] = []
        for i, d in enumerate(depth):
            if starts[i]:
                for j in stack:
                    rights[j] = i
                stack = []
                begin = i
            while stack and depth[stack[-1]] >= d:
                rights[stack.pop()] = i
            lefts[i] = stack[-1] + 1 if stack else begin
            stack.append(i)
        for j in stack:
            rights[j] = len(depth)
        # From places in the list to places in the array: boundaries of one stretch lie side by side.
        at = np.arange(len(depth))
        place = inner[longer]
        left[longer] = place - (at - np.array(lefts)) - 1
        right[longer] = place + (np.array(rights) - at)
    return inner, left, right


def branching_squares(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(start, half) of every square whose halves agree in just their own length."""
    n, order, place = len(suffixes.order), suffixes.order, suffixes.place
    middle, left, right = _splits(suffixes.common)
    depth = suffixes.common[middle]
    lower = middle - left <= right - middle  # the side with fewer suffixes is asked
    begin, size = np.where(lower, left, middle), np.where(lower, middle - left, right - middle)
    of = np.repeat(np.arange(len(middle)), size)
    if not len(of):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start = order[begin[of] + np.arange(len(of)) - (np.cumsum(size) - size)[of]]
    d = depth[of]
    other_from, other_to = np.where(lower, middle, left)[of], np.where(lower, right, middle)[of]
    found = []
    for partner in (start + d, start - d):
        inside = (partner >= 0) & (partner < n)
        at = place[np.where(inside, partner, 0)]
        hit = inside & (at >= other_from) & (at < other_to)
        found.append((np.minimum(start, partner)[hit], d[hit]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def runs(numbers: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of the runs in an array of small numbers, by start and period."""
    if len(numbers) < 2:
        return np.empty((0, 3), np.int64)
    suffixes = Suffixes(numbers)
    start, half = branching_squares(suffixes)
    rotated = suffixes.agree(start, start + half, back=True)
    length = rotated + 2 * half
    start = start - rotated
    long = length >= np.maximum(min_length, min_exponent * half)
    start, length, half = start[long], length[long], half[long]
    by = np.lexsort((half, length, start))
    start, length, half = start[by], length[by], half[by]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    out = np.stack([start[least], length[least], half[least]], axis=1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _in_texts(split: list[list[bytes]], min_length: int, min_exponent: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of each text its runs, and which words stay when of every run only the first period does."""
    numbers, base = [], 0
    for words in split:
        known = dict.fromkeys(words)
        known = dict(zip(known, range(base, base + len(known))))
        numbers.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        base += len(known) + 1
        numbers.append(np.array([base - 1]))  # the word after a text
    ends = np.cumsum([len(words) + 1 for words in split])
    starts = ends - [len(words) + 1 for words in split]
    found = runs(np.concatenate(numbers), min_length, min_exponent)
    gone = np.zeros(ends[-1] + 1, np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 0] + found[:, 1], -1)
    stays = np.cumsum(gone) == 0
    cuts = np.searchsorted(found[:, 0], np.append(starts, ends[-1]))
    each = [found[a:b] - [first, 0, 0] for a, b, first in zip(cuts[:-1], cuts[1:], starts)]
    return each, [stays[a:b - 1] for a, b in zip(starts, ends)]


def _together(split: Iterator[list[bytes]], some: int) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for words in split:
        if held and size + len(words) > some:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def find_runs(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT, some: int = SOME_WORDS,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): runs by start and period, and the text with one period of each run."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, ids = 0, batch.column("doc_id")
            # Bytes: ASCII white space only.
            for split in _together(((text or b"").split() for text in batch.column("text").to_pylist()), some):
                found, stays = _in_texts(split, min_length, min_exponent)
                joined = [
                    b" ".join(words) if kept.all() else b" ".join([word for word, stay in zip(words, kept.tolist()) if stay])
                    for words, kept in zip(split, stays)
                ]
                flat = np.concatenate(found)
                values = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=["start", "length", "period"])
                offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(split)), pa.array([len(words) for words in split], pa.int64()),
                     pa.ListArray.from_arrays(offsets, values).cast(kind), pa.array(joined, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )
                at += len(split)

    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(work, f"doc_id BIGINT, n_words BIGINT, runs {RUNS}, collapsed STRING")


def _with_repeats(docs: DataFrame) -> DataFrame:
    """The query's input: in one of ten documents (by crc32 of the id) the words from some place on repeat."""
    docs = id_and_text(docs)
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(whole(), r"[\x20\x09-\x0D]+"), lambda word: word != "")
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    chosen = docs.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    a = g % n
    placed = chosen.withColumns({"a": F.when(n > 0, a), "p": F.when(n > 0, 1 + F.floor((n - a) / (3 + g % 8)))})

    def word(i: Column) -> Column:
        at = F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
        return F.element_at("words", (at + 1).cast("int"))

    repeated = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), n - 1), word))
    return placed.select("doc_id", F.when(n > 0, repeated).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, with digests; a null doc_id has no crc32, so its text is left as it is."""
    found = find_runs(_with_repeats(documents(spark, sf_dir)))
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    more = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    best = F.reduce("runs", none, lambda best, run: F.when(more(best, run), run).otherwise(best))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
