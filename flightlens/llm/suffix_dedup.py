"""Removal of repeated byte strings by hashes of stretches at anchors, sorted in ranges.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier: in a smaller doc_id, or
further to the front of the same document. Not every suffix need be sorted for that: equal strings have
the same anchor (see ``windows``), so suffixes that start at anchors, about one in thirty, find all.

1. Sampled suffixes give splitters that range-partition suffixes by their leading eight bytes, one bucket
   for ``BUCKET_BYTES`` of text; past ``RANGES`` buckets a range has several, dealt by a hash of those bytes. A leading word that fills several buckets by itself is spread over
   them by hash, so a passage in a third of all documents does not fill one task.
2. A bucket is sorted by leading words, ties by hashes, so this is not full suffix order. Stretches
   of strings equal to an earlier one as a whole are repeated; of equal stretches only the first goes
   on. Each task has already done the same for its own stretches, so copies do not travel.
3. What is left undecided are edges of repeats: different stretches around equal anchors. Their bytes
   are cut from the texts, range-partitioned by the same splitters, sorted by 32 bytes, and their
   strings compared one by one with all others around that anchor. Where a leading word was spread,
   strings are compared on their own instead, dealt by their hashes.
4. Covered stretches of bytes are merged by document and cut out.

Equality is that of 64-bit hashes together with the leading bytes and a hash of the anchor (over 128 bits
in all). Between the tasks travel columns of numbers, compressed, in a row for each pair of task and
bucket. No task gathers more than its bucket.

Defined cases: a null text is empty; texts under ``LENGTH`` bytes are kept; a null doc_id counts as the
smallest; of different texts under one doc_id the order is that of their XXH64, and rows that repeat
doc_id and text are one document, decided alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from flightlens.llm.common import documents, id_and_text, whole, written
from flightlens.llm.windows import GRAM, LENGTH, Hashes, stretches

BUCKET_BYTES = 8 << 20
RANGES = 1 << 16  # at most, of leading words
SAMPLE_DOCS = 2000  # documents, about, from which splitters are drawn: more where there are over 8,000 ranges
SAMPLE_SUFFIXES = 64  # at most, of each of them
CHUNK = 1 << 20  # bytes of text worked on at a time; working them takes about fifty times as many
HELD = 48 << 20  # bytes of text a task holds back the records of
BEFORE_ALL = -(1 << 63)


def packed(**columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(columns, 5))


def unpacked(blobs) -> list[dict[str, np.ndarray]]:
    return [pickle.loads(zstandard.ZstdDecompressor().decompress(blob)) for blob in blobs]


def multikey_order(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by the keys, and the number of the run of rows equal in all of them at each place.

    Each further key is looked at for rows that tie in those before, as in multikey quicksort.
    """
    order = np.argsort(keys[0], kind="stable")
    run = _runs(keys[0][order])
    for key in keys[1:]:
        size = np.bincount(run, minlength=1)
        tied = np.flatnonzero(size[run] > 1)
        if not len(tied):
            break
        rows = order[tied]
        order[tied] = rows[np.lexsort((key[rows], run[tied]))]
        run = _runs(run, key[order])
    return order, run


def _runs(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


def _leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, in the order of bytes."""
    return np.lib.stride_tricks.sliding_window_view(data, 8)[at].copy().view(">u8").reshape(-1).astype(np.uint64)


class Splitters:
    """Buckets by leading word: ranges of words, each dealt by hash to as many buckets as its share of the text asks for.

    A word that is a splitter more than once owns the buckets of the ranges between. There are ``ranges`` at most, so
    what every task is sent is bounded, however many buckets there are.
    """

    def __init__(self, words: np.ndarray, buckets: int, ranges: int = RANGES):
        ranges = min(buckets, ranges)
        self.dealt = -(-buckets // ranges)
        at = np.linspace(0, len(words), ranges + 1)[1:-1].astype(int)
        self.cuts = np.sort(words)[at] if len(words) else np.empty(0, np.uint64)

    def of(self, words: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of each word, by the hash ``spread`` where it owns several ranges, and whether it does."""
        low, high = np.searchsorted(self.cuts, words, "left"), np.searchsorted(self.cuts, words, "right")
        several = high - low > 1
        mixed = (words ^ words >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
        own = np.where(several, high - low, 1).astype(np.uint64) * np.uint64(self.dealt)
        by = np.where(several, spread.astype(np.uint64), mixed ^ mixed >> np.uint64(32))
        return low * self.dealt + (by % own).astype(np.int64), several


def _chunks(texts: list[bytes], chunk: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the first, bytes, number of the text of each byte, where texts start): long texts alone."""
    start = 0
    while start < len(texts):
        stop, size = start + 1, len(texts[start])
        while stop < len(texts) and size + len(texts[stop]) <= chunk:
            size += len(texts[stop])
            stop += 1
        lengths = [len(text) for text in texts[start:stop]]
        owner = np.repeat(np.arange(start, stop, dtype=np.int32), lengths)
        yield start, np.frombuffer(b"".join(texts[start:stop]), np.uint8), owner, np.cumsum([0, *lengths])
        start = stop


def _suffixes(texts: list[bytes], chunk: int) -> dict[str, np.ndarray]:
    """All stretches of some texts: number of the text, place of the anchor, leading word, hashes."""
    out = [{"text": np.empty(0, np.uint32), "at": np.empty(0, np.uint32), "lead": np.empty(0, np.uint64), "gram": np.empty(0, np.uint32), "whole": np.empty(0, np.uint64)}]
    for first, data, owner, starts in _chunks(texts, chunk):
        hashes = Hashes(data)
        found = stretches(hashes, owner)
        if len(found.anchor):
            text = owner[found.anchor]
            out.append({
                "text": text.astype(np.uint32), "at": (found.anchor - starts[text - first]).astype(np.uint32), "lead": _leading(data, found.anchor),
                "gram": hashes.of(found.anchor, found.anchor + GRAM).astype(np.uint32), "whole": hashes.of(found.first, found.last + LENGTH),
            })
    return {name: np.concatenate([part[name] for part in out]) for name in out[0]}


def _scan(splitters: Splitters, chunk: int, held: int):
    """Step 1: blobs of stretches by bucket. Those equal to an earlier one of the task go as repeated."""
    def flush(rows: list[tuple], parts: list[dict]) -> Iterator[pd.DataFrame]:
        doc, tie, slice_ = (np.array([row[i] for row in rows], np.int64) for i in range(3))
        found = {name: np.concatenate([part.pop(name) for part in parts]) for name in ("text", "at", "lead", "gram", "whole")}
        place = np.empty(len(rows), np.uint32)
        place[np.lexsort((tie, doc))] = np.arange(len(rows))
        order = np.argsort(place[found["text"]], kind="stable")
        for name in found:
            found[name] = found[name][order]
        order, run = multikey_order(found["lead"], found["gram"], found["whole"])  # stable: earlier documents first
        for name in found:
            found[name] = found[name][order]
        del order
        again = np.zeros(len(run), bool)
        again[1:] = run[1:] == run[:-1]
        bucket, several = splitters.of(found["lead"], found["whole"])
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for a, b in zip(edges, np.append(edges[1:], len(order))):
            mine = order[a:b]
            new, old = mine[~again[mine]], mine[again[mine]]
            used, text = np.unique(found["text"][np.concatenate([new, old])], return_inverse=True)
            text = text.astype(np.uint32)
            yield pd.DataFrame({"bucket": [int(bucket[mine[0]])], "blob": [packed(
                doc=doc[used], tie=tie[used], slice=slice_[used].astype(np.int32), text=text[:len(new)], at=found["at"][new].astype(np.uint32),
                lead=found["lead"][new], gram=found["gram"][new], whole=found["whole"][new], several=several[new],
                old_text=text[len(new):], old_at=found["at"][old].astype(np.uint32),
            )]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, parts, size = {}, [], 0  # the documents of the open flush, numbered, and their stretches
        some, waiting = [], 0  # the texts not yet worked on, the last of the rows

        def work() -> None:
            part = _suffixes(some, chunk)
            part["text"] += np.uint32(len(rows) - len(some))
            parts.append(part)
            some.clear()

        for batch in batches:
            for doc, tie, slice_, text in zip(batch["doc"].tolist(), batch["tie"].tolist(), batch["slice"].tolist(), batch["text"]):
                if (doc, tie) in rows:
                    continue
                rows[doc, tie] = slice_
                some.append(text)
                size, waiting = size + len(text), waiting + len(text)
                if waiting >= chunk or size >= held:
                    work()
                    waiting = 0
                if size >= held:
                    yield from flush([(*key, slice_) for key, slice_ in rows.items()], parts)
                    rows, parts, size = {}, [], 0
        if rows:
            work()
            yield from flush([(*key, slice_) for key, slice_ in rows.items()], parts)

    return run


def _by_slice(doc, tie, slice_, at, undecided) -> Iterator[pd.DataFrame]:
    order = np.argsort(slice_, kind="stable")
    edges = np.flatnonzero(np.diff(slice_[order], prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(order))):
        mine = order[a:b]
        yield pd.DataFrame({"slice": [int(slice_[mine[0]])], "found": [packed(
            doc=doc[mine], tie=tie[mine], at=at[mine].astype(np.uint32), undecided=undecided[mine])]})


def _whole_stretches(rows: pd.DataFrame) -> pd.DataFrame:
    """Step 2, one bucket: stretches that are repeated as a whole, and the undecided, by slice of documents."""
    blobs = unpacked(rows["blob"])
    doc, tie, slice_ = (np.concatenate([b[name][b["text"]] for b in blobs]) for name in ("doc", "tie", "slice"))
    at, lead, gram, equal, several = (np.concatenate([b[name] for b in blobs]) for name in ("at", "lead", "gram", "whole", "several"))
    order, run = multikey_order(lead, gram, equal, doc, tie, at)
    once = np.flatnonzero(np.diff(_runs(run, doc[order], tie[order], at[order]), prepend=-1))  # rows repeated in other tasks or flushes
    order = order[once]
    doc, tie, slice_, at, lead, gram, equal, several = (x[order] for x in (doc, tie, slice_, at, lead, gram, equal, several))
    same = _runs(lead, gram, equal)
    repeated = np.zeros(len(same), bool)
    repeated[1:] = same[1:] == same[:-1]
    firsts = np.bincount(_runs(lead, gram), weights=~repeated)  # different stretches around an anchor
    undecided = ~repeated & ((firsts[_runs(lead, gram)] > 1) | several)
    some = repeated | undecided
    old = [np.concatenate([b[name][b["old_text"]] for b in blobs]) for name in ("doc", "tie", "slice")]
    old_at = np.concatenate([b["old_at"] for b in blobs])
    doc, tie, slice_, at = (np.concatenate([x[some], y]) for x, y in zip((doc, tie, slice_, at), (*old, old_at)))
    parts = _by_slice(doc, tie, slice_, at, np.concatenate([undecided[some], np.zeros(len(old_at), bool)]))
    return pd.concat([pd.DataFrame({"slice": pd.Series(dtype="int32"), "found": pd.Series(dtype=object)}), *parts])


SPAN_OR_EDGE = "bucket INT, doc BIGINT, tie BIGINT, start BIGINT, stop BIGINT, blob BINARY"


def _rows(**columns) -> pd.DataFrame:
    """Rows of SPAN_OR_EDGE with nulls in the columns not given; never by way of floats."""
    n = max((len(column) for column in columns.values()), default=0)
    made = {name: pd.array(columns.get(name, [None] * n), "Int64") for name in ("bucket", "doc", "tie", "start", "stop")}
    return pd.DataFrame(made | {"blob": pd.Series(columns.get("blob", [None] * n), dtype=object)})


def _merged(doc, tie, start, stop) -> pd.DataFrame:
    """Spans by document, those that touch as one."""
    if not len(doc):
        return pd.DataFrame({name: pd.Series(dtype="int64") for name in ("doc", "tie", "start", "stop")})
    order = np.lexsort((start, tie, doc))
    doc, tie, start, stop = doc[order], tie[order], start[order], stop[order]
    who = _runs(doc, tie)
    wide = int(max(stop.max(), 1)) + 1
    reach = np.maximum.accumulate(stop + who * wide) - who * wide  # the furthest stop so far of a document
    new = np.concatenate([[True], (who[1:] != who[:-1]) | (start[1:] > reach[:-1])])
    first = np.flatnonzero(new)
    return pd.DataFrame({"doc": doc[first], "tie": tie[first], "start": start[first], "stop": np.maximum.reduceat(stop, first)})


def _edges(splitters: Splitters, chunk: int):
    """Step 3, one slice of documents: spans of repeated stretches, and the undecided with their bytes."""
    def run(texts: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = unpacked(rows["found"])
        if not found:
            return _rows()
        found = {name: np.concatenate([f[name] for f in found]) for name in found[0]}
        texts = texts.drop_duplicates(["doc", "tie"]).sort_values(["doc", "tie"])
        doc, tie = texts["doc"].to_numpy(np.int64), texts["tie"].to_numpy(np.int64)
        text_of = pd.MultiIndex.from_arrays([doc, tie]).get_indexer(pd.MultiIndex.from_arrays([found["doc"], found["tie"]]))
        spans, out = [], []
        by_text = np.argsort(text_of, kind="stable")
        for first, data, owner, starts in _chunks(texts["text"].tolist(), chunk):
            last = first + len(starts) - 1
            mine = by_text[np.searchsorted(text_of[by_text], first):np.searchsorted(text_of[by_text], last)]
            if not len(mine):
                continue
            hashes = Hashes(data)
            all_ = stretches(hashes, owner)
            offset = starts[text_of[mine] - first]
            which = np.searchsorted(all_.anchor, offset + found["at"][mine])
            begin, end = all_.first[which], all_.last[which] + LENGTH
            spans.append((text_of[mine], begin - offset, end - offset, found["undecided"][mine]))
            some = np.flatnonzero(found["undecided"][mine])
            anchor, begin, end, offset, text = all_.anchor[which][some], begin[some], end[some], offset[some], text_of[mine][some]
            lead = _leading(data, anchor)
            bucket, several = splitters.of(lead, np.zeros(len(lead), np.uint64))
            for b in np.unique(bucket[~several]):
                i = np.flatnonzero((bucket == b) & ~several)
                out.append((int(b), packed(
                    doc=doc[text[i]], tie=tie[text[i]], at=anchor[i] - offset[i], before=(anchor - begin)[i], size=(end - begin)[i],
                    data=np.concatenate([data[x:y] for x, y in zip(begin[i], end[i])]),
                )))
            i = np.flatnonzero(several)
            if len(i):  # every string by itself
                n = end[i] - begin[i] - LENGTH + 1
                j = np.repeat(i, n)
                start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[j]
                value, gram = hashes.of(start, start + LENGTH), hashes.of(anchor[j], anchor[j] + GRAM)
                to, _ = splitters.of(lead[j], value)
                for b in np.unique(to):
                    k = np.flatnonzero(to == b)
                    out.append((int(b), packed(doc=doc[text[j[k]]], tie=tie[text[j[k]]], start=start[k] - offset[j[k]], value=value[k], gram=gram[k])))
        text, start, stop, undecided = (np.concatenate(x) for x in zip(*spans)) if spans else (np.empty(0, np.int64),) * 4
        sure = np.flatnonzero(~undecided.astype(bool))
        merged = _merged(doc[text[sure]], tie[text[sure]], start[sure], stop[sure])
        return pd.concat([_rows(**merged), _rows(bucket=[b for b, _ in out], blob=[blob for _, blob in out])])

    return run


def _strings(rows: pd.DataFrame) -> pd.DataFrame:
    """Step 3, one bucket: spans of strings around equal anchors that also start earlier."""
    blobs = unpacked(rows["blob"])
    spans = [_spread_strings([b for b in blobs if "value" in b]), _anchored_strings([b for b in blobs if "value" not in b])]
    return _merged(*(np.concatenate(x) for x in zip(*spans)))


def _spread_strings(blobs: list[dict]) -> tuple[np.ndarray, ...]:
    if not blobs:
        return (np.empty(0, np.int64),) * 4
    doc, tie, start, value, gram = (np.concatenate([b[name] for b in blobs]) for name in ("doc", "tie", "start", "value", "gram"))
    order, _ = multikey_order(value, gram, doc, tie, start)
    same = _runs(value[order], gram[order])
    again = order[1:][same[1:] == same[:-1]]
    return doc[again], tie[again], start[again], start[again] + LENGTH


def _anchored_strings(blobs: list[dict]) -> tuple[np.ndarray, ...]:
    if not blobs:
        return (np.empty(0, np.int64),) * 4
    doc, tie, at, before, size, data = (np.concatenate([b[name] for b in blobs]) for name in ("doc", "tie", "at", "before", "size", "data"))
    begin = np.cumsum(size) - size
    words = [_leading(data, begin + before + i) for i in range(0, GRAM, 8)]  # the suffixes' leading bytes
    order, _ = multikey_order(*words, doc, tie, at)
    doc, tie, at, before, size, begin = (x[order] for x in (doc, tie, at, before, size, begin))
    group = _runs(*(word[order] for word in words))
    hashes = Hashes(data)
    least, most = np.full(len(doc), LENGTH), np.full(len(doc), -1)
    for ahead in range(LENGTH - GRAM + 1):  # strings that start so far ahead of their anchor
        some = np.flatnonzero((before >= ahead) & (size - before + ahead >= LENGTH))
        start = begin[some] + before[some] - ahead
        value = hashes.of(start, start + LENGTH)
        by = np.lexsort((value, group[some]))  # stable: the first of equals is the earliest
        again = some[by[1:][(value[by][1:] == value[by][:-1]) & (group[some][by][1:] == group[some][by][:-1])]]
        least[again], most[again] = np.minimum(least[again], ahead), ahead
    hit = np.flatnonzero(most >= 0)  # starts at most LENGTH - GRAM apart, so these strings overlap
    return doc[hit], tie[hit], at[hit] - most[hit], at[hit] - least[hit] + LENGTH


def repeated_spans(docs: DataFrame, *, bucket_bytes: int = BUCKET_BYTES, chunk: int = CHUNK, held: int = HELD) -> DataFrame:
    """(doc, tie, spans) for ``docs`` (doc, tie, text as binary): array of (start, stop) in bytes, merged."""
    size = docs.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("bytes")).first()
    buckets = max(1, -(-size["bytes"] // bucket_bytes))
    sampled = max(SAMPLE_DOCS, min(buckets, RANGES) // 4)
    share = min(1.0, sampled / max(size["rows"], 1))

    def leads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = _suffixes(batch["text"].tolist(), chunk)
            for text in np.unique(found["text"]):
                lead = found["lead"][found["text"] == text]
                yield pd.DataFrame({"lead": lead[::max(1, -(-len(lead) // SAMPLE_SUFFIXES))].view(np.int64)})

    some = docs.where(F.pmod(F.xxhash64("doc", "tie", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = some.select("text").mapInPandas(leads, "lead BIGINT").toPandas()["lead"].to_numpy(np.int64).view(np.uint64)
    splitters = Splitters(sample, buckets)

    sliced = docs.withColumn("slice", F.pmod(F.xxhash64("doc", "tie"), F.lit(buckets)).cast("int"))
    scanned = sliced.select("doc", "tie", "slice", "text").mapInPandas(_scan(splitters, chunk, held), "bucket INT, blob BINARY")
    found = scanned.groupBy("bucket").applyInPandas(_whole_stretches, "slice INT, found BINARY")
    edges = written(
        sliced.select("slice", "doc", "tie", "text").groupBy("slice").cogroup(found.groupBy("slice"))
        .applyInPandas(_edges(splitters, chunk), SPAN_OR_EDGE), "edges",
    )
    strings = edges.where("bucket IS NOT NULL").groupBy("bucket").applyInPandas(_strings, "doc BIGINT, tie BIGINT, start BIGINT, stop BIGINT")
    spans = edges.where("bucket IS NULL").select("doc", "tie", "start", "stop").unionByName(strings)
    # A span that begins within those before it lengthens their run.
    in_order = Window.partitionBy("doc", "tie").orderBy("start", "stop")
    before = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = spans.withColumn("begins", F.coalesce(F.col("start") > before, F.lit(True)).cast("long"))
    runs = begins.withColumn("run", F.sum("begins").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = runs.groupBy("doc", "tie", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return written(merged.groupBy("doc", "tie").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans")), "spans")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans removed (start, stop in bytes), kept (the other bytes)."""
    text = whole()
    keyed = id_and_text(docs, id_col, text_col).select(
        "doc_id", F.coalesce("doc_id", F.lit(BEFORE_ALL)).alias("doc"), F.xxhash64(text).alias("tie"), text.cast("binary").alias("text"),
    )
    spans = repeated_spans(keyed.select("doc", "tie", "text"), **sizes)

    @F.pandas_udf("binary")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        def rest(text: bytes, some) -> bytes:
            if some is None or not len(some):
                return text
            edges = [0, *(edge for span in some for edge in (span["start"], span["stop"])), len(text)]
            return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
        return pd.Series([rest(text, some) for text, some in zip(texts, spans)])

    return keyed.join(spans, ["doc", "tie"], "left").select(
        "doc_id", F.length("text").cast("long").alias("n_bytes"), "spans", cut("text", "spans").alias("kept"),
    )


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed"),
        F.when(F.col("spans").isNull(), 0).otherwise(F.size("spans")).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
