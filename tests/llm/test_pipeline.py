"""The pipeline: every stage against plain Python on its own input, and odd rows through all of them."""

import re
from collections import Counter

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from test_native import LOWER, fill
from test_simhash import plain_components
from test_tokens import check_packed

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=5):
    words = WORDS.findall((text or "").translate(LOWER))
    return [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)] * bool(words)


def similar(a, b):
    a, b = set(shingles(a)), set(shingles(b))
    return len(a & b) / len(a | b) if a or b else 1.0


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [df.collect() for df in out], [df.columns for df in out]


def test_columns(stages):
    assert all(columns == stages[1][0] for columns in stages[1][:-1])
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "source_mixing", "best_fit_packing"]


def test_language_stage(stages):
    before, after = stages[0][:2]
    assert Counter(after) == Counter(r for r in before if any(c.isalpha() for c in r["text"] or ""))


def test_exact_stage(stages):
    before, after = stages[0][1:3]
    last = {}
    for r in before:
        key = r["text"].translate(LOWER)
        last[key] = max(r["doc_id"], last.get(key, -1))
    assert sorted(r["doc_id"] for r in after) == sorted(last.values())


def test_near_stage(stages):
    """Every dropped row is similar to one that stays, no two that stay are similar, and no similar pair is missed."""
    before, after = stages[0][2:4]
    texts = {r["doc_id"]: set(shingles(r["text"])) for r in before}
    kept = {r["doc_id"] for r in after}
    likeness = lambda a, b: len(texts[a] & texts[b]) / max(1, len(texts[a] | texts[b]))
    assert len(kept) == len(after) < len(before)
    assert all(max(likeness(i, k) for k in kept) >= 0.8 for i in set(texts) - kept)
    assert all(likeness(a, b) < 0.8 for a in kept for b in kept if a < b)


def test_mixing_stage(stages):
    before, after = stages[0][3:5]
    size = {r["doc_id"]: len(WORDS.findall(r["text"])) for r in before}
    sizes = Counter()
    for r in before:
        sizes[r["source"]] += size[r["doc_id"]]
    target = fill(sizes, {s: i % 3 + 1 for i, s in enumerate(sorted(sizes))})
    taken = Counter()
    for r in after:
        taken[r["source"]] += size[r["doc_id"]]
    longest = max(size.values())
    assert all(abs(taken[s] - target[s]) <= longest for s in sizes)
    assert max(Counter(r["doc_id"] for r in after).values()) <= 3
    assert set(after) <= set(before)


def test_packing_stage(stages):
    before, after = stages[0][4:6]
    repeats = Counter(r["doc_id"] for r in before)
    assert Counter(r["doc_id"] for r in after if r["piece"] == 0) == repeats
    check_packed(after, [(r["doc_id"], r["text"]) for r in before], 4096)


def test_run(spark, stages):
    got = pipeline.run(spark, SF).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert Counter(got) == Counter(tuple(r)[:5] for r in stages[0][-1])


def test_odd_rows_and_no_rows(spark, make_docs, odd_rows, tmp_path):
    for name, rows in (("odd", odd_rows), ("none", [])):
        docs = make_docs(rows)
        for i, (_, stage) in enumerate(pipeline.STAGES):
            out = stage(spark, docs, SF)
            assert i == 4 or out.columns == docs.columns
            out.write.parquet(str(tmp_path / f"{name}{i}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}{i}"))
        assert (docs.count() > 0) == bool(rows)


def test_other_columns_keep_their_values(spark, make_docs, odd_rows):
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, make_docs(odd_rows), SF)
        others = [name for name in out.columns if name not in ("doc_id", "text", "lang", "source", "n_chars")]
        assert {value for row in out.select(*others).collect() for value in row} == {"other"}


def test_each_stage_alone_takes_odd_rows(spark, make_docs, odd_rows):
    for name, stage in pipeline.STAGES:
        rows = stage(spark, make_docs(odd_rows), SF).collect()
        if name in ("exact_dedup", "simhash_near_dedup"):
            assert Counter((r["doc_id"], r["text"]) for r in rows) <= Counter(r[:2] for r in odd_rows)
        assert rows


def test_mixing_keeps_repeated_rows_apart(spark, make_docs):
    rows = [(1, "a b c d", "en", "x")] * 2 + [(2, "e f", "en", "y"), (3, "g h i j k l", "en", "x"), (4, "m n o p", "en", "y")]
    docs = make_docs(rows, clashing=False)
    taken = Counter(r["doc_id"] for r in pipeline.mix(spark, docs, SF).collect())
    keyed = docs.select("doc_id", "text", "source")
    wanted = Counter()
    for r in pipeline.mixing.assign_positions(keyed).collect():
        wanted[r["doc_id"]] += sum(2 * c["words"] >= r["size"] for c in r["copies"])
    assert taken == wanted


def test_near_duplicates_of_a_group_leave_one(spark, make_docs):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(i, base.replace(f"word{i * 7} ", f"other{i} "), "en", "x") for i in range(1, 12)] + [(50, "something else entirely here now", "en", "x")]
    kept = {r["doc_id"] for r in pipeline.near(spark, make_docs(rows), SF).select(F.col("doc_id")).collect()}
    assert all(similar(rows[0][1], rows[i - 1][1]) >= 0.8 for i in range(1, 12))
    assert 50 in kept and len(kept) == 2
