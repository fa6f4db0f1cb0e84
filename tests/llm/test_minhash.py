"""The pipeline's near duplicates against brute force over shingles, from similarity 0.8 on."""

import random

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from flightlens.llm import minhash, simhash
from test_pipeline import SF, similar


def edited(rng, split, k):
    split = list(split)
    for at in rng.sample(range(len(split)), k):
        split[at] = f"new{rng.getrandbits(40)}"
    return split


def kept_ids(spark, make_docs, rows):
    return {r["doc_id"] for r in pipeline.near(spark, make_docs([(i, t, "en", "x") for i, t in rows]), SF).select("doc_id").collect()}


def test_planted_copies_from_0_8_are_found(spark, make_docs):
    rng = random.Random(3)
    rows, wanted, seen, pairs = [], set(), [], []
    for i in range(150):
        base = [f"word{rng.getrandbits(30)}" for _ in range(rng.choice([60, 400]))]
        pair = " ".join(base), " ".join(edited(rng, base, rng.randint(1, max(1, len(base) // 40))))
        seen.append(similar(*pair))
        rows += [(2 * i, pair[0]), (2 * i + 1, pair[1])]
    assert sum(0.8 <= s < 0.9 for s in seen) > 30 and sum(s < 0.8 for s in seen) > 5
    kept = kept_ids(spark, make_docs, rows)
    assert [len(kept & {2 * i, 2 * i + 1}) for i in range(150)] == [1 if s >= 0.8 else 2 for s in seen]


def test_group_leaves_one(spark, make_docs):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(i, base.replace(f"word{i * 7} ", f"other{i} ")) for i in range(1, 12)] + [(50, "something else entirely here now")]
    kept = kept_ids(spark, make_docs, rows)
    assert 50 in kept and len(kept) == 2


def check(texts, kept):
    """No two rows that stay are similar, and each that goes is similar to one that stays."""
    assert all(similar(texts[a], texts[b]) < 0.8 for a in kept for b in kept if a < b)
    assert all(any(similar(texts[i], texts[k]) >= 0.8 for k in kept) for i in set(texts) - kept)


def stay(make_docs, texts, **kwargs):
    gone = minhash.similar_to_kept(make_docs([(i, t, "en", "x") for i, t in texts.items()]), words=5, **kwargs)
    return set(texts) - {r["doc_id"] for r in gone.collect()}


@pytest.mark.parametrize("block", [3, 20, minhash.BLOCK])
def test_groups_of_short_edited_texts(spark, make_docs, block):
    """Copies that differ in two words of sixty are unlike each other in the main; keys are cut into blocks or not."""
    rng = random.Random(4)
    texts = {}
    for i in range(4):
        base = [f"word{rng.getrandbits(30)}" for _ in range(60)]
        texts |= {100 * i + j: " ".join(edited(rng, base, j % (i + 1))) for j in range(30)}
    kept = stay(make_docs, texts, block=block)
    check(texts, kept)
    assert len(kept & set(range(100))) == 1 and len(kept & set(range(300, 400))) > 5


@pytest.mark.parametrize("block", [2, minhash.BLOCK])
def test_drifting_group_leaves_no_two_similar_rows(spark, make_docs, block):
    """Edits pile up along a chain, so most rows are similar to their neighbours and few to the first."""
    rng = random.Random(5)
    split, texts = [f"word{i}" for i in range(200)], {}
    for i in range(40):
        texts[i] = " ".join(split)
        split = edited(rng, split, 1)
    kept = stay(make_docs, texts, block=block)
    assert 2 <= len(kept) < 20 and similar(texts[0], texts[39]) < 0.8
    check(texts, kept)


def test_pairs_grow_with_a_group_not_with_its_square(spark, make_docs):
    rng = random.Random(6)
    base = [f"word{rng.getrandbits(30)}" for _ in range(300)]
    made = {}
    for n in (100, 400):
        docs = make_docs([(i, " ".join(edited(rng, base, 2)), "en", "x") for i in range(n)])
        sketched = minhash.sketches(docs, 5)
        active = sketched.select("node", "sketch", "short", F.array().cast("array<bigint>").alias("tried"))
        made[n] = minhash.pairs(minhash.shared_keys(sketched), active, None, 1, None, 0.8)[0].count()
    assert 100 <= made[100] <= 40 * 100 and made[400] <= 6 * made[100]


def test_repeated_rows_and_ids(spark, make_docs):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text, "en", "x"), (1, text, "en", "x"), (None, text + " end", "en", "x"), (1, "quite another text", "en", "y"), (2, None, "en", "x"), (3, "", "en", "x")]
    out = pipeline.near(spark, make_docs(rows), SF).collect()
    texts = [r["text"] for r in out]
    assert texts.count("quite another text") == 1 and sum(not t for t in texts) == 1
    assert (texts.count(text), texts.count(text + " end")) in ((2, 0), (0, 1))


def test_simhash_links_make_candidates(spark):
    """Rows whose SimHashes are three bits apart, equal or linked to a third one meet, whatever their bands say."""
    fps = [0, 0b111, 0b111 << 20, -1, -1, 0b1111 << 40]
    rows = [(i, [100 + i], fp) for i, fp in enumerate(fps)]
    keys = minhash.shared_keys(spark.createDataFrame(rows, "node BIGINT, keys ARRAY<BIGINT>, fp BIGINT")).collect()
    met = {frozenset((a["node"], b["node"])) for a in keys for b in keys if a["key"] == b["key"] and a["node"] != b["node"]}
    assert met == {frozenset(pair) for pair in ((0, 1), (0, 2), (1, 2), (3, 4))}


def test_sketches_carry_the_simhash_of_the_stage(make_docs):
    texts = {1: "one two three four five six seven", 2: "", 3: None, 4: "one two"}
    docs = make_docs([(i, text, "en", "x") for i, text in texts.items()])
    got = {r["doc_id"]: r["fp"] for r in minhash.sketches(docs, 5).select("doc_id", "fp").collect()}
    assert got == {i: simhash.simhash(text, 5) for i, text in texts.items()}
