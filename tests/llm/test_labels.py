"""Language ID and toxicity: held-out accuracy, the risk, and odd rows."""

import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flightlens.llm import language_id as lang, toxicity as tox

SF = "/root/testdata/sf0.01"


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


@pytest.fixture(scope="module")
def truth(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()}


def test_language_query(spark, truth):
    rows = lang.op9_language_id(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held) >= 0.98 * len(held)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, lang.op9_language_id(spark, SF).collect()))


def test_languages_of_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    model = lang.train(docs)
    found = {(r["doc_id"], r["text"]): (r["p"]["lang"], r["p"]["score"]) for r in docs.select("doc_id", "text", lang.predict(docs, model).alias("p")).collect()}
    for doc_id, text, *_ in odd_rows:
        pred, score = found[doc_id, text]
        has_letter = any(c.isalpha() for c in text or "")
        assert (pred == "und") == (not has_letter) and 0 <= score <= 1 and (has_letter or score == 0)
    empty = make_docs([])
    nothing = lang.train(empty)
    assert nothing.languages == []
    assert {r["p"]["lang"] for r in docs.select(lang.predict(docs, nothing).alias("p")).collect()} == {"und"}
    assert empty.select(lang.predict(empty, model).alias("p")).count() == 0


def test_many_languages_need_several_words(spark):
    """Seventy languages, each with letters of its own: masks of two words."""
    rng = random.Random(0)
    alphabets = {f"l{i:02d}": [chr(0x4E00 + 40 * i + j) for j in range(40)] for i in range(70)}
    rows = [(k, "".join(rng.choices(letters, k=60)), name) for k, (name, letters) in enumerate(alphabets.items()) for _ in range(3)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    model = lang.train(docs, places=1 << 16, least=1)
    assert model.masks.shape == (1 << 16, 2)
    got = docs.select("lang", lang.predict(docs, model).alias("p")).collect()
    assert all(r["lang"] == r["p"]["lang"] for r in got)


def test_filter_returns_all_owners():
    """A small, full filter errs; the correction knows by how much."""
    rng = np.random.default_rng(0)
    masks = np.zeros((1 << 10, 1), np.uint64)
    own = rng.integers(0, 1 << 62, 200)
    masks[lang.places_of(own, 1 << 10, 4).reshape(-1), 0] |= np.uint64(1)
    model = lang.LanguageFilter(["a"], masks, 4, 0)
    strange = rng.integers(0, 1 << 62, 20_000)
    wrong = np.bitwise_and.reduce(masks[lang.places_of(strange, 1 << 10, 4)], axis=0)[:, 0].mean()
    assert model.false_yes()[0] == pytest.approx(wrong, rel=0.15)
    assert np.bitwise_and.reduce(masks[lang.places_of(own, 1 << 10, 4)], axis=0).all()


def plain_languages(rows):
    """{doc_id: {lang: share of its trigrams that the lang owns}} with sets in place of the filter."""
    def spelt(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        padded = " " + " ".join(words) + " "
        grams = [padded[i:i + 3] for i in range(len(padded) - 2)]
        return [g for g in grams if g[1] != " "]

    counts = {}
    for _, text, name in rows:
        if name is not None:
            for g in spelt(text or ""):
                counts.setdefault(name, {}).setdefault(g, 0)
                counts[name][g] += 1
    totals = {name: sum(c.values()) for name, c in counts.items()}
    rates = {}
    for name, c in counts.items():
        for g, n in c.items():
            if n >= lang.LEAST:
                rates.setdefault(g, {})[name] = n / totals[name]
    owners = {g: {name for name, r in by.items() if r >= max(by.values()) * lang.OWNED} for g, by in rates.items()}
    return {i: {name: sum(name in owners.get(g, ()) for g in spelt(text or "")) / max(len(spelt(text or "")), 1) for name in counts} for i, text, _ in rows}


@pytest.mark.parametrize("least_places", [lang.PLACES, 64])
def test_filter_against_sets(spark, least_places):
    """Shares by the filter are those by sets, at its least size and at a size its owners ask for."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = sorted(map(tuple, docs.collect()))
    wanted = plain_languages(rows)
    model = lang.train(docs, least_places=least_places)
    assert least_places == lang.PLACES and len(model.masks) == lang.PLACES or 1 << 12 < len(model.masks) < lang.PLACES
    shares, _ = model.shares([text or "" for _, text, _ in rows], model.false_yes())
    off = np.abs(shares - [[wanted[i][name] for name in model.languages] for i, *_ in rows])
    assert off.max() < (1e-3 if least_places == lang.PLACES else 0.2) and off.mean() < 0.02


def test_trigrams():
    grams, owner, lettered = lang.trigrams(["Ab, cD", "", "1 2", "é"])
    spell = lambda g: "".join(chr(g >> s & 0x1FFFFF) for s in (42, 21, 0))
    assert [spell(int(g)) for g in grams] == [" ab", "ab ", " cd", "cd ", " é "]
    assert owner.tolist() == [0, 0, 0, 0, 3] and lettered.tolist() == [True, False, False, True]


def test_toxicity_query(spark):
    """On tables with few toxic rows: most are found, of the English ones, which share words, nearly all."""
    rows = {r["doc_id"]: r for r in tox.op4_toxicity(spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang").collect()}
    assert set(rows) == set(docs)
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())
    held = [(rows[x["doc_id"]], x["toxic"]) for x in labels if rows[x["doc_id"]]["held_out"] and docs[x["doc_id"]] == "en"]
    assert np.mean([r["predicted"] for r, y in held if y == 1]) >= 0.8
    assert np.mean([r["predicted"] for r, y in held if y == 0]) <= 0.03
    everywhere = [(rows[x["doc_id"]]["predicted"], x["toxic"]) for x in labels if rows[x["doc_id"]]["held_out"]]
    assert np.mean([p for p, y in everywhere if y == 1]) >= 0.75 and np.mean([p for p, y in everywhere if y == 0]) <= 0.05


def test_features():
    texts = ["vequx and vequx", "", "AND vequx", "1 2 3", "abc" * 20]
    who, what = tox.features(texts)
    sets = [set(what[who == i]) for i in range(5)]
    alone = [set(tox.features([t])[1]) for t in texts]
    assert sets == alone and sets[0] == sets[2] and not sets[1] and not sets[3]
    assert len(set(zip(who, what))) == len(who)


def test_non_negative_risk():
    """Positives carry a mark that a tenth of the unlabelled also have; noise features stay small."""
    rng = np.random.default_rng(0)
    n, f = 3000, 40
    positive = np.arange(n) < 500
    toxic = positive | (rng.random(n) < 0.1)
    x = rng.random((n, f)) < 0.3
    x[:, 0] = toxic & (rng.random(n) < 0.9)
    who, what = np.nonzero(x)
    weights, bias = tox.train_nnpu(who, what, n, f, positive, 0.1)
    score = x @ weights + bias
    assert (score[x[:, 0]] > 0).mean() > 0.95 and (score[~x[:, 0]] > 0).mean() < 0.02
    assert np.abs(weights[1:]).max() < weights[0] / 3


def test_toxicity_of_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    labels = spark.createDataFrame([(1, 1), (3, 0), (8, 1), (None, 1), (99, 1), (10, None)], "doc_id BIGINT, toxic INT")
    for learnt in (tox.train(docs, labels), tox.train(docs, labels.limit(0)), tox.train(make_docs([]), labels)):
        scores = [r["s"] for r in docs.select(tox.predict(docs, learnt).alias("s")).collect()]
        assert len(scores) == len(odd_rows) and all(0 <= s <= 1 for s in scores)
    assert make_docs([]).select(tox.predict(make_docs([]), learnt).alias("s")).count() == 0


def test_training_sees_no_label_of_held_out_rows(spark):
    """Scores stay the same when all held-out labels are turned round."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = lang.fold(F.col("doc_id"), 5) == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    models = [tox.train(docs.where(~held), table.where(~held)) for table in (labels, turned)]
    assert (models[0].weights == models[1].weights).all() and models[0].bias == models[1].bias
