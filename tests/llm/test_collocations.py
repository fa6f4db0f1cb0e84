"""Collocations against plain counting, whatever the sieve lets through; paths; arithmetic beyond 64 bits; SQL."""

import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import duckdb
import pyarrow as pa
import pytest

from flightlens.llm import collocations
from flightlens.llm.collocations import OP11_SQL, best, counts, edges_and_ends, op11_phrase_collocations, paths, scored

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_grams(rows, order):
    found, sizes = Counter(), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(words)
            for k in range(1, order + 1):
                for i in range(len(words) - k + 1):
                    found[lang or "und", " ".join(words[i:i + k])] += 1
    return found, sizes


def plain(rows, order=4, least=30, percent=80, top=2000):
    found, sizes = plain_grams(rows, order)
    candidates = {key: a for key, a in found.items() if a >= least and " " in key[1]}
    longer = Counter()
    for (lang, phrase), a in candidates.items():
        words = phrase.split(" ")
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                key = lang, " ".join(words[i:i + k])
                longer[key] = max(longer[key], a)
    out = {}
    for (lang, phrase), a in candidates.items():
        if 100 * longer[lang, phrase] < percent * a:
            words, cuts = phrase.split(" "), []
            for k in range(1, len(words)):
                left, right = found[lang, " ".join(words[:k])], found[lang, " ".join(words[k:])]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score)
        for lang, rows in out.items() for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1)
    )


def random_rows(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Über", "É"]
    line = " ".join(rng.choices(words, k=30))
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.randint(0, 25)))
        text = text.replace("w3", "w3,").replace("w5", "W5\t") + rng.choice([".", "\n", "", "; "]) + rng.choice([line, "", line[:40], "a b " * 9])
        rows.append((i, text, rng.choice(["en", "de", None]), "x"))
    return rows


@pytest.mark.parametrize("order", [2, 3, 4, 5])
@pytest.mark.parametrize("bits", [3, 12, 20])
def test_against_plain_counting(spark, make_docs, order, bits):
    """A sieve of eight counters lets everything pass, one of a million nearly nothing rare."""
    rows = random_rows(order)
    got = best(scored(edges_and_ends(make_docs(rows), order=order, min_count=12, sieve_bits=bits), order=order, min_count=12))
    wanted = plain(rows, order, 12)
    assert sorted(map(tuple, got.collect())) == wanted and len(wanted) > 20


def test_counts_of_all_lengths(spark, make_docs):
    rows = random_rows(9)
    got = {(r["lang"], r["gram"]): r["f"] for r in counts(edges_and_ends(make_docs(rows), min_count=10, sieve_bits=16), min_count=10).collect()}
    assert got == {key: n for key, n in plain_grams(rows, 4)[0].items() if n >= 10}


def test_tables_are_added_up_in_steps(spark, make_docs, monkeypatch):
    monkeypatch.setattr(collocations, "FAN_IN", 2)
    rows = random_rows(10)
    docs = make_docs(rows).repartition(7)
    got = scored(edges_and_ends(docs, min_count=12, sieve_bits=14), min_count=12)
    assert sorted(map(tuple, best(got).collect())) == plain(rows, least=12)


def test_paths(spark):
    """A chain, a fork, a circle and a loop; each edge is on just one path, with its weight."""
    texts = ["a b c d e f g h i", "x y z p", "x y z q", "k l m k l m k l m", "o o o o o", "f g h j"]
    edges = sorted({" ".join(t.split()[i:i + 4]) for t in texts for i in range(len(t.split()) - 3)})
    df = spark.createDataFrame([("en", e, 100 + i) for i, e in enumerate(edges)], "lang STRING, gram STRING, n BIGINT")
    got = [(r["path"], r["weights"]) for r in paths(df).collect()]
    back = {" ".join(path[i:i + 4]): n for path, weights in got for i, n in enumerate(weights)}
    assert back == {e: 100 + i for i, e in enumerate(edges)} and sum(len(w) for _, w in got) == len(edges)
    assert all(len(path) == len(weights) + 3 for path, weights in got)
    words = {" ".join(path) for path, _ in got}
    assert {"a b c d e f g h", "f g h i", "f g h j", "x y z p", "o o o o"} <= words
    assert sum("k" in path for path, _ in got) == 3


def test_long_path(spark):
    """Thousands of edges in one row, in their order."""
    words = [f"w{i}" for i in range(3000)]
    rows = [("en", " ".join(words[i:i + 4]), i) for i in range(2997)]
    (path,) = paths(spark.createDataFrame(rows, "lang STRING, gram STRING, n BIGINT").repartition(5)).collect()
    assert path["path"] == words and path["weights"] == list(range(2997))


def test_arithmetic_beyond_64_bits(spark):
    a, l, r = 10**15 + 7, 3 * 10**15 + 1, 2 * 10**15 + 3
    rows = [("en", "x y", 2, a), ("en", "x", 1, l - a), ("en", "y", 1, r), ("en", "", 0, 9 * 10**15)]
    (row,) = scored(spark.createDataFrame(rows, "lang STRING, gram STRING, words INT, n BIGINT")).collect()
    assert tuple(row) == ("en", "x y", a, l, r, 9 * 10**15, 2_000_000 * a // (l + r))


def test_top_and_ties(spark):
    rows = [("en", f"p{i % 50:02d} q{i:03d}", 30 + i % 3, 100, 100, 10, i % 7) for i in range(300)]
    rows += [("de", "a b", 30, 30, 30, 60, 1)]
    df = spark.createDataFrame(rows, "lang STRING, phrase STRING, a BIGINT, l BIGINT, r BIGINT, n BIGINT, score BIGINT").repartition(4)
    got = [(r["lang"], r["rank"], r["phrase"]) for r in best(df, 40).collect()]
    english = sorted((r for r in rows if r[0] == "en"), key=lambda r: (-r[6], -r[2], r[1]))[:40]
    assert sorted(got) == sorted([("de", 1, "a b")] + [("en", i, r[1]) for i, r in enumerate(english, 1)])


def test_odd_rows_and_no_rows(spark, make_docs, odd_rows):
    rows = odd_rows + [(30, "One line here " * 50, None, "a")] * 2
    got = best(scored(edges_and_ends(make_docs(rows), min_count=2, sieve_bits=18), min_count=2))
    assert sorted(map(tuple, got.collect())) == plain(rows, least=2)
    none = best(scored(edges_and_ends(make_docs([]), sieve_bits=10)))
    assert none.count() == 0 and none.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_query_equals_sql(spark, tables):
    got = sorted(map(tuple, op11_phrase_collocations(spark, tables).collect()))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tables}/documents.parquet'")
        assert got == sorted(db.execute(OP11_SQL).fetchall()) and got


def test_a_task_holds_words_once(monkeypatch):
    """Counting 16 MB of text takes little memory beside the table of counters."""
    monkeypatch.setattr(collocations, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rng = random.Random(4)
    words = [f"word{i}" for i in range(5000)]

    def batches():
        for _ in range(16):
            texts = [" ".join(rng.choices(words, k=500)).encode() for _ in range(256)]
            yield pa.RecordBatch.from_pydict({"text": texts, "lang": ["en"] * 256})

    tracemalloc.start()
    try:
        assert sum(len(part) for part in collocations._count_into(4, 16, 30)(batches())) == 1
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100 << 20, peak >> 20
