"""Periodic runs against a search of every start and period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from flightlens.llm import periodic_runs
from flightlens.llm.periodic_runs import find_runs, op12_periodic_runs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, min_length=6, min_exponent=4):
    """Every longest stretch with period q; of equal stretches the smallest q."""
    n, least = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_exponent * q):
                least.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in least.items())


def plain_collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def strings():
    rng = random.Random(5)
    for _ in range(1500):
        n, letters = rng.randint(0, 40), rng.randint(1, 4)
        yield [rng.randrange(letters) for _ in range(n)]
    for _ in range(300):  # planted powers, of powers too
        out = []
        for _ in range(rng.randint(1, 4)):
            root = [rng.randrange(3) for _ in range(rng.randint(1, 6))]
            out += root * rng.randint(1, 7) + root[:rng.randint(0, len(root))] + [rng.randrange(9) for _ in range(rng.randint(0, 4))]
        yield out
    yield [0] * 300
    yield [0, 1] * 200
    fibonacci = [0], [0, 1]
    for _ in range(10):
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    yield fibonacci[1]


@pytest.mark.parametrize(("length", "exponent"), [(6, 4), (2, 2), (3, 3)])
def test_against_brute_force(length, exponent):
    for numbers in strings():
        dense = np.unique(numbers, return_inverse=True)[1].astype(np.int64) if numbers else np.empty(0, np.int64)
        got = [tuple(row) for row in periodic_runs.runs(dense, length, exponent).tolist()]
        assert got == plain_runs(numbers, length, exponent), numbers


def test_suffix_array_and_common_prefixes():
    rng = random.Random(6)
    for _ in range(200):
        numbers = [rng.randrange(3) for _ in range(rng.randint(2, 50))]
        found = periodic_runs.Suffixes(np.array(numbers))
        if len(set(numbers)) == max(numbers) + 1:
            order = sorted(range(len(numbers)), key=lambda i: numbers[i:])
            assert found.order.tolist() == order and found.place[order].tolist() == list(range(len(order)))
            for a, b, common in zip(order, order[1:], found.common[1:]):
                assert numbers[a:a + common] == numbers[b:b + common] and numbers[a + common:a + common + 1] != numbers[b + common:b + common + 1]


def made_periodic(doc_id, text):
    words = WORDS.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query(spark, tables):
    given = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    result = op12_periodic_runs(spark, tables)
    assert result.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {row["doc_id"]: tuple(row)[1:] for row in result.collect()}
    assert len(got) == len(given) and sum(row[0] > 0 for row in got.values()) > len(given) // 20
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for doc_id, text in given:
        words = made_periodic(doc_id, text)
        if len(words) > 1500 and doc_id % 5:  # brute force takes time with the square
            continue
        found = plain_runs(words)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join("%d,%d,%d\n" % row for row in found)
        assert got[doc_id] == (len(found), *first, digest(lines), digest(plain_collapsed(words, found)))


@pytest.mark.parametrize("some", [1, 50, periodic_runs.SOME_WORDS])
def test_odd_rows(spark, make_docs, odd_rows, some):
    """However texts are put together: one at a time, a few, all."""
    rows = odd_rows + [(20, "x " * 5000, "en", "a"), (21, "a b c " * 9, "en", "a"), (21, "a b c " * 9, "en", "a"), (22, "y" * 100_000, "en", "a")]
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in find_runs(make_docs(rows), some=some).collect()]
    wanted = []
    for doc_id, text, *_ in rows:
        words = WORDS.findall(text or "")
        found = [(0, 5000, 1)] if doc_id == 20 else [] if len(words) > 5000 else plain_runs(words)
        wanted.append((doc_id, len(words), found, plain_collapsed(words, found)))
    assert sorted(map(str, got)) == sorted(map(str, wanted))


def test_no_rows(spark, make_docs):
    assert find_runs(make_docs([])).count() == 0
