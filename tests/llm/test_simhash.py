"""SimHash fingerprints, links and components against plain Python over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from flightlens.llm import simhash as sim

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_simhash(text, words=3):
    split = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(split[i:i + words]) for i in range(len(split) - words + 1)] or [" ".join(split)] * bool(split)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(fps, distance=3):
    """{fp: smallest fp reachable}"""
    root = {fp: fp for fp in fps}
    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    fps = sorted(fps)
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {fp: find(fp) for fp in fps}


def expected(rows):
    fps = [plain_simhash(t) for _, t in rows]
    root = plain_components(set(fps))
    least = {}
    for (doc_id, _), fp in zip(rows, fps):
        if doc_id is not None:
            least[root[fp]] = min(doc_id, least.get(root[fp], doc_id))
    return sorted(((i, f"{fp:016x}", least.get(root[fp])) for (i, _), fp in zip(rows, fps)), key=str)


def found(docs):
    rows = sim.near_duplicates(sim.fingerprints(docs)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("f"), "component_id")
    return sorted(map(tuple, rows.collect()), key=str)


def test_odd_rows(make_docs, odd_rows):
    rows = [(i, t) for i, t, *_ in odd_rows]
    assert found(make_docs(odd_rows)) == expected(rows)
    assert found(make_docs([])) == []


def test_near_copies(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    base = [rng.choices(words, k=rng.randint(1, 150)) for _ in range(30)]
    rows = []
    for i in range(300):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    assert found(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")) == expected(rows)


@pytest.mark.parametrize("run", [1 << 16, 9, 40])
@pytest.mark.parametrize("distance", [3, 2, 5])
def test_links_of_random_fingerprints(spark, run, distance):
    """Chains, dense balls and strangers; short limits force the way by pairs of blocks."""
    rng = random.Random(distance)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for start in list(fps)[:6]:
        for _ in range(60):
            fp = rng.choice([start, *fps]) if rng.random() < 0.3 else start
            for bit in rng.sample(range(64), rng.randint(0, distance)):
                fp ^= 1 << bit
            fps.add(fp)
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in fps]
    edges = sim.links(spark.createDataFrame([(x,) for x in signed], "fp BIGINT").repartition(4), distance, run)
    pairs = edges.collect()
    assert all(((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= distance for r in pairs)
    got = {r["node"]: r["root"] for r in sim.components(edges).collect()}
    root = plain_components(fps, distance)
    groups, wanted = {}, {}
    for fp, s in zip(fps, signed):
        groups.setdefault(got.get(s, s), set()).add(fp)
        wanted.setdefault(root[fp], set()).add(fp)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_a_long_chain(spark):
    rng = random.Random(4)
    names = rng.sample(range(10_000), 300)
    edges = [(a, b) for a, b in zip(names, names[1:])]
    got = {r["node"]: r["root"] for r in sim.components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert set(got.values()) == {min(names)} and set(got) == set(names) - {min(names)}


def test_forest_spans_dense_runs():
    rng = np.random.default_rng(1)
    fps = np.unique(rng.integers(0, 1 << 9, 300)).astype(np.int64)
    a, b = sim.forest(fps, 3)
    assert len(a) == len(fps) - 1


def test_query_on_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sim.op5_simhash_near_dedup(spark, sf).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)
