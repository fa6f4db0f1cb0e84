"""Token files and packing: exact ids, round trips, and plans that hold."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from flightlens.llm import packing, token_files as files, tokens

EDGE = [
    "", "a", "it's don't 'S 're", "foo,bar.. x. , .", "İstanbul ẞtraße ŉ x́y", "abc<|endoftext|>def <|startoftext|> <|ENDOFTEXT|>",
    "a\x1cb\x85c　d e", "12 3.14,5 ﬁne ǅ 日本語 ไทย हिन्दी", "é ́a J̌ H̱", "Σας ΟΔΟΣ K Å", "x" * 3000,
    "퟿�", "don't. they'LL, ’s", "\n\t \r\x0b\x0c", "ª º ʰ.", "ﷺ, ﷺ",
]


def ids_of(text):
    return tokens.encoder(tokens.vocabulary_path()).tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def given(spark):
    return [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]


def test_word_encoder_is_the_tokenizer(given, monkeypatch):
    texts = EDGE + [t for _, t in given]
    wanted = [ids_of(t) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.encoder(tokens.vocabulary_path()).encode(texts, 1)] == wanted
    monkeypatch.setattr(tokens, "KEPT_WORDS", 50)
    small = tokens.WordEncoder(tokens.vocabulary_path())
    assert [np.frombuffer(x, "<u4").tolist() for x in small.encode(EDGE * 3, 1)] == wanted[:len(EDGE)] * 3


def test_words_with_marks_are_made_of_letters_and_marks(monkeypatch):
    """Letters in either case and the marks after them are encoded apart, so that few words are texts of their own."""
    pairs = [f"wort{a}{b}" for a in tokens.MARKS for b in ["", *tokens.MARKS]]
    words = pairs + ["Éle&&&", "ciÓnÑ,!!", "ÉpamentÊ,", "thndoror!!", "ØÞ", "ª.", "µ!", "ßÿ--", "İx!", "ŉ,", "Ǆ.", "it's.", "a<b", "a|.", "a_.", "x'.", "12.", "...", "a.b,"]
    small = tokens.WordEncoder(tokens.vocabulary_path())
    whole, asked = small._whole, []
    monkeypatch.setattr(small, "_whole", lambda texts: asked.extend(texts) or whole(texts))
    texts = [*words, " ".join(words), " ".join(word + " <|endoftext|>" for word in words)]
    assert [np.frombuffer(x, "<u4").tolist() for x in small.encode(texts, 1)] == [ids_of(text) for text in texts]
    assert not {"wort!!", "wort)]", "thndoror!!", "éle&&&", "Éle&&&", "ÉpamentÊ,"} & set(asked) and {"!!", "&&&", "it's."} <= set(asked)


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(0)
    for ids in (np.array([1]), np.zeros(9), rng.integers(0, 1 << 32, 1001), rng.integers(0, 49408, 65536)):
        ids = ids.astype(np.uint32)
        planes = files.to_planes(ids, bits)
        assert len(planes) == (32 if bits else 4)
        assert (files.from_planes(b"".join(planes), [len(p) for p in planes], len(ids)) == ids).all()
    assert files.to_planes(np.array([3, 7], np.uint32))[1:] == [b""] * 3


@pytest.mark.parametrize("bits", [False, True])
def test_files_of_odd_rows(spark, make_docs, odd_rows, tmp_path, bits):
    path = str(tmp_path / "tokens")
    files.write_tokens(make_docs(odd_rows), path, block_ids=64, bits=bits)
    got = defaultdict(list)
    base = {r["shard"]: r["base"] for r in files.shard_starts(spark, path).collect()}
    for r in files.read_tokens(spark, path).collect():
        got[r["shard"], r["doc_no"]].append((base[r["shard"]] + r["first"], r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()))
    docs = sorted((min(parts)[0], parts[0][1], sum((p[2] for p in sorted(parts)), [])) for parts in got.values())
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [d[1] for d in docs] == [r[0] for r in order]
    assert [d[2] for d in docs] == [ids_of(r[1]) for r in order]
    assert [d[0] for d in docs] == np.cumsum([0] + [len(d[2]) for d in docs])[:-1].tolist()
    files.write_tokens(make_docs([]), str(tmp_path / "none"))
    assert files.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_token_query(spark, given, monkeypatch):
    monkeypatch.setattr(files, "BLOCK_IDS", 4096)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in files.op2_token_planes(spark, "/root/testdata/sf0.001").collect()}
    at, wanted = 0, {}
    for doc_id, text in sorted(given):
        ids = ids_of(text)
        wanted[doc_id] = (at, len(ids), crc(ids))
        at += len(ids)
    assert got == wanted


def test_crc_of_parts():
    import pandas as pd
    ids = list(range(100))
    parts = [{"part": i, "n": len(p), "crc": crc(p)} for i, p in enumerate((ids[:10], ids[10:11], ids[11:]))]
    assert files.join_crc32(pd.Series([parts, parts[:1]])).tolist() == [crc(ids), crc(ids[:10])]


def holds(counts, capacity):
    """The plan puts every piece somewhere, gaplessly, within the capacity."""
    runs, n = packing.plan(counts, capacity)
    bins, ranks = defaultdict(list), defaultdict(list)
    for length, rank, count, first, offset in runs.tolist():
        ranks[length] += range(rank, rank + count)
        for i in range(count):
            bins[first + i].append((offset, length))
    assert {length: sorted(r) for length, r in ranks.items()} == {length: list(range(c)) for length, c in counts.items() if c}
    assert sorted(bins) == list(range(n))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in pieces) <= 2
    return n


@pytest.mark.parametrize("seed", range(12))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 50, 4096])
    counts = {rng.randint(1, capacity): rng.choice([1, 2, 3, 50, 1000]) for _ in range(rng.randint(1, 60))}
    n = holds(counts, capacity)
    total = sum(length * c for length, c in counts.items())
    assert n >= -(-total // capacity)
    if all(3 * length <= capacity for length in counts):
        assert n <= total / (capacity * 2 / 3) + 1


def test_large_items_pair_as_well_as_can_be():
    """All pieces over a third: the best number of pairs, found by trying all matchings."""
    def best(items, capacity):
        if not items:
            return 0
        head, rest = items[0], items[1:]
        tries = [1 + best(rest, capacity)]
        tries += [1 + best(rest[:i] + rest[i + 1:], capacity) for i, x in enumerate(rest) if head + x <= capacity]
        return min(tries)

    rng = random.Random(1)
    for _ in range(40):
        items = [rng.randint(11, 30) for _ in range(rng.randint(1, 8))]
        counts = {x: items.count(x) for x in items}
        assert packing.plan(counts, 30)[1] == best(items, 30)


def check_packed(rows, docs, capacity):
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    wanted = defaultdict(list)
    for doc_id, text in docs:
        ids = ids_of(text)
        wanted[doc_id] += [(i, at, len(ids[at:at + capacity]), crc(ids[at:at + capacity])) for i, at in enumerate(range(0, len(ids), capacity))]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in wanted.items()}
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(n for v in bins.values() for _, n in v)


def test_packing_odd_rows(spark, make_docs, odd_rows):
    packed = packing.pack(packing.cut(make_docs(odd_rows), capacity=64, with_ids=True), 64, slices=3)
    check_packed(packed.collect(), [r[:2] for r in odd_rows], 64)
    sequences = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert zlib.crc32(sequences[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]].tobytes()) == r["ids_crc32"]
    assert packing.pack(packing.cut(make_docs([]))).count() == 0


def test_packing_query(spark, given):
    n, total = check_packed(packing.op3_best_fit_packing(spark, "/root/testdata/sf0.001").collect(), given, 4096)
    assert n <= -(-total // 4096) + 2


def test_known_words_are_joined_without_comparing_each():
    """Ids of known words are joined as they are found: none is looked at to see whether it is missing."""
    class Alone(bytes):
        def __eq__(self, other):
            raise AssertionError("compared")
        __hash__ = bytes.__hash__

    encode = tokens.WordEncoder(tokens.vocabulary_path())
    texts = ["One word, two words.", "", None, "two WORDS one"]
    wanted = encode.encode(texts, 1)
    encode.known = {word: Alone(ids) for word, ids in encode.known.items()}
    assert encode.encode(texts, 1) == wanted
    assert encode.encode(["one new, word"]) == tokens.WordEncoder(tokens.vocabulary_path()).encode(["one new, word"])


def test_each_piece_is_looked_up_once_for_some_texts():
    """Words are numbered first: letters and marks are looked up once for some texts, however often they come."""
    asked = []

    class Counted(dict):
        def get(self, key, default=None):
            asked.append(key)
            return dict.get(self, key, default)

    encode, texts = tokens.WordEncoder(tokens.vocabulary_path()), [" one, two; ONE;\n", None, "two, one"] * 100
    encode.known = Counted()
    assert [np.frombuffer(x, "<u4").tolist() for x in encode.encode(texts, 1)] == [ids_of(text) for text in texts]
    assert len(asked) == len(set(asked)) == 5  # one, two, the two marks and nothing


def test_small_steps_give_the_same_ids(given, monkeypatch):
    texts = EDGE + [t for _, t in given[:50]]
    wanted = [ids_of(t) for t in texts]
    for name, size in (("SOME_BYTES", 500), ("GATHERED", 7), ("KEPT_WORDS", 40), ("RUN_WORDS", 1)):
        monkeypatch.setattr(tokens, name, size)
    encode = tokens.WordEncoder(tokens.vocabulary_path())
    for end in (1, None):
        got = [np.frombuffer(x, "<u4").tolist() for x in encode.encode(texts, end)]
        assert got == (wanted if end else [ids[:-1] for ids in wanted])
    assert list(encode.runs(tokens.pa.array([], tokens.pa.string()), 1)) == []
