"""BPE by a rank array against the tokenizers library, on given and awkward texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flightlens.llm.rank_bpe import RankBpe, decode, encode, op13_bpe_round_trip

AWKWARD = [
    "", " ", "a" * 5000, "ab" * 200 + "!" * 300, "don't we'll I'VE 's", "<|startoftext|>a <|endoftext|>b<|end", "word's, (word) \"word\" -word- word's.",
    "İ straße  x y\x85z\x1c\x00", "日本語テキスト 123 ４５", "😀👩‍👩‍👧 ok", "Å Å x́", "ΑΣ ΣΑΣ", "﻿a​b c", " a  b\t\tc\n\nd ", "ﬁ ǅ ǆ", "éÁ È, (è)",
]


def texts(seed=1):
    rng = random.Random(seed)
    ranges = [(0x20, 0x7F), (0xA0, 0x250), (0x300, 0x370), (0x370, 0x2000), (0x2000, 0xD7FF), (0xE000, 0x11000), (0x10000, 0x20000)]
    strange = ["".join(chr(rng.choice([rng.randrange(*rng.choice(ranges)), 0x20, 0x27, 0x73])) for _ in range(100)) for _ in range(500)]
    blocks = [" ".join(chr(c) for c in range(a, a + 64) if not 0xD800 <= c < 0xE000) for a in range(0, 0x20000, 64)]
    return AWKWARD + strange + blocks


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("short", [1, 4, 64])
def test_equal_to_the_library(name, short):
    """With a short array of 1 or 4, nearly every piece goes through the heap."""
    path = public_tokenizers.path(name)
    own, library = RankBpe(path, short), Tokenizer.from_file(path)
    for text, wanted in zip(texts(), library.encode_batch(texts(), add_special_tokens=False)):
        raw = own.encode(text)
        assert np.frombuffer(raw, "<u4").tolist() == wanted.ids
        assert own.decode(raw) == library.decode(wanted.ids, skip_special_tokens=False)


def test_dictionary_stays_bounded(monkeypatch):
    monkeypatch.setattr("flightlens.llm.rank_bpe.KEPT_WORDS", 50)
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = RankBpe(path), Tokenizer.from_file(path)
    for i in range(20):
        text = " ".join(f"word{'abc'[j % 3]}{chr(97 + i)}{'x' * j}," for j in range(20))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(own.known) < 150


def check_rows(rows, given):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = []
    for doc_id, text in given:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        wanted.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    key = lambda row: tuple((value is None, value) for value in row)
    assert sorted(map(tuple, rows), key=key) == sorted(wanted, key=key)


def test_query(spark, tables):
    given = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    result = op13_bpe_round_trip(spark, tables)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    check_rows(result.collect(), given)


def test_odd_rows(spark, make_docs, odd_rows):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encoded = encode(make_docs(odd_rows))
    wanted = [(i, library.encode(text or "", add_special_tokens=False).ids) for i, text, *_ in odd_rows]
    got = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in encoded.collect()]
    assert sorted(map(str, got)) == sorted(map(str, wanted))
    texts = [(r["doc_id"], r["decoded"]) for r in decode(encoded).collect()]
    assert sorted(map(str, texts)) == sorted(str((i, library.decode(ids, skip_special_tokens=False))) for i, ids in wanted)


def test_no_rows(spark, make_docs):
    assert encode(make_docs([]), decoded=True).columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert encode(make_docs([])).count() == decode(encode(make_docs([]))).count() == 0
