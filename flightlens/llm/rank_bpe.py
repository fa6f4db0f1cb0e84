"""Byte-pair encoding by a contiguous rank array, and decoding by a table of tokens.

A piece of text (a word, as the vocabulary's own normaliser and splitter give it) begins as one part per
symbol. Beside the parts stands the array of ranks of adjacent parts. Again and again the array is
scanned for its least rank, the first of equals; the boundary there is deleted, and the ranks of the new
part with its two neighbours are looked up again. Pieces are short, so the scan over a few dozen numbers
that lie together costs less than a queue would. A piece of more than ``SHORT`` symbols would need time with
the square of its length; it goes through a heap of the same ranks over linked parts, which merges in the
same order.

The vocabulary file is that of the tokenizers library (a BPE model without dropout or unknown token). Its
normaliser and splitter are used as they are for anything but plain words; merging and decoding are done
here. Where the splitter drops white space, texts are cut at ASCII white space first, and the ids of each
distinct word are found once and kept in a bounded dictionary of the task. Other splitters see whole texts.

Decoding looks each id up in one table of all tokens' bytes: by the file's decoder, either tokens with a
space between them (none) or bytes put together (byte level). Special tokens in a text become their ids,
and come back as their names.

Defined cases: a null text is empty and has no ids; a null doc_id is kept; repeated rows and ties come out
each; an empty table gives no rows; a text of any length is encoded whole; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from flightlens.llm.common import documents, id_and_text
from flightlens.llm.tokens import vocabulary_path

SHORT = 64  # symbols of a piece that is worked off by the array
KEPT_WORDS = 400_000  # words and pieces kept between texts, about 250 bytes each
SOME_BYTES = 4 << 20  # of text worked on at a time
NEVER = 1 << 60  # the rank of parts that no merge joins
ENCODED = "doc_id BIGINT, n_tokens BIGINT, ids BINARY"

_known: dict[str, "RankBpe"] = {}
# A word of letters that neither normalising nor lowering changes, perhaps with an ASCII mark before or after it.
_PLAIN = re.compile(r"""([!-&(-/:;=>?@[-^`{}~]?)([a-zß-öø-ÿ]+)([!-&(-/:;=>?@[-^`{}~]?)""")


def bpe(path: str) -> "RankBpe":
    """This process's encoder for the vocabulary file at ``path``."""
    if path not in _known:
        _known[path] = RankBpe(path)
    return _known[path]


def _byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in printable)
    symbols = {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(rest)}
    return [symbols[b] for b in range(256)]


class RankBpe:
    def __init__(self, path: str, short: int = SHORT):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or any(model.get(name) for name in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("the vocabulary must be plain BPE")
        self.short = short
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.width = max(self.vocab.values()) + 1
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[self.vocab[left] * self.width + self.vocab[right]] = rank
            self.made.append(self.vocab[left + right])
        self.symbols = _byte_symbols()
        self.latin = dict(enumerate(self.symbols))
        self.tokenizer = Tokenizer.from_file(path)  # for its normaliser and splitter
        added = spec.get("added_tokens") or []
        if any(token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"] for token in added):
            raise ValueError("special tokens must be plain strings")
        self.special = {token["content"]: token["id"] for token in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        lowers = any(n["type"] == "Lowercase" for n in (spec.get("normalizer") or {}).get("normalizers", ()))
        # Words stand alone if white space is dropped and what comes before a word changes nothing.
        split = [self._split(text) for text in ("a'b. c", "a'b.", "c")]
        self.by_words = lowers and split[0] == split[1] + split[2]
        self.known: dict[bytes, bytes] = {}
        self._set_table((spec.get("decoder") or {}).get("type"))

    # encoding

    def merge(self, piece: str) -> list[int]:
        """Ids of a piece of symbols, by the array of ranks."""
        vocab, ranks, width = self.vocab, self.ranks, self.width
        parts = [vocab[symbol] for symbol in piece[:-1]]
        parts.append(vocab[piece[-1] + self.suffix])
        if len(parts) > self.short:
            return self._merge_long(parts)
        rank = ranks.get
        adjacent = [rank(a * width + b, NEVER) for a, b in zip(parts, parts[1:])]
        while adjacent:
            least = min(adjacent)
            if least == NEVER:
                break
            i = adjacent.index(least)
            parts[i] = self.made[least]
            del parts[i + 1], adjacent[i]
            if i:
                adjacent[i - 1] = rank(parts[i - 1] * width + parts[i], NEVER)
            if i < len(adjacent):
                adjacent[i] = rank(parts[i] * width + parts[i + 1], NEVER)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order, from a heap of (rank, place, parts) over linked places."""
        rank, width, n = self.ranks.get, self.width, len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue: list[tuple[int, int, int, int]] = []

        def enter(i: int) -> None:
            j = after[i]
            if j < n and (found := rank(parts[i] * width + parts[j])) is not None:
                heapq.heappush(queue, (found, i, parts[i], parts[j]))

        for i in range(n - 1):
            enter(i)
        while queue:
            found, i, left, right = heapq.heappop(queue)
            j = after[i]
            if j >= n or parts[i] != left or parts[j] != right:
                continue  # what stood here has been merged
            parts[i], parts[j], after[i] = self.made[found], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                enter(before[i])
            enter(i)
        return [part for part in parts if part >= 0]

    def _split(self, text: str) -> list[str]:
        """Pieces of a text without special tokens, in symbols, as the file's own rules give them."""
        if self.tokenizer.normalizer:
            text = self.tokenizer.normalizer.normalize_str(text)
        return [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _ids(self, text: str) -> list[int]:
        """Ids of any stretch of text, special tokens included."""
        out: list[int] = []
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                for piece in self._split(part):
                    out += self.merge(piece)
        return out

    def _learn(self, word: bytes) -> bytes:
        """Ids of one word; a word of letters is looked up apart from the marks around it."""
        found = _PLAIN.fullmatch(text := word.decode())
        if found is None:
            return np.array(self._ids(text), "<u4").tobytes()
        front, letters, tail = found.groups()
        base = letters.encode()
        ids = self.known.get(base)
        if ids is None:
            ids = np.array(self.merge(base.decode("latin-1").translate(self.latin)), "<u4").tobytes()
            self.known[base] = ids
        for mark in {front, tail} - {""}:
            if mark.encode() not in self.known:
                self.known[mark.encode()] = np.array(self._ids(mark), "<u4").tobytes()
        return (self.known[front.encode()] if front else b"") + ids + (self.known[tail.encode()] if tail else b"")

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.by_words:
            return np.array(self._ids(text), "<u4").tobytes()
        words = self._words(text)
        ids = list(map(self.known.get, words))
        if None in ids:
            for i, (word, found) in enumerate(zip(words, ids)):
                if found is None:
                    ids[i] = self.known.get(word)
                    if ids[i] is None:
                        ids[i] = self.known[word] = self._learn(word)
            if len(self.known) > KEPT_WORDS:
                self.known = dict(zip(words[:KEPT_WORDS], ids))
        return b"".join(ids)

    @staticmethod
    def _words(text: str) -> list[bytes]:
        """Words between ASCII white space. A-Z are lowered, unless combining marks (first byte CC or CD), which
        could compose with a letter otherwise, or the brackets of a special token are about."""
        raw = text.encode()
        if b"<|" not in raw and b"\xcc" not in raw and b"\xcd" not in raw:
            raw = raw.lower()
        return raw.split()

    # decoding

    def _set_table(self, decoder: str | None) -> None:
        if decoder not in (None, "ByteLevel"):
            raise ValueError(f"decoder {decoder} is not known here")
        self.spaced = decoder is None
        back = {symbol: bytes([b]) for b, symbol in enumerate(self.symbols)}
        tokens = {i: token for token, i in self.vocab.items()} | {i: token for token, i in self.special.items()}
        rows = []
        for i in range(max(tokens) + 1):
            token = tokens.get(i)
            if token is None:
                rows.append(b"")
            elif self.spaced:
                rows.append(token.encode() + b" ")
            else:
                rows.append(b"".join(back[c] for c in token) if all(c in back for c in token) else token.encode())
        self.lengths = np.array([len(row) for row in rows], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.table = np.frombuffer(b"".join(rows), np.uint8)

    def decode(self, raw: bytes) -> str:
        """The text of some ids; ids that the vocabulary lacks give nothing."""
        ids = np.frombuffer(raw, "<u4")
        if len(ids) and ids.max() >= len(self.lengths):
            ids = ids[ids < len(self.lengths)]
        lengths = self.lengths[ids]
        total = int(lengths.sum())
        shift = self.starts[ids] - (np.cumsum(lengths) - lengths)
        text = self.table[np.repeat(shift, lengths) + np.arange(total)].tobytes()
        return (text[:-1] if self.spaced else text).decode("utf-8", "replace")


def _some(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, each with few bytes in a column, or one long row."""
    sizes = np.array([len(value) if value else 0 for value in batch.column(column).to_pylist()])
    start = 0
    while start < len(sizes):
        more = np.searchsorted(np.cumsum(sizes[start:]), SOME_BYTES, "right")
        stop = start + max(1, int(more))
        yield batch.slice(start, stop - start)
        start = stop


def encode(docs: DataFrame, *, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian unsigned 32-bit integers; with ``decoded`` their text as well."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(path)
        for whole in batches:
            for batch in _some(whole, "text"):
                ids = [coder.encode(text) for text in batch.column("text").to_pylist()]
                columns = [batch.column("doc_id"), pa.array([len(raw) // 4 for raw in ids], pa.int64()), pa.array(ids, pa.binary())]
                names = ["doc_id", "n_tokens", "ids"]
                if decoded:
                    columns.append(pa.array([coder.decode(raw) for raw in ids], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, ENCODED + ", decoded STRING" * decoded)


def decode(encoded: DataFrame, *, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) of stored ids; null ids give an empty text."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(path)
        for whole in batches:
            for batch in _some(whole, "ids"):
                texts = [coder.decode(raw or b"") for raw in batch.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("binary").alias("ids"))
    return rows.mapInArrow(run, "doc_id BIGINT, decoded STRING")


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and its ids decoded again in the same pass; digests of both."""
    rows = encode(documents(spark, sf_dir), decoded=True)
    return rows.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
