"""Token ids by the tokenizers library, each distinct word encoded once per task.

The tokenizer splits at white space before it merges, and its normaliser never joins text across a space,
so a text's ids are those of its words in a row. A few megabytes of texts are worked on at a time: Arrow
cuts them at the six ASCII white-space bytes and numbers the distinct words, only these are looked up, and
the ids of all words are gathered by their numbers. Letters and the marks after them are looked up apart,
in two bounded dictionaries, the newer and the older half; those not met before are encoded together.
"""

from __future__ import annotations

import codecs
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
KEPT_WORDS = 600_000  # words, letters or marks kept between batches: about 200 bytes each
RUN_WORDS = 30  # words encoded as one text; longer texts cost more a word
SOME_BYTES = 6 << 20  # of text worked on at a time, or one longer text
GATHERED = 1 << 20  # words whose ids are gathered at a time
# Texts that are not lowered early: combining marks could then compose otherwise, and special tokens' brackets.
KEPT = r"<\||[\x{0300}-\x{037F}]"
# ASCII marks that the splitter always parts from letters before them and that are in no contraction or special token.
MARKS = "!\"#$%&()*+,-./:;=>?@[\\]^`{}~"
# Letters that neither normalising nor lowering changes, and marks after them.
_LATIN = "".join(c for c in map(chr, range(0x80, 0x180)) if c.isalpha() and c.islower())
LETTERS_MARKS = f"^(?P<letters>[a-z{_LATIN}]*)(?P<marks>[{re.escape(MARKS)}]*)$"

_encoders: dict[str, "WordEncoder"] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def encoder(path: str) -> "WordEncoder":
    """This process's encoder for the vocabulary file at ``path``."""
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; idle threads would spin
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class WordEncoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # For lower-case Latin letters alone the normaliser does nothing and a word is one run of letters.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        symbols = [*map(chr, range(256))]  # the model's character for each byte of a Latin letter
        for c in filter(str.isalpha, map(chr, range(0x80, 0x180))):
            for byte, symbol in zip(c.encode(), alphabet.pre_tokenize_str(c)[0][0]):
                symbols[byte] = symbol
        self.symbols = "".join(symbols)
        ends = [(i, piece.endswith("</w>")) for piece, i in self.tokenizer.get_vocab(with_added_tokens=False).items()]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        self.ends[[i for i, end in ends if end]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters: each is one token run, so the run's ends show where words end."""
        found: list[bytes] = []
        runs = [words[at:at + RUN_WORDS] for at in range(0, len(words), RUN_WORDS)]
        texts = [" ".join(some) for some in runs]
        texts = [text if text.isascii() else codecs.charmap_decode(text.encode(), "strict", self.symbols)[0] for text in texts]
        for some, e in zip(runs, self.plain.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            raw, stops = ids.tobytes(), (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(stops) != len(some) or stops[-1] != len(raw):
                raise ValueError("the vocabulary does not mark the ends of words")
            found += [raw[a:b] for a, b in zip([0, *stops], stops)]
        return found

    def _learn(self, new: list[str]) -> list[bytes]:
        """Letters by ``_plain``; letters with Latin capitals, and the marks after them, as well; any other piece by itself."""
        plain, other, cut = [], [], []
        for piece in new:
            if piece.isalpha() and piece.islower() and (piece.isascii() or max(piece) < "\u0180"):
                plain.append(piece)
                continue
            base = piece.rstrip(MARKS)
            if base.isalpha() and max(base) < "\u0100" and (low := base.lower()).islower() and not base.isascii():
                plain.append(low)
                cut.append((piece, low, piece[len(base):]))
                other.append(cut[-1][2])
            else:
                other.append(piece)
        plain, other = list(dict.fromkeys(plain)), list(filter(None, dict.fromkeys(other)))
        found = dict(zip(plain, self._plain(plain)))
        found.update(zip(other, self._whole(other)))
        found[""] = b""
        found.update((piece, found[low] + found[tail]) for piece, low, tail in cut)
        return [found[piece] for piece in new]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        found = list(map(self.known.get, pieces))
        gaps = [at for at, ids in enumerate(found) if ids is None]
        if gaps:
            new = []
            for at in gaps:
                found[at] = self.older.get(pieces[at])
                if found[at] is None:
                    new.append(at)
            for at, ids in zip(new, self._learn([pieces[at] for at in new])):
                found[at] = ids
            if len(self.known) + len(gaps) > KEPT_WORDS // 2:
                self.known, self.older = {}, self.known
            self.known.update(zip([pieces[at] for at in gaps], [found[at] for at in gaps]))
        return found

    def _some(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """As ``runs``, for texts without nulls that are few enough."""
        lowered = pc.if_else(pc.match_substring_regex(texts, KEPT), texts, pc.ascii_lower(texts))
        words = pc.ascii_split_whitespace(lowered)  # white space at either side makes an empty word, without ids
        stops = words.offsets.to_numpy()[1:]
        numbered = words.flatten().dictionary_encode()
        table, lengths = self._words(numbered.dictionary)
        at = numbered.indices.to_numpy()
        if end:
            at = np.insert(at, stops, len(lengths))
            stops = stops + np.arange(1, len(stops) + 1)
            table, lengths = np.append(table, np.frombuffer(end, "<u4")), np.append(lengths, 1)
        firsts = np.cumsum(lengths) - lengths
        ids = [_gather(table, firsts, lengths, at[i:i + GATHERED]) for i in range(0, len(at), GATHERED)]
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(lengths[at])])[stops]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words in a row, and how many each has. Letters and the marks after them are looked up apart."""
        cut = pc.extract_regex(words, LETTERS_MARKS)  # null: another word, one piece
        letters, marks = pc.if_else(cut.is_valid(), cut.field("letters"), words), pc.if_else(cut.is_valid(), cut.field("marks"), "")
        pieces = pa.concat_arrays([letters, marks]).dictionary_encode()
        found = self._ids(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = pieces.indices.to_numpy().reshape(2, -1)
        table = _gather(np.frombuffer(b"".join(found), "<u4"), np.cumsum(lengths) - lengths, lengths, at.T.reshape(-1))
        return table, lengths[at].sum(axis=0)

    def runs(self, texts: pa.Array, end_id: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some texts at a time (null: empty): their ids in a row, ``end_id`` after each text, and where each text's ids end."""
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        texts = pc.fill_null(texts, "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(texts):
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + SOME_BYTES, "right")))
            yield self._some(texts[start:stop], end)
            start = stop

    def encode(self, texts: Sequence[str | None], end_id: int | None = None) -> list[bytes]:
        """Little-endian 32-bit ids of each text (null: empty), ``end_id`` last."""
        out: list[bytes] = []
        for ids, stops in self.runs(pa.array(texts, pa.string()), end_id):
            raw, bounds = ids.tobytes(), (4 * stops).tolist()
            out += [raw[a:b] for a, b in zip([0, *bounds], bounds)]
        return out


def _gather(table: np.ndarray, firsts: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The stretches of the table with the numbers ``at``, one after the other."""
    n = lengths[at]
    ends = np.cumsum(n)
    return table[np.repeat(firsts[at] - (ends - n), n) + np.arange(ends[-1])]
