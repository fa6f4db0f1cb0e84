"""Language identification by a bit-sliced Bloom filter of character trigrams.

The filter is one array of bit masks, a bit for each language: a trigram belongs to the languages whose
bits are set at all of its ``HASHES`` places, so one lookup tests all languages at once. Training counts
trigrams by language over all labelled texts, as rows that Spark sums; a language owns a trigram that is
at least ``OWNED`` times as frequent in it as in any other. Predicting counts, for each language, the
trigrams of a text that it owns. A filter with a share f of a language's bits set answers yes to a
strange trigram with chance f ** HASHES; shares are corrected for that, and the largest decides.

What is collected and broadcast is the array. A language owns only trigrams that are at least ``RARE`` of its text, so
it owns 1 / ``RARE`` at most, whatever the corpus; the array has ``ROOM`` places for each trigram of the language
that owns most, rounded up to a power of two, so at most 2^23 and never under ``PLACES``.

Trigrams are taken from lower-case letters, with one space for what lies between words; none spans two
words. A very long text is worked on alone, whole. Defined cases: null texts and texts without a letter get ``und`` and score 0; a text none of
whose trigrams any language owns gets the language with most training text and score 0, and ties go
to the first language by code point; with nothing to learn from, all texts get ``und``; a null doc_id is
never held out; repeated rows are predicted each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flightlens.llm.common import documents, id_and_text, written

PLACES = 1 << 21  # at least
ROOM = 8
RARE = 1e-6
HASHES = 4
OWNED = 0.5
LEAST = 2
UNKNOWN = "und"
CHUNK = 1 << 20  # characters worked on at a time


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds


@lru_cache(1)
def letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def chunks(texts: pd.Series) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts): null as empty, a bounded number of characters or one long text."""
    held, size, start = [], 0, 0
    for i, text in enumerate(texts):
        text = text if isinstance(text, str) else ""
        if held and size + len(text) > CHUNK:
            yield start, held
            held, size, start = [], 0, i
        held.append(text)
        size += len(text)
    if held:
        yield start, held


def lowered(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts in lower case, a space before and after each, and the index of each one's text."""
    spaced = [f" {text.lower()} " for text in texts]
    codes = np.frombuffer("".join(spaced).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.repeat(np.arange(len(texts)), [len(text) for text in spaced])


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all trigrams, the index of the text of each, and whether each text has a letter."""
    codes, owner = lowered(texts)
    codes = codes.astype(np.int64)
    letter = letters()[codes]
    lettered = np.bincount(owner[letter], minlength=len(texts)) > 0
    codes = np.where(letter, codes, 32)
    keep = np.ones(len(codes), bool)
    keep[1:] = letter[1:] | letter[:-1]  # one space between words
    codes, owner, letter = codes[keep], owner[keep], letter[keep]
    if len(codes) < 3:
        return codes[:0], owner[:0], lettered
    inside = letter[1:-1]
    grams = (codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[inside]
    return grams, owner[1:-1][inside], lettered


def places_of(grams: np.ndarray, places: int, hashes: int) -> np.ndarray:
    """(hashes, n) places of the trigrams: multiplications by odd numbers, highest bits."""
    with np.errstate(over="ignore"):
        mixed = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        odd = [np.uint64((0xBF58476D1CE4E5B9 * (2 * i + 1)) % (1 << 64) | 1) for i in range(hashes)]
        shift = np.uint64(64 - int(places).bit_length() + 1)
        return np.stack([(mixed * m) >> shift for m in odd]).astype(np.int64)


def gram_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, gram, n) over all rows with text and language; each task sums its own first."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                for _, some in chunks(texts):
                    grams, _, _ = trigrams(some)
                    n = pd.Series(grams).value_counts(sort=False)
                    yield pd.DataFrame({"lang": lang, "gram": n.index.to_numpy(np.int64), "n": n.to_numpy(np.int64)})

    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counted = texts.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return counted.mapInPandas(count, "lang STRING, gram BIGINT, n BIGINT").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class LanguageFilter:
    languages: list[str]
    masks: np.ndarray  # (places, words of 64 languages)
    hashes: int
    usual: int  # index of the language with most text

    def false_yes(self) -> np.ndarray:
        """Each language's chance that a strange trigram seems its own."""
        places = len(self.masks)
        set_bits = [np.count_nonzero(self.masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) for i in range(len(self.languages))]
        return (np.array(set_bits) / places) ** self.hashes

    def shares(self, texts: list[str], false_yes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of each language's trigrams by text, and whether it has a letter."""
        grams, owner, lettered = trigrams(texts)
        masks = np.bitwise_and.reduce(self.masks[places_of(grams, len(self.masks), self.hashes)], axis=0)
        total = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        shares = np.empty((len(texts), len(self.languages)))
        for i, wrong in enumerate(false_yes):
            hit = (masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).astype(bool)
            seen = np.bincount(owner[hit], minlength=len(texts)) / total
            shares[:, i] = np.maximum((seen - wrong) / max(1 - wrong, 1e-9), 0)
        return shares, lettered


def train(
    docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text", places: int | None = None, hashes: int = HASHES,
    owned: float = OWNED, least: int = LEAST, rare: float = RARE, least_places: int = PLACES,
) -> LanguageFilter:
    """Learn from all rows of ``docs`` that have a text and a language; ``places``, a power of two, fixes the filter's size."""
    counts = written(gram_counts(docs, lang_col, text_col), "grams")
    totals = {row["lang"]: row["n"] for row in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return LanguageFilter([], np.zeros((1, 1), np.uint64), hashes, 0)
    number = F.create_map(*(x for i, lang in enumerate(languages) for x in (F.lit(lang), F.lit(i))))
    total = F.create_map(*(x for lang in languages for x in (F.lit(lang), F.lit(float(totals[lang])))))
    rates = counts.where((F.col("n") >= least) & (F.col("n") >= total[F.col("lang")] * rare)).groupBy("gram").agg(
        F.collect_list(F.struct((F.col("n") / total[F.col("lang")]).alias("rate"), number[F.col("lang")].alias("number"))).alias("rates"),
    )
    top = F.array_max(F.transform("rates", lambda r: r["rate"]))
    owners = written(rates.withColumn("top", top).select(
        "gram", F.explode(F.filter("rates", lambda r: r["rate"] >= F.col("top") * owned)).alias("r"),
    ).select("gram", "r.number"), "owners")
    if places is None:
        most = owners.groupBy("number").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
        places = 1 << (max(least_places, ROOM * most) - 1).bit_length()
    masks = np.zeros((places, -(-len(languages) // 64)), np.uint64)

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            number = batch["number"].to_numpy(np.uint64)
            at = places_of(batch["gram"].to_numpy(np.int64), places, hashes)
            mask = (np.uint64(1) << number % np.uint64(64)).view(np.int64)
            yield pd.DataFrame({
                "place": at.reshape(-1), "word": np.tile((number // np.uint64(64)).astype(np.int32), hashes), "mask": np.tile(mask, hashes),
            })

    rows = owners.mapInPandas(bits, "place BIGINT, word INT, mask BIGINT").groupBy("place", "word").agg(F.bit_or("mask").alias("mask"))
    found = rows.toPandas()  # at most one row per place and 64 languages
    masks[found["place"].to_numpy(np.int64), found["word"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).view(np.uint64)
    return LanguageFilter(languages, masks, hashes, max(range(len(languages)), key=lambda i: totals[languages[i]]))


def predict(docs: DataFrame, model: LanguageFilter, *, text_col: str = "text") -> Column:
    """A column struct<lang, score> for ``docs``: the language of its text, and its share of all shares."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def language(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        langs, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        if model.languages:
            names, false_yes = np.array(model.languages, object), model.false_yes()
            for start, some in chunks(texts):
                shares, lettered = model.shares(some, false_yes)
                best, most, total = shares.argmax(axis=1), shares.max(axis=1), shares.sum(axis=1)
                best = np.where(most > 0, best, model.usual)
                here = slice(start, start + len(some))
                langs[here] = np.where(lettered, names[best], UNKNOWN)
                scores[here] = np.where(lettered & (total > 0), most / np.where(total > 0, total, 1), 0)
        return pd.DataFrame({"lang": langs, "score": scores})

    return language(F.col(text_col))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from the documents of three folds, then predict all."""
    docs = documents(spark, sf_dir)
    held_out = fold(F.col("doc_id"), 4) == 2
    model = train(docs.where(~held_out))
    texts = id_and_text(docs)
    return texts.withColumn("found", predict(texts, model)).select(
        "doc_id", held_out.alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score",
    )
