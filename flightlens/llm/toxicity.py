"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts and unlabelled texts are learnt from; nothing is known to be clean. With the
class prior p, the risk of a classifier is p R+(P) + max(0, R-(U) - p R-(P)): what unlabelled texts
cost as negatives, less the share that toxic ones among them must have, and never less than nothing, or
a flexible model would drive it below zero (Kiryo et al., 2017). Where that part is negative, the step
goes against it.

A text is the set of its words and of the strings of four and five letters in them, word starts marked, hashed; one insult in
a long text counts as in a short one. Each of ``SHARDS`` tasks gets a share of a sample of bounded size,
keeps the ``KEPT`` features most over-represented among its toxic texts, and trains a logistic model
with numpy; the sum of their sparse weights scores all texts. What reaches the driver is at most
``SHARDS * KEPT`` weights.

Bounds: the sample has about ``POSITIVES`` toxic and ``UNLABELLED`` unlabelled texts, chosen by a hash of
doc_id; equal texts count once. The prior is the share of toxic rows among all labelled ones learnt
from.

Defined cases: a null text is empty; a very long text is worked on alone, whole; an empty table gives no rows; empty texts get the score of no feature; without toxic or
unlabelled texts to learn from all scores are the prior, or 0 without labels; a label that is null, or
whose doc_id is null or unknown, is not used; repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flightlens.llm.common import documents, id_and_text, written
from flightlens.llm.language_id import chunks, fold, letters, lowered

POSITIVES = 6_000
UNLABELLED = 18_000
SHARDS = 6
BITS = 20
KEPT = 1500
ROUNDS = 300
GRAMS = (4, 5)
WORD_LIMIT = 24  # longer words are known by their strings alone


def features(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, hashed feature), each pair once."""
    codes, owner = lowered(texts)
    letter = letters()[codes]
    shift = np.uint64(64 - bits)
    found = []
    with np.errstate(over="ignore"):
        mixed = (np.where(letter, codes, 32).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        # strings of letters; the first place may be the space before a word
        rolling, inside = mixed, np.ones(len(codes), bool)
        for length in range(2, max(GRAMS) + 1):
            rolling = rolling[:-1] * np.uint64(0x100000001B3) + mixed[length - 1:]
            inside = inside[:-1] & letter[length - 1:]
            if length in GRAMS:
                found.append((owner[:len(inside)][inside], _places(rolling[inside], 2 * length + 1, shift)))
        # a word's hash: the sum over its letters of letter times a power of its place
        edge = np.diff(letter.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(starts):
            some = stops - starts <= WORD_LIMIT
            place = np.arange(len(codes)) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(codes)]])))
            powers = np.cumprod(np.full(WORD_LIMIT + 1, 0xD6E8FEB86659FD93, np.uint64))
            terms = np.where(letter, mixed * powers[np.minimum(place, WORD_LIMIT)], np.uint64(0))
            found.append((owner[starts][some], _places(np.add.reduceat(terms, starts)[some], 1, shift)))
    keys = np.concatenate([who << bits | what for who, what in found])
    keys = pd.unique(keys)
    return keys >> bits, keys & ((1 << bits) - 1)


def _places(hashes: np.ndarray, kind: int, shift: np.uint64) -> np.ndarray:
    """Feature numbers: the highest bits of the hashes mixed with the kind of feature."""
    mixed = (hashes ^ hashes >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9 * kind % (1 << 64) | 1)
    return ((mixed ^ mixed >> np.uint64(29)) * np.uint64(0x94D049BB133111EB) >> shift).astype(np.int64)


def train_nnpu(
    who: np.ndarray, what: np.ndarray, n_texts: int, n_features: int, positive: np.ndarray, prior: float, rounds: int = ROUNDS,
    rate: float = 0.05, decay: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model on binary features, by Adam on the non-negative risk."""
    weights, bias = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    moments = np.zeros((2, n_features + 1))
    n_pos, n_all = positive.sum(), len(positive) - positive.sum()
    for step in range(1, rounds + 1):
        score = np.bincount(who, weights=weights[what], minlength=n_texts) + bias
        chance = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        # logistic losses: -log chance as positive, -log (1 - chance) as negative
        as_negative = -np.log1p(-np.minimum(chance, 1 - 1e-12))
        negative = as_negative[~positive].sum() / n_all - prior * as_negative[positive].sum() / n_pos
        slope = np.where(positive, -prior * chance / n_pos, chance / n_all)
        slope = slope + np.where(positive, prior * (chance - 1) / n_pos, 0) if negative >= 0 else -slope
        gradient = np.append(np.bincount(what, weights=slope[who], minlength=n_features) + decay * weights, slope.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def _fit(rows: pd.DataFrame, prior: float, kept: int) -> pd.DataFrame:
    """One shard's model as (feature, weight); the bias is feature -1."""
    none = pd.DataFrame({"feature": np.empty(0, np.int64), "weight": np.empty(0)})
    rows = rows.sort_values("order")
    positive = rows["positive"].to_numpy(bool)
    if positive.all() or not positive.any():
        return none
    found = [(start + who, what) for start, some in chunks(rows["text"]) for who, what in [features(some)]]
    who, what = (np.concatenate(x) for x in zip(*found))
    size = 1 << BITS
    in_pos = np.bincount(what[positive[who]], minlength=size)
    in_all = np.bincount(what[~positive[who]], minlength=size)
    n_pos, n_all = positive.sum(), len(positive) - positive.sum()
    # How far the share among toxic texts lies above that among all, in deviations of the latter
    usual = (in_all + 0.5) / (n_all + 1)
    over = (in_pos / n_pos - usual) / np.sqrt(usual * (1 / n_pos + 1 / n_all))
    over[in_pos < min(3, n_pos)] = 0
    best = np.argsort(-over, kind="stable")[:kept]
    best = np.sort(best[over[best] > 3])
    if not len(best):
        return none
    number = np.full(size, -1)
    number[best] = np.arange(len(best))
    use = number[what] >= 0
    weights, bias = train_nnpu(who[use], number[what[use]], len(rows), len(best), positive, prior)
    return pd.DataFrame({"feature": np.append(best, -1), "weight": np.append(weights, bias)})


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        who, what = features(texts)
        return 1 / (1 + np.exp(-(np.bincount(who, weights=self.weights[what], minlength=len(texts)) + self.bias)))


def train(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    positives: int = POSITIVES, unlabelled: int = UNLABELLED, shards: int = SHARDS, kept: int = KEPT,
) -> ToxicityModel:
    """Learn from rows of ``labels`` (doc_id, toxic) that are 1, and from ``docs`` without their labels."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("toxic")).dropna()
    counts = known.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0)).alias("toxic")).first()
    texts = id_and_text(docs, id_col, text_col).where("text IS NOT NULL")
    size = texts.count()
    if not counts["n"]:
        return ToxicityModel(np.zeros(1 << BITS), -30.0)
    prior = min(max(counts["toxic"] / counts["n"], 1e-3), 0.5)
    order = F.xxhash64("doc_id", F.lit("fit"))

    def share(most: int, of: int) -> Column:
        """A hash below this keeps about ``most`` rows of ``of``."""
        return F.pmod(order, F.lit(1 << 30)) < int(min(1.0, most / max(of, 1)) * (1 << 30))

    sure = written(known.where("toxic = 1").where(share(positives, counts["toxic"])).select("doc_id").distinct(), "sure")
    if sure.count() <= 2 * positives:  # about ``positives`` ids by their hashes: texts need not be shuffled to find them
        sure = F.broadcast(sure)
    sample = texts.join(sure, "doc_id", "left_semi").withColumn("positive", F.lit(True)).union(
        texts.where(share(unlabelled, size)).withColumn("positive", F.lit(False)),
    ).dropDuplicates(["text", "positive"])
    dealt = sample.select("text", "positive", F.xxhash64("text").alias("order")).withColumn("shard", F.pmod("order", F.lit(shards)))
    models = dealt.groupBy("shard").applyInPandas(lambda rows: _fit(rows, prior, kept), "feature BIGINT, weight DOUBLE")
    found = models.toPandas()
    parts = max(1, int((found["feature"] == -1).sum()))
    weights = np.zeros(1 << BITS)
    inner = found[found["feature"] >= 0]
    np.add.at(weights, inner["feature"].to_numpy(), inner["weight"].to_numpy() / parts)
    bias = found.loc[found["feature"] == -1, "weight"].sum() / parts if len(found) else np.log(prior / (1 - prior))
    return ToxicityModel(weights, float(bias))


def predict(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text") -> Column:
    """The score of each text of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.concatenate([shared.value.score(some) for _, some in chunks(texts)] or [np.empty(0)]))

    return score(F.col(text_col))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from four folds of labels and texts, then score all documents."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = train(docs.where(~held_out), labels.where(~held_out))
    texts = id_and_text(docs)
    scored = texts.withColumn("score", predict(texts, model))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
