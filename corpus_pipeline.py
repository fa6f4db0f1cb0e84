"""From documents to packed training sequences in five stages.

Every stage takes what its predecessor kept, as Parquet, and all but the last return rows with the columns of
documents. No stage reads a column it does not name, so other columns pass through, whatever they are called.

1. Language ID learns from the rows with a language outside fold 2 and drops texts it can give none: null
   and without a letter.
2. Exact dedup keeps, of texts equal but for the case of A-Z, the row with the largest doc_id.
3. Near-dedup finds pairs by SimHashes of five-word shingles that differ in three bits or fewer, and, as
   these end at a similarity of about 0.98, by MinHash bands down to 0.8; it drops rows whose shingles are similar by 0.8 or
   more to a row that stays. Which row of a group stays depends on a hash of its id and text; no two rows that
   stay are similar.
4. Mixing repeats or leaves out rows by the target weights of their sources, in training order. Of the copy
   at which a target ends, the row is taken if at least half its words are.
5. Packing puts the tokens of all rows into sequences of 4096: one row per piece.

Null and empty texts leave in the first stage; null doc_ids, languages and sources, ties and repeated rows
are treated as the operators document; an empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flightlens.llm import exact_dedup, language_id as languages, minhash, mixing, packing
from flightlens.llm.common import documents, free_names, whole, written

SHINGLE_WORDS = 5
SIMILAR = 0.8

ORACLE_SQL = None  # SQL has neither the language model nor XXH64 nor the tokenizer


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = languages.train(docs.where(languages.fold(F.col("doc_id"), 4) != 2))
    return docs.where(languages.predict(docs, model)["lang"] != languages.UNKNOWN)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_rows(docs, exact_dedup.deduplicate(docs, exact_dedup.DigestIndex(spark)))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row_id, tie = free_names(docs, "row_id", "row_tie")
    dropped = minhash.similar_to_kept(docs, words=SHINGLE_WORDS, similar=SIMILAR).select(
        F.col("doc_id").alias(row_id), F.col("tie").alias(tie),
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(row_id)) & (F.xxhash64(whole()) == F.col(tie))
    return docs.join(dropped, same, "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row_id, row_tie, row_source, copy, position, text = free_names(
        docs, "row_id", "row_tie", "row_source", "row_copy", "row_position", "row_text",
    )
    keyed = docs.select("doc_id", "text", "source", F.xxhash64(whole()).alias("tie"))
    copies = mixing.assign_positions(keyed, rest=["tie"]).select("doc_id", "tie", "source", "size", F.explode("copies").alias("c"))
    taken = written(copies.where(2 * F.col("c.words") >= F.col("size")).select(
        F.col("doc_id").alias(row_id), F.col("tie").alias(row_tie), F.col("source").alias(row_source),
        F.col("c.copy").alias(copy), F.col("c.position").alias(position),
    ), "taken")
    rows = docs.withColumn(text, F.xxhash64(whole())).dropDuplicates(["doc_id", text, "source"])
    same = (
        F.col("doc_id").cast("long").eqNullSafe(F.col(row_id)) & (F.col(text) == F.col(row_tie))
        & F.col("source").eqNullSafe(F.col(row_source))
    )
    place = [position, row_id, copy]
    return rows.join(taken, same).repartitionByRange(*place).sortWithinPartitions(*place).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.cut(docs))


STAGES = [
    ("language_id", language_id), ("exact_dedup", exact), ("simhash_near_dedup", near), ("source_mixing", mix),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each but the last is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
