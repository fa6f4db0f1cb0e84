"""Exact dedup against a persistent index of digests.

The index is a Parquet table bucketed and sorted by digest, one row for every text ever kept. A batch
is first reduced to one row per digest, in the tasks before the shuffle, so that a text with any
number of copies is one row in what follows. A sort-merge anti-join with the index, which is read in
its buckets and not shuffled, leaves the digests that are new; they are appended. Only digests move,
never texts, and joining decisions back to rows is a plain equality join whose hot keys adaptive
execution splits.

Defined cases: a null text counts as empty, and empty texts are copies of each other; a very long text
is hashed where it lies and does not travel with its digest; a null doc_id
sorts below all others and stays only where its text has no other; repeated rows are copies (rows
that repeat doc_id and text are all marked as kept, ``keep_rows`` lets one of them through); an empty
batch leaves the index as it is; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flightlens.llm.common import ascii_lower, documents, free_names, id_and_text, new_path, whole, written

BUCKETS = 32  # at least
BUCKET_ROWS = 4_000_000  # of the first batch, about 200 MB of digests


def text_digest(text: str | Column = "text") -> Column:
    """SHA-256 of the text with A-Z in lower case."""
    return F.unhex(F.sha2(ascii_lower(whole(text)), 256))


class DigestIndex:
    """The index at ``path``; it opens what an earlier job has left there.

    Without ``buckets`` the first batch decides their number, one for ``BUCKET_ROWS`` digests. It is kept beside the
    index. Every append adds a file to each bucket; ``compacted`` gives an index of one sorted file each, with as
    many buckets as its rows ask for by then.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.bucket_rows, self.buckets = spark, bucket_rows, None
        self.path = path or new_path(spark, "digests")
        self.table = "digest_index_" + "".join(c if c.isalnum() else "_" for c in self.path)[-80:]
        layout = spark.createDataFrame([], "buckets INT")
        layout.write.mode("append").parquet(self._layout)
        kept = spark.read.schema("buckets INT").parquet(self._layout).agg(F.max("buckets")).first()[0]
        if kept or buckets:
            self._create(kept or buckets, known=kept is not None)

    @property
    def _layout(self) -> str:
        return f"{self.path}-layout"

    def _create(self, buckets: int, known: bool = False) -> None:
        if not known:
            self.spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("append").parquet(self._layout)
        self.buckets = buckets
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def _fit(self, rows: int) -> None:
        """Nothing has decided yet: the rows do. None decide nothing."""
        if self.buckets is None and rows:
            self._create(max(BUCKETS, -(-rows // self.bucket_rows)))

    def rows(self) -> DataFrame:
        if self.buckets is None:
            return self.spark.createDataFrame([], "digest BINARY, keep_id BIGINT")
        return self.spark.table(self.table)

    def new_in(self, digests: DataFrame) -> DataFrame:
        """(digest, keep_id): digests of the batch that the index lacks, each with its largest doc_id."""
        batch = written(digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id")), "batch")
        if self.buckets is None:
            self._fit(batch.count())
        if self.buckets is None:
            return batch
        known = self.rows().select("digest").hint("merge")
        return batch.repartition(self.buckets, "digest").join(known, "digest", "left_anti")

    def append(self, digests: DataFrame) -> None:
        """Add a batch of (doc_id, digest). Running it again after a failure adds nothing twice."""
        new = self.new_in(digests)
        if self.buckets is not None:
            new.sortWithinPartitions("digest").write.insertInto(self.table)
            self.spark.catalog.refreshTable(self.table)

    def compacted(self, path: str | None = None) -> DigestIndex:
        """The same digests at another path; this index stays as it is, so a job that breaks off loses nothing."""
        rows = self.rows()
        new = DigestIndex(self.spark, path, bucket_rows=self.bucket_rows)
        new._fit(rows.count())
        if new.buckets is not None:
            rows.repartition(new.buckets, "digest").sortWithinPartitions("digest").write.insertInto(new.table, overwrite=True)
            self.spark.catalog.refreshTable(new.table)
        return new


def digests_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest), written: texts are read and hashed once."""
    return written(id_and_text(docs, id_col, text_col).select("doc_id", text_digest().alias("digest")), "digested")


def decide(digests: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per row of ``digests``: doc_id, digest, keep_id from the index, group_size, kept."""
    sizes = digests.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = written(sizes.join(index.rows(), "digest", "left"), "groups")
    return digests.join(groups, "digest").select(
        "doc_id", "digest", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
    )


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Append a batch to the index and decide on its rows: copies of earlier batches are not kept."""
    digests = digests_of(docs, id_col, text_col)
    index.append(digests)
    return decide(digests, index)


def keep_rows(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns; of rows that repeat one, one."""
    own, kept_id, kept_digest = free_names(docs, "own_digest", "kept_id", "kept_digest")
    kept = decisions.where("kept").select(F.col("doc_id").alias(kept_id), F.col("digest").alias(kept_digest)).distinct()
    marked = docs.withColumn(own, text_digest(text_col))
    same = (F.col(own) == F.col(kept_digest)) & F.col(id_col).cast("long").eqNullSafe(F.col(kept_id))
    return marked.join(kept, same).dropDuplicates([kept_digest, kept_id]).select(*docs.columns)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in two batches, larger ids first, so that the largest id of equal texts stays."""
    digests = digests_of(documents(spark, sf_dir))
    low, high = digests.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = F.lit(None if low is None else (low + high) // 2)
    index = DigestIndex(spark)
    index.append(digests.where(F.col("doc_id") > middle))
    index.append(digests.where(~F.coalesce(F.col("doc_id") > middle, F.lit(False))))
    return decide(digests, index).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"),
    )


OP6_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
"""
