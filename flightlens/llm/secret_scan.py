"""Secret scans over a ledger of blobs, so that no text is scanned twice by one version of a rule.

A text is addressed by its SHA-256: all paths and historical versions with equal text are one blob. The
ledger has two Parquet tables, ``scanned`` with the pairs of blob and rule version that are done, and
``findings`` with spans by blob. A scan reduces its input to one row per blob (in the tasks first, so
copies do not travel), looks up which rule versions each blob has behind it, runs the others, appends
findings and then pairs, and joins the findings of all blobs back to every path that has them. A scan
that broke off before its pairs were appended is run again in full; its findings are read once.

Spans come from built-in regular expressions: the lengths of the pieces between matches and of the matches
themselves, added up in order, give every match's place in code points. Nothing runs in Python.

Defined cases: a null text is the empty text; a very long text is scanned whole, in one task; a null path is reported under null; repeated rows are
reported once each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from flightlens.llm.common import documents, new_path, whole, written


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more. Raise ``version`` on any change."""
    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    # Runs of the class are maximal, so asking for 16 in the pattern finds the same runs as asking afterwards.
    Rule("hex", r"[0-9a-f]{16,}", 16),
)
ADDED_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + ADDED_RULES


def parts(text: Column, rule: Rule) -> Column:
    """array<struct<gap, hit, enough>>: lengths before and of each leftmost match, and whether it is long enough; null if none is."""
    pattern = F.lit(rule.pattern)
    pieces = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("tested"),
    )
    lengths = F.transform(pieces, lambda part: F.struct(
        F.length(part["gap"]).alias("gap"), F.coalesce(F.length(part["hit"]), F.lit(0)).alias("hit"),
        F.coalesce(F.length(part["tested"]) >= rule.least, F.lit(False)).alias("enough"),
    ))
    return F.when(text.rlike(rule.pattern), lengths)


def placed(rows: DataFrame) -> DataFrame:
    """(blob, rule, kind, start, end) from (blob, rule, kind, parts): code points, end exclusive.

    Places are running sums of lengths, so the work on a text grows with its matches.
    """
    so_far = Window.partitionBy("blob", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = rows.where(F.exists("parts", lambda part: part["enough"])).select("blob", "rule", "kind", F.posexplode("parts").alias("pos", "part"))
    ends = each.withColumn("end", F.sum(F.col("part.gap").cast("long") + F.col("part.hit")).over(so_far))
    return ends.where("part.enough").select("blob", "rule", "kind", (F.col("end") - F.col("part.hit")).alias("start"), "end")


class BlobLedger:
    """The ledger in the folder ``path``; it opens what earlier scans have left there."""

    SCANNED = "blob BINARY, rule STRING"
    FINDINGS = "blob BINARY, rule STRING, kind STRING, start BIGINT, end BIGINT"

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or new_path(spark, "ledger")
        for name, schema in (("scanned", self.SCANNED), ("findings", self.FINDINGS)):
            empty = spark.range(0).select(F.from_json(F.lit(None).cast("string"), schema).alias("row")).select("row.*")
            empty.write.mode("append").parquet(f"{self.path}/{name}")

    def scanned(self) -> DataFrame:
        return self.spark.read.schema(self.SCANNED).parquet(f"{self.path}/scanned")

    def findings(self) -> DataFrame:
        return self.spark.read.schema(self.FINDINGS).parquet(f"{self.path}/findings")

    def unseen(self, versions: DataFrame, rules: Sequence[Rule]) -> DataFrame:
        """(blob, text, todo): one row per blob of ``versions`` (blob, text) with the rules it has not met."""
        done = self.scanned().groupBy("blob").agg(F.collect_set("rule").alias("done"))
        blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))
        names = F.array(*(F.lit(rule.name) for rule in rules))
        todo = F.array_except(names, F.coalesce("done", F.array().cast("array<string>")))
        return blobs.join(done, "blob", "left").select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)

    def scan(self, versions: DataFrame, rules: Sequence[Rule] = RULES) -> None:
        """Run each rule on the blobs of ``versions`` (blob, text) that it has not seen and record both."""
        by_rule = F.array(*(
            F.when(F.array_contains("todo", rule.name), F.struct(
                F.lit(rule.name).alias("rule"), F.lit(rule.kind).alias("kind"), parts(F.col("text"), rule).alias("parts"),
            )) for rule in rules
        ))
        results = written(
            self.unseen(versions, rules).select("blob", F.filter(by_rule, lambda r: r.isNotNull()).alias("results")), "scan",
        ).select("blob", F.explode("results").alias("r"))
        placed(results.select("blob", "r.rule", "r.kind", "r.parts")).write.mode("append").parquet(f"{self.path}/findings")
        results.select("blob", "r.rule").write.mode("append").parquet(f"{self.path}/scanned")

    def by_path(self, paths: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
        """``paths`` (with blob) and ``found``: array of (start, rank, kind, end), in that order."""
        ranks = F.create_map(*(x for i, rule in enumerate(rules) for x in (F.lit(rule.name), F.lit(i))))
        # A scan that was run again has written some findings twice: the set has them once.
        found = self.findings().where(F.col("rule").isin([rule.name for rule in rules])).groupBy("blob").agg(
            F.sort_array(F.collect_set(F.struct("start", ranks[F.col("rule")].alias("rank"), "kind", "end"))).alias("found"),
        )
        return paths.join(found, "blob", "left")


def address(docs: DataFrame, *path: str, text_col: str = "text") -> DataFrame:
    """``path`` columns, blob and text of every historical version."""
    text = whole(text_col)
    return docs.select(*path, F.unhex(F.sha2(text, 256)).alias("blob"), text.alias("text"))


def scan_secrets(
    docs: DataFrame, ledger: BlobLedger, *path: str, text_col: str = "text", rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """Scan what the ledger has not seen of ``docs``; one row per row of it: path columns, blob, found."""
    versions = address(docs, *path, text_col=text_col)
    ledger.scan(versions.select("blob", "text"), rules)
    return ledger.by_path(versions.drop("text"), rules)


def joined(found: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_secrets(documents(spark, sf_dir), BlobLedger(spark), "doc_id")
    found = F.coalesce("found", F.expr("CAST(array() AS array<struct<start: bigint, rank: int, kind: string, end: bigint>>)"))
    base = F.filter("found", lambda s: s["rank"] < len(BASE_RULES))

    def count(rank: int) -> Column:
        return F.size(F.filter("found", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(rank).alias(f"n_{rule.kind}") for rank, rule in enumerate(BASE_RULES)]
    return rows.withColumn("found", found).select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
    )


def _sql_spans(rule: Rule, rank: int) -> str:
    # RE2 folds (?i) over all of Unicode; letter classes fold ASCII alone.
    pattern = rule.pattern.replace("'", "''")
    if pattern.startswith("(?i)"):
        head, rest = pattern[4:].split(")", 1)
        pattern = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in head) + ")" + rest
    return f"""
  SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, length(tested) AS n, start, start + length(hit) AS stop FROM (
    SELECT doc_id, hits[i] AS hit, groups[i] AS tested,
           list_sum([length(x) FOR x IN gaps[1:i]]) + coalesce(list_sum([length(x) FOR x IN hits[1:i - 1]]), 0) AS start
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
      SELECT doc_id, regexp_split_to_array(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS hits,
             regexp_extract_all(text, '{pattern}', {rule.group}) AS groups FROM d WHERE regexp_matches(text, '{pattern}')))
  ) WHERE n >= {rule.least}"""


OP10_SQL = "WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), f AS (" + " UNION ALL".join(
    _sql_spans(rule, i) for i, rule in enumerate(RULES)
) + """
), j AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
         string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rank) AS spans
  FROM f GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (doc_id)
"""
