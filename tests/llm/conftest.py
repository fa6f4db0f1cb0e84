import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
# Columns of documents that have names the operators use themselves.
CLASHING = (
    "digest", "keep_id", "kept", "group_size", "blob", "found", "size", "target", "position", "copies", "copy", "words", "fp", "root",
    "component_id", "length", "piece", "sequence_id", "offset", "start", "score", "positive", "order", "shard", "slice", "end",
    "next_text", "uid", "held_out", "lang_pred", "__rank", "__slice", "__order", "__digest", "__text",
    "__id", "__tie", "own_digest", "kept_id", "kept_digest", "row_id", "row_tie", "row_text", "row_source", "row_copy", "row_position",
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, lang, source), with columns whose names clash."""
    def make(rows, clashing=True):
        docs = spark.createDataFrame([(*row, None if row[1] is None else len(row[1])) for row in rows], SCHEMA).repartition(3)
        return docs.withColumns({name: F.lit("other") for name in CLASHING}) if clashing else docs
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, repeated, tied and very long texts; null ids, languages and sources; non-ASCII text."""
    rng = random.Random(7)
    long_text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(9_000))
    return [
        (1, "One line here.\nAnd another line there.", "en", "a"), (2, None, None, None), (3, "", "de", "b"),
        (4, " \t\n", "fr", "a"), (5, "One line here.\nAnd another line there.", "en", "b"), (5, "One line here.\nAnd another line there.", "en", "b"),
        (6, "ONE LINE HERE.\nand another line there.", None, "a"), (None, "nobody's text", "en", None), (None, None, None, None),
        (8, long_text, "en", "a"), (9, long_text + " end", "en", "a"), (10, "Ärger \U0001f600 İ straße x", "de", "é"),
        (11, "ärger \U0001f600 İ straße x", "de", "b"), (12, "12345 67890 !!", "en", "b"), (13, "\x00 zero \x1f byte", "en", "b"),
    ]
