"""What the operators share: reading documents, words, and tables written to the shared folder."""

from __future__ import annotations

import string
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word, in Java's, RE2's and Python's regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once per application, as ``--py-files`` would.

    The archive lies in the driver's own temporary folder; Spark hands it to each executor.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parent.parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    _shipped.add(context.applicationId)
    archive = Path(tempfile.mkdtemp(prefix="flightlens-")) / "flightlens.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, in local mode only, a folder in the warehouse. No setting is changed."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there and outlives executors."""
    ship(df.sparkSession)
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the named columns, so that no other column of ``docs`` can clash with an operator's own."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as make it none of the columns of ``df``."""
    taken, out = {column.lower() for column in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def whole(text: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; texts of ASCII alone take the faster built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
