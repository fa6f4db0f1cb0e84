"""Session settings and the shared-folder write used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(app_name: str = "flightlens", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on. On a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str | None:
    """The folder named by ``spark.checkpoint.dir``, which all executors reach, if it is set."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path that the driver and all executors reach: in the shared folder, or where that is unset in the warehouse."""
    folder = shared_folder(spark) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a summary once and read it back, for summaries used by several branches of a plan.

    A written table outlives lost executors, and its file size is known exactly, so Spark's own
    broadcast threshold decides correctly whether the summary is small enough to broadcast.
    Where no shared folder is set, Spark keeps the summary itself: it is worked out by the first
    branch that needs it, and what a lost executor held is worked out again.
    """
    spark = df.sparkSession
    if shared_folder(spark) is None:
        return df.persist()
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
