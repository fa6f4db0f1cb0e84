from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from flightlens import schemas


def write_by_year(facts: DataFrame, path: str) -> None:
    """Keep the flight facts as Parquet, one folder per year.

    Repeated reports then read only the years and columns they need, which for data larger than
    the cluster's memory does the work of caching every yearly file. The rows are not shuffled,
    so a year with most of the flights is still written by many tasks.
    """
    facts.write.partitionBy("Year").parquet(path)


def read_by_year(spark: SparkSession, path: str) -> DataFrame:
    """The yearly copy. Filters on ``Year`` choose folders before the scan; a join with a filtered frame of years
    chooses them while the query runs."""
    return spark.read.option("basePath", path).parquet(path)


def _in_order(df: DataFrame, schema: str) -> DataFrame:
    """All columns of a file format in its order; those that ``df`` lacks are null."""
    return df.select(*(
        (F.col(field.name) if field.name in df.columns else F.lit(None)).cast("string").alias(field.name) for field in StructType.fromDDL(schema)
    ))


def write_flight_facts(facts: DataFrame, path: str) -> None:
    """Flight facts as CSV with a header, missing values as ``NA``, as ``read_flight_facts`` takes them."""
    _in_order(facts, schemas.FLIGHT_FACTS).write.csv(path, header=True, nullValue="NA")


def write_flight_edges(edges: DataFrame, path: str) -> None:
    """Monthly totals as ``read_flight_edges`` takes them: tab-separated, with header."""
    _in_order(edges, schemas.FLIGHT_EDGES).write.csv(path, header=True, sep="\t")


def write_airports(airports: DataFrame, path: str) -> None:
    airports.write.csv(path, header=True)


def write_weather(observations: DataFrame, path: str) -> None:
    """Weather observations without a header, with the fields that are not kept left empty."""
    _in_order(observations, schemas.WEATHER_OBSERVATIONS).write.csv(path, header=False)


def write_report(report: DataFrame, path: str) -> None:
    """Write a report table as Parquet, each file keeping the report's order."""
    report.write.parquet(path)
