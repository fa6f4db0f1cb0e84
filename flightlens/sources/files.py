from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flightlens import schemas
from flightlens.functions import fixed_width

Paths = str | Iterable[str]

# Column with the whole line where a line could not be read, if asked for.
UNREADABLE = "unreadable"


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _csv(spark: SparkSession, paths: Paths, schema: str | StructType, keep_unreadable: bool, **options) -> DataFrame:
    """Lines by a declared schema. A line that does not fit, in a value or in the number of values, gives nulls for what
    does not fit; with ``keep_unreadable`` a last column has the line itself, null for the others.

    Spark looks for such values only in the columns that a query asks for; ``quarantine`` asks for all.
    """
    reader = spark.read.options(**options)
    if keep_unreadable:
        fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        schema = StructType([*fields.fields, StructField(UNREADABLE, StringType())])
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=UNREADABLE, columnPruning=False)
    return reader.schema(schema).csv(_paths(paths))


def read_flight_facts(spark: SparkSession, paths: Paths, *, infer: bool = False, keep_unreadable: bool = False) -> DataFrame:
    """Flight facts from one CSV file, a glob, or all yearly files in a single scan.

    Missing values are written ``NA``. ``infer`` lets Spark guess the types instead, at the price
    of one more pass; then ``NA`` still reads as null, so numeric columns stay numeric.
    """
    options = {"header": True, "nullValue": "NA"}
    schema = schemas.FLIGHT_FACTS
    if infer:
        schema = spark.read.options(**options, inferSchema=True).csv(_paths(paths)).schema
    return _csv(spark, paths, schema, keep_unreadable, **options)


def read_flight_edges(spark: SparkSession, paths: Paths, *, keep_unreadable: bool = False) -> DataFrame:
    """Monthly origin-destination totals: tab-separated, with header."""
    return _csv(spark, paths, schemas.FLIGHT_EDGES, keep_unreadable, header=True, sep="\t")


def read_airports(spark: SparkSession, paths: Paths, *, keep_unreadable: bool = False) -> DataFrame:
    """Airports, read by header name so that the order and number of further columns is free.

    A coordinate that is not a number is null and does not make its line unreadable.
    """
    rows = _csv(spark, paths, spark.read.option("header", True).csv(_paths(paths)).schema, keep_unreadable, header=True)
    return rows.withColumns({name: F.col(name).try_cast("double") for name in ("Latitude", "Longitude")})


def read_weather(spark: SparkSession, paths: Paths, *, keep_unreadable: bool = False) -> DataFrame:
    """Daily weather observations: CSV without header; the flag fields are not kept."""
    rows = _csv(spark, paths, schemas.WEATHER_OBSERVATIONS, keep_unreadable)
    kept = ("stationCode", "doy", "observationType", "observationVal", "observationTime")
    return rows.select(*kept, *([UNREADABLE] if keep_unreadable else []))


def station_locations(
    lines: DataFrame, slices: Mapping[str, tuple[int, int, str]] = schemas.STATION_SLICES
) -> DataFrame:
    """Station code and coordinates out of fixed-width lines (the first column of ``lines``)."""
    return lines.select(*fixed_width(lines.columns[0], slices))


def read_stations(
    spark: SparkSession, paths: Paths,
    slices: Mapping[str, tuple[int, int, str]] = schemas.STATION_SLICES, *, keep_unreadable: bool = False,
) -> DataFrame:
    """The station list as whole lines, so a comma in a station name does not matter.

    A line is unreadable if a number that should stand in it does not parse, or it is too short for one.
    """
    lines = spark.read.text(_paths(paths))
    if not keep_unreadable:
        return station_locations(lines, slices)
    numbers = [name for name, (_, _, kind) in slices.items() if kind != "string"]
    located = lines.select(*fixed_width("value", slices), "value")
    bad = reduce(or_, (F.col(name).isNull() for name in numbers), F.lit(False))
    return located.select(*slices, F.when(bad, F.col("value")).alias(UNREADABLE))


def quarantine(rows: DataFrame, path: str) -> DataFrame:
    """The rows that could be read; lines that could not go to ``path``, as (file, line, parsed), to be looked at.

    ``parsed`` is JSON of what could be made out.    ``rows`` comes from a reader with ``keep_unreadable``. The files are read once for the quarantine, which
    is written now, and again whenever the result is asked for.
    """
    parsed = F.to_json(F.struct(*(name for name in rows.columns if name != UNREADABLE)))
    lines = rows.select(F.input_file_name().alias("file"), F.col(UNREADABLE).alias("line"), parsed.alias("parsed"))
    lines.filter(F.col("line").isNotNull()).write.parquet(path)
    # Always true, but it names all columns: Spark looks for what does not fit only in columns that are asked for.
    all_read = F.coalesce(*(F.col(name).cast("string") for name in rows.columns if name != UNREADABLE), F.lit("")) >= ""
    return rows.filter(F.col(UNREADABLE).isNull() & all_read).drop(UNREADABLE)
