"""The given TPC-H-like tables reshaped into the library's inputs.

Every view is a lazy DataFrame over whole tables, read without running a job. A view takes the columns its reader needs and
joins only the tables those come from: the foreign keys hold in these tables (a test checks it),
so leaving out an unused inner join changes no row. ``years`` limits the ship dates, which
reaches the file scan, as naming the yearly files would.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flightlens import schemas
from flightlens.functions import with_period
from flightlens.plans.constants import DELAY_CAUSES
from flightlens.sources import station_locations

# Parameters that take the place of the reports' defaults on these tables.
FOCUS = "N15"
FIRST, LAST = 1995, 2001

FROM_SUPPLIER = {"originCode", "origin_city", "origin_population", "Origin"}
FROM_CUSTOMER = {"destinationCode", "destination_city", "destination_population", "Dest"}
FROM_ORDERS = {"CancellationCode"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _code(key: str) -> Column:
    return F.concat(F.lit("N"), F.lpad(F.col(key).cast("string"), 2, "0"))


def _shipped_in(year: int) -> Column:
    """A range of the stored column, which reaches the file scan."""
    start, stop = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    return (F.col("l_shipdate") >= start) & (F.col("l_shipdate") < stop)


def _base(spark: SparkSession, sf_dir: str, columns: Iterable[str], years: Iterable[int] | None) -> DataFrame:
    """Line items with the tables that the wanted columns come from.

    Codes and populations are worked out on the short sides, once per supplier or customer.
    Customers are joined to orders before orders to line items, so that at scale the line items,
    the largest table, are shuffled once less. No broadcast is hinted: Spark decides by file sizes
    and, while running, by the bytes it has shuffled.

    A table is left out where no wanted column comes from it. That takes for granted that every
    line item has its order, customer, supplier and nations, which a test checks on these tables
    and nothing checks while a query runs.
    """
    wanted = set(columns)
    base = table(spark, sf_dir, "lineitem")
    if years is not None:
        base = base.filter(reduce(or_, map(_shipped_in, years), F.lit(False)))

    def place(owner: str, prefix: str, end: str) -> DataFrame:
        return table(spark, sf_dir, owner).withColumns({
            f"{end}_code": _code(f"{prefix}_nationkey"),
            f"{end}_people": F.floor(F.abs(F.col(f"{prefix}_acctbal"))).cast("int"),
        })

    def named(rows: DataFrame, key: str, city: str) -> DataFrame:
        nation = table(spark, sf_dir, "nation")
        return rows.join(nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(city)), key)

    if wanted & FROM_SUPPLIER:
        base = base.join(place("supplier", "s", "origin"), F.col("l_suppkey") == F.col("s_suppkey"))
        if "origin_city" in wanted:
            base = named(base, "s_nationkey", "origin_city")
    if wanted & (FROM_CUSTOMER | FROM_ORDERS):
        side = table(spark, sf_dir, "orders")
        if wanted & FROM_CUSTOMER:
            side = side.join(place("customer", "c", "destination"), F.col("o_custkey") == F.col("c_custkey"))
            if "destination_city" in wanted:
                side = named(side, "c_nationkey", "destination_city")
        base = base.join(side, F.col("l_orderkey") == F.col("o_orderkey"))
    return base


def flight_edges(
    spark: SparkSession, sf_dir: str, columns: Iterable[str], years: Iterable[int] | None = None
) -> DataFrame:
    """Line items as flight edges, with the derived period columns where ``fly_date`` is wanted."""
    columns = list(columns)
    passengers = F.floor("l_quantity").cast("int")
    made = {
        "originCode": F.col("origin_code"),
        "destinationCode": F.col("destination_code"),
        "origin_city": F.col("origin_city"),
        "destination_city": F.col("destination_city"),
        "passengers": passengers,
        "seats": passengers + (F.col("l_partkey") % 10).cast("int"),
        "flights": F.col("l_linenumber").cast("int"),
        "distance": F.col("l_extendedprice"),
        "fly_date": (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("string"),
        "origin_population": F.when(F.col("l_linenumber") != 7, F.col("origin_people")),
        "destination_population": F.col("destination_people"),
    }
    base = _base(spark, sf_dir, columns, years)
    edges = base.select(*(made[name].alias(name) for name in columns))
    return with_period(edges) if "fly_date" in columns else edges


def flight_facts(
    spark: SparkSession, sf_dir: str, columns: Iterable[str], years: Iterable[int] | None = None
) -> DataFrame:
    """Line items as single flights; delays are text, with ``NA`` for cancelled flights."""
    columns = list(columns)
    cancelled = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    order, line = F.col("l_orderkey"), F.col("l_linenumber")

    def delay(minutes: Column) -> Column:
        return F.when(cancelled, F.lit("NA")).otherwise(minutes.cast("string"))

    status = F.col("o_orderstatus")
    reason = F.when(status == "F", "A").when(status == "O", "B").when(status == "P", "C")
    made = {
        "Year": F.year("l_shipdate"),
        "Month": F.month("l_shipdate"),
        "DayofMonth": F.dayofmonth("l_shipdate"),
        "DepTime": (F.floor((order * 37 + line * 101) % 1440 / 60) * 100 + (order * 37 + line * 101) % 60).cast("int"),
        "DepDelay": delay((order * 7 + line * 13) % 200 - 20),
        "ArrDelay": delay((order * 11 + line * 17) % 240 - 30),
        "Cancelled": cancelled.cast("int"),
        "CancellationCode": F.when(cancelled, reason),
        "Origin": F.col("origin_code"),
        "Dest": F.col("destination_code"),
        "TailNum": F.when(F.col("l_suppkey") % 3 != 0, F.concat(F.lit("T"), F.col("l_suppkey").cast("string"))),
    }
    for i, cause in enumerate(DELAY_CAUSES, start=1):
        made[cause] = ((order + line * i) % 30).cast("int")
    return _base(spark, sf_dir, columns, years).select(*(made[name].alias(name) for name in columns))


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One airport per nation; the last one has no latitude."""
    regions = table(spark, sf_dir, "region")
    rows = table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("n_nationkey")
    return rows.select(
        _code("n_nationkey").alias("IATA"),
        F.concat("n_name", F.lit(" Airport")).alias("AirportName"),
        F.col("n_name").alias("City"),
        F.col("r_name").alias("Country"),
        F.when(key != 24, F.lit(5.0) + F.lit(2.5) * key).alias("Latitude"),
        (F.lit(-160.0) + F.lit(5.0) * key).alias("Longitude"),
    )


def _station(key: str) -> Column:
    return F.concat(F.lit("ST"), F.lpad(F.col(key).cast("string"), 9, "0"))


def weather_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as weather observations."""
    kinds = {"view": "TOBS", "click": "PRCP", "purchase": "TMAX", "signup": "TMIN", "error": "SNOW"}
    kind = F.create_map(*(F.lit(text) for pair in kinds.items() for text in pair))
    return table(spark, sf_dir, "events").select(
        _station("user_id").alias("stationCode"),
        F.date_format("ts", "yyyyMMdd").cast("int").alias("doy"),
        F.try_element_at(kind, F.col("event_type")).alias("observationType"),
        F.floor("value").cast("int").alias("observationVal"),
        F.when(F.col("event_id") % 5 != 0, F.date_format("ts", "HHmm").cast("int")).alias("observationTime"),
    )


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fixed-width line per user of the events."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    lat = F.concat((15 + F.col("user_id") % 40).cast("string"), F.lit(".0000"))
    long = F.concat((F.col("user_id") % 70 - 135).cast("string"), F.lit(".0000"))
    return users.select(F.concat(
        _station("user_id"), F.lit(" "), F.lpad(lat, 8, " "), F.lit(" "), F.lpad(long, 9, " "),
        F.lit("   10.0    STATION"),
    ).alias("line"))


def stations(spark: SparkSession, sf_dir: str, slices=schemas.STATION_SLICES) -> DataFrame:
    return station_locations(station_lines(spark, sf_dir), slices)
