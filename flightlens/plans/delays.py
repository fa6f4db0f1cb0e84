from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from flightlens.functions import as_number, in_box
from flightlens.operators import as_of, average_by, contains_join, row_numbers, total_by
from flightlens.plans.constants import AIRPORT_BOX, DELAY_CAUSES

AIRPORT_FLIGHT_COLUMNS = (
    "AirportName", "City", "Country", "Latitude", "Longitude", "Year", "Month", "DayofMonth",
    "DepDelay", "ArrDelay", "Cancelled", "CancellationCode", "Dest",
)


def avg_arrival_delay_by_year(facts: DataFrame) -> DataFrame:
    return average_by(facts, "Year", "ArrDelay", "avg_arrival_delay").orderBy("Year")


def avg_departure_delay_by_year(facts: DataFrame) -> DataFrame:
    return average_by(facts, "Year", "DepDelay", "avg_departure_delay").orderBy("Year")


def facts_of_years(facts: DataFrame, years: Iterable[int]) -> DataFrame:
    """The flights of several years, from one scan of facts that hold them all.

    ``Year`` must be a stored column for the filter to reach the scan; for files of one year each,
    name the files, or union them (``union_by_position``).
    """
    return facts.filter(F.col("Year").isin(*years))


def flights_at_airports(
    flights: DataFrame, airports: DataFrame, *, box: dict[str, float] | None = None,
    columns: Iterable[str] = AIRPORT_FLIGHT_COLUMNS,
) -> DataFrame:
    """Flights with their airport of origin, for airports inside a box.

    An airport matches if its code contains the flight's origin. The airports are the side that
    is cut into substrings, so the flights stream past them unchanged.
    """
    inside = airports.filter(in_box("Latitude", "Longitude", **(AIRPORT_BOX if box is None else box)))
    return contains_join(inside, "IATA", flights, "Origin", expand="rows").select(*columns)


def delay_causes(facts: DataFrame, causes: Iterable[str] = DELAY_CAUSES) -> DataFrame:
    """Minutes lost and flights affected per cause of delay, worst first, in one pass."""
    causes = list(causes)
    totals = facts.agg(*(
        F.struct(
            F.lit(cause).alias("cause"),
            F.sum(as_number(cause)).cast("long").alias("total_minutes"),
            F.count_if(as_number(cause) > 0).alias("flights_delayed"),
        ).alias(cause)
        for cause in causes
    ))
    rows = totals.select(F.inline(F.array(*causes)))
    return rows.orderBy(F.desc("total_minutes"), "cause")


def cancellation_reasons(facts: DataFrame) -> DataFrame:
    """Cancelled flights per cancellation code, most frequent first."""
    cancelled = facts.filter(F.col("Cancelled") == 1).na.drop(subset=["CancellationCode"])
    counts = cancelled.groupBy("CancellationCode").agg(F.count("*").alias("cancelled_flights"))
    return counts.orderBy(F.desc("cancelled_flights"), "CancellationCode")


def plane_use(facts: DataFrame) -> DataFrame:
    """Flights and days of use per plane and year; rows without a tail number are left out.

    Days are counted by a second grouping over per-day counts, which both combine inside the
    tasks first, so one plane with very many rows costs no more than any other.
    """
    known = facts.na.drop(subset=["TailNum"])
    daily = known.groupBy("TailNum", "Year", "Month", "DayofMonth").agg(F.count("*").alias("n"))
    return daily.groupBy("TailNum", "Year").agg(
        F.sum("n").alias("flights"), F.count("*").alias("days_used")
    ).orderBy(F.desc("flights"), "TailNum", "Year")


def flights_by_period(facts: DataFrame, period: str) -> DataFrame:
    """Flights and cancellations per day, week, month or year, in order of time."""
    day = F.make_date("Year", "Month", "DayofMonth")
    start = day if period == "day" else F.trunc(day, period)
    return facts.groupBy(start.alias("period_start")).agg(
        F.count("*").alias("flights"), F.sum("Cancelled").alias("cancelled")
    ).orderBy("period_start")


def minute_of_day(name: str) -> Column:
    """Minutes since midnight of a time written hhmm; null outside the day."""
    time = F.col(name).try_cast("int")
    minute = F.floor(time / 100) * 60 + time % 100
    return F.when(time.between(0, 2359) & (time % 100 < 60), minute)


def delays_in_busiest_years(stored: DataFrame, edges: DataFrame, years: int = 3) -> DataFrame:
    """Delays per month in the years with most passengers, from facts stored by year.

    Which years these are comes out of the edges while the query runs; the scan of the facts then opens the folders of
    those years only.
    """
    totals = total_by(edges, "fly_year", measure="passengers", name="passengers").filter(F.col("fly_year").isNotNull())
    busiest = row_numbers(totals, F.desc("passengers"), "fly_year").filter(F.col("rank") <= years)
    chosen = stored.join(busiest.select(F.col("fly_year").alias("Year"), "rank"), "Year")
    return chosen.groupBy("Year", "rank", "Month").agg(
        F.count("*").alias("flights"), F.avg(as_number("ArrDelay")).alias("avg_arrival_delay"),
        F.sum("Cancelled").alias("cancelled"),
    ).orderBy("rank", "Month")


def departures_with_readings(
    facts: DataFrame, readings: DataFrame, *, delay: str = "DepDelay", calendar_day: bool = False, how: str = "inner"
) -> DataFrame:
    """Flights with a known delay and the last temperature read that day before or at departure.

    ``readings`` are (IATA, doy, observationTime, temperature), see ``weather.airport_readings``. ``calendar_day`` matches
    month and day only; readings of several years at one time are then averaged. how="left" keeps flights
    without an earlier reading on their day.
    """
    day = F.col("Month") * 100 + F.col("DayofMonth")
    when = F.col("doy")
    if calendar_day:
        when = when % 10000
    else:
        day = F.col("Year") * 10000 + day
    read = readings.select(
        F.col("IATA").alias("Origin"), when.alias("day"), minute_of_day("observationTime").alias("reading_minute"), "temperature",
    ).groupBy("Origin", "day", "reading_minute").agg(F.avg("temperature").alias("temperature"))
    left = facts.select(
        "Origin", "Dest", day.alias("day"), "DepTime", as_number(delay).alias("delay"), minute_of_day("DepTime").alias("minute"),
    ).na.drop(subset=["delay", "minute"])
    found = as_of(left, read, ["Origin", "day"], "minute", "reading_minute", until=1440, bucket=60, how=how)
    return found.drop("minute")


def passengers_by_year(edges: DataFrame) -> DataFrame:
    return total_by(edges, "fly_year", measure="passengers", name="passengers").orderBy("fly_year")


def delays_with_temperatures(
    facts: DataFrame, temperatures: DataFrame, *, delay: str = "ArrDelay", calendar_day: bool = False
) -> DataFrame:
    """Flights with a known delay and the day's temperature at both ends.

    ``calendar_day`` matches month and day only, for weather of another year than the flights;
    temperatures of several years are then averaged, so that no flight is counted twice.
    """
    day = F.col("Month") * 100 + F.col("DayofMonth")
    if calendar_day:
        temperatures = temperatures.groupBy("IATA", (F.col("doy") % 10000).alias("doy")).agg(
            F.avg("temperature").alias("temperature")
        )
    else:
        day = F.col("Year") * 10000 + day
    known = facts.select("Origin", "Dest", day.alias("day"), as_number(delay).alias("delay")).na.drop(subset=["delay"])

    def at(code: str, name: str) -> DataFrame:
        return temperatures.select(F.col("IATA").alias(code), F.col("doy").alias("day"), F.col("temperature").alias(name))

    return (
        known.join(at("Origin", "origin_temperature"), ["Origin", "day"])
        .join(at("Dest", "destination_temperature"), ["Dest", "day"])
        .select("Origin", "Dest", "day", "delay", "origin_temperature", "destination_temperature")
    )
