from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flightlens.functions import in_box
from flightlens.operators import band_join, many_to_many, nearest
from flightlens.plans.constants import BAND_DEGREES, RAIN, TEMPERATURE, WEATHER_BOX
from flightlens.session import materialize

BAND = (("Longitude", "long"), ("Latitude", "lat"))


def weather_with_location(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Distinct complete observations with the coordinates of their station.

    Rows with any null, a missing time included, are dropped. Both steps are done per side before
    the join, which gives the same rows because the join keeps every column of both sides, and
    moves no coordinates through the shuffle that removes copies.
    """
    return observations.na.drop().distinct().join(stations.na.drop().distinct(), "stationCode")


def temperature_and_rain(
    observations: DataFrame, stations: DataFrame, box: dict[str, float] | None = None
) -> DataFrame:
    """Temperature and rain of the same station and day side by side, inside a box.

    Several readings of a kind on one day all pair up, so this is a join and not a pivot; a station's day with
    very many readings is split over tasks. Both
    inputs are read once: the stations with a place in the box, a small table, and the complete
    readings of the two kinds at those stations are summaries that the two sides share.
    """
    inside = in_box("lat", "long", **(WEATHER_BOX if box is None else box))
    complete = materialize(stations.na.drop().distinct(), "complete-stations")
    places = complete.join(complete.filter(inside).select("stationCode"), "stationCode", "left_semi")
    both = observations.filter(F.col("observationType").isin(TEMPERATURE, RAIN)).na.drop()
    at_places = both.join(places.select("stationCode"), "stationCode", "left_semi").distinct()
    located = materialize(at_places.join(places, "stationCode"), "located-readings")

    def readings(kind: str, name: str, *more: str) -> DataFrame:
        kept = located.filter(F.col("observationType") == kind)
        return kept.select("stationCode", "doy", F.col("observationVal").alias(name), *more)

    rain = readings(RAIN, "precip", "lat", "long").filter(inside)
    wide = many_to_many(readings(TEMPERATURE, "temperature"), rain, ["stationCode", "doy"])
    return wide.select("stationCode", "doy", "precip", "temperature", "lat", "long")


def airports_near_stations(airports: DataFrame, stations: DataFrame, width: float = BAND_DEGREES) -> DataFrame:
    """Distinct complete pairs of airport and station closer than the band on both axes."""
    ports, places = airports.na.drop().distinct(), stations.na.drop().distinct()
    near = band_join(places, ports, [(place, port) for port, place in BAND], width)  # the few airports are copied
    return near.select(*airports.columns, *stations.columns)


def nearest_station(airports: DataFrame, stations: DataFrame, width: float = BAND_DEGREES) -> DataFrame:
    """For each airport the closest station, with the distance in degrees; the search begins within the band."""
    # Both joins of the search read the places, so that these are put together once.
    ports = materialize(airports.select("IATA", "Longitude", "Latitude"), "airport-places")
    places = materialize(stations.select("stationCode", "long", "lat"), "station-places")
    return nearest(ports, places, BAND, width, key="IATA", candidate="stationCode")


def airport_readings(
    observations: DataFrame, airports: DataFrame, stations: DataFrame, width: float = BAND_DEGREES
) -> DataFrame:
    """Temperatures read at each airport's nearest station, with their day and time; several at one time are averaged."""
    readings = observations.na.drop().distinct().filter(F.col("observationType") == TEMPERATURE)
    timed = readings.groupBy("stationCode", "doy", "observationTime").agg(F.avg("observationVal").alias("temperature"))
    placed = nearest_station(airports.na.drop(), stations.na.drop(), width)
    return placed.join(timed, "stationCode").select("IATA", "doy", "observationTime", "temperature")


def airport_temperatures(
    observations: DataFrame, airports: DataFrame, stations: DataFrame, width: float = BAND_DEGREES
) -> DataFrame:
    """Mean temperature per airport and day, read at the airport's nearest station.

    A small table (airports by days), written once because flights meet it at both ends.
    """
    readings = observations.na.drop().distinct().filter(F.col("observationType") == TEMPERATURE)
    daily = readings.groupBy("stationCode", "doy").agg(F.avg("observationVal").alias("temperature"))
    placed = nearest_station(airports.na.drop(), stations.na.drop(), width)
    return materialize(placed.join(daily, "stationCode").select("IATA", "doy", "temperature"), "temperatures")
