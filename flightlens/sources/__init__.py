"""Readers for the five kinds of input file, and the columnar copy of the flight facts."""

from flightlens.sources.files import (
    UNREADABLE,
    quarantine,
    read_airports,
    read_flight_edges,
    read_flight_facts,
    read_stations,
    read_weather,
    station_locations,
)
from flightlens.sources.sinks import (
    read_by_year,
    write_airports,
    write_by_year,
    write_flight_edges,
    write_flight_facts,
    write_report,
    write_weather,
)

__all__ = [
    "UNREADABLE", "quarantine", "read_airports", "read_by_year", "read_flight_edges", "read_flight_facts", "read_stations",
    "read_weather", "station_locations", "write_airports", "write_by_year", "write_flight_edges", "write_flight_facts",
    "write_report", "write_weather",
]
