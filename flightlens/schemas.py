"""Declared schemas of the input files, as Spark DDL.

Declaring them saves the inference pass over every file and keeps a column's
type the same in every year.
"""

# Column names and order of the input files.

FLIGHT_EDGES = """
    originCode STRING, destinationCode STRING, origin_city STRING, destination_city STRING,
    passengers INT, seats INT, flights INT, distance DOUBLE, fly_date STRING,
    origin_population INT, destination_population INT
"""

FLIGHT_FACTS = """
    Year INT, Month INT, DayofMonth INT, DayOfWeek INT, DepTime INT, CRSDepTime INT,
    ArrTime INT, CRSArrTime INT, UniqueCarrier STRING, FlightNum INT, TailNum STRING,
    ActualElapsedTime INT, CRSElapsedTime INT, AirTime INT, ArrDelay INT, DepDelay INT,
    Origin STRING, Dest STRING, Distance INT, TaxiIn INT, TaxiOut INT, Cancelled INT,
    CancellationCode STRING, Diverted INT, CarrierDelay INT, WeatherDelay INT, NASDelay INT,
    SecurityDelay INT, LateAircraftDelay INT
"""

# Daily weather files have no header; the fields between the value and the time are unused flags.
WEATHER_OBSERVATIONS = """
    stationCode STRING, doy INT, observationType STRING, observationVal INT,
    mFlag STRING, qFlag STRING, sFlag STRING, observationTime INT
"""

# Station list: fixed-width text. name -> (first character counted from 1, length, type).
STATION_SLICES = {
    "stationCode": (1, 11, "string"),
    "lat": (13, 8, "double"),
    "long": (22, 9, "double"),
}

# The older reading of the same file, which starts the longitude one character late and so
# loses the sign of longitudes at or beyond -100 degrees.
REFERENCE_STATION_SLICES = STATION_SLICES | {"long": (23, 8, "double")}
