"""Default parameters of the reports."""

# Fixed values of the original reports.
FOCUS_AIRPORT = "SAT"
FIRST_YEAR = 1990
LAST_YEAR = 2008
TICK_HEIGHT = 6700.0
TICK_EVERY = 12
BUBBLE_DIVISOR = 20000
BUBBLE_BASE = 5.0
WEATHER_BOX = {"west": -130.0, "east": -70.0, "south": 20.0}
AIRPORT_BOX = {"west": -150.0, "east": -70.0, "south": 20.0}
FIRST_MAP_BOX = {"west": -130.0}
LAST_MAP_BOX = {"west": -130.0, "south": 0.0}
BAND_DEGREES = 3.0
REGRESSION_CANDIDATES = ("origin_population", "destination_population", "distance", "passengers", "seats")
REGRESSION_LABEL = "flights"
CLUSTER_COLUMNS = ("Cancelled", "Month", "Latitude")
CLUSTER_COUNT = 2
TEMPERATURE = "TOBS"
RAIN = "PRCP"
DELAY_CAUSES = ("CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay")
