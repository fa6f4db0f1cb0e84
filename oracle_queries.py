"""DuckDB SQL for the registered queries, over the same Parquet tables.

The views repeat the reshaping of ``flightlens/fixtures.py`` with every inner join written out,
whichever columns a query uses.
"""

from __future__ import annotations

from itertools import combinations

FOCUS = "N15"
FIRST, LAST = 1995, 2001
CANDIDATES = ("origin_population", "destination_population", "distance", "passengers", "seats")


def _code(key: str) -> str:
    return f"concat('N', lpad(CAST({key} AS VARCHAR), 2, '0'))"


BASE = """base AS (
  SELECT l.*, o.o_orderstatus, s.s_nationkey, s.s_acctbal, c.c_nationkey, c.c_acctbal,
         ns.n_name AS origin_name, nc.n_name AS destination_name
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation ns ON s.s_nationkey = ns.n_nationkey
  JOIN nation nc ON c.c_nationkey = nc.n_nationkey
)"""

EDGES = f"""{BASE}, edges AS (
  SELECT {_code('s_nationkey')} AS originCode, {_code('c_nationkey')} AS destinationCode,
         origin_name AS origin_city, destination_name AS destination_city,
         CAST(floor(l_quantity) AS INTEGER) AS passengers,
         CAST(CAST(floor(l_quantity) AS INTEGER) + l_partkey % 10 AS INTEGER) AS seats,
         CAST(l_linenumber AS INTEGER) AS flights,
         l_extendedprice AS distance,
         strftime(l_shipdate, '%Y%m') AS fly_date,
         CAST(substr(strftime(l_shipdate, '%Y%m'), 1, 4) AS INTEGER) AS fly_year,
         CAST(substr(strftime(l_shipdate, '%Y%m'), 5, 2) AS INTEGER) AS fly_month,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(floor(abs(s_acctbal)) AS INTEGER) END AS origin_population,
         CAST(floor(abs(c_acctbal)) AS INTEGER) AS destination_population
  FROM base
)"""

ONLY_FACTS = f"""facts AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS "Year", CAST(month(l_shipdate) AS INTEGER) AS "Month",
         CAST(day(l_shipdate) AS INTEGER) AS "DayofMonth",
         CAST((l_orderkey * 37 + l_linenumber * 101) % 1440 // 60 * 100 + (l_orderkey * 37 + l_linenumber * 101) % 1440 % 60 AS INTEGER) AS "DepTime",
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'NA'
              ELSE CAST((l_orderkey * 7 + l_linenumber * 13) % 200 - 20 AS VARCHAR) END AS "DepDelay",
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'NA'
              ELSE CAST((l_orderkey * 11 + l_linenumber * 17) % 240 - 30 AS VARCHAR) END AS "ArrDelay",
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 ELSE 0 END AS "Cancelled",
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN
              CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'B' WHEN 'P' THEN 'C' END END AS "CancellationCode",
         {_code('s_nationkey')} AS "Origin", {_code('c_nationkey')} AS "Dest",
         CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE concat('T', CAST(l_suppkey AS VARCHAR)) END AS "TailNum",
         (l_orderkey + 1 * l_linenumber) % 30 AS "CarrierDelay",
         (l_orderkey + 2 * l_linenumber) % 30 AS "WeatherDelay",
         (l_orderkey + 3 * l_linenumber) % 30 AS "NASDelay",
         (l_orderkey + 4 * l_linenumber) % 30 AS "SecurityDelay",
         (l_orderkey + 5 * l_linenumber) % 30 AS "LateAircraftDelay"
  FROM base
)"""

FACTS = f"{BASE}, {ONLY_FACTS}"

AIRPORTS = f"""airports AS (
  SELECT {_code('n_nationkey')} AS "IATA", concat(n_name, ' Airport') AS "AirportName", n_name AS "City",
         r_name AS "Country",
         CASE WHEN n_nationkey = 24 THEN NULL ELSE 5.0E0 + 2.5E0 * n_nationkey END AS "Latitude",
         -160.0E0 + 5.0E0 * n_nationkey AS "Longitude"
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

OBSERVATIONS = """observations AS (
  SELECT concat('ST', lpad(CAST(user_id AS VARCHAR), 9, '0')) AS stationCode,
         CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS doy,
         CASE event_type WHEN 'view' THEN 'TOBS' WHEN 'click' THEN 'PRCP' WHEN 'purchase' THEN 'TMAX'
                         WHEN 'signup' THEN 'TMIN' WHEN 'error' THEN 'SNOW' END AS observationType,
         CAST(floor("value") AS INTEGER) AS observationVal,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(strftime(ts, '%H%M') AS INTEGER) END AS observationTime
  FROM events
)"""


def _stations(start: int = 22, length: int = 9) -> str:
    return f"""station_lines AS (
  SELECT DISTINCT concat('ST', lpad(CAST(user_id AS VARCHAR), 9, '0'), ' ',
         lpad(concat(CAST(15 + user_id % 40 AS VARCHAR), '.0000'), 8, ' '), ' ',
         lpad(concat(CAST(user_id % 70 - 135 AS VARCHAR), '.0000'), 9, ' '), '   10.0    STATION') AS line
  FROM events
), stations AS (
  SELECT substr(line, 1, 11) AS stationCode, TRY_CAST(trim(substr(line, 13, 8)) AS DOUBLE) AS lat,
         TRY_CAST(trim(substr(line, {start}, {length})) AS DOUBLE) AS long
  FROM station_lines
)"""


LOCATED = """located AS (
  SELECT DISTINCT o.stationCode, o.doy, o.observationType, o.observationVal, o.observationTime, s.lat, s.long
  FROM observations o JOIN stations s ON o.stationCode = s.stationCode
  WHERE o.doy IS NOT NULL AND o.observationType IS NOT NULL AND o.observationVal IS NOT NULL
    AND o.observationTime IS NOT NULL AND s.lat IS NOT NULL AND s.long IS NOT NULL
)"""

NEAR = """complete_airports AS (
  SELECT * FROM airports WHERE "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL
), near AS (
  SELECT DISTINCT a.*, s.* FROM complete_airports a JOIN stations s
    ON abs(a."Longitude" - s.long) < 3.0E0 AND abs(a."Latitude" - s.lat) < 3.0E0
), closest AS (
  -- the least of all pairs, whatever their distance
  SELECT "IATA", stationCode, distance FROM (
    SELECT "IATA", stationCode,
           sqrt(("Longitude" - long) * ("Longitude" - long) + ("Latitude" - lat) * ("Latitude" - lat)) AS distance,
           row_number() OVER (PARTITION BY "IATA" ORDER BY
             ("Longitude" - long) * ("Longitude" - long) + ("Latitude" - lat) * ("Latitude" - lat), stationCode) AS n
    FROM complete_airports, stations WHERE lat IS NOT NULL AND long IS NOT NULL) WHERE n = 1
)"""

TRAFFIC = f"""{EDGES}, departures AS (
  SELECT origin_city, fly_date, sum(flights) AS n FROM edges GROUP BY ALL
), arrivals AS (
  SELECT destination_city, fly_date, sum(flights) AS n FROM edges GROUP BY ALL
), traffic AS (
  SELECT d.origin_city, d.fly_date, CAST(d.n + a.n AS BIGINT) AS flights
  FROM departures d JOIN arrivals a ON d.fly_date = a.fly_date AND contains(d.origin_city, a.destination_city)
)"""

CHANGES = f"""{EDGES}, ends AS (
  SELECT origin_city AS city, fly_date, fly_month, flights FROM edges
  UNION ALL SELECT destination_city, fly_date, fly_month, flights FROM edges
), monthly AS (
  SELECT city, fly_date, fly_month, sum(flights) AS flights FROM ends GROUP BY ALL
), numbered AS (
  SELECT *, CAST(left(fly_date, 4) AS INTEGER) * 12 + fly_month AS month_number FROM monthly
), changes AS (
  SELECT m.city, m.fly_date, m.fly_month, m.flights, CAST(m.flights - before.flights AS BIGINT) AS change
  FROM numbered m LEFT JOIN numbered before ON before.city = m.city AND before.month_number = m.month_number - 1
)"""


def _airport_traffic(year: int) -> str:
    return f"""{EDGES}, codes AS (
  SELECT d.originCode AS airportCode, d.n AS flightsFrom, a.n AS flightsTo
  FROM (SELECT originCode, sum(flights) AS n FROM edges WHERE fly_year = {year} GROUP BY 1) d
  JOIN (SELECT destinationCode, sum(flights) AS n FROM edges WHERE fly_year = {year} GROUP BY 1) a
    ON contains(d.originCode, a.destinationCode)
)"""


def _airport_traffic_rows(year: int) -> str:
    return f"""WITH {_airport_traffic(year)}
SELECT airportCode, CAST(flightsFrom AS BIGINT) AS "flightsFrom", CAST(flightsTo AS BIGINT) AS "flightsTo",
       CAST(flightsFrom + flightsTo AS BIGINT) AS flights FROM codes"""


def _bubbles(year: int, box: str) -> str:
    return f"""WITH {_airport_traffic(year)}, {AIRPORTS}
SELECT p."Longitude", p."Latitude", CAST(t.flightsFrom + t.flightsTo AS DOUBLE) AS flights,
       round(CAST(t.flightsFrom + t.flightsTo AS DOUBLE) / 20000 + 5.0E0, 6) AS bubble_size
FROM codes t JOIN airports p ON contains(t.airportCode, p."IATA")
WHERE p."Latitude" IS NOT NULL AND p."Longitude" IS NOT NULL AND {box}"""


def _focus(where: str, keys: str) -> str:
    return f"""WITH {EDGES}
SELECT {keys}, CAST(sum(flights) AS BIGINT) AS number_of_flights FROM edges WHERE {where} GROUP BY {keys}"""


def _calendar(where: str) -> str:
    return f"""WITH {EDGES}
SELECT fly_month, CAST(sum(flights) AS BIGINT) AS total_flights FROM edges WHERE {where} GROUP BY fly_month"""


def _calendar_places(year: int) -> str:
    totals = _calendar(f"fly_year = {year}")
    return f"""SELECT *, CAST(row_number() OVER (ORDER BY total_flights, fly_month) AS INTEGER) AS place FROM ({totals})"""


def _period(period: str) -> str:
    return f"""WITH {FACTS}
SELECT CAST(date_trunc('{period}', make_date("Year", "Month", "DayofMonth")) AS DATE) AS period_start,
       count(*) AS flights, CAST(sum("Cancelled") AS BIGINT) AS cancelled FROM facts GROUP BY 1"""


def _determinant(rows: list[list[str]]) -> str:
    if len(rows) == 1:
        return rows[0][0]
    terms = []
    for i, head in enumerate(rows[0]):
        minor = [[x for j, x in enumerate(row) if j != i] for row in rows[1:]]
        terms.append(f"{'-' if i % 2 else '+'} {head} * ({_determinant(minor)})")
    return " ".join(terms)


def _least_squares(name: str, source: str, features: tuple[str, ...], label: str) -> str:
    """CTEs ``{name}_rows`` and ``{name}_fit``: the solved normal equations by Cramer's rule."""
    where = " AND ".join(f"{f} IS NOT NULL" for f in (*features, label))
    cov = {(a, b): f"covar_pop({a}, {b})" for a in features for b in (*features, label)}
    cells = [[f"m{i}_{j}" for j in range(len(features))] for i in range(len(features))]
    moments = [f"{cov[a, b]} AS m{i}_{j}" for i, a in enumerate(features) for j, b in enumerate(features)]
    moments += [f"{cov[a, label]} AS r{i}" for i, a in enumerate(features)]
    moments += [f"avg({a}) AS a{i}" for i, a in enumerate(features)] + [f"avg({label}) AS al"]
    whole = _determinant(cells)
    slopes = []
    for k in range(len(features)):
        swapped = [[f"r{i}" if j == k else x for j, x in enumerate(row)] for i, row in enumerate(cells)]
        slopes.append(f"({_determinant(swapped)}) / ({whole}) AS b{k}")
    intercept = "al - " + " - ".join(f"b{k} * a{k}" for k in range(len(features)))
    columns = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in (*features, label))
    return f"""{name}_rows AS (SELECT {columns} FROM {source} WHERE {where}),
{name}_moments AS (SELECT {', '.join(moments)} FROM {name}_rows),
{name}_slopes AS (SELECT *, {', '.join(slopes)} FROM {name}_moments),
{name}_fit AS (SELECT {', '.join(f'b{k}' for k in range(len(features)))}, {intercept} AS b FROM {name}_slopes)"""


def _mae(name: str, features: tuple[str, ...], label: str) -> str:
    value = " + ".join(["b", *(f"b{k} * {f}" for k, f in enumerate(features))])
    return f"avg(abs({label} - ({value}))) FROM {name}_rows, {name}_fit"


def _feature_search() -> str:
    fits, rows = [], []
    for i, features in enumerate(combinations(CANDIDATES, 3)):
        fits.append(_least_squares(f"f{i}", "edges", features, "flights"))
        error = _mae(f"f{i}", features, "flights")
        rows.append(f"SELECT '{','.join(features)}' AS features, {error.replace(' FROM', ' AS mae FROM', 1)}")
    return f"WITH {EDGES}, {', '.join(fits)}, searched AS ({' UNION ALL '.join(rows)})"


def _model(views: str, source: str, features: tuple[str, ...], label: str) -> str:
    terms = [("intercept", "b"), *((f, f"b{k}") for k, f in enumerate(features))]
    rows = " UNION ALL ".join(
        f"SELECT '{term}' AS term, round({column}, 9) AS coefficient FROM f_fit" for term, column in terms
    )
    return f"""WITH {views}, {_least_squares('f', source, features, label)}, terms AS ({rows}),
error AS (SELECT {_mae('f', features, label).replace(' FROM', ' AS mae FROM', 1)})
SELECT term, coefficient, round(mae, 6) AS mae FROM terms, error"""


TEMPERATURES = f"""{AIRPORTS}, {OBSERVATIONS}, {_stations()}, {NEAR}, daily AS (
  SELECT stationCode, doy, avg(observationVal) AS temperature FROM (SELECT DISTINCT * FROM observations)
  WHERE observationType = 'TOBS' AND observationTime IS NOT NULL AND observationVal IS NOT NULL GROUP BY ALL
), by_day AS (
  SELECT c."IATA", d.doy % 10000 AS md, avg(d.temperature) AS temperature
  FROM closest c JOIN daily d ON c.stationCode = d.stationCode GROUP BY ALL
)"""

PAIRS = f"""{FACTS}, {TEMPERATURES}, pairs AS (
  SELECT f."Origin", f."Dest", f."Month" * 100 + f."DayofMonth" AS "day", TRY_CAST(f."ArrDelay" AS DOUBLE) AS delay,
         o.temperature AS origin_temperature, d.temperature AS destination_temperature
  FROM facts f
  JOIN by_day o ON f."Origin" = o."IATA" AND f."Month" * 100 + f."DayofMonth" = o.md
  JOIN by_day d ON f."Dest" = d."IATA" AND f."Month" * 100 + f."DayofMonth" = d.md
  WHERE TRY_CAST(f."ArrDelay" AS DOUBLE) IS NOT NULL
)"""

# The last reading at or before departure, by DuckDB's own as-of join.
DEPARTURES = f"""{FACTS}, {AIRPORTS}, {OBSERVATIONS}, {_stations()}, {NEAR}, timed AS (
  SELECT stationCode, doy, observationTime, avg(observationVal) AS temperature FROM (SELECT DISTINCT * FROM observations)
  WHERE observationType = 'TOBS' AND observationTime IS NOT NULL AND observationVal IS NOT NULL GROUP BY ALL
), readings AS (
  SELECT c."IATA", t.doy % 10000 AS md, CAST(observationTime // 100 * 60 + observationTime % 100 AS BIGINT) AS reading_minute,
         avg(t.temperature) AS temperature
  FROM closest c JOIN timed t ON c.stationCode = t.stationCode GROUP BY ALL
), departures AS (
  SELECT "Origin", "Dest", "Month" * 100 + "DayofMonth" AS "day", "DepTime", TRY_CAST("DepDelay" AS DOUBLE) AS delay,
         "DepTime" // 100 * 60 + "DepTime" % 100 AS minute
  FROM facts WHERE TRY_CAST("DepDelay" AS DOUBLE) IS NOT NULL
)"""

AIRPORT_FLIGHTS = f"""{FACTS}, {AIRPORTS}, airport_flights AS (
  SELECT a."AirportName", a."City", a."Country", a."Latitude", a."Longitude", f."Year", f."Month", f."DayofMonth",
         f."DepDelay", f."ArrDelay", f."Cancelled", f."CancellationCode", f."Dest"
  FROM facts f JOIN airports a ON contains(a."IATA", f."Origin")
  WHERE a."Longitude" < -70 AND a."Longitude" > -150 AND a."Latitude" > 20
)"""


CLUSTERED = f"""{AIRPORTS}, origins AS (
  SELECT s_suppkey, "Latitude" FROM supplier JOIN airports ON contains("IATA", {_code('s_nationkey')})
  WHERE "Longitude" < -70 AND "Longitude" > -150 AND "Latitude" > 20
), kept AS MATERIALIZED (
  SELECT CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 ELSE 0 END AS "Cancelled",
         CAST(month(l_shipdate) AS INTEGER) AS "Month", "Latitude"
  FROM lineitem JOIN origins ON l_suppkey = s_suppkey
), deviations AS (
  SELECT stddev_samp("Cancelled") AS c, stddev_samp("Month") AS m, stddev_samp("Latitude") AS l FROM kept)"""

# Two clusters: Lloyd's steps from the halves by each axis, 60 of them (the last ones move nothing), and
# the cheapest of the three ends.
CLUSTERS = f"""WITH RECURSIVE {CLUSTERED}, points AS MATERIALIZED (
  SELECT "Cancelled", "Month", "Latitude", "Cancelled" / any_value(c) AS x, "Month" / any_value(m) AS y, "Latitude" / any_value(l) AS z,
         count(*) AS w FROM kept, deviations GROUP BY "Cancelled", "Month", "Latitude"
), middles AS (
  SELECT sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my, sum(w * z) / sum(w) AS mz FROM points
), halves AS (
  SELECT 1 AS start, x < mx AS low, x, y, z, w FROM points, middles
  UNION ALL SELECT 2, y < my, x, y, z, w FROM points, middles
  UNION ALL SELECT 3, z < mz, x, y, z, w FROM points, middles
), steps AS (
  SELECT start, 0 AS step, sum(w * x) FILTER (low) / sum(w) FILTER (low) AS ax, sum(w * y) FILTER (low) / sum(w) FILTER (low) AS ay,
         sum(w * z) FILTER (low) / sum(w) FILTER (low) AS az, sum(w * x) FILTER (NOT low) / sum(w) FILTER (NOT low) AS bx,
         sum(w * y) FILTER (NOT low) / sum(w) FILTER (NOT low) AS b_y, sum(w * z) FILTER (NOT low) / sum(w) FILTER (NOT low) AS bz
  FROM halves GROUP BY start
  UNION ALL
  SELECT start, step + 1, sum(w * x) FILTER (low) / sum(w) FILTER (low), sum(w * y) FILTER (low) / sum(w) FILTER (low),
         sum(w * z) FILTER (low) / sum(w) FILTER (low), sum(w * x) FILTER (NOT low) / sum(w) FILTER (NOT low),
         sum(w * y) FILTER (NOT low) / sum(w) FILTER (NOT low), sum(w * z) FILTER (NOT low) / sum(w) FILTER (NOT low)
  FROM (SELECT s.*, x, y, z, w, (x - ax)**2 + (y - ay)**2 + (z - az)**2 <= (x - bx)**2 + (y - b_y)**2 + (z - bz)**2 AS low
        FROM steps s, points WHERE step < 60) GROUP BY start, step
), ends AS (
  SELECT start, ax, ay, az, bx, b_y, bz, sum(w * least((x - ax)**2 + (y - ay)**2 + (z - az)**2, (x - bx)**2 + (y - b_y)**2 + (z - bz)**2)) AS cost
  FROM steps, points WHERE step = 60 GROUP BY ALL ORDER BY cost, start LIMIT 1
), centers AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY x, y, z) - 1 AS INTEGER) AS prediction, x, y, z
  FROM (SELECT ax AS x, ay AS y, az AS z FROM ends UNION ALL SELECT bx, b_y, bz FROM ends)
), spots AS MATERIALIZED (
  SELECT p."Cancelled", p."Month", p."Latitude", p.x, p.y, p.z, p.w,
         arg_min(t.prediction, (p.x - t.x)**2 + (p.y - t.y)**2 + (p.z - t.z)**2) AS prediction
  FROM points p, centers t GROUP BY ALL
)"""


def _wide(start: int, length: int) -> str:
    return f"""WITH {OBSERVATIONS}, {_stations(start, length)}, {LOCATED}
SELECT t.stationCode, t.doy, p.observationVal AS precip, t.observationVal AS temperature, p.lat, p.long
FROM (SELECT * FROM located WHERE observationType = 'TOBS') t
JOIN (SELECT * FROM located WHERE observationType = 'PRCP') p ON t.stationCode = p.stationCode AND t.doy = p.doy
WHERE p.long < -70 AND p.long > -130 AND p.lat > 20"""


def _average_delay(column: str, name: str) -> str:
    return f"""WITH {FACTS}
SELECT "Year", round(avg(TRY_CAST("{column}" AS DOUBLE)), 6) AS {name} FROM facts GROUP BY "Year\""""


def _union_years() -> str:
    columns = '"Year", "Month", "DayofMonth", "Origin", "Dest", "DepDelay", "ArrDelay", "Cancelled"'
    yearly = (f'SELECT {columns} FROM facts WHERE "Year" = {year}' for year in range(FIRST, LAST + 1))
    return f"WITH {FACTS}\n" + "\nUNION ALL ".join(yearly)


def _delay_causes() -> str:
    causes = ("CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay")
    rows = (
        f"SELECT '{cause}' AS cause, CAST(sum(\"{cause}\") AS BIGINT) AS total_minutes, "
        f"count(*) FILTER (WHERE \"{cause}\" > 0) AS flights_delayed FROM facts" for cause in causes
    )
    return f"WITH {FACTS}\n" + "\nUNION ALL ".join(rows)


def _correlations() -> str:
    rows = (
        f"SELECT '{p}' AS population, '{m}' AS measure, round(corr({p}, {m}), 9) AS correlation FROM edges"
        for p in ("origin_population", "destination_population") for m in ("passengers", "flights")
    )
    return f"WITH {EDGES}\n" + "\nUNION ALL ".join(rows)


def _stepwise(candidates: tuple[str, ...], label: str) -> str:
    """Three steps of forward selection by partial correlations, from the plain ones."""
    names = (*candidates, label)
    where = " AND ".join(f"{name} IS NOT NULL" for name in names)
    pairs = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM known" for a in names for b in names if a != b)
    return f"""WITH {EDGES}, known AS (SELECT * FROM edges WHERE {where}), r AS MATERIALIZED ({pairs}),
first AS (SELECT a, r, r * r AS explained FROM r WHERE b = '{label}' ORDER BY explained DESC LIMIT 1),
given1 AS MATERIALIZED (  -- correlations of all pairs, the first feature given
  SELECT x.a, x.b, (x.r - p.r * q.r) / sqrt((1 - p.r * p.r) * (1 - q.r * q.r)) AS r
  FROM r x, first f, r p, r q WHERE p.a = x.a AND p.b = f.a AND q.a = x.b AND q.b = f.a AND x.a <> f.a AND x.b <> f.a),
second AS (SELECT g.a, 1 - (1 - f.explained) * (1 - g.r * g.r) AS explained FROM given1 g, first f WHERE g.b = '{label}'
  ORDER BY g.r * g.r DESC LIMIT 1),
given2 AS (
  SELECT x.a, x.b, (x.r - p.r * q.r) / sqrt((1 - p.r * p.r) * (1 - q.r * q.r)) AS r
  FROM given1 x, second s, given1 p, given1 q WHERE p.a = x.a AND p.b = s.a AND q.a = x.b AND q.b = s.a AND x.a <> s.a AND x.b <> s.a),
third AS (SELECT g.a, 1 - (1 - s.explained) * (1 - g.r * g.r) AS explained FROM given2 g, second s WHERE g.b = '{label}'
  ORDER BY g.r * g.r DESC LIMIT 1)
SELECT CAST(1 AS INTEGER) AS step, a AS feature, round(explained, 6) AS r_squared FROM first
UNION ALL SELECT CAST(2 AS INTEGER), a, round(explained, 6) FROM second UNION ALL SELECT CAST(3 AS INTEGER), a, round(explained, 6) FROM third"""


def _routes() -> str:
    return f"WITH {EDGES}\nSELECT DISTINCT origin_city, destination_city, distance FROM edges"


def oracle_sql() -> dict[str, str]:
    both = f"originCode = '{FOCUS}' OR destinationCode = '{FOCUS}'"
    inbound, outbound = f"destinationCode = '{FOCUS}'", f"originCode = '{FOCUS}'"
    return {
        # sources and projections
        "station_locations": f"WITH {_stations()} SELECT * FROM stations",
        "station_locations_reference_slices": f"WITH {_stations(23, 8)} SELECT * FROM stations",
        "edges_with_period": f"WITH {EDGES} SELECT * FROM edges",
        "union_years": _union_years(),
        "facts_from_files": f"""WITH {FACTS} SELECT * REPLACE (TRY_CAST("ArrDelay" AS INTEGER) AS "ArrDelay",
TRY_CAST("DepDelay" AS INTEGER) AS "DepDelay", CAST("CarrierDelay" AS INTEGER) AS "CarrierDelay", CAST("WeatherDelay" AS INTEGER) AS "WeatherDelay",
CAST("NASDelay" AS INTEGER) AS "NASDelay", CAST("SecurityDelay" AS INTEGER) AS "SecurityDelay",
CAST("LateAircraftDelay" AS INTEGER) AS "LateAircraftDelay") FROM facts""",
        "edges_from_files": f"WITH {EDGES} SELECT * EXCLUDE (fly_year, fly_month) FROM edges",
        "airports_from_files": f"WITH {AIRPORTS} SELECT * FROM airports",
        "weather_from_files": f"WITH {OBSERVATIONS} SELECT * FROM observations",
        "stations_from_files": f"WITH {_stations()} SELECT * FROM stations",
        # weather
        "weather_with_location": f"WITH {OBSERVATIONS}, {_stations()}, {LOCATED} SELECT * FROM located",
        "weather_daily_wide": _wide(22, 9),
        "weather_daily_wide_reference_slices": _wide(23, 8),
        "airports_near_stations": f"WITH {AIRPORTS}, {_stations()}, {NEAR} SELECT * FROM near",
        "nearest_station": f"""WITH {AIRPORTS}, {_stations()}, {NEAR}
SELECT "IATA", stationCode, round(distance, 6) AS distance FROM closest""",
        # delays
        "avg_arrival_delay_by_year": _average_delay("ArrDelay", "avg_arrival_delay"),
        "avg_departure_delay_by_year": _average_delay("DepDelay", "avg_departure_delay"),
        "flights_at_airports_in_box": f"WITH {AIRPORT_FLIGHTS} SELECT * FROM airport_flights",
        "delay_causes": _delay_causes(),
        "cancellation_reasons": f"""WITH {FACTS} SELECT "CancellationCode", count(*) AS cancelled_flights FROM facts
WHERE "Cancelled" = 1 AND "CancellationCode" IS NOT NULL GROUP BY 1""",
        "plane_use": f"""WITH {FACTS} SELECT "TailNum", "Year", count(*) AS flights,
count(DISTINCT make_date("Year", "Month", "DayofMonth")) AS days_used
FROM facts WHERE "TailNum" IS NOT NULL GROUP BY 1, 2""",
        "flights_by_day": _period("day"),
        "flights_by_week": _period("week"),
        "flights_by_year": _period("year"),
        "delays_with_temperatures": f"""WITH {PAIRS} SELECT "Origin", "Dest", "day", delay,
round(origin_temperature, 6) AS origin_temperature, round(destination_temperature, 6) AS destination_temperature
FROM pairs""",
        "delay_temperature_model": _model(PAIRS, "pairs", ("origin_temperature", "destination_temperature"), "delay"),
        "delays_in_busiest_years": f"""WITH {EDGES}, {ONLY_FACTS}, busiest AS (
  SELECT fly_year, row_number() OVER (ORDER BY sum(passengers) DESC, fly_year) AS rank FROM edges GROUP BY fly_year)
SELECT "Year", rank, "Month", count(*) AS flights, round(avg(TRY_CAST("ArrDelay" AS DOUBLE)), 6) AS avg_arrival_delay,
       CAST(sum("Cancelled") AS BIGINT) AS cancelled
FROM facts JOIN busiest ON "Year" = fly_year WHERE rank <= 3 GROUP BY ALL""",
        "departures_with_readings": f"""WITH {DEPARTURES}
SELECT d."Origin", d."Dest", d."day", d."DepTime", d.delay, r.reading_minute, round(r.temperature, 6) AS temperature
FROM departures d ASOF JOIN readings r ON d."Origin" = r."IATA" AND d."day" = r.md AND d.minute >= r.reading_minute""",
        # one airport
        "focus_flights_by_year": _focus(both, "fly_year"),
        "focus_flights_by_month": _focus(both, "fly_date") + " ORDER BY number_of_flights DESC, fly_date LIMIT 20",
        "focus_month_histogram": _focus(both, "fly_date"),
        "focus_month_series": f"""WITH {EDGES}, months AS (
  SELECT fly_date, CAST(row_number() OVER (ORDER BY fly_date) - 1 AS INTEGER) AS month_index,
         CAST(sum(flights) AS DOUBLE) AS n FROM edges WHERE {both} GROUP BY fly_date)
SELECT fly_date, month_index, 'number_of_flights' AS series, n AS "value" FROM months
UNION ALL SELECT fly_date, month_index, 'tick', 6700.0E0 FROM months WHERE month_index % 12 = 0""",
        "focus_inbound_city_year": _focus(inbound, "origin_city, fly_year"),
        "focus_inbound_city": _focus(inbound, "origin_city"),
        "focus_outbound_city_year": _focus(outbound, "destination_city, fly_year"),
        "focus_outbound_city": _focus(outbound, "destination_city"),
        "focus_inbound_city_year_first_last":
            _focus(f"{inbound} AND fly_year IN ({FIRST}, {LAST})", "origin_city, fly_year"),
        "focus_outbound_city_year_first_last":
            _focus(f"{outbound} AND fly_year IN ({FIRST}, {LAST})", "destination_city, fly_year"),
        # traffic, maps, routes
        "traffic_by_city_month": f"WITH {TRAFFIC} SELECT * FROM traffic",
        "traffic_by_same_city_month": f"""WITH {TRAFFIC}
SELECT d.origin_city, d.fly_date, CAST(d.n + a.n AS BIGINT) AS flights
FROM departures d JOIN arrivals a ON d.fly_date = a.fly_date AND d.origin_city = a.destination_city""",
        "busiest_city_months": f"""WITH {TRAFFIC} SELECT * FROM traffic
ORDER BY flights DESC, origin_city, fly_date LIMIT 20""",
        "least_travelled_city_months": f"""WITH {TRAFFIC} SELECT * FROM traffic
ORDER BY flights, origin_city, fly_date LIMIT 20""",
        "ranked_city_months": f"""WITH {TRAFFIC}
SELECT *, row_number() OVER (ORDER BY flights DESC, origin_city, fly_date) AS rank FROM traffic""",
        "ranked_routes": f"""SELECT *, row_number() OVER (ORDER BY distance DESC, origin_city, destination_city) AS rank FROM ({_routes()})""",
        "airport_traffic_first_year": _airport_traffic_rows(FIRST),
        "airport_traffic_last_year": _airport_traffic_rows(LAST),
        "airport_bubbles_first_year": _bubbles(FIRST, 'p."Longitude" > -130'),
        "airport_bubbles_last_year": _bubbles(LAST, 'p."Longitude" > -130 AND p."Latitude" > 0'),
        "contains_join_airports": f"""WITH {EDGES}, {AIRPORTS}, totals AS (
  SELECT origin_city, CAST(sum(flights) AS BIGINT) AS number_of_flights FROM edges GROUP BY 1)
SELECT t.*, a.* FROM totals t JOIN airports a ON contains(t.origin_city, a."City")""",
        "routes_longest": f"{_routes()} ORDER BY distance DESC, origin_city, destination_city LIMIT 20",
        "routes_shortest": f"{_routes()} ORDER BY distance, origin_city, destination_city LIMIT 20",
        "route_lines": f"""WITH {EDGES}, {AIRPORTS}
SELECT e.originCode, e.destinationCode, e.fly_year, CAST(sum(e.flights) AS BIGINT) AS flights,
       o."Latitude" AS origin_lat, o."Longitude" AS origin_long,
       d."Latitude" AS destination_lat, d."Longitude" AS destination_long
FROM edges e JOIN airports o ON e.originCode = o."IATA" JOIN airports d ON e.destinationCode = d."IATA" GROUP BY ALL""",
        # seasons and load
        "flights_by_calendar_month": _calendar("true"),
        "flights_by_calendar_month_first_year": _calendar(f"fly_year = {FIRST}"),
        "flights_by_calendar_month_last_year": _calendar(f"fly_year = {LAST}"),
        "calendar_months_by_total_first_year": _calendar_places(FIRST),
        "calendar_months_by_total_last_year": _calendar_places(LAST),
        "passengers_by_year": f"""WITH {EDGES}
SELECT fly_year, CAST(sum(passengers) AS BIGINT) AS passengers FROM edges GROUP BY 1""",
        "passengers_per_flight_by_year": f"""WITH {EDGES}
SELECT fly_year, round(CAST(sum(passengers) AS DOUBLE) / sum(flights), 6) AS passengers_per_flight
FROM edges GROUP BY 1""",
        "seats_filled_by_year": f"""WITH {EDGES}
SELECT fly_year, round(CAST(sum(passengers) AS DOUBLE) / sum(seats), 6) AS fraction_seats_filled,
       round(CAST(sum(passengers) AS DOUBLE) / sum(seats) * 100, 6) AS percent_seats_filled FROM edges GROUP BY 1""",
        "load_series": f"""WITH {EDGES}
SELECT fly_year, 'passengers_per_flight' AS series,
       round(CAST(sum(passengers) AS DOUBLE) / sum(flights), 6) AS "value" FROM edges GROUP BY 1
UNION ALL SELECT fly_year, 'percent_seats_filled', round(CAST(sum(passengers) AS DOUBLE) / sum(seats) * 100, 6)
FROM edges GROUP BY 1""",
        # trends
        "seasonal_spikes": f"""WITH {CHANGES}
SELECT city, fly_month, round(avg(change), 6) AS avg_change, count(*) AS years
FROM changes WHERE change IS NOT NULL GROUP BY 1, 2""",
        "trend_breaks": f"""WITH {CHANGES}, scored AS (
  SELECT city, fly_date, change, avg(change) OVER w AS usual, stddev_samp(change) OVER w AS deviation
  FROM changes WINDOW w AS (PARTITION BY city, fly_month))
SELECT city, fly_date, change, round(usual, 6) AS usual_change, round((change - usual) / deviation, 6) AS z_score
FROM scored WHERE deviation > 0 AND abs((change - usual) / deviation) >= 2""",
        "trend_spans": f"""WITH {CHANGES}, scored AS (
  SELECT city, fly_date, CAST(left(fly_date, 4) AS INTEGER) * 12 + fly_month AS m, change, avg(change) OVER w AS usual,
         stddev_samp(change) OVER w AS deviation FROM changes WINDOW w AS (PARTITION BY city, fly_month)
), breaks AS (
  SELECT city, fly_date, m, change - usual AS off, (change - usual) / deviation AS z FROM scored
  WHERE deviation > 0 AND abs((change - usual) / deviation) >= 1
), begun AS (
  SELECT *, CASE WHEN m - 1 = lag(m) OVER (PARTITION BY city ORDER BY m) THEN 0 ELSE 1 END AS begins FROM breaks
), spans AS (
  SELECT *, sum(begins) OVER (PARTITION BY city ORDER BY m) AS span FROM begun)
SELECT city, min(fly_date) AS "from", max(fly_date) AS "to", count(*) AS months, round(sum(off), 6) AS departure,
       round(max(abs(z)), 6) AS largest_z FROM spans GROUP BY city, span""",
        "travel_trend": f"""WITH {CHANGES}, yearly AS (
  SELECT city, CAST(left(fly_date, 4) AS INTEGER) AS y, CAST(sum(flights) AS BIGINT) AS n FROM monthly GROUP BY ALL
), jumps AS (
  SELECT b.city, b.y, b.n - a.n AS jump, row_number() OVER (PARTITION BY b.city ORDER BY abs(b.n - a.n) DESC, b.y) AS o
  FROM yearly a JOIN yearly b ON a.city = b.city AND a.y + 1 = b.y
)
SELECT y.city, count(*) AS years, CAST(sum(y.n) AS BIGINT) AS flights, round(regr_slope(y.n, y.y), 6) AS yearly_change,
       any_value(j.y) AS jump_year, any_value(j.jump) AS jump
FROM yearly y LEFT JOIN jumps j ON y.city = j.city AND j.o = 1 GROUP BY y.city""",
        "travel_stepwise": _stepwise(("origin_population", "destination_population", "distance", "seats", "flights"), "passengers"),
        "travel_change": f"""WITH {CHANGES}, totals AS (
  SELECT city, CAST(coalesce(sum(flights) FILTER (WHERE fly_date LIKE '{FIRST}%'), 0) AS BIGINT) AS first_year_flights,
         CAST(coalesce(sum(flights) FILTER (WHERE fly_date LIKE '{LAST}%'), 0) AS BIGINT) AS last_year_flights
  FROM monthly WHERE fly_date LIKE '{FIRST}%' OR fly_date LIKE '{LAST}%' GROUP BY city)
SELECT *, last_year_flights - first_year_flights AS change FROM totals""",
        "population_travel_correlation": _correlations(),
        # models
        "lr_feature_search": f"{_feature_search()} SELECT features, round(mae, 6) AS mae FROM searched",
        "lr_best_features": f"""{_feature_search()} SELECT features, round(mae, 6) AS mae FROM searched
ORDER BY searched.mae, features LIMIT 1""",
        "lr_model_fit": _model(EDGES, "edges", ("origin_population", "distance", "passengers"), "flights"),
        "scaled_features": f"""WITH {CLUSTERED}
SELECT "Cancelled", "Month", "Latitude", round("Cancelled" / c, 6) AS "scaled_Cancelled",
       round("Month" / m, 6) AS "scaled_Month", round("Latitude" / l, 6) AS "scaled_Latitude" FROM kept, deviations""",
        "kmeans_centers": f"""{CLUSTERS}
SELECT prediction, round(x, 6) AS "scaled_Cancelled", round(y, 6) AS "scaled_Month", round(z, 6) AS "scaled_Latitude",
       round(x * c, 6) AS "Cancelled", round(y * m, 6) AS "Month", round(z * l, 6) AS "Latitude" FROM centers, deviations""",
        "kmeans_cluster_sizes": f"""{CLUSTERS}
SELECT prediction, CAST(sum(w) AS BIGINT) AS members FROM spots GROUP BY prediction""",
        "kmeans_predictions": f"""{CLUSTERS}
SELECT kept.*, prediction FROM kept JOIN spots USING ("Cancelled", "Month", "Latitude")""",
        "kmeans_silhouette": f"""{CLUSTERS}, clusters AS (
  SELECT prediction AS p, sum(w) AS n, sum(w * (x * x + y * y + z * z)) AS norms, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * z) AS sz
  FROM spots GROUP BY prediction
), apart AS (  -- the mean squared distance of a spot to all members of a cluster, itself included
  SELECT s.*, p, n, x * x + y * y + z * z + norms / n - 2 * (x * sx + y * sy + z * sz) / n AS d FROM spots s, clusters
), scored AS (
  SELECT any_value(w) AS w, min(d * n / nullif(n - 1, 0)) FILTER (WHERE p = prediction) AS own, min(d) FILTER (WHERE p <> prediction) AS other
  FROM apart GROUP BY "Cancelled", "Month", "Latitude"
)
SELECT 2 AS k, round(sum(w * coalesce((other - own) / greatest(own, other), 0)) / sum(w), 6) AS silhouette FROM scored""",
    }
