"""Small files written by the test and read back."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flightlens import schemas, sources
from flightlens.operators import average_by, union_by_position
from flightlens.plans import delays
from flightlens.plans.delays import avg_arrival_delay_by_year
from flightlens.sources import (
    read_airports,
    read_flight_edges,
    read_flight_facts,
    read_stations,
    read_weather,
    write_by_year,
    write_report,
)

FACT_NAMES = [field.split()[0] for field in schemas.FLIGHT_FACTS.split(",")]


def _fact(**known):
    return ",".join(str(known.get(name, "NA")) for name in FACT_NAMES)


def _write_facts(folder, year, *rows):
    path = folder / f"{year}.csv"
    path.write_text("\n".join([",".join(FACT_NAMES), *(_fact(Year=year, **row) for row in rows)]) + "\n")
    return str(path)


def test_fact_columns():
    assert len(FACT_NAMES) == 29
    assert FACT_NAMES[:4] == ["Year", "Month", "DayofMonth", "DayOfWeek"]


def test_yearly_files_in_one_scan(spark, tmp_path):
    paths = [
        _write_facts(tmp_path, 1990, {"ArrDelay": 5, "Origin": "SAT"}, {"ArrDelay": "NA"}),
        _write_facts(tmp_path, 1991, {"ArrDelay": 7}),
        _write_facts(tmp_path, 1992, {"ArrDelay": "NA"}),
    ]
    facts = read_flight_facts(spark, paths)
    assert facts.count() == 4
    assert dict(facts.dtypes)["ArrDelay"] == "int"
    means = {row.Year: row.avg_arrival_delay for row in avg_arrival_delay_by_year(facts).collect()}
    assert means == {1990: 5.0, 1991: 7.0, 1992: None}
    assert facts.filter("Origin = 'SAT'").select("TailNum").first()[0] is None

    apart = union_by_position(read_flight_facts(spark, path) for path in paths)
    assert sorted(map(str, apart.collect())) == sorted(map(str, facts.collect()))


def test_inferred_types_keep_missing_values(spark, tmp_path):
    path = _write_facts(tmp_path, 1990, {"ArrDelay": 5, "Origin": "SAT"}, {"ArrDelay": "NA", "Origin": "DFW"})
    facts = read_flight_facts(spark, path, infer=True)
    assert dict(facts.dtypes)["ArrDelay"] == "int"
    assert [row[0] for row in facts.orderBy("Origin").select("ArrDelay").collect()] == [None, 5]


def test_text_delays(spark):
    rows = spark.createDataFrame([(1990, "5"), (1990, "NA"), (1991, "7"), (1992, "NA")], "Year INT, Delay STRING")
    means = {row.Year: row.m for row in average_by(rows, "Year", "Delay", "m").collect()}
    assert means == {1990: 5.0, 1991: 7.0, 1992: None}


def test_edges(spark, tmp_path):
    path = tmp_path / "edges.tsv"
    path.write_text(
        "a\tb\tc\td\te\tf\tg\th\ti\tj\tk\n"
        "SAT\tDFW\tSan Antonio, TX\tDallas, TX\t21\t30\t1\t247.0\t199010\t100\t200\n"
        "DFW\tSAT\tDallas, TX\tSan Antonio, TX\t41\t396\t22\t247.0\t199011\t\t100\n"
    )
    edges = read_flight_edges(spark, str(path))
    assert [field.strip() for field in schemas.FLIGHT_EDGES.split(",")][0] == "originCode STRING"
    assert edges.count() == 2
    first = edges.filter("originCode = 'SAT'").first()
    assert (first.origin_city, first.seats, first.distance, first.fly_date) == ("San Antonio, TX", 30, 247.0, "199010")
    assert edges.filter("origin_population IS NULL").count() == 1


def test_airports_by_header_name(spark, tmp_path):
    path = tmp_path / "airports.csv"
    path.write_text(
        "Id,IATA,Longitude,Latitude,AirportName,City,Country\n"
        "1,SAT,-98.47,29.53,San Antonio Intl,San Antonio,US\n"
        "2,XXX,,bad,Nowhere,,US\n"
    )
    airports = read_airports(spark, str(path))
    row = airports.filter("IATA = 'SAT'").first()
    assert (row.Latitude, row.Longitude, row.City) == (29.53, -98.47, "San Antonio")
    bad = airports.filter("IATA = 'XXX'").first()
    assert bad.Latitude is None and bad.Longitude is None and bad.City is None


def test_weather(spark, tmp_path):
    path = tmp_path / "weather.csv"
    path.write_text("USW00023183,20070101,TOBS,56,,,X,0700\nUSW00023183,20070101,PRCP,0,,,X,\n")
    rows = read_weather(spark, str(path))
    assert rows.columns == ["stationCode", "doy", "observationType", "observationVal", "observationTime"]
    assert [tuple(r) for r in rows.orderBy("observationType").collect()] == [
        ("USW00023183", 20070101, "PRCP", 0, None), ("USW00023183", 20070101, "TOBS", 56, 700),
    ]


def _station_line(code, lat, long, name):
    return f"{code:11} {lat:>8} {long:>9} {'337.4':>6} {name}"


def test_stations(spark, tmp_path):
    path = tmp_path / "stations.txt"
    path.write_text("\n".join([
        _station_line("USW00023183", "33.4278", "-112.0038", "AZ PHOENIX"),
        _station_line("USW00012921", "29.5443", "-98.4839", "TX SAN, ANTONIO"),
        "short",
    ]) + "\n")
    rows = {r.stationCode: (r.lat, r.long) for r in read_stations(spark, str(path)).collect()}
    assert rows["USW00023183"] == (33.4278, -112.0038)
    assert rows["USW00012921"] == (29.5443, -98.4839)
    assert rows["short"] == (None, None)
    old = read_stations(spark, str(path), schemas.REFERENCE_STATION_SLICES)
    rows = {r.stationCode: r.long for r in old.collect()}
    assert rows["USW00023183"] == 112.0038
    assert rows["USW00012921"] == -98.4839


def test_columnar_copy_prunes_years(spark, tmp_path):
    paths = [_write_facts(tmp_path, year, {"ArrDelay": year % 10}) for year in (1990, 1991)]
    target = str(tmp_path / "facts")
    write_by_year(read_flight_facts(spark, paths), target)
    back = spark.read.parquet(target).filter(F.col("Year") == 1991)
    assert [row.ArrDelay for row in back.collect()] == [1]
    assert "PartitionFilters: [isnotnull(Year" in back._jdf.queryExecution().executedPlan().toString()


def test_report_copy(spark, tmp_path):
    target = str(tmp_path / "report")
    write_report(spark.range(5), target)
    assert spark.read.parquet(target).count() == 5


# lines that cannot be read

def _quarantined(spark, read, folder, lines, **options):
    """Rows and the lines put aside, from a file of some lines."""
    (folder / "in").mkdir()
    (folder / "in" / "a.txt").write_text("\n".join(lines) + "\n")
    rows = sources.quarantine(read(spark, str(folder / "in"), keep_unreadable=True, **options), str(folder / "bad"))
    return rows, spark.read.parquet(str(folder / "bad")).collect()


def test_unreadable_facts_are_put_aside(spark, tmp_path):
    names = [field.name for field in StructType.fromDDL(schemas.FLIGHT_FACTS)]
    good = dict.fromkeys(names, "NA") | {"Year": "1990", "Month": "1", "ArrDelay": "NA", "Origin": "SAT"}
    line = lambda **values: ",".join((good | values).values())
    bad = [line(Year="19x0"), line() + ",7", "1990,1", line(SecurityDelay="late")]
    rows, aside = _quarantined(spark, sources.read_flight_facts, tmp_path, [",".join(names), line(), *bad, line(ArrDelay="5")])
    assert sorted((r.Year, r.ArrDelay, r.Origin) for r in rows.collect() if r.ArrDelay) == [(1990, 5, "SAT")]
    # Few columns asked for: a line is as unreadable as when all are.
    assert rows.count() == 2 and rows.select("Origin").count() == 2 and rows.agg({"Year": "sum"}).first()[0] == 3980
    assert sorted(r.line for r in aside) == sorted(bad) and all(r.file.endswith("a.txt") for r in aside)
    assert {r.line: r.parsed for r in aside}["1990,1"] == '{"Year":1990,"Month":1}'


def test_unreadable_edges_airports_weather_and_stations(spark, tmp_path):
    for name in "abcd":
        (tmp_path / name).mkdir()
    head = "\t".join(field.name for field in StructType.fromDDL(schemas.FLIGHT_EDGES))
    edge = "AAA\tBBB\tA\tB\t1\t2\t3\t4.5\t199001\t7\t"
    rows, aside = _quarantined(spark, sources.read_flight_edges, tmp_path / "a", [head, edge, edge.replace("4.5", "far"), "AAA"])
    assert rows.count() == 1 and sorted(r.line for r in aside) == ["AAA", edge.replace("4.5", "far")]
    assert rows.first().destination_population is None
    rows, aside = _quarantined(spark, sources.read_airports, tmp_path / "b", [
        "IATA,AirportName,City,Country,Latitude,Longitude", "SAT,San,S,US,29.5,-98.4", "X,Y,Z,W,north,1", "Q,R,S,T,1,2,3",
    ])
    assert sorted((r.IATA, r.Latitude) for r in rows.collect()) == [("SAT", 29.5), ("X", None)] and [r.line for r in aside] == ["Q,R,S,T,1,2,3"]
    rows, aside = _quarantined(spark, sources.read_weather, tmp_path / "c", ["S1,20240101,TOBS,5,,,,700", "S1,2024x,TOBS,5,,,,700", "S2,20240102,PRCP,1,,,,"])
    assert sorted(r.stationCode for r in rows.collect()) == ["S1", "S2"] and len(aside) == 1
    line = "USW00023183  33.4278 -112.0038  337.4 AZ PHOENIX"
    rows, aside = _quarantined(spark, sources.read_stations, tmp_path / "d", [line, "USW0002", line.replace("33.4278", "3x.4278")])
    assert [tuple(r) for r in rows.collect()] == [("USW00023183", 33.4278, -112.0038)] and len(aside) == 2


def test_yearly_copy_opens_the_years_a_join_names(spark, tmp_path):
    rows = [(year, month, str(month), 0) for year in range(1990, 2000) for month in (1, 2)]
    facts = spark.createDataFrame(rows, "Year INT, Month INT, ArrDelay STRING, Cancelled INT")
    sources.write_by_year(facts, str(tmp_path / "facts"))
    edges = spark.createDataFrame([(y, 100 if y in (1993, 1997) else 1) for y in range(1990, 2000)], "fly_year INT, passengers INT")
    out = delays.delays_in_busiest_years(sources.read_by_year(spark, str(tmp_path / "facts")), edges, 2)
    got = [(r.Year, r["rank"], r.Month, r.flights) for r in out.collect()]
    assert got == [(1993, 1, 1, 1), (1993, 1, 2, 1), (1997, 2, 1, 1), (1997, 2, 2, 1)]
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()
