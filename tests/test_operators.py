import math
import random
from contextlib import contextmanager

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as registered
from flightlens import fixtures as fx
from flightlens.functions import in_box, in_years, pieces, with_period
from flightlens.operators import (
    as_of,
    band_join,
    change_from_previous,
    contains_join,
    distinct_ranked,
    many_to_many,
    nearest,
    numbered,
    place_traffic,
    ranked,
    ratio_by,
    row_numbers,
    runs_of_months,
    union_by_position,
    with_ticks,
)

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _rows(df):
    return sorted((tuple(row) for row in df.collect()), key=lambda row: tuple((v is None, v) for v in row))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _texts(spark, values, name):
    return spark.createDataFrame(list(enumerate(values)), f"{name}_id INT, {name} STRING")


# columns

def test_period_columns(spark):
    rows = with_period(spark.createDataFrame([("199001",), ("200812",)], "fly_date STRING"))
    assert _rows(rows.select("fly_year", "fly_month")) == [(1990, 1), (2008, 12)]


def test_malformed_periods_are_null(spark):
    rows = with_period(spark.createDataFrame([("NA",), ("19x012",), ("1990",), (None,), ("199005",)], "fly_date STRING"))
    got = {r.fly_date: (r.fly_year, r.fly_month) for r in rows.collect()}
    assert got == {"NA": (None, None), "19x012": (None, 12), "1990": (1990, None), None: (None, None), "199005": (1990, 5)}
    assert rows.filter(in_years([])).count() == 0


def test_change_is_from_the_month_before(spark):
    """A month that is missing leaves a gap; the change over it is not a change of one month."""
    months = [("a", "199001", 10), ("a", "199012", 100), ("a", "199101", 130), ("a", "NA", 5), ("b", "199101", 7), ("b", "199102", 3)]
    rows = change_from_previous(spark.createDataFrame(months, "city STRING, fly_date STRING, n INT"), "city", "fly_date", "n")
    assert {(r.city, r.fly_date): r.change for r in rows.collect()} == {
        ("a", "199001"): None, ("a", "199012"): None, ("a", "199101"): 30, ("a", "NA"): None, ("b", "199101"): None, ("b", "199102"): -4,
    }


def test_year_prefix_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "dates")
    spark.createDataFrame([("199001",), ("200812",), ("199112",)], "fly_date STRING").write.parquet(path)
    kept = with_period(spark.read.parquet(path)).filter(in_years([1990, 1991]))
    assert _rows(kept.select("fly_year")) == [(1990,), (1991,)]
    assert "StringStartsWith(fly_date,1990)" in _plan(kept)


def test_box_is_open_and_sides_are_optional(spark):
    points = spark.createDataFrame([(20.0, -100.0), (21.0, -70.0), (21.0, -71.0), (None, -71.0)], "lat DOUBLE, long DOUBLE")
    assert _rows(points.filter(in_box("lat", "long", west=-130, east=-70, south=20))) == [(21.0, -71.0)]
    assert points.filter(in_box("lat", "long", west=-130)).count() == 4
    assert points.filter(in_box("lat", "long", north=20.5)).count() == 1
    assert points.filter(in_box("lat", "long")).count() == 4


def test_pieces(spark):
    rows = spark.createDataFrame([("ABAB",), ("",), (None,)], "t STRING")
    all_of = [sorted(r[0]) if r[0] is not None else None for r in rows.select(pieces("t")).collect()]
    assert all_of == [["", "A", "AB", "ABA", "ABAB", "B", "BA", "BAB"], [""], None]
    twos = [sorted(r[0] or []) for r in rows.select(pieces("t", [2, 9])).collect()]
    assert twos == [["AB", "BA"], [], []]
    assert rows.select(F.explode(pieces("t", []))).count() == 0


# totals

def test_zero_denominator_is_null(spark):
    rows = spark.createDataFrame([(1990, 10, 0), (1991, 10, 4)], "y INT, passengers INT, flights INT")
    assert _rows(ratio_by(rows, "y", r=("passengers", "flights"))) == [(1990, None), (1991, 2.5)]


def test_ranked_breaks_ties(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "k STRING, n INT")
    assert [r.k for r in ranked(rows, "n", "k").collect()] == ["c", "a", "b"]
    assert [r.k for r in ranked(rows, "n", "k", descending=False, top=2).collect()] == ["a", "b"]


def test_distinct_then_sort(spark):
    rows = spark.createDataFrame([("x", "y", 5.0), ("a", "b", 9.0), ("x", "y", 5.0), ("c", "d", 5.0)], "o STRING, d STRING, far DOUBLE")
    out = distinct_ranked(rows, ("o", "d", "far"), "far").collect()
    assert [tuple(r) for r in out] == [("a", "b", 9.0), ("c", "d", 5.0), ("x", "y", 5.0)]


def test_place_traffic_counts_both_ends(spark):
    rows = spark.createDataFrame(
        [("a", "b", 3), ("a", "c", 4), ("b", "b", 5), ("d", "a", None), (None, "a", 1)], "o STRING, d STRING, flights INT"
    )
    got = {r.place: (r.flightsFrom, r.flightsTo, r.departs, r.arrives) for r in place_traffic(rows, "o", "d").collect()}
    assert got["a"] == (7, 1, True, True)
    assert got["b"] == (5, 8, True, True)
    assert got["c"] == (None, 4, False, True)
    assert got["d"] == (None, None, True, False)


def test_union_keeps_duplicates_and_goes_by_position(spark):
    one = spark.createDataFrame([(1, "a")], "x INT, y STRING")
    two = spark.createDataFrame([(1, "a"), (2, "b")], "p INT, q STRING")
    assert _rows(union_by_position([one, two])) == [(1, "a"), (1, "a"), (2, "b")]


# series

def test_thirteen_months(spark):
    months = spark.createDataFrame([(f"1990{m:02d}" if m <= 12 else "199101", m) for m in range(13, 0, -1)], "d STRING, n INT")
    out = with_ticks(numbered(months, "d"), "month_index", "n", every=12, tick=6700.0)
    values = [r for r in out.collect() if r.series == "n"]
    ticks = [r.month_index for r in out.collect() if r.series == "tick"]
    assert [(r.month_index, r.value) for r in sorted(values, key=lambda r: r.d)] == [(i, i + 1.0) for i in range(13)]
    assert sorted(ticks) == [0, 12]


# containment join

@pytest.mark.parametrize("expand", ["values", "rows"])
def test_contains_join_cases(spark, expand):
    long = _texts(spark, ["XSATX", "SAT", None, "ABAB", "", "SAT"], "long")
    short = _texts(spark, ["SAT", "", None, "AB", "XSATXX"], "short")
    got = _rows(contains_join(long, "long", short, "short", expand=expand).select("long_id", "short_id"))
    brute = _rows(long.crossJoin(short).filter(F.col("long").contains(F.col("short"))).select("long_id", "short_id"))
    assert got == brute
    assert (3, 3) in got and got.count((3, 3)) == 1
    assert [a for a, b in got if b == 1] == [0, 1, 3, 4, 5]


@FEW
@given(
    st.lists(st.text("ab", max_size=5), min_size=1, max_size=12),
    st.lists(st.text("ab", max_size=3), min_size=1, max_size=8),
)
def test_contains_join_equals_nested_loop(spark, longs, shorts):
    long, short = _texts(spark, longs, "long"), _texts(spark, shorts, "short")
    brute = sorted((i, j) for i, a in enumerate(longs) for j, b in enumerate(shorts) if b in a)
    for expand in ("values", "rows"):
        assert _rows(contains_join(long, "long", short, "short", expand=expand).select("long_id", "short_id")) == brute
    lengths = {len(text) for text in shorts}
    limited = contains_join(long, "long", short, "short", lengths=lengths)
    assert _rows(limited.select("long_id", "short_id")) == brute


def test_contains_join_with_equal_key(spark):
    long = spark.createDataFrame([("ab", 1), ("ab", 2), ("b", 1)], "l STRING, x INT")
    short = spark.createDataFrame([("b", 1), ("a", 2), ("c", 1)], "s STRING, y INT")
    for expand in ("values", "rows"):
        got = contains_join(long, "l", short, "s", equal=[("x", "y")], expand=expand)
        assert got.columns == ["l", "x", "s", "y"]
        assert _rows(got) == [("ab", 1, "b", 1), ("ab", 2, "a", 2), ("b", 1, "b", 1)]


def test_contains_join_wants_distinct_names(spark):
    one = spark.createDataFrame([("a",)], "t STRING")
    with pytest.raises(ValueError):
        contains_join(one, "t", one, "t")
    with pytest.raises(ValueError):
        contains_join(one, "t", one.toDF("u"), "u", expand="else")


def test_contains_join_with_a_hot_value(spark):
    """A value in a third of all rows, and no broadcast: a sort-merge join split by its skew."""
    hot = [("hot place" if i % 3 == 0 else f"place {i % 50}", i) for i in range(30_000)]
    long = spark.createDataFrame(hot, "l STRING, n INT")
    short = spark.createDataFrame([("hot",), ("place 7",), ("e 1",)], "s STRING")
    expected = sum(1 for text, _ in hot for s in ("hot", "place 7", "e 1") if s in text)
    with _split_small_partitions(spark):
        joined = contains_join(long.repartition(8), "l", short, "s")
        assert len(joined.collect()) == expected
        assert "skew=true" in _plan(joined)


@contextmanager
def _settings(spark, conf):
    old = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@contextmanager
def _split_small_partitions(spark):
    """No broadcasts, and adaptive execution that calls partitions of a few kilobytes skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    old = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_no_nested_loop_or_product(spark):
    long, short = _texts(spark, ["abc"] * 3, "long"), _texts(spark, ["b"] * 3, "short")
    points = spark.createDataFrame([(1.0, 2.0)], "x DOUBLE, y DOUBLE")
    others = spark.createDataFrame([(1.0, 2.0)], "u DOUBLE, v DOUBLE")
    for df in (
        contains_join(long, "long", short, "short"),
        contains_join(long, "long", short, "short", expand="rows"),
        band_join(points, others, [("x", "u"), ("y", "v")], 3.0),
    ):
        plan = _plan(df)
        assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


# band join

def _points(spark, rows, names):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], names)


def _brute_band(lefts, rights, width):
    return sorted(
        (i, j) for i, (a, b) in enumerate(lefts) for j, (c, d) in enumerate(rights)
        if abs(a - c) < width and abs(b - d) < width
    )


def _band(spark, lefts, rights, width):
    left = _points(spark, lefts, "i INT, x DOUBLE, y DOUBLE")
    right = _points(spark, rights, "j INT, u DOUBLE, v DOUBLE")
    return _rows(band_join(left, right, [("x", "u"), ("y", "v")], width).select("i", "j"))


def test_band_edges(spark):
    lefts = [(0, 0), (-0.5, -0.5), (2.9, 2.9), (-112.5, 33.4)]
    rights = [(3.0, 0), (0.5, 0.5), (3.1, 3.1), (-114.0, 35.0), (2.999, 0)]
    got = _band(spark, lefts, rights, 3.0)
    assert got == _brute_band(lefts, rights, 3.0)
    assert (0, 0) not in got and (0, 4) in got and got.count((2, 2)) == 1 and (3, 3) in got


def test_band_ignores_missing_coordinates(spark):
    left = spark.createDataFrame([(1, None, 1.0), (2, 1.0, 1.0), (3, math.nan, 1.0)], "i INT, x DOUBLE, y DOUBLE")
    right = spark.createDataFrame([(1, 1.0, 1.0), (2, None, None)], "j INT, u DOUBLE, v DOUBLE")
    assert _rows(band_join(left, right, [("x", "u"), ("y", "v")], 3.0).select("i", "j")) == [(2, 1)]


@FEW
@given(st.integers(0, 10**6), st.sampled_from([0.1, 1.0, 3.0, 7.3]))
def test_band_join_equals_nested_loop(spark, seed, width):
    source = random.Random(seed)
    def point():
        # a grid of exact multiples and free values, so that differences of exactly the width occur
        return tuple(source.choice([source.randint(-9, 9) * width, source.uniform(-9, 9)]) for _ in range(2))
    lefts, rights = [point() for _ in range(40)], [point() for _ in range(40)]
    assert _band(spark, lefts, rights, width) == _brute_band(lefts, rights, width)


def test_band_join_with_a_hot_cell(spark):
    """A third of the points in one cell: the same pairs, from a sort-merge join split by its skew."""
    source = random.Random(9)
    lefts = [(1.0, 1.0) if i % 3 == 0 else (source.uniform(-200, 200), source.uniform(-90, 90)) for i in range(30_000)]
    rights = [(1.5, 1.5), (3.9, 1.0), (4.0, 1.0), (100.0, 40.0), (-100.0, -40.0)]
    left = _points(spark, lefts, "i INT, x DOUBLE, y DOUBLE").repartition(8)
    right = _points(spark, rights, "j INT, u DOUBLE, v DOUBLE")
    with _split_small_partitions(spark):
        joined = band_join(left, right, [("x", "u"), ("y", "v")], 3.0)
        assert _rows(joined.select("i", "j")) == _brute_band(lefts, rights, 3.0)
        joined.collect()
        assert "skew=true" in _plan(joined)


def test_nearest_breaks_ties_by_name(spark):
    left = _points(spark, [(0, 0), (50, 50)], "i INT, x DOUBLE, y DOUBLE")
    right = _points(spark, [(1, 0), (0, 1), (2, 2)], "j INT, u DOUBLE, v DOUBLE")
    got = nearest(left, right, [("x", "u"), ("y", "v")], 3.0, key="i", candidate="j")
    assert _rows(got.select("i", "j")) == [(0, 0), (1, 2)]
    assert {r.i: round(r.distance, 6) for r in got.collect()} == {0: 1.0, 1: round(48 * 2**0.5, 6)}


@pytest.mark.parametrize("seed,width", [(1, 3.0), (2, 0.5), (3, 40.0)])
def test_nearest_equals_all_pairs(spark, seed, width):
    """Points inside, in the corners of, beside and far beyond the band, with ties."""
    rng = random.Random(seed)
    lefts = [(rng.randint(-60, 60), rng.randint(-60, 60)) for _ in range(25)] + [(500, 500)]
    rights = [(rng.randint(-40, 40), rng.randint(-40, 40)) for _ in range(40)]
    found = nearest(
        _points(spark, lefts, "i INT, x DOUBLE, y DOUBLE"), _points(spark, rights, "j INT, u DOUBLE, v DOUBLE"),
        [("x", "u"), ("y", "v")], width, key="i", candidate="j",
    )
    wanted = {i: min(((a - c) ** 2 + (b - d) ** 2, j) for j, (c, d) in enumerate(rights)) for i, (a, b) in enumerate(lefts)}
    assert {r.i: r.j for r in found.collect()} == {i: j for i, (_, j) in wanted.items()}


def test_nearest_without_candidates(spark):
    left, none = _points(spark, [(0, 0)], "i INT, x DOUBLE, y DOUBLE"), spark.createDataFrame([], "j INT, u DOUBLE, v DOUBLE")
    assert nearest(left, none, [("x", "u"), ("y", "v")], 3.0, key="i", candidate="j").count() == 0


# the given tables

def test_foreign_keys_hold(spark, tables):
    """The views leave out inner joins that only a foreign key makes harmless."""
    for table, key, other, its in (
        ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("orders", "o_custkey", "customer", "c_custkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
        ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ):
        rows, keys = fx.table(spark, tables, table), fx.table(spark, tables, other)
        assert rows.join(keys, F.col(key) == F.col(its), "left_anti").count() == 0, (table, key)
        assert keys.count() == keys.select(its).distinct().count(), other


def test_years_reach_the_scan(spark, tables):
    plan = _plan(fx.flight_edges(spark, tables, ["fly_date", "flights"], [1995]))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    assert "ReadSchema: struct<l_linenumber:int,l_shipdate:timestamp_ntz>" in plan


@pytest.fixture()
def whole_plans(spark):
    """Pushed filters are cut off after a hundred characters else."""
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "3000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", before)


@pytest.mark.parametrize("name", ["travel_change", "focus_inbound_city_year_first_last", "focus_outbound_city_year_first_last"])
def test_two_years_are_two_ranges_of_the_scan(spark, tables, name, whole_plans):
    plan = _plan(registered.queries()[name](spark, tables))
    scans = [line for line in plan.splitlines() if "PushedFilters" in line and "l_shipdate" in line]
    assert scans
    for scan in scans:
        assert all(f"l_shipdate,{year}-01-01" in scan for year in (1995, 1996, 2001, 2002)) and "Or(" in scan


def test_union_of_years_reads_each_year_once(spark, tables, whole_plans):
    plan = _plan(registered.queries()["union_years"](spark, tables))
    scans = [line for line in plan.splitlines() if "PushedFilters" in line and "l_shipdate" in line]
    assert len(scans) == 7 and "Union" in plan
    assert all(f"l_shipdate,{1995 + i}-01-01" in scan and f"l_shipdate,{1996 + i}-01-01" in scan for i, scan in enumerate(scans))


# nearest, far away

def test_nearest_takes_two_joins_whatever_the_distance(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0), (2, 500.0, -300.0), (3, 5000.0, 0.0), (4, None, 1.0)], "i INT, x DOUBLE, y DOUBLE")
    right = spark.createDataFrame([(10, 0.5, 0.5), (11, 1.0, 0.0), (12, 100.0, 200.0), (13, None, 0.0)], "j INT, u DOUBLE, v DOUBLE")
    found = nearest(left, right, [("x", "u"), ("y", "v")], 1.0, key="i", candidate="j")
    assert [(r.i, r.j) for r in found.orderBy("i").collect()] == [(1, 10), (2, 11)]
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert len(joins) == 2 and all("Inner" in line for line in joins)


# hot keys in a many-to-many join

@pytest.mark.parametrize("block", [1, 7, 50, 4096])
def test_many_to_many_loses_no_pair(spark, block):
    rng = random.Random(block)
    left = [(rng.choice("aaab"), rng.randrange(3), i) for i in range(200)] + [("hot", 0, i) for i in range(200, 300)] + [(None, 0, 1)]
    right = [(rng.choice("aabc"), rng.randrange(3), i) for i in range(150)] + [("hot", 0, i) for i in range(150, 250)] + [(None, 0, 1)]
    joined = many_to_many(
        spark.createDataFrame(left, "k STRING, d INT, x INT"), spark.createDataFrame(right, "k STRING, d INT, y INT"), ["k", "d"], block=block,
    )
    assert joined.columns == ["k", "d", "x", "y"]
    wanted = [(k, d, x, y) for k, d, x in left for k2, d2, y in right if k == k2 and k is not None and d == d2]
    assert _rows(joined) == sorted(wanted)


def test_many_to_many_spreads_a_hot_key(spark):
    """A third of all readings at one station on one day: its pairs come out of many tasks."""
    def readings(name):
        rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias(name))
        return rows.repartition(4)

    with _settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        split = many_to_many(readings("x"), readings("y"), ["k"], block=300).filter("k = -1").groupBy(F.spark_partition_id()).count()
        plain = readings("x").join(readings("y"), "k").filter("k = -1").groupBy(F.spark_partition_id()).count()
        tasks = sorted(row["count"] for row in split.collect())
        assert [row["count"] for row in plain.collect()] == [4_000_000]
    assert sum(tasks) == 4_000_000 and len(tasks) >= 6 and tasks[-1] < 1_200_000


# the last reading

@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("bucket", [1, 7, 60, 1440])
def test_as_of_is_the_last_reading(spark, how, bucket):
    rng = random.Random(bucket)
    left = [(rng.choice("abc"), rng.randrange(1440), i) for i in range(300)] + [("none", 5, 300), (None, 5, 301), ("a", None, 302), ("a", 1439, 303)]
    right = [(rng.choice("abx"), rng.randrange(1440), rng.randrange(100)) for _ in range(40)]
    right += [("a", 700, 1), ("a", 700, 9), ("a", None, 5), (None, 5, 5), ("b", 1439, 4), ("b", 2000, 7)]
    found = as_of(
        spark.createDataFrame(left, "k STRING, t INT, i INT"), spark.createDataFrame(right, "k STRING, read INT, v INT"),
        ["k"], "t", "read", until=1440, bucket=bucket, how=how,
    )
    wanted = []
    for k, t, i in left:
        before = [(read, v) for k2, read, v in right if k2 == k and None not in (k, t, read) and read <= t and read < 1440]
        if before or how == "left":
            wanted.append((k, t, i, *max(before, default=(None, None))))
    assert found.columns == ["k", "t", "i", "read", "v"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted))


def test_as_of_neither_sorts_nor_gathers_the_facts(spark):
    left = spark.range(1000).selectExpr("'a' AS k", "id % 1440 AS t")
    right = spark.createDataFrame([("a", 3, 1)], "k STRING, read INT, v INT")
    plan = _plan(as_of(left, right, ["k"], "t", "read", until=1440, bucket=60))
    assert "BroadcastHashJoin" in plan and plan.count("Window [") == plan.count("Window [lead(read") == 1
    assert plan.count("Exchange hashpartitioning(k") == 2  # of the readings, by time and by key


# numbers without one partition

@pytest.mark.parametrize("n", [0, 1, 5, 2000])
def test_row_numbers_equal_row_number(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, *range(20)]), rng.choice("abc"), i) for i in range(n)]
    df = spark.createDataFrame(rows, "x INT, y STRING, i INT").repartition(6)
    numbered_rows = row_numbers(df, F.desc("x"), "y", "i")
    wanted = df.selectExpr("*", "CAST(row_number() OVER (ORDER BY x DESC, y, i) AS BIGINT) AS rank")
    assert numbered_rows.columns == wanted.columns and dict(numbered_rows.dtypes) == dict(wanted.dtypes)
    assert _rows(numbered_rows) == _rows(wanted)
    assert "SinglePartition" not in _plan(numbered_rows)


def test_row_numbers_with_ties_in_the_order_are_all_numbers(spark):
    df = spark.range(500).selectExpr("id % 3 AS x", "id").repartition(5)
    got = row_numbers(df, "x", start=0).collect()
    assert sorted(r["rank"] for r in got) == list(range(500))
    assert [r.x for r in sorted(got, key=lambda r: r["rank"])] == sorted(r.x for r in got)


# spans

def test_runs_of_months(spark):
    months = ["199011", "199012", "199101", "199103", "199104", "NA", None]
    rows = spark.createDataFrame([("a", m, i) for i, m in enumerate(months)] + [("b", "199012", 7)], "city STRING, m STRING, n INT")
    got = runs_of_months(rows, "city", "m", total=F.sum("n"))
    assert _rows(got) == [("a", "199011", "199101", 3, 3), ("a", "199103", "199104", 2, 7), ("b", "199012", "199012", 1, 7)]
