"""Every registered query with SQL gives the rows DuckDB gives on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered

# The optional operators have tests of their own.
QUERIES = {name: query for name, query in registered.queries().items() if name not in registered.LLM_QUERIES}
SQL = {name: sql for name, sql in registered.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck(tables):
    connection = duckdb.connect()
    for path in sorted(Path(tables).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def _kind(type_name: str) -> str:
    names = {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "DATE": "date"}
    return names.get(type_name, type_name)


def _sortable(row):
    return tuple((value is None, 0 if value is None else value) for value in row)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, tables, name):
    got = QUERIES[name](spark, tables)
    expected = duck.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    kinds = dict(zip(expected.columns, (_kind(str(t)) for t in expected.types)))
    assert {c: t for c, t in got.dtypes} == kinds
    ours = sorted((tuple(row) for row in got.select(*columns).collect()), key=_sortable)
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted(duck.sql(f"SELECT {quoted} FROM ({SQL[name]})").fetchall(), key=_sortable)
    assert len(ours) == len(theirs) > 0
    for a, b in zip(ours, theirs):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=0, abs_tol=1e-9)), (a, b)


@pytest.mark.parametrize("name", ["seasonal_spikes", "trend_breaks"])
def test_changes_where_months_are_missing(spark, name):
    """In the smallest tables many months of a city are missing."""
    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    columns = sorted(QUERIES[name](spark, folder).columns)
    ours = sorted((tuple(r) for r in QUERIES[name](spark, folder).select(*columns).collect()), key=_sortable)
    theirs = sorted(connection.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall(), key=_sortable)
    connection.close()
    assert len(ours) == len(theirs) > 0
    for a, b in zip(ours, theirs):
        assert all(x == y or math.isclose(x, y, rel_tol=0, abs_tol=1e-6) for x, y in zip(a, b)), (a, b)


def test_entry(spark):
    assert registered.entry(spark).count() == 1390
