from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F


def with_period(edges: DataFrame) -> DataFrame:
    """Add ``fly_year`` and ``fly_month`` as integers, from the yyyymm text ``fly_date``; null for other text."""
    return edges.withColumns({
        "fly_year": F.substring("fly_date", 1, 4).try_cast("int"),
        "fly_month": F.substring("fly_date", 5, 2).try_cast("int"),
    })


def in_years(years: Iterable[int]) -> Column:
    """Rows whose yyyymm text falls in one of the years.

    Written as a prefix test on the stored column, because that reaches the file scan, which a
    comparison with the derived year does not.
    """
    return reduce(or_, (F.col("fly_date").startswith(f"{year:04d}") for year in years), F.lit(False))


def fixed_width(line: str, slices: Mapping[str, tuple[int, int, str]]) -> list[Column]:
    """Cut typed columns out of a line of text; a slice that does not parse becomes null."""
    return [
        F.trim(F.substring(line, start, length)).try_cast(kind).alias(name)
        if kind != "string" else F.substring(line, start, length).alias(name)
        for name, (start, length, kind) in slices.items()
    ]


def in_box(
    lat: str, long: str, *,
    west: float | None = None, east: float | None = None,
    south: float | None = None, north: float | None = None,
) -> Column:
    """Strictly inside a latitude/longitude box; a side left out is unbounded."""
    tests = []
    if west is not None:
        tests.append(F.col(long) > west)
    if east is not None:
        tests.append(F.col(long) < east)
    if south is not None:
        tests.append(F.col(lat) > south)
    if north is not None:
        tests.append(F.col(lat) < north)
    return reduce(and_, tests, F.lit(True))


def as_number(name: str) -> Column:
    """A numeric reading of a column that may be text with markers such as ``NA`` (read as null)."""
    return F.col(name).try_cast("double")


def ratio_of_sums(top: str, bottom: str) -> Column:
    """sum(top) / sum(bottom), null where the divisor is zero."""
    return F.try_divide(F.sum(top), F.sum(bottom))


def pieces(text: str, lengths: Iterable[int] | None = None) -> Column:
    """The distinct substrings of a column, of the given lengths or of every length from 0 up.

    Every length is meant for codes and names: a text of n characters has about n*n/2 substrings.
    """
    size = F.length(text)
    if lengths is None:
        wanted = F.sequence(F.lit(0), size)
    else:
        wanted = F.filter(F.array(*map(F.lit, sorted(set(lengths)))).cast("array<int>"), lambda n: n <= size)
    cut = F.transform(
        wanted,
        lambda n: F.transform(
            F.sequence(F.lit(1), size - n + 1), lambda start: F.col(text).substr(start, n)
        ),
    )
    return F.array_distinct(F.flatten(cut))
