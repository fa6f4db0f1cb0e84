"""Reusable operators on DataFrames: joins, totals, ordered series and the modelling steps."""

from flightlens.operators.aggregates import (
    average_by,
    distinct_ranked,
    place_traffic,
    ranked,
    ratio_by,
    total_by,
    union_by_position,
)
from flightlens.operators.joins import as_of, band_join, contains_join, many_to_many, nearest
from flightlens.operators.series import change_from_previous, numbered, row_numbers, runs_of_months, with_ticks

__all__ = [
    "as_of", "average_by", "band_join", "change_from_previous", "contains_join", "distinct_ranked",
    "many_to_many", "nearest", "numbered", "place_traffic", "ranked", "ratio_by", "row_numbers", "runs_of_months", "total_by",
    "union_by_position", "with_ticks",
]
