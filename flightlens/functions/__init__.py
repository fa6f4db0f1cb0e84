"""Column expressions shared by the operators and reports; all of them run inside the JVM."""

from flightlens.functions.columns import (
    as_number,
    fixed_width,
    in_box,
    in_years,
    pieces,
    ratio_of_sums,
    with_period,
)

__all__ = [
    "as_number", "fixed_width", "in_box", "in_years", "pieces", "ratio_of_sums", "with_period",
]
