"""Column expressions shared by all operators."""

from wattloom.functions.calendar import (
    align_hour,
    epoch_nanos_to_timestamp,
    hour_of_day,
    restamp_year,
    season,
    wrap_year,
)
from wattloom.functions.numbers import (
    is_number,
    mmbtu_to_kwh,
    non_negative,
    out_of_tolerance,
    percent_delta,
    relative_difference,
    round_any,
    safe_ratio,
    zero_if_null,
)
from wattloom.functions.text import col, cols, sector_of, slug

__all__ = [
    "align_hour",
    "col",
    "cols",
    "epoch_nanos_to_timestamp",
    "hour_of_day",
    "is_number",
    "mmbtu_to_kwh",
    "non_negative",
    "out_of_tolerance",
    "percent_delta",
    "relative_difference",
    "restamp_year",
    "round_any",
    "safe_ratio",
    "season",
    "sector_of",
    "slug",
    "wrap_year",
    "zero_if_null",
]
