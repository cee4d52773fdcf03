"""Number rules.

Spark treats ``NaN = NaN`` and ``NaN >= 0`` as true and raises on division by
zero under ANSI mode.  The helpers below fix one meaning for all operators: a
value that is NULL or NaN is "not a number", and a ratio without a usable
denominator is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: kWh = MMBtu / 3412 * 1e6.
BTU_PER_KWH = 3412
BTU_PER_MMBTU = 1e6


def is_number(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def non_negative(value: Column) -> Column:
    return is_number(value) & (value >= F.lit(0))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def safe_ratio(part: Column, total: Column) -> Column:
    """``part / total``; NULL when the total is zero or missing."""
    return F.try_divide(part, total)


def relative_difference(part: Column, whole: Column) -> Column:
    """``1 - part / whole``."""
    return F.lit(1.0) - safe_ratio(part, whole)


def percent_delta(before: Column, after: Column) -> Column:
    """Change relative to ``before``: 0 if both are 0, +inf if only ``after`` is not."""
    return (
        F.when(before != 0, (after - before) / F.nullif(before, F.lit(0.0)))
        .when(after == 0, F.lit(0.0))
        .otherwise(F.lit(float("inf")))
    )


def out_of_tolerance(value: Column, low: float = 0.99, high: float = 1.01) -> Column:
    """True for values outside ``[low, high]`` and for values that are no number."""
    return ~is_number(value) | (value > high) | (value < low)


def mmbtu_to_kwh(value: Column) -> Column:
    return value / F.lit(float(BTU_PER_KWH)) * F.lit(BTU_PER_MMBTU)


def round_any(value: Column, step: float) -> Column:
    """Nearest multiple of ``step`` (half away from zero)."""
    return F.round(value / F.lit(float(step))) * F.lit(float(step))
