"""Join helpers that keep key columns single and NULL keys comparable."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.text import col, cols

_RIGHT = "__right_"


def prefixed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with its key columns renamed, ready for an explicit condition."""
    return df.select(
        *[
            col(n).alias(_RIGHT + n) if n in keys else col(n)
            for n in df.columns
        ]
    )


def right(name: str) -> Column:
    """A key column of a ``prefixed`` frame."""
    return col(_RIGHT + name)


def null_safe_condition(left: DataFrame, keys: Sequence[str]) -> Column:
    """``left.key <=> right.key`` for every key, right side from ``prefixed``."""
    return reduce(
        lambda a, b: a & b, [col(k).eqNullSafe(right(k)) for k in keys]
    )


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which a NULL key matches a NULL key (as in a GROUP BY)."""
    if not keys:
        raise ValueError("a join needs at least one key")
    joined = left.join(prefixed(right, keys), null_safe_condition(left, keys), how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[_RIGHT + k for k in keys])


def full_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Null-safe full join; each key is taken from whichever side has the row."""
    joined = left.join(
        prefixed(right, keys), null_safe_condition(left, keys), "full"
    )
    keep_left = [n for n in left.columns if n not in keys]
    keep_right = [n for n in right.columns if n not in keys]
    return joined.select(
        *[F.coalesce(col(k), col(_RIGHT + k)).alias(k) for k in keys],
        *cols(keep_left),
        *cols(keep_right),
    )


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; names with dots are taken literally."""
    return df.select(
        *[col(n).alias(names[n]) if n in names else col(n) for n in df.columns]
    )


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Fail the running job if a key occurs twice in ``df`` (many-to-one guard).

    The check travels with the data: it adds no action and no driver round trip.
    """
    others = [n for n in df.columns if n not in keys]
    counted = df.groupBy(*cols(keys)).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.first(col(n)).alias(n) for n in others],
    )
    message = F.lit(f"duplicate key in {what}")
    checked = F.when(col("__n") > 1, F.raise_error(message).cast("bigint")).otherwise(
        col("__n")
    )
    return counted.filter(checked >= 1).select(*cols(df.columns))
