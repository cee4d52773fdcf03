"""Share of a group: the geographic and the hourly multiplier in one operator.

A multiplier is ``value / sum(value) over group``.  The group totals are
computed by a second, tiny aggregation over the already aggregated detail and
joined back.  A window would pull a whole group into one task; the join keeps
the detail spread out, lets adaptive execution broadcast the totals when they
are small and split a hot group when they are not.  Spark reuses the exchange
of the detail aggregation for both sides, so the fact table is read once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.numbers import safe_ratio
from wattloom.functions.text import col, cols
from wattloom.operators.joins import join_null_safe

TOTAL = "_total"


@dataclass(frozen=True)
class Target:
    """One output row of a fan-out: the share of ``measure`` for (end use, fuel)."""

    measure: str
    end_use: str
    fuel: str | None
    guard: bool = False  # drop the row unless the group total is positive


def targets(
    measure: str, end_use: str, fuels: Sequence[str | None], guard: bool = False
) -> tuple[Target, ...]:
    return tuple(Target(measure, end_use, fuel, guard) for fuel in fuels)


def sum_by(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """Grouped sums with a map-side combine; the first step of every share."""
    return df.groupBy(*cols(keys)).agg(
        *[F.sum(expr).alias(name) for name, expr in values.items()]
    )


def with_group_totals(
    df: DataFrame, within: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Add ``<value>_total`` over ``within`` for every value column."""
    totals = df.groupBy(*cols(within)).agg(
        *[F.sum(col(v)).alias(v + TOTAL) for v in values]
    )
    return join_null_safe(df, totals, within)


def with_shares(
    df: DataFrame,
    within: Sequence[str],
    values: Mapping[str, str],
    keep_totals: bool = False,
) -> DataFrame:
    """Add the share of each value in its group; ``values`` maps value -> share name."""
    totalled = with_group_totals(df, within, list(values))
    shared = totalled.select(
        *cols(totalled.columns),
        *[
            safe_ratio(col(v), col(v + TOTAL)).alias(share)
            for v, share in values.items()
        ],
    )
    if keep_totals:
        return shared
    return shared.drop(*[v + TOTAL for v in values])


def fan_out(
    df: DataFrame,
    keep: Sequence[str],
    rows: Sequence[Target],
    value_name: str | None = None,
    share_name: str = "multiplier",
) -> DataFrame:
    """One row per target from totals-bearing detail, without rescanning it.

    The branches are array elements of one row, not branches of a UNION, so the
    detail is computed once however many (end use, fuel) pairs it feeds.
    """
    entries = []
    for t in rows:
        fields = [
            F.lit(t.end_use).alias("end_use"),
            F.lit(t.fuel).cast("string").alias("fuel"),
            safe_ratio(col(t.measure), col(t.measure + TOTAL)).alias(share_name),
        ]
        if value_name:
            fields.append(col(t.measure).alias(value_name))
        keep_row = (
            F.coalesce(col(t.measure + TOTAL) > 0, F.lit(False))
            if t.guard
            else F.lit(True)
        )
        fields.append(keep_row.alias("__keep"))
        entries.append(F.struct(*fields))
    fanned = df.select(*cols(keep), F.inline(F.array(*entries)))
    return fanned.filter(col("__keep")).drop("__keep")


def share_of_group(
    df: DataFrame,
    place: Sequence[str],
    within: Sequence[str],
    values: Mapping[str, Column],
    rows: Sequence[Target],
    value_name: str | None = None,
    share_name: str = "multiplier",
    drop_null: Sequence[str] = (),
) -> DataFrame:
    """Sum by place, share within the group, fan out to (end use, fuel) rows.

    ``place`` are the detail keys, ``within`` the group keys (state, technology
    group ...).  Keys named in both are kept once.

    ``drop_null`` names keys that must not be NULL.  Use it when the shares are
    joined on those keys in the same plan: the optimiser would otherwise push
    the NULL check into the detail but not into the totals, the two would no
    longer share an exchange, and the fact table would be read twice.
    """
    keys = list(dict.fromkeys([*place, *within]))
    for key in drop_null:
        df = df.filter(col(key).isNotNull())
    detail = sum_by(df, keys, values)
    totalled = with_group_totals(detail, within, list(values))
    return fan_out(totalled, keys, rows, value_name, share_name)


def nested_shares(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    levels: Mapping[str, Sequence[str]],
    value_name: str = "total",
) -> DataFrame:
    """Shares of one sum at several nesting levels (share name -> group keys).

    The coarser totals are built from the finer ones, never from the detail
    again: every level must be a subset of the level named before it.
    """
    detail = sum_by(df, keys, {value_name: value})
    out, coarser = detail, detail
    names = []
    for share, within in levels.items():
        total = f"__{share}"
        source = value_name if coarser is detail else names[-1]
        coarser = coarser.groupBy(*cols(within)).agg(F.sum(col(source)).alias(total))
        out = join_null_safe(out, coarser, within)
        names.append(total)
    return out.select(
        *cols(keys),
        col(value_name),
        *[safe_ratio(col(value_name), col(f"__{s}")).alias(s) for s in levels],
    )
