"""Checks that nothing is lost between one level and the next."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.numbers import (
    is_number,
    out_of_tolerance,
    percent_delta,
    relative_difference,
    zero_if_null,
)
from wattloom.functions.text import col, cols
from wattloom.operators.joins import join_null_safe


def multiplier_sums(
    multipliers: DataFrame,
    keys: Sequence[str],
    value: str = "multiplier_annual",
    place: str | None = None,
    result: str = "multiplier_sum",
) -> DataFrame:
    """Sum of the multipliers per group, and how many places share it."""
    aggs = [F.sum(col(value)).alias(result)]
    if place:
        aggs.append(F.countDistinct(col(place)).alias("n_places"))
    return multipliers.filter(is_number(col(value))).groupBy(*cols(keys)).agg(*aggs)


def off_by(
    sums: DataFrame, value: str = "multiplier_sum", low: float = 0.99, high: float = 1.01
) -> DataFrame:
    """Groups whose sum is not 1 within the tolerance, or is no number."""
    return sums.filter(out_of_tolerance(col(value), low, high))


def reaggregate(
    levels: Mapping[str, tuple[DataFrame, str]], keys: Sequence[str]
) -> DataFrame:
    """Sums of several tables on shared keys, side by side.

    ``levels`` maps result column -> (table, value column).  The tables are
    stacked with one value column each and summed in one aggregation: one
    shuffle of map-side sums instead of a chain of full joins, and a key found
    in only one table (or a NULL key) keeps its row.
    """
    stacked: DataFrame | None = None
    for name, (table, value) in levels.items():
        part = table.select(
            *cols(keys),
            *[
                (col(value) if n == name else F.lit(None)).cast("double").alias(n)
                for n in levels
            ],
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    assert stacked is not None, "at least one level is needed"
    return stacked.groupBy(*cols(keys)).agg(*[F.sum(col(n)).alias(n) for n in levels])


def reconcile(
    levels: Mapping[str, tuple[DataFrame, str]], keys: Sequence[str]
) -> DataFrame:
    """``reaggregate`` plus the relative difference of each level to the first."""
    names = list(levels)
    base = names[0]
    summed = reaggregate(levels, keys)
    return summed.select(
        *cols([*keys, *names]),
        *[
            relative_difference(col(n), col(base)).alias(f"per_diff_{n}")
            for n in names[1:]
        ],
    )


def unreconciled(
    compared: DataFrame, base: str, others: Sequence[str], tolerance: float = 0.001
) -> DataFrame:
    """Rows off by more than the tolerance, or present on one side only."""
    bad: Column = F.lit(False)
    for n in others:
        diff = col(f"per_diff_{n}")
        bad = (
            bad
            | F.coalesce((diff > tolerance) | (diff < -tolerance), F.lit(False))
            | (col(n).isNotNull() & col(base).isNull())
            | (col(n).isNull() & F.coalesce(col(base) != 0, F.lit(True)))
        )
    return compared.filter(bad)


def conservation(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    value: str,
    scopes: Mapping[str, Column],
) -> DataFrame:
    """Before/after sums per key and scope with deltas, plus a totals row per scope.

    ``scopes`` maps a scope's name to a condition on the keys.  Both tables are
    read once: scopes and totals (keys ``ALL``) are built from the per-key sums.
    """
    pairs = reaggregate(
        {"kwh_before": (before, value), "kwh_after": (after, value)}, keys
    )
    named = F.array(*[F.when(hit, F.lit(name)) for name, hit in scopes.items()])
    scoped = pairs.select(
        *[col(k).cast("string").alias(k) for k in keys],
        zero_if_null(col("kwh_before")).alias("kwh_before"),
        zero_if_null(col("kwh_after")).alias("kwh_after"),
        F.explode(F.filter(named, lambda s: s.isNotNull())).alias("scope"),
    )
    totals = scoped.groupBy("scope").agg(
        F.sum("kwh_before").alias("kwh_before"), F.sum("kwh_after").alias("kwh_after")
    ).select(
        *[F.lit("ALL").alias(k) for k in keys],
        "kwh_before",
        "kwh_after",
        F.concat(col("scope"), F.lit("_TOTAL")).alias("scope"),
    )
    both = totals.unionByName(scoped)
    return both.select(
        *cols(keys),
        *cols(["kwh_before", "kwh_after"]),
        (col("kwh_after") - col("kwh_before")).alias("delta"),
        percent_delta(col("kwh_before"), col("kwh_after")).alias("pct_delta"),
        col("scope"),
    )


def coverage(
    used: DataFrame,
    multipliers: DataFrame,
    used_keys: Sequence[str],
    value: str,
    result: str = "mult_sum",
) -> DataFrame:
    """Distinct key combinations in use and the multiplier sum each one has."""
    sums = multipliers.filter(is_number(col(value))).groupBy(*cols(used_keys)).agg(
        F.sum(col(value)).alias(result)
    )
    combos = used.select(*cols(used_keys)).distinct()
    return combos.join(sums, list(used_keys), "left").select(
        *cols([*used_keys, result])
    )


def missing_multipliers(
    annual: DataFrame,
    groups: DataFrame,
    multipliers: DataFrame,
    keys: Sequence[str],
    energy: str,
    value: str,
) -> DataFrame:
    """Coverage of the (place, group, end use, fuel) combinations that hold energy."""
    mapped = annual.filter(is_number(col(energy)) & (col(energy) > 0)).join(
        groups, ["meas", "end_use", "tech_stage"], "inner"
    )
    return coverage(mapped, multipliers, keys, value)


def compare_sources(
    sources: Mapping[str, tuple[DataFrame, str, Column]],
    keys: Sequence[str],
    pairs: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """One column of sums per source, and ``1 - a / b`` for chosen pairs.

    ``sources`` maps result column -> (table, value column, condition).  Sources
    of the same table are summed conditionally in one scan of it.  A source
    without a row for a key counts as 0.
    """
    tables: dict[int, DataFrame] = {id(df): df for df, _, _ in sources.values()}
    stacked: DataFrame | None = None
    for ident, table in tables.items():
        columns, used = [], F.lit(False)
        for name, (df, value, hit) in sources.items():
            if id(df) == ident:
                counts = F.coalesce(hit, F.lit(False)) & is_number(col(value))
                columns.append(F.when(counts, col(value)).cast("double").alias(name))
                used = used | counts
            else:
                columns.append(F.lit(None).cast("double").alias(name))
        part = table.filter(used).select(*cols(keys), *columns)
        stacked = part if stacked is None else stacked.unionByName(part)
    assert stacked is not None, "at least one source is needed"
    wide = stacked.groupBy(*cols(keys)).agg(
        *[zero_if_null(F.sum(col(n))).alias(n) for n in sources]
    )
    diffs = [
        relative_difference(col(a), col(b)).alias(name)
        for name, (a, b) in (pairs or {}).items()
    ]
    return wide.select(*cols([*keys, *sources]), *diffs)


def lacking_members(
    df: DataFrame,
    place: Sequence[str],
    member: str,
    expected: int,
    value: str,
    result: str = "n_uses",
    lookup: DataFrame | None = None,
) -> DataFrame:
    """Places whose number of distinct members differs from ``expected``."""
    counted = (
        df.filter(is_number(col(value)))
        .groupBy(*cols(place))
        .agg(F.countDistinct(col(member)).alias(result))
        .filter(col(result) != expected)
    )
    if lookup is None:
        return counted
    on = [k for k in place if k in lookup.columns]
    return counted.join(lookup, on, "left")


def shape_status(
    wanted: DataFrame,
    first: DataFrame,
    second: DataFrame,
    keys: Sequence[str],
    value: str,
    names: tuple[str, str],
    minimum: tuple[float, float],
) -> DataFrame:
    """'ok' or 'check' per wanted shape, from its multiplier sums in two tables."""
    out = wanted.select(*cols(keys)).distinct()
    for table, name in zip((first, second), names, strict=True):
        sums = table.filter(is_number(col(value))).groupBy(*cols(keys)).agg(
            F.sum(col(value)).alias(name)
        )
        out = join_null_safe(out, sums, keys, "left")
    a, b = col(names[0]), col(names[1])
    status = (
        F.when(a.isNull() & b.isNull(), F.lit("check"))
        .when(a < minimum[0], F.lit("check"))
        .when(b < minimum[1], F.lit("check"))
        .otherwise(F.lit("ok"))
    )
    return out.select(
        *cols(keys),
        zero_if_null(a).alias(names[0]),
        zero_if_null(b).alias(names[1]),
        status.alias("status"),
    )


def conservation_sets(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    value: str,
    scopes: Mapping[str, Column],
    subsets: Sequence[Sequence[str]] = ((),),
) -> DataFrame:
    """Before/after sums per key, per subset of the keys and in all, from one aggregation.

    ``scopes`` maps a scope's name to a condition on the keys; a row may be in several.
    Every scope has its detail (all ``keys``) and one set of totals for each of ``subsets``
    (``()`` is the scope's grand total).  ``level`` counts the keys that are summed away
    (0 is the detail) and a summed key reads ``ALL``; a key that is NULL in the data stays NULL.
    """
    parts = [
        table.select(
            *cols(keys),
            (col(value) if side == 0 else F.lit(None)).cast("double").alias("kwh_before"),
            (col(value) if side == 1 else F.lit(None)).cast("double").alias("kwh_after"),
        )
        for side, table in enumerate((before, after))
    ]
    named = F.array(*[F.when(hit, F.lit(name)) for name, hit in scopes.items()])
    scoped = parts[0].unionByName(parts[1]).withColumn(
        "scope", F.explode(F.filter(named, lambda s: s.isNotNull()))
    )
    sets = list(dict.fromkeys([tuple(keys), *[tuple(s) for s in subsets]]))
    summed = scoped.groupingSets(
        [[col("scope"), *cols(s)] for s in sets], col("scope"), *cols(keys)
    ).agg(
        zero_if_null(F.sum("kwh_before")).alias("kwh_before"),
        zero_if_null(F.sum("kwh_after")).alias("kwh_after"),
        *[F.grouping(col(k)).alias(f"__all_{i}") for i, k in enumerate(keys)],
    )
    away = [col(f"__all_{i}") for i in range(len(keys))]
    level = away[0].cast("int")
    for flag in away[1:]:
        level = level + flag.cast("int")
    return summed.select(
        *[F.when(flag == 1, F.lit("ALL")).otherwise(col(k).cast("string")).alias(k) for k, flag in zip(keys, away)],
        "kwh_before",
        "kwh_after",
        (col("kwh_after") - col("kwh_before")).alias("delta"),
        percent_delta(col("kwh_before"), col("kwh_after")).alias("pct_delta"),
        level.alias("level"),
        col("scope"),
    )
