"""Mapping tables: characteristic maps, stage maps, coverage of keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.text import col, cols
from wattloom.operators.joins import join_null_safe


def melt(
    df: DataFrame,
    ids: Sequence[str],
    columns: Mapping[str, str],
    stage_name: str,
    value_name: str,
) -> DataFrame:
    """Columns to rows in one scan; ``columns`` maps source column -> stage label."""
    stages = [
        F.struct(F.lit(label).alias(stage_name), col(source).alias(value_name))
        for source, label in columns.items()
    ]
    return df.select(*cols(ids), F.inline(F.array(*stages)))


def attach_groups(
    df: DataFrame,
    chars: DataFrame,
    keys: Sequence[str],
    group: str,
    upgrade: str | None = "upgrade",
    exclude: Sequence[str] = (),
    keep_upgrade: bool = False,
) -> DataFrame:
    """Inner join of rows to the groups their characteristics belong to.

    One row may belong to several groups.  The map holds upgrades as text, so
    the fact's upgrade is cast once, here.  The join itself drops upgrades the
    map does not name; no separate semi-join is needed.
    """
    picked = chars.select(*cols([*keys, group]), *([col(upgrade)] if upgrade else []))
    if exclude:
        picked = picked.filter(~col(group).isin(*exclude))
    on = list(keys)
    if upgrade:
        df = df.withColumn(upgrade, col(upgrade).cast("string"))
        picked = picked.withColumn(upgrade, col(upgrade).cast("string"))
        on.append(upgrade)
    joined = df.join(picked, on, "inner")
    return joined if keep_upgrade or not upgrade else joined.drop(upgrade)


def keep_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys occur in ``known`` (``IN (SELECT DISTINCT ...)``)."""
    return df.join(known.select(*cols(keys)), list(keys), "left_semi")


def missing_keys(
    df: DataFrame,
    known: DataFrame,
    keys: Sequence[str],
    renamed: Mapping[str, str] | None = None,
) -> DataFrame:
    """Distinct keys of ``df`` that ``known`` lacks; NULL keys compare as equal."""
    names = renamed or {}
    right = known.select(*[col(names.get(k, k)).alias(k) for k in keys])
    # Distinct first: the combine runs before the shuffle, so a key that holds a
    # third of the rows reaches the join once.
    return join_null_safe(
        df.select(*cols(keys)).distinct(), right.distinct(), keys, "left_anti"
    )


def unmapped_measures(
    projection: DataFrame,
    measure_map: DataFrame,
    measure: str = "meas",
    end_use: str = "end_use",
) -> DataFrame:
    """(measure, end use) pairs of a projection the measure map does not cover."""
    return missing_keys(projection, measure_map, [measure, end_use])


def unmapped_packages(
    scenario: DataFrame,
    package_map: DataFrame,
    metric: str,
    measure: str = "meas",
    part: str = "meas_separated",
) -> DataFrame:
    """Measures with a non-zero package metric that the package map does not name.

    A measure counts as named when it is either a package or one of its parts.
    """
    used = scenario.filter((col("metric") == metric) & (col("value") != 0)).filter(
        ~F.isnan(col("value"))
    )
    named = package_map.select(
        F.explode(F.array(col(measure), col(part))).alias(measure)
    ).filter(col(measure).isNotNull())
    return missing_keys(used, named, [measure])


def replace_rows(
    df: DataFrame, drop: Column, replacements: DataFrame
) -> DataFrame:
    """A map variant: rows matching ``drop`` are swapped for ``replacements``."""
    kept = df.filter(~F.coalesce(drop, F.lit(False)))
    return kept.unionByName(replacements, allowMissingColumns=True)


def tagged_variants(
    variants: Mapping[str, DataFrame], tag: str = "kind"
) -> DataFrame:
    """All map variants in one frame, so that one job serves every what-if."""
    frames = [df.withColumn(tag, F.lit(name)) for name, df in variants.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def enrich_stage(
    df: DataFrame,
    measure_map: DataFrame,
    keys: Sequence[str],
    columns: Mapping[str, str],
    stage_name: str = "tech_stage",
    value_name: str = "description",
    how: str = "inner",
) -> DataFrame:
    """Add the description (or group) that belongs to a row's technology stage."""
    long_map = melt(measure_map, keys, columns, stage_name, value_name)
    return df.join(long_map, [*keys, stage_name], how)
