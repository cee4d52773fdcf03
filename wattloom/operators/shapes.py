"""Hourly multipliers: a building time series turned into shares of a year."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.calendar import align_hour
from wattloom.functions.numbers import safe_ratio
from wattloom.functions.text import col, cols
from wattloom.operators.joins import join_null_safe
from wattloom.operators.shares import (
    TOTAL,
    Target,
    share_of_group,
    sum_by,
    with_group_totals,
)

HOUR = "timestamp_hour"


@dataclass(frozen=True)
class HourlyProfile:
    """One load profile: which buildings, which columns, which output rows.

    A profile has at most two sums, ``primary`` and ``secondary`` (electric and
    fossil), because every output fuel uses one of the two.
    """

    name: str
    primary: str  # SQL expression over the series
    targets: tuple[Target, ...]
    secondary: str | None = None
    shape: str | None = None  # one shape for every building of upgrade 0 ...
    map_name: str | None = None  # ... or a shape per characteristic
    keys: tuple[str, ...] = field(default_factory=tuple)


def hourly_shape(
    series: DataFrame,
    place: Sequence[str],
    shape: Sequence[str],
    hour: Column,
    values: Mapping[str, Column],
    rows: Sequence[Target],
    drop_null: Sequence[str] = (),
) -> DataFrame:
    """Hourly sums by place and shape, each divided by its total over all hours.

    The sum is combined before the shuffle (a building's readings collapse to
    hours in the scan task), the share is joined back, and fuels are fanned out
    last, after the division, so they cost no extra shuffle.
    """
    keys = [*place, *shape]
    return share_of_group(
        series.withColumn(HOUR, hour),
        [*keys, HOUR],
        keys,
        values,
        rows,
        value_name="kwh",
        share_name="multiplier_hourly",
        drop_null=drop_null,
    )


def building_shapes(
    buildings: DataFrame,
    maps: Mapping[str, DataFrame],
    profiles: Sequence[HourlyProfile],
    keep: Sequence[str],
    on: Sequence[str] = ("bldg_id", "upgrade"),
    upgrade: str = "upgrade",
) -> DataFrame:
    """(building, upgrade) -> ``shapes``, an array of (profile, shape).

    One pass over the building table: every mapped profile adds an array column
    from its small map (a map may list a characteristic under several shapes).
    Buildings that feed no profile are dropped.
    """
    out = buildings.withColumn(upgrade, col(upgrade).cast("string"))
    listed = []
    literal = [p for p in profiles if p.shape]
    if literal:
        entries = [_entry(p.name, F.lit(p.shape)) for p in literal]
        listed.append(F.when(col(upgrade) == "0", F.array(*entries)))
    for i, p in enumerate(profiles):
        if not p.map_name:
            continue
        keys, name = [*p.keys, upgrade], f"__shapes{i}"
        chars = (
            maps[p.map_name]
            .withColumn(upgrade, col(upgrade).cast("string"))
            .groupBy(*cols(keys))
            .agg(F.collect_list(col("shape_ts")).alias(name))
        )
        out = out.join(chars, keys, "left")
        listed.append(_entries(p.name, col(name)))
    empty = F.array().cast("array<struct<profile:string,shape_ts:string>>")
    joined = F.concat(*[F.coalesce(entries, empty) for entries in listed])
    kept = list(dict.fromkeys([*on, *keep]))
    return out.select(*cols(kept), joined.alias("shapes")).filter(F.size("shapes") > 0)


def used_upgrades(
    maps: Mapping[str, DataFrame], profiles: Sequence[HourlyProfile], upgrade: str = "upgrade"
) -> list[str]:
    """The upgrades that any profile uses, from the small maps (a few values)."""
    found = {"0"} if any(p.shape for p in profiles) else set()
    for name in sorted({p.map_name for p in profiles if p.map_name}):
        values = maps[name].select(col(upgrade).cast("string")).distinct().dropna()
        found |= {row[0] for row in values.collect()}
    return sorted(found)


def _entries(profile: str, shapes: Column) -> Column:
    return F.transform(shapes, lambda shape: _entry(profile, shape))


def _entry(profile: str, shape: Column) -> Column:
    return F.struct(F.lit(profile).alias("profile"), shape.alias("shape_ts"))


def hourly_sums(
    series: DataFrame,
    shapes: DataFrame,
    profiles: Sequence[HourlyProfile],
    place: Sequence[str],
    hour: Column,
    weight: str | None = None,
    on: Sequence[str] = ("bldg_id", "upgrade"),
    upgrade: str = "upgrade",
    extra: Sequence[str] = (),
    collapse: bool = False,
    upgrades: Sequence[str] | None = None,
) -> DataFrame:
    """Hourly kWh of every profile from one scan of the series.

    ``upgrades`` (see ``used_upgrades``) limits the scan itself: other folders of
    the series are not opened, or their rows dropped before any shuffle, however
    large the building table is.

    The series is by far the largest table, so it is scanned once for all profiles
    instead of once per profile and state; rows are multiplied by profile only
    behind the last shuffle, next to the sum.  ``collapse`` adds a
    building's readings of one hour up before the join, which for quarter-hourly
    data cuts the rows that are shuffled to a quarter.  ``extra`` are attributes
    of the place that are carried along (a county's state).
    """
    measures = _measures(profiles)
    if upgrades is not None:
        series = series.filter(col(upgrade).cast("string").isin(list(upgrades)))
    keyed = series.select(
        *[
            col(k).cast("string").alias(k) if k == upgrade else col(k)
            for k in on
        ],
        hour.alias(HOUR),
        *[value.alias(name) for name, value in measures.items()],
    )
    if collapse:
        keyed = sum_by(keyed, [*on, HOUR], {name: col(name) for name in measures})
    carried = list(dict.fromkeys([*place, *extra, *([weight] if weight else [])]))
    joined = keyed.join(shapes, list(on), "inner").select(*cols([*carried, HOUR, *measures, "shapes"]))
    # A place's hour is part of every key below: readings are dealt by it as they are, once,
    # and fanned out to profiles and shapes in the task that sums them.
    dealt = joined.repartition(*cols([*place, HOUR]))
    joined = dealt.select(*cols([*carried, HOUR, *measures]), F.inline(col("shapes")))
    factor = col(weight) if weight else F.lit(1.0)
    picked = {"primary": _pick(profiles, "p"), "secondary": _pick(profiles, "s")}
    return sum_by(
        joined,
        [*place, *extra, "profile", "shape_ts", HOUR],
        {name: expr * factor for name, expr in picked.items()},
    )


def _measures(profiles: Sequence[HourlyProfile]) -> dict[str, Column]:
    out = {}
    for i, p in enumerate(profiles):
        out[f"__p{i}"] = F.expr(p.primary).cast("double")
        if p.secondary:
            out[f"__s{i}"] = F.expr(p.secondary).cast("double")
    return out


def _pick(profiles: Sequence[HourlyProfile], kind: str) -> Column:
    """The measure of the row's own profile; NULL where the profile has none."""
    chosen = F.lit(None).cast("double")
    for i, p in enumerate(profiles):
        if kind == "p" or p.secondary:
            chosen = F.when(col("profile") == p.name, col(f"__{kind}{i}")).otherwise(
                chosen
            )
    return chosen


def hourly_multipliers(
    sums: DataFrame,
    profiles: Sequence[HourlyProfile],
    place: Sequence[str],
    sector: str,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Share of the year per (place, shape, fuel), fanned out to end uses and fuels.

    ``extra`` are columns that depend on the place (a county's state) and are
    carried through but not part of the group.
    """
    totals = sums.groupBy(*cols([*place, "profile", "shape_ts"])).agg(
        F.sum(col("primary")).alias("primary" + TOTAL),
        F.sum(col("secondary")).alias("secondary" + TOTAL),
    )
    # One row for each place and shape: broadcast, so that the hourly sums stay where they are.
    shared = join_null_safe(sums, F.broadcast(totals), [*place, "profile", "shape_ts"])
    rows = F.lit(None)
    for p in profiles:
        entries = F.array(
            *[
                F.struct(
                    F.lit(t.end_use).alias("end_use"),
                    F.lit(t.fuel).cast("string").alias("fuel"),
                    col(t.measure).alias("kwh"),
                    safe_ratio(col(t.measure), col(t.measure + TOTAL)).alias(
                        "multiplier_hourly"
                    ),
                    (
                        F.coalesce(col(t.measure + TOTAL) > 0, F.lit(False))
                        if t.guard
                        else F.lit(True)
                    ).alias("__keep"),
                )
                for t in p.targets
            ]
        )
        rows = F.when(col("profile") == p.name, entries).otherwise(rows)
    return (
        shared.select(
            *cols([*place, *extra]),
            col("shape_ts"),
            col(HOUR),
            F.lit(sector).alias("sector"),
            F.inline(rows),
        )
        .filter(col("__keep"))
        .drop("__keep")
    )


def hour_share(
    hourly: DataFrame,
    place: Sequence[str],
    value: str = "kwh",
    shape: Sequence[str] = ("shape_ts", "fuel"),
    also: Sequence[str] = ("sector", "end_use"),
    share_name: str = "multiplier_hourly",
) -> DataFrame:
    """Normalise a long hourly table: merge rows of one hour, divide by the year.

    Used on tables that were filled piecewise (a weather place that crosses
    state borders has rows from several states for the same hour).
    """
    keys = [*place, *shape, *also]
    merged = sum_by(hourly, [*keys, HOUR], {value: col(value)})
    totalled = with_group_totals(merged, keys, [value])
    return totalled.filter(col(value + TOTAL) > 0).select(
        *cols(merged.columns),
        safe_ratio(col(value), col(value + TOTAL)).alias(share_name),
    )


def shape_difference(
    series: DataFrame,
    zone: Sequence[str],
    hour: Column,
    value: Column,
    base: Column,
    changed: Column,
    share_name: str = "multiplier_hourly",
) -> DataFrame:
    """Shape of what an upgrade adds: (changed - base) per zone and hour.

    ``base`` and ``changed`` are predicates over the series.
    """
    summed = series.withColumn(HOUR, hour).groupBy(*cols([*zone, HOUR])).agg(
        F.sum(F.when(base, value).otherwise(0.0)).alias("__base"),
        F.sum(F.when(changed, value).otherwise(0.0)).alias("__changed"),
    )
    diff = summed.select(
        *cols([*zone, HOUR]), (col("__changed") - col("__base")).alias("kwh")
    )
    totalled = with_group_totals(diff, zone, ["kwh"])
    return totalled.select(
        *cols([*zone, HOUR, "kwh"]),
        safe_ratio(col("kwh"), col("kwh" + TOTAL)).alias(share_name),
    )


def spread_to_places(
    shapes: DataFrame, places: DataFrame, zone: Sequence[str]
) -> DataFrame:
    """Give every place of a zone the zone's shape (many-to-many on the zone)."""
    return shapes.join(places, list(zone), "inner").drop(*zone)


def series_share(
    series: DataFrame,
    place: Sequence[str],
    hour: Column,
    value: str,
    end_uses: Sequence[str],
    fuel: str,
    keep: Sequence[str] = (),
    share_name: str = "multiplier_hourly",
) -> DataFrame:
    """Share of a series that is already hourly, copied to several end uses."""
    totalled = with_group_totals(series, place, [value])
    return totalled.select(
        *cols([*place, *keep]),
        hour.alias(HOUR),
        col(value).alias("kwh"),
        safe_ratio(col(value), col(value + TOTAL)).alias(share_name),
        F.lit(fuel).alias("fuel"),
        F.explode(F.array(*[F.lit(e) for e in end_uses])).alias("end_use"),
    )


def aligned(time: str = "timestamp", spill_year: int | None = 2019) -> Column:
    return align_hour(col(time), spill_year)
