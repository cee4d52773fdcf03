"""How catalogue entries are described and turned into annual multipliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.numbers import safe_ratio
from wattloom.functions.text import col, cols
from wattloom.operators.joins import join_null_safe
from wattloom.operators.mapping import attach_groups
from wattloom.operators.shares import TOTAL, Target, share_of_group, with_group_totals


@dataclass(frozen=True)
class AnnualSpec:
    """One set of geographic multipliers.

    Either ``group`` names the only group, with ``where`` choosing its rows, or
    ``map_name`` and ``keys`` assign groups by building characteristics.
    ``values`` are SQL expressions to be summed per place.
    """

    name: str
    values: Mapping[str, str]
    targets: tuple[Target, ...]
    group: str | None = None
    where: str = "upgrade = 0"
    map_name: str | None = None
    keys: tuple[str, ...] = field(default_factory=tuple)
    exclude: tuple[str, ...] = field(default_factory=tuple)


def add(template: str, *names: str) -> str:
    """``a + b + c`` over columns; a missing one makes the sum NULL."""
    return " + ".join("`" + template.format(n) + "`" for n in names)


def mapped_multipliers(
    meta: DataFrame,
    chars: DataFrame,
    spec: AnnualSpec,
    place: Sequence[str],
    state: str,
    sector: str,
) -> DataFrame:
    grouped = attach_groups(meta, chars, spec.keys, "group_ann", exclude=spec.exclude)
    return share_of_group(
        grouped,
        [*place, state],
        [state, "group_ann"],
        {name: F.expr(text) for name, text in spec.values.items()},
        spec.targets,
        share_name="multiplier_annual",
    ).withColumn("sector", F.lit(sector))


def literal_multipliers(
    meta: DataFrame,
    specs: Sequence[AnnualSpec],
    place: Sequence[str],
    state: str,
    sector: str,
) -> DataFrame:
    """All one-group specs in one aggregation of the building table.

    Each spec sums only the rows its ``where`` admits and yields no row for a
    place that has none of them.
    """
    aggs, names = [], []
    for i, spec in enumerate(specs):
        admitted = F.expr(spec.where)
        aggs.append(F.bool_or(F.coalesce(admitted, F.lit(False))).alias(f"__has{i}"))
        for value, text in spec.values.items():
            name = f"__{i}_{value}"
            aggs.append(F.sum(F.when(admitted, F.expr(text).cast("double"))).alias(name))
            names.append(name)
    wanted = " OR ".join(f"({w})" for w in dict.fromkeys(s.where for s in specs))
    keys = [*place, state]
    detail = meta.filter(wanted).groupBy(*cols(keys)).agg(*aggs)
    totalled = with_group_totals(detail, [state], names)
    rows = []
    for i, spec in enumerate(specs):
        for t in spec.targets:
            name = f"__{i}_{t.measure}"
            keep = col(f"__has{i}")
            if t.guard:
                keep = keep & F.coalesce(col(name + TOTAL) > 0, F.lit(False))
            rows.append(
                F.struct(
                    F.lit(spec.group).alias("group_ann"),
                    F.lit(t.end_use).alias("end_use"),
                    F.lit(t.fuel).cast("string").alias("fuel"),
                    safe_ratio(col(name), col(name + TOTAL)).alias("multiplier_annual"),
                    keep.alias("__keep"),
                )
            )
    fanned = totalled.select(*cols(keys), F.inline(F.array(*rows)))
    return (
        fanned.filter(col("__keep")).drop("__keep").withColumn("sector", F.lit(sector))
    )


def annual_multipliers(
    meta: DataFrame,
    maps: Mapping[str, DataFrame],
    specs: Sequence[AnnualSpec],
    place: Sequence[str],
    sector: str,
    state: str = "in.state",
) -> DataFrame:
    """Every geographic multiplier of a sector."""
    columns = [*place, "group_ann", "multiplier_annual", "sector", state, "end_use", "fuel"]
    literal = [s for s in specs if s.map_name is None]
    frames = []
    if literal:
        frames.append(literal_multipliers(meta, literal, place, state, sector))
    for spec in specs:
        if spec.map_name is not None:
            frames.append(
                mapped_multipliers(
                    meta, maps[spec.map_name], spec, place, state, sector
                )
            )
    out = frames[0].select(*cols(columns))
    for frame in frames[1:]:
        out = out.unionByName(frame.select(*cols(columns)))
    return out


def place_lookup(
    buildings: DataFrame, keys: Sequence[str], upgrade: str = "upgrade"
) -> DataFrame:
    """Distinct place attributes (county -> state, county -> weather place)."""
    return buildings.filter(col(upgrade) == 0).select(*cols(keys)).distinct()


def gap_annual(
    gap: DataFrame,
    county_states: DataFrame,
    value: str,
    end_uses: Sequence[str],
    group: str = "com_gap_ann_1",
    county: str = "in.county",
    state: str = "in.state",
    sector: str = "com",
) -> DataFrame:
    """County shares of unmodelled consumption, the same for every end use.

    Counties without a known state form one group of their own.
    """
    sums = gap.groupBy(col(county)).agg(F.sum(col(value)).alias("__gap"))
    placed = sums.join(county_states.select(*cols([county, state])), [county], "left")
    per_state = placed.groupBy(*cols([state, county])).agg(
        F.sum(col("__gap")).alias("__gap")
    )
    totals = per_state.groupBy(col(state)).agg(F.sum("__gap").alias("__total"))
    shared = join_null_safe(per_state, totals, [state])
    return shared.select(
        col(county),
        F.lit(group).alias("group_ann"),
        safe_ratio(col("__gap"), col("__total")).alias("multiplier_annual"),
        F.lit(sector).alias("sector"),
        col(state),
        F.explode(F.array(*[F.lit(e) for e in end_uses])).alias("end_use"),
        F.lit("Electric").alias("fuel"),
    )
