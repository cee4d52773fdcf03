"""The staged workflow: scenarios -> multipliers -> counties -> hours -> tables.

Each stage is a lazy function of its inputs; ``run_all`` writes every stage to
Parquet before the next one reads it, so lost executors cost a stage's tasks
and never the whole chain.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.calendar import epoch_nanos_to_timestamp, wrap_year
from wattloom.functions.text import col, cols
from wattloom.operators import calibrate, disagg, peaks, reconcile, scenario, shapes, stock, wide
from wattloom.operators.mapping import unmapped_measures, unmapped_packages
from wattloom.plans import commercial as com
from wattloom.plans import residential as res
from wattloom.plans.specs import annual_multipliers, gap_annual, place_lookup
from wattloom.sources import schemas, writers


@dataclass(frozen=True)
class Buildings:
    """Source tables of the building models."""

    meta_res: DataFrame
    ts_res: DataFrame
    meta_com: DataFrame
    ts_com: DataFrame
    gap_com: DataFrame
    zones: DataFrame  # in.county, in.state, tz
    building_type: str = "in.building_type"
    spill_year: int = 2019


@dataclass(frozen=True)
class Layout:
    """Where the stages are written."""

    root: str
    names: Mapping[str, str] = field(default_factory=dict)

    def __call__(self, stage: str) -> str:
        return f"{self.root}/{self.names.get(stage, stage)}"


# --- scenarios ---------------------------------------------------------------


def projection(
    documents: DataFrame,
    package_map: DataFrame | None,
    turnover: str,
    run: str,
    include_baseline: bool = True,
    split_gap: bool = True,
    include_origin: bool = False,
) -> DataFrame:
    """Annual state kWh of one scenario, unmodelled commercial energy split off.

    ``split_gap=False`` is for scenarios that carry no weights: nothing is split
    and building types are summed up.  ``include_origin`` keeps the documents' names of
    measures, which ``merge_baselines`` needs to tell several measures' ``Gap`` apart.
    """
    rows = scenario.flatten_scenario(documents)
    long = scenario.annual_long(
        rows, package_map, turnover, run, include_baseline, split_gap, include_origin
    )
    if not split_gap:
        return long.withColumn("bldg_type", F.lit(None).cast("string"))
    return scenario.weighted_split(long, scenario.gap_weights(documents))


def projection_checks(
    documents: DataFrame,
    projected: DataFrame,
    measure_map: DataFrame,
    package_map: DataFrame,
) -> dict[str, DataFrame]:
    rows = scenario.flatten_scenario(documents)
    return {
        "unmapped_measures": unmapped_measures(projected, measure_map),
        "unmapped_packages": unmapped_packages(rows, package_map, scenario.ENVELOPE),
    }


def split_check(
    documents: DataFrame, package_map: DataFrame | None, turnover: str, run: str
) -> DataFrame:
    """Sums before and after the split of unmodelled energy, with totals rows."""
    rows = scenario.flatten_scenario(documents)
    before = scenario.annual_long(rows, package_map, turnover, run)
    after = scenario.weighted_split(before, scenario.gap_weights(documents))
    keys = [n for n in before.columns if n not in ("meas", "state_ann_kwh")]
    return scenario.split_conservation(before, after, keys)


# --- multipliers -------------------------------------------------------------


def res_buildings(b: Buildings) -> DataFrame:
    """Residential buildings with the weather place as text.

    A double inside a join key is normalised by the join and would not match the
    clustering the inputs already have.
    """
    return b.meta_res.withColumns({c: col(c).cast("string") for c in res.WEATHER})


def com_buildings(b: Buildings) -> DataFrame:
    """Commercial buildings with the county under its common name."""
    return b.meta_com.withColumn("in.county", col(com.COUNTY))


def annual_tables(
    b: Buildings, maps: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """Geographic multipliers of both sectors."""
    states = place_lookup(b.meta_res, ["in.county", "in.state"])
    modelled = annual_multipliers(com_buildings(b), maps, com.ANNUAL, com.PLACE, "com")
    gap = gap_annual(b.gap_com, states, com.GAP_VALUE, com.GAP_END_USES)
    return {
        "res": annual_multipliers(res_buildings(b), maps, res.ANNUAL, res.PLACE, "res"),
        "com": modelled.unionByName(gap),
    }


def hourly_res(b: Buildings, maps: Mapping[str, DataFrame]) -> DataFrame:
    series = b.ts_res.withColumn("timestamp", epoch_nanos_to_timestamp(col("timestamp")))
    linked = shapes.building_shapes(res_buildings(b), maps, res.HOURLY, res.WEATHER)
    sums = shapes.hourly_sums(
        series,
        linked,
        res.HOURLY,
        res.WEATHER,
        shapes.aligned(spill_year=b.spill_year),
        collapse=True,
        upgrades=shapes.used_upgrades(maps, res.HOURLY),
    )
    return shapes.hourly_multipliers(sums, res.HOURLY, res.WEATHER, "res")


def hourly_com(b: Buildings, maps: Mapping[str, DataFrame]) -> DataFrame:
    """Commercial shapes: weighted profiles, cooking by time zone, gap series."""
    on = ("bldg_id", "upgrade", "state")
    carry = ("in.county", "in.state", "weight")
    linked = shapes.building_shapes(com_buildings(b), maps, com.HOURLY, carry, on)
    sums = shapes.hourly_sums(
        b.ts_com,
        linked,
        com.HOURLY,
        com.PLACE,
        shapes.aligned(spill_year=b.spill_year),
        weight="weight",
        on=on,
        extra=("in.state",),
        collapse=True,
        upgrades=shapes.used_upgrades(maps, com.HOURLY),
    )
    profiles = shapes.hourly_multipliers(
        sums, com.HOURLY, com.PLACE, "com", extra=("in.state",)
    )
    columns = profiles.columns
    return (
        profiles.unionByName(cooking_shape(b).select(*cols(columns)))
        .unionByName(gap_shape(b).select(*cols(columns)))
    )


def cooking_shape(b: Buildings) -> DataFrame:
    """Electric cooking = what the kitchen upgrade adds, by time zone.

    Buildings are matched on their id alone: each of a building's metadata rows
    contributes, which scales the kWh but not the shares.
    """
    upgrades = (0, com.COOKING_UPGRADE)
    kitchens = (
        com_buildings(b)
        .filter(
            col(b.building_type).isin(*com.COOKING_TYPES)
            & col("upgrade").isin(*upgrades)
        )
        .join(b.zones.select(*cols(["in.county", "tz"])), ["in.county"], "inner")
        # one row per building and zone: a reading is never multiplied by metadata rows
        .groupBy("bldg_id", "tz")
        .agg(F.sum("weight").alias("weight"))
    )
    used = b.ts_com.filter(
        col("upgrade").cast("string").isin(*[str(u) for u in upgrades])
    ).join(kitchens, "bldg_id", "inner")
    per_zone = shapes.shape_difference(
        used,
        ["tz"],
        shapes.aligned(spill_year=b.spill_year),
        col("out.electricity.interior_equipment.energy_consumption") * col("weight"),
        col("upgrade").cast("string") == "0",
        col("upgrade").cast("string") == str(com.COOKING_UPGRADE),
    )
    return shapes.spread_to_places(per_zone, b.zones, ["tz"]).select(
        *cols(["in.county", "in.state"]),
        F.lit(com.COOKING_SHAPE).alias("shape_ts"),
        *cols([shapes.HOUR, "kwh", "multiplier_hourly"]),
        F.lit("com").alias("sector"),
        F.lit(com.COOKING).alias("end_use"),
        F.explode(F.array(F.lit(com.EL), F.lit(com.NG))).alias("fuel"),
    )


def gap_shape(b: Buildings) -> DataFrame:
    """Shape of the unmodelled consumption; stamps are hour-ending already."""
    states = place_lookup(b.meta_res, ["in.county", "in.state"])
    placed = b.gap_com.join(states, ["in.county"], "left")
    shared = shapes.series_share(
        placed,
        ["in.county"],
        wrap_year(col("timestamp").cast("timestamp"), b.spill_year),
        com.GAP_VALUE,
        com.GAP_END_USES,
        com.EL,
        keep=["in.state"],
    )
    return shared.withColumn("shape_ts", F.lit("com_gap_ts_1")).withColumn(
        "sector", F.lit("com")
    )


def gap_shape_res(b: Buildings) -> DataFrame:
    """The same series as a residential shape by weather place (not in a run)."""
    weather = place_lookup(res_buildings(b), [*res.WEATHER, "in.county"])
    placed = b.gap_com.join(weather, ["in.county"], "left")
    shared = shapes.series_share(
        placed,
        res.WEATHER,
        wrap_year(col("timestamp").cast("timestamp"), b.spill_year),
        com.GAP_VALUE,
        [res.OTHER],
        res.EL,
    )
    return shared.withColumn("shape_ts", F.lit("res_gap_ts_1")).withColumn(
        "sector", F.lit("res")
    )


def multiplier_checks(
    annual: Mapping[str, DataFrame], hourly: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """Groups whose multipliers do not sum to 1."""
    group = ["in.state", "sector", "group_ann", "end_use", "fuel"]
    shape = ["shape_ts", "end_use", "fuel"]
    sums = {
        f"annual_{s}": reconcile.multiplier_sums(t, group, place="in.county")
        for s, t in annual.items()
    }
    for sector, place in (("com", ["in.state", "in.county"]), ("res", list(res.WEATHER))):
        sums[f"hourly_{sector}"] = reconcile.multiplier_sums(
            hourly[sector], [*place, *shape], "multiplier_hourly"
        )
    return {name: reconcile.off_by(t) for name, t in sums.items()}


# --- counties ----------------------------------------------------------------


def county_annual(
    projected: DataFrame, measure_map: DataFrame, annual: DataFrame, sector: str
) -> DataFrame:
    groups = disagg.stage_groups(measure_map).filter(col("sector") == sector)
    return disagg.disaggregate_annual(projected, groups, annual)


def county_hourly(
    annual: DataFrame,
    measure_map: DataFrame,
    hourly: DataFrame,
    sector: str,
    hour_blocks: int = 1,
    totals: disagg.HourTotals | None = None,
) -> DataFrame:
    place = list(res.WEATHER) if sector == "res" else list(com.PLACE)
    return disagg.disaggregate_hourly(
        annual,
        disagg.stage_shapes(measure_map),
        hourly,
        place,
        carry=("in.county", "in.state", "year", "turnover", "run_id"),
        hour_blocks=hour_blocks,
        totals=totals,
    )


def combined_hourly(
    parts: Sequence[DataFrame], ratios: DataFrame
) -> DataFrame:
    columns = [f.name for f in schemas.COUNTY_HOURLY.fields]
    return calibrate.calibrate_hours(calibrate.combine(parts, columns), ratios)


def combined_annual(parts: Sequence[DataFrame]) -> DataFrame:
    columns = [f.name for f in schemas.COUNTY_ANNUAL.fields]
    return calibrate.combine(parts, columns)


def county_checks(
    projected: DataFrame, annual: DataFrame, hourly: DataFrame
) -> dict[str, DataFrame]:
    """Re-aggregated levels that differ from the projection by more than 0.1 %."""
    state = projected.withColumnRenamed("reg", "in.state")
    levels = {
        "projection": (state, "state_ann_kwh"),
        "ann": (annual, "county_ann_kwh"),
        "hr": (hourly, "county_hourly_uncal_kwh"),
    }
    base = ["turnover", "in.state", "sector", "fuel", "year"]
    out = {}
    for name, keys in (("fuel", base), ("enduse", [*base, "end_use"])):
        compared = reconcile.reconcile(levels, keys)
        out[name] = reconcile.unreconciled(compared, "projection", ["ann", "hr"])
    by_measure = reconcile.reconcile(
        {k: levels[k] for k in ("projection", "ann")}, [*base, "end_use", "meas"]
    )
    out["meas"] = reconcile.unreconciled(by_measure, "projection", ["ann"])
    return out


def coverage_checks(
    projected: DataFrame,
    measure_map: DataFrame,
    annual: Mapping[str, DataFrame],
    counties: Mapping[str, DataFrame],
    hourly: Mapping[str, DataFrame],
) -> dict[str, DataFrame]:
    """Combinations that hold energy but whose multipliers are missing or not 1."""
    group = ["in.state", "group_ann", "end_use", "fuel"]
    known = calibrate.combine(list(annual.values()), [*group, "multiplier_annual"])
    out = {
        "annual": reconcile.missing_multipliers(
            projected.withColumnRenamed("reg", "in.state"),
            disagg.stage_groups(measure_map, ("meas", "end_use")),
            known,
            group,
            "state_ann_kwh",
            "multiplier_annual",
        )
    }
    places = {"res": list(res.WEATHER), "com": ["in.county", "in.state"]}
    for sector, place in places.items():
        out[f"hourly_{sector}"] = reconcile.missing_multipliers(
            counties[sector],
            disagg.stage_shapes(measure_map),
            hourly[sector],
            [*place, "shape_ts", "end_use", "fuel"],
            "county_ann_kwh",
            "multiplier_hourly",
        )
    return {name: reconcile.off_by(t, "mult_sum") for name, t in out.items()}


def extracts(hourly: DataFrame, base_year: int, last_year: int) -> dict[str, DataFrame]:
    """The standard analytic extracts of one combined hourly table."""
    cal = "county_hourly_cal_kwh"
    place = ["in.county", "turnover"]
    electric = hourly.filter(col("fuel") == "Electric")
    return {
        "county_ann_eu": peaks.totals(
            hourly.filter(col(cal) >= 0),
            ["in.county", "turnover", "in.state", "year", "sector", "end_use", "fuel"],
            {cal: "county_ann_kwh"},
        ),
        "county_monthly_maxes": peaks.monthly_peaks(
            electric, [*place, "in.state", "year"], cal
        ),
        "state_monthly": peaks.monthly_totals(
            hourly,
            ["turnover", "sector", "fuel", "in.state", "year"],
            {
                "county_hourly_uncal_kwh": "state_monthly_uncal_kwh",
                cal: "state_monthly_cal_kwh",
            },
        ),
        "county_peak_hour": peaks.peak_change(electric, place, cal, base_year, last_year),
        "county_share_winter": peaks.winter_share(electric, [*place, "year"], cal),
    }


def air_quality(hourly: DataFrame) -> DataFrame:
    """Hourly totals over end uses for emission models, all scenarios at once."""
    keys = ["in.county", "timestamp_hour", "turnover", "in.state", "year", "fuel", "sector"]
    return peaks.totals(
        hourly.filter(col("turnover") != "baseline"),
        keys,
        {
            "county_hourly_uncal_kwh": "county_hourly_uncal_kwh",
            "county_hourly_cal_kwh": "county_hourly_cal_kwh",
        },
    )


def county_totals(hourly: DataFrame) -> DataFrame:
    """Electricity of all buildings per county and hour."""
    return peaks.totals(
        hourly.filter(col("fuel") == "Electric"),
        ["timestamp_hour", "turnover", "in.county", "year", "in.state"],
        {"county_hourly_cal_kwh": "buildings_kwh"},
    ).select(
        col("timestamp_hour"),
        col("turnover"),
        col("in.county").alias("county"),
        col("buildings_kwh"),
        col("year"),
        col("in.state").alias("state"),
    )


def publish(
    long_hourly: DataFrame,
    wide_hourly: DataFrame,
    hourly_com: DataFrame,
    layout: Layout,
) -> dict[str, str]:
    """Write the published tables; each is one partitioned write, not one per key."""
    tables = {
        "published_county_hourly": (wide_hourly, ["scenario", "sector", "year", "state"]),
        "published_totals": (county_totals(long_hourly), ["turnover", "year", "state"]),
        "air_quality": (air_quality(long_hourly), schemas.PARTITIONS["air_quality"]),
    }
    for name, (df, by) in tables.items():
        writers.write_partitioned(df, layout(name), by)
    multipliers = layout("multipliers_by_county")
    writers.export_per_key(
        hourly_com.select(
            *cols(["in.county", "shape_ts", "timestamp_hour", "multiplier_hourly", "in.state"])
        ),
        multipliers,
        "in.county",
        "in_county",
    )
    return {**{n: layout(n) for n in tables}, "multipliers_by_county": multipliers}


# --- everything --------------------------------------------------------------


def run_all(
    spark: SparkSession,
    buildings: Buildings,
    maps: Mapping[str, DataFrame],
    measure_map: DataFrame,
    package_map: DataFrame | None,
    scenarios: Mapping[str, DataFrame],
    ratios: DataFrame,
    layout: Layout,
    run: str,
    hour_blocks: int = 4,
    years: tuple[int, int] | None = None,
) -> dict[str, str]:
    """Run every stage and return the paths written.

    After the tables come the checks, of which each writes the rows it rejects
    (``check_...``; an empty table is a pass), the published tables, and with ``years``
    (the first and last year to compare) the extracts (``extract_...``).

    ``hour_blocks`` splits the year of one place over so many tasks, as one
    weather place may serve many counties.  ``baseline_conflicts`` lists baseline
    values on which scenarios disagree, ``unstampable_hours`` counts the hours
    whose day the projection year lacks; they are not in the wide table.
    ``scenarios`` maps a scenario name to its documents.  All scenarios, years
    and sectors go through one plan per stage.
    """
    written: dict[str, str] = {}

    def stage(name: str, df: DataFrame, by: Sequence[str], sort: Sequence[str] = ()):
        written[name] = layout(name)
        writers.write_partitioned(df, written[name], by, sort=sort)
        return spark.read.parquet(written[name])

    parts = [
        projection(documents, package_map, turnover, run, include_origin=True)
        for turnover, documents in scenarios.items()
    ]
    stage("baseline_conflicts", scenario.baseline_conflicts(parts), [])
    projected = stage("projection", scenario.merge_baselines(parts), ["turnover"])

    annual = {
        s: stage(f"annual_multipliers_{s}", t, schemas.PARTITIONS["annual_multipliers"])
        for s, t in annual_tables(buildings, maps).items()
    }
    hourly = {
        "res": stage(
            "hourly_multipliers_res",
            hourly_res(buildings, maps),
            schemas.PARTITIONS["hourly_multipliers_res"],
            sort=[*res.WEATHER, "shape_ts"],
        ),
        "com": stage(
            "hourly_multipliers_com",
            hourly_com(buildings, maps),
            schemas.PARTITIONS["hourly_multipliers_com"],
            sort=["in.county", "shape_ts"],
        ),
    }
    counties = {
        s: stage(
            f"county_annual_{s}",
            county_annual(projected, measure_map, annual[s], s),
            schemas.PARTITIONS["county_annual"],
        )
        for s in ("res", "com")
    }
    hours = [
        county_hourly(counties[s], measure_map, hourly[s], s, hour_blocks)
        for s in ("res", "com")
    ]
    by = schemas.PARTITIONS["long_county"]
    stage("long_county_annual", combined_annual(list(counties.values())), by)
    long_hourly = stage(
        "long_county_hourly", combined_hourly(hours, ratios), by, sort=["in.county"]
    )
    stage("wide_county_hourly", wide.wide_hourly(long_hourly), ["sector", "year", "state"])
    stage(
        "wide_county_hourly_baseline",
        wide.wide_hourly(long_hourly, baseline=True),
        ["sector", "year", "state"],
    )
    stage("unstampable_hours", wide.unstampable(long_hourly), [])
    stage("wide_annual_state", wide.wide_annual(projected, long_hourly, years=None), ["scenario"])

    long_annual = spark.read.parquet(written["long_county_annual"])
    checks = {
        **{f"multipliers_{n}": df for n, df in multiplier_checks(annual, hourly).items()},
        **{f"coverage_{n}": df for n, df in coverage_checks(projected, measure_map, annual, counties, hourly).items()},
        **{f"levels_{n}": df for n, df in county_checks(projected, long_annual, long_hourly).items()},
        "unmapped_measures": unmapped_measures(projected, measure_map),
    }
    for name, df in checks.items():
        stage(f"check_{name}", df, [])
    published = publish(
        long_hourly, spark.read.parquet(written["wide_county_hourly"]), hourly["com"], layout
    )
    written.update(published)
    for name, df in (extracts(long_hourly, *years) if years else {}).items():
        stage(f"extract_{name}", df, [])
    return written


# --- stock ---------------------------------------------------------------------


def stock_tables(
    documents: DataFrame,
    division_buildings: DataFrame,
    state_shares: DataFrame,
    on: Sequence[str],
    keep: Sequence[str] = ("scenario",),
    text: str = "value",
    cut: bool = False,
) -> dict[str, DataFrame]:
    """Households and commercial buildings of all scenarios, from one read of their documents."""
    rows = scenario.flatten_scenario(documents, text, keep, cut)
    return {
        "households": stock.household_counts(rows, keep),
        "buildings": stock.building_counts(rows, division_buildings, state_shares, on, keep),
    }


def write_stock(tables: Mapping[str, DataFrame], layout: Layout) -> dict[str, str]:
    """The stock tables as .tsv, sorted by scenario, year and state."""
    paths = {name: layout(f"{name}.tsv") for name in tables}
    for name, df in tables.items():
        writers.write_extract(df, paths[name], "\t", ["scenario", "year", "state"])
    return paths
