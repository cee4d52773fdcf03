"""Long results to wide publication tables.

Columns are fixed lists, never discovered from the data, so no job runs to
find them and a table has the same schema every time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.calendar import restamp_year
from wattloom.functions.text import col, cols, slug
from wattloom.operators.joins import full_join
from wattloom.operators.shapes import HOUR

# End use -> column stem of the hourly wide table.
HOURLY_STEMS = {
    "Computers and Electronics": "computers_electronics",
    "Cooking": "cooking",
    "Cooling (Equip.)": "cooling",
    "Heating (Equip.)": "heating",
    "Lighting": "lighting",
    "Other": "other",
    "Refrigeration": "refrigeration",
    "Ventilation": "ventilation",
    "Water Heating": "water_heating",
}

# Fuel -> alias in the annual wide table.
FUEL_ALIAS = {
    "Electric": "electricity_uncalibrated",
    "Propane": "propane",
    "Natural Gas": "natural_gas",
    "Biomass": "biomass",
    "Distillate/Other": "other",
}

# End-use slug -> (column stem, fuels published besides electricity).
ANNUAL_STEMS: dict[str, tuple[str, tuple[str, ...]]] = {
    "cooling_equip_": ("cooling", ("natural_gas",)),
    "heating_equip_": ("heating", ("propane", "natural_gas", "biomass", "other")),
    "water_heating": ("water_heating", ("propane", "natural_gas", "other")),
    "lighting": ("lighting", ()),
    "ventilation": ("ventilation", ()),
    "refrigeration": ("refrigeration", ()),
    "cooking": ("cooking", ("propane", "natural_gas")),
    "computers_and_electronics": ("computers_and_electronics", ()),
    "other": ("other", ("natural_gas", "other")),
}

PUBLISHED_YEARS = (2026, 2030, 2035, 2040, 2045, 2050)
SECTOR_NAMES = {"res": "Residential", "com": "Commercial"}


def pick_columns(
    df: DataFrame,
    keys: Sequence[str],
    on: str,
    columns: Mapping[str, str],
    values: Mapping[str, str],
    how=F.max,
) -> DataFrame:
    """Pivot by conditional aggregates.

    ``columns`` maps a label of ``on`` to a column stem, ``values`` maps a value
    column to a name prefix; the result has one column per pair.
    """
    aggs = [
        how(F.when(col(on) == label, col(value))).alias(prefix + stem)
        for value, prefix in values.items()
        for label, stem in columns.items()
    ]
    return df.groupBy(*cols(keys)).agg(*aggs)


def sector_name(sector: Column) -> Column:
    out = sector
    for short, name in SECTOR_NAMES.items():
        out = F.when(sector == short, F.lit(name)).otherwise(out)
    return out


def wide_hourly(
    hourly: DataFrame,
    values: Mapping[str, str] | None = None,
    fuel: str | None = "Electric",
    baseline: bool = False,
    stems: Mapping[str, str] = HOURLY_STEMS,
) -> DataFrame:
    """One row per scenario, place and hour with a column per end use.

    Hours carry the weather year's date; they are re-stamped to the projection
    year.  A day the target year lacks (29 February) gives a NULL stamp and is
    dropped; ``unstampable`` counts such rows.  Only one fuel is published here:
    without that filter fuels would compete for the same cell.
    """
    values = values or {
        "county_hourly_uncal_kwh": "uncal_",
        "county_hourly_cal_kwh": "cal_",
    }
    scenario = col("turnover") == "baseline"
    kept = hourly.filter(scenario if baseline else ~scenario)
    if fuel:
        kept = kept.filter(col("fuel") == fuel)
    named = kept.select(
        col("turnover").alias("scenario"),
        col("year"),
        sector_name(col("sector")).alias("sector"),
        col("in.state").alias("state"),
        col("in.county").alias("county"),
        restamp_year(col(HOUR), col("year")).alias("date_time"),
        col("end_use"),
        *cols(values),
    ).filter(col("date_time").isNotNull())
    keys = ["scenario", "county", "date_time", "sector", "year", "state"]
    return pick_columns(named, keys, "end_use", stems, values)


def unstampable(hourly: DataFrame) -> DataFrame:
    """Rows per year whose day does not exist in that year."""
    lost = restamp_year(col(HOUR), col("year")).isNull() & col(HOUR).isNotNull()
    return hourly.filter(lost).groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"))


def fuel_alias(fuel: Column) -> Column:
    out = F.lit("other")
    for name, alias in FUEL_ALIAS.items():
        out = F.when(fuel == name, F.lit(alias)).otherwise(out)
    return out


def wide_annual(
    projection: DataFrame,
    hourly: DataFrame,
    baseline: bool = False,
    years: Sequence[int] | None = PUBLISHED_YEARS,
    state: str = "reg",
    fuel: str = "Electric",
) -> DataFrame:
    """Fuel x end use columns from the projection, calibrated kWh from the hours."""
    wanted = col("turnover") == "baseline"
    wanted = wanted if baseline else ~wanted
    if years is not None:
        wanted = wanted & col("year").isin(*years)
    keys = ["state", "sector", "scenario", "year"]
    planned = projection.filter(wanted).select(
        col(state).alias("state"),
        col("sector"),
        col("turnover").alias("scenario"),
        col("year"),
        F.concat_ws(".", fuel_alias(col("fuel")), slug(col("end_use"))).alias("cell"),
        col("state_ann_kwh").alias("kwh"),
    )
    calibrated = hourly.filter(wanted & (col("fuel") == fuel)).select(
        col("in.state").alias("state"),
        col("sector"),
        col("turnover").alias("scenario"),
        col("year"),
        F.concat_ws(".", F.lit("electricity_calibrated"), slug(col("end_use"))).alias(
            "cell"
        ),
        col("county_hourly_cal_kwh").alias("kwh"),
    )
    cells = {}
    for eu, (stem, fuels) in ANNUAL_STEMS.items():
        for alias in (*fuels, "electricity_uncalibrated", "electricity_calibrated"):
            cells[f"{alias}.{eu}"] = f"{alias}.{stem}.kwh"
    both = planned.groupBy(*cols([*keys, "cell"])).agg(F.sum("kwh").alias("kwh"))
    both = both.unionByName(
        calibrated.groupBy(*cols([*keys, "cell"])).agg(F.sum("kwh").alias("kwh"))
    )
    return pick_columns(both, keys, "cell", cells, {"kwh": ""})


def electric_and_other(
    projection: DataFrame,
    keys: Sequence[str],
    value: str = "state_ann_kwh",
    electric: str = "Electric",
    other: str = "max",
) -> DataFrame:
    """Electric next to non-electric totals per scenario.

    ``other='max'`` keeps the largest non-electric fuel, as published;
    ``other='sum'`` adds the non-electric fuels up.
    """
    summed = projection.groupBy(*cols([*keys, "fuel"])).agg(F.sum(col(value)).alias("__v"))
    is_electric = col("fuel") == electric
    rest = F.when(~is_electric, col("__v"))
    return summed.groupBy(*cols(keys)).agg(
        F.max(F.when(is_electric, col("__v"))).alias("electricity"),
        (F.max(rest) if other == "max" else F.sum(rest)).alias("non_electric"),
    )


def merge_wide(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two wide tables side by side; a key found in one only is kept."""
    return full_join(left, right, keys)


def pivot_filled(
    df: DataFrame,
    keys: Sequence[str],
    parts: Sequence[str],
    labels: Sequence[Sequence[str]],
    value: str,
) -> DataFrame:
    """Pivot on several columns at once, missing cells filled with 0.

    ``labels`` lists the combinations of ``parts`` that become columns, each
    named by its labels joined with ``_``.
    """
    aggs = []
    for combo in labels:
        hit = F.lit(True)
        for part, label in zip(parts, combo, strict=True):
            hit = hit & (col(part) == label)
        total = F.sum(F.when(hit, col(value)))
        aggs.append(F.coalesce(total, F.lit(0.0)).alias("_".join(combo)))
    return df.groupBy(*cols(keys)).agg(*aggs)
