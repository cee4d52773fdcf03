"""Equipment stock: households and commercial buildings by state and year."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.numbers import safe_ratio, zero_if_null
from wattloom.functions.text import col, cols

# Metric and measure names used in stock scenarios.
HEATING = "Heating (Equip.)"
BASE_UNITS = "Baseline Stock (units equipment)"
MEASURE_UNITS = "Measure Stock (units equipment)"
UNITS_MARK = "units equipment"
BASE_SERVED = "Baseline Stock (TBtu heating served)"
MEASURE_SERVED = "Measure Stock (TBtu heating served)"
NO_COOL_MARK = "No Cool"
NO_COOL_MEASURES = (
    "(R) Ref. Case Other Fossil Heat, No Cooling",
    "(R) Ref. Case NG Heat, No Cooling",
    "(R) Best NG Heat, No Cooling",
    "(R) Ref. Case Resist. Heat, No Cooling",
    "(R) Ref. Case Resist. Heat, No Cooling (TS)",
)


def _metric(name: str, value: Column | None = None) -> Column:
    return F.when(col("metric") == name, col("value") if value is None else value)


def household_counts(
    rows: DataFrame, tags: Sequence[str] = ("scenario",)
) -> DataFrame:
    """Heating units in total and electric, cooling units, and their shares.

    One unit of heating equipment stands for one household.  A repeated cell
    (same keys and metric) counts once; the smaller value is used.
    """
    by = [*tags, "year", "reg"]
    heating = rows.filter(
        col("metric").contains(UNITS_MARK) & (col("end_use") == HEATING)
    )
    cell = [*by, "meas", "bldg_type", "end_use", "fuel"]
    cells = heating.groupBy(*cols(cell)).agg(
        F.sum(_metric(BASE_UNITS)).alias("units"),
        F.min(_metric(BASE_UNITS)).alias("base"),
        F.min(_metric(MEASURE_UNITS)).alias("measure"),
    )
    # Electric and cooling units count complete cells only, the total all rows.
    complete = reduce(lambda a, b: a & b, [col(n).isNotNull() for n in cell])
    electric = F.when(col("base") > 0, col("base")).when(col("base") == 0, col("measure"))
    no_cool = col("meas").contains(NO_COOL_MARK)
    cooling = (
        F.when(col("meas").isin(*NO_COOL_MEASURES), F.lit(0.0))
        .when(no_cool & (col("fuel") == "Electric"), col("measure"))
        .when(no_cool & (col("fuel") == "Non-Electric"), F.lit(0.0))
        .otherwise(col("base"))
    )
    is_electric = complete & (col("fuel") == "Electric")
    counts = cells.groupBy(*cols(by)).agg(
        F.sum(col("units")).alias("heating_units_total"),
        F.sum(F.when(is_electric, zero_if_null(electric))).alias("heating_units_elec"),
        F.sum(F.when(complete, zero_if_null(cooling))).alias("cooling_units"),
        F.count(col("units")).alias("__based"),
    )
    total = col("heating_units_total")
    return (
        counts.filter(col("__based") > 0)  # a state needs a baseline to be listed
        .drop("__based")
        .withColumn("share_elec_heat", safe_ratio(col("heating_units_elec"), total))
        .withColumn("share_cooling", safe_ratio(col("cooling_units"), total))
        .withColumnRenamed("reg", "state")
    )


def electric_heat_share(
    rows: DataFrame, tags: Sequence[str] = ("scenario",)
) -> DataFrame:
    """Share of the heat served by electric equipment after the measures."""
    by = [*tags, "reg", "year"]
    served = rows.filter(
        (col("end_use") == HEATING) & col("metric").isin(BASE_SERVED, MEASURE_SERVED)
    )
    electric = col("fuel") == "Electric"
    cells = served.groupBy(*cols([*by, "meas"])).agg(
        zero_if_null(F.sum(F.when(electric, _metric(BASE_SERVED)))).alias("base"),
        zero_if_null(F.sum(F.when(electric, _metric(MEASURE_SERVED)))).alias("measure"),
        zero_if_null(F.sum(_metric(BASE_SERVED))).alias("total"),
    )
    left = F.when(col("base") > 0, col("base") - col("measure")).otherwise(F.lit(0.0))
    return (
        cells.groupBy(*cols(by))
        .agg(F.sum(left).alias("eff_elec"), F.sum("total").alias("baseline_total"))
        .withColumn("share_elec", safe_ratio(col("eff_elec"), col("baseline_total")))
    )


def building_counts(
    rows: DataFrame,
    division_buildings: DataFrame,
    state_shares: DataFrame,
    on: Sequence[str],
    tags: Sequence[str] = ("scenario",),
    state: str = "in.state",
) -> DataFrame:
    """Commercial buildings per state and year, and those heated electrically.

    ``division_buildings`` (``N_bldgs_CDIV`` per division, type and year) are
    spread to states with ``cdiv_share`` first.
    """
    shares = electric_heat_share(rows, tags).withColumn("year", col("year").cast("int"))
    spread = (
        division_buildings.join(state_shares, list(on), "full")
        .groupBy(col("year").cast("int").alias("year"), col(state).alias("reg"))
        .agg(F.sum(col("N_bldgs_CDIV") * col("cdiv_share")).alias("N_bldgs"))
    )
    return spread.join(shares, ["reg", "year"], "right").select(
        col("year"),
        col("reg").alias("state"),
        *cols(tags),
        col("N_bldgs"),
        (col("N_bldgs") * col("share_elec")).alias("N_bldgs_elec_heat"),
    )
