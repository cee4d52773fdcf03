"""Monthly calibration of modelled hours to measured consumption."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.numbers import is_number, relative_difference, safe_ratio
from wattloom.functions.text import col, cols
from wattloom.operators.joins import full_join
from wattloom.operators.shapes import HOUR

CAL_KEYS = ("sector", "in.state", "month", "fuel")


def calibration_ratios(
    modelled: DataFrame,
    measured: DataFrame,
    keys: Sequence[str] = CAL_KEYS,
    year: str = "year",
    modelled_value: str = "state_monthly_uncal_kwh",
    measured_value: str = "gross.kWh",
    result: str = "calibration_multiplier",
) -> DataFrame:
    """Mean over the years of measured / modelled, per state, month, sector, fuel.

    Both inputs hold one row per key and year, so the average of a group has as
    many terms as there are years.
    """
    joined = modelled.join(measured, [*keys, year], "inner")
    ratio = safe_ratio(col(measured_value), col(modelled_value))
    return joined.groupBy(*cols(keys)).agg(F.avg(ratio).alias(result))


def calibrate_hours(
    hourly: DataFrame,
    ratios: DataFrame,
    keys: Sequence[str] = CAL_KEYS,
    hour: str = HOUR,
    value: str = "county_hourly_uncal_kwh",
    result: str = "county_hourly_cal_kwh",
    factor: str = "calibration_multiplier",
) -> DataFrame:
    """Hours x the ratio of their month; 1 where no ratio is known.

    Rows without an hour are dropped.  The ratios (states x 12 x fuels x
    sectors) are a side the optimiser sees the size of; the hourly table is
    neither shuffled nor unioned per sector and year.
    """
    monthly = hourly.filter(col(hour).isNotNull()).withColumn(
        "month", F.month(col(hour))
    )
    joined = monthly.join(ratios.select(*cols([*keys, factor])), list(keys), "left")
    return joined.withColumn(
        result, col(value) * F.coalesce(col(factor), F.lit(1.0))
    ).drop("month", factor)


def combine(parts: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Tables of several sectors in one frame, aligned by column name."""
    out = parts[0].select(*cols(columns))
    for part in parts[1:]:
        out = out.unionByName(part.select(*cols(columns)))
    return out


def calibration_audit(
    hourly: DataFrame,
    projection: DataFrame,
    ratios: DataFrame,
    keys: Sequence[str] = ("in.state", "sector"),
    tags: Sequence[str] = ("turnover",),
    uncal: str = "county_hourly_uncal_kwh",
    cal: str = "county_hourly_cal_kwh",
    projected: str = "state_ann_kwh",
    factor: str = "calibration_multiplier",
) -> DataFrame:
    """Multiplier implied by the results next to the mean of the given ratios."""
    by = [*tags, *keys]
    modelled = hourly.filter(is_number(col(uncal))).groupBy(*cols(by)).agg(
        F.sum(col(uncal)).alias("kwh_uncal"), F.sum(col(cal)).alias("kwh_cal")
    )
    planned = projection.groupBy(*cols(by)).agg(
        F.sum(col(projected)).alias("kwh_projection")
    )
    means = ratios.groupBy(*cols(keys)).agg(F.avg(col(factor)).alias("multiplier_avg"))
    both = full_join(planned, modelled, by)
    derived = safe_ratio(col("kwh_cal"), col("kwh_uncal"))
    return full_join(both, means, keys).select(
        *cols(by),
        *cols(["kwh_uncal", "kwh_cal", "kwh_projection", "multiplier_avg"]),
        derived.alias("multiplier_derived"),
        relative_difference(col("kwh_cal"), col("kwh_projection")).alias("diff_energy"),
        relative_difference(derived, col("multiplier_avg")).alias("diff_multiplier"),
    )


def scaled_by_group_ratio(
    detail: DataFrame,
    hourly: DataFrame,
    detail_keys: Sequence[str],
    ratio_keys: Sequence[str],
    value: str = "state_ann_kwh",
    uncal: str = "county_hourly_uncal_kwh",
    cal: str = "county_hourly_cal_kwh",
) -> DataFrame:
    """Detail sums next to the same sums scaled by their group's cal / uncal ratio."""
    ratios = hourly.groupBy(*cols(ratio_keys)).agg(
        safe_ratio(F.sum(col(cal)), F.sum(col(uncal))).alias("cal_over_uncal")
    )
    summed = detail.groupBy(*cols(detail_keys)).agg(
        F.sum(col(value)).alias(value + "_uncal")
    )
    return (
        summed.join(ratios, list(ratio_keys), "left")
        .withColumn(value + "_cal", col(value + "_uncal") * col("cal_over_uncal"))
        .drop("cal_over_uncal")
    )
