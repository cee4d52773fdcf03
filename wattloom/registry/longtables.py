"""Long result tables laid over the line items, under the workflow's own names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.text import col
from wattloom.registry.core import LINES_SQL, Tables

END_USES = {
    "1-URGENT": "Cooling (Equip.)",
    "2-HIGH": "Heating (Equip.)",
    "3-MEDIUM": "Lighting",
    "4-NOT SPECIFIED": "Other",
    "5-LOW": "Water Heating",
}
TURNOVERS = {"A": "state", "N": "fossil", "R": "baseline"}
END_USE_SQL = "CASE o_orderpriority " + " ".join(
    f"WHEN '{p}' THEN '{e}'" for p, e in END_USES.items()
) + " END"
TURNOVER_SQL = "CASE l_returnflag " + " ".join(
    f"WHEN '{f}' THEN '{n}'" for f, n in TURNOVERS.items()
) + " END"


def _case(on: str, labels: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for key, value in labels.items():
        out = F.when(col(on) == key, F.lit(value)).otherwise(out)
    return out


def facts(t: Tables) -> DataFrame:
    """One row per line item: county (nation), state (region), hour, kWh."""
    regions = t("nation").join(
        t("region"), col("n_regionkey") == col("r_regionkey")
    ).select(col("n_name").alias("state"), col("r_name").alias("in.state"))
    return (
        t.lines()
        .join(regions, "state")
        .select(
            col("state").alias("in.county"),
            col("in.state"),
            F.when(col("l_linenumber") % 2 == 0, "res").otherwise("com").alias("sector"),
            _case("l_returnflag", TURNOVERS).alias("turnover"),
            F.year("l_shipdate").alias("year"),
            F.when(col("l_linestatus") == "F", "Electric")
            .otherwise("Natural Gas")
            .alias("fuel"),
            _case("o_orderpriority", END_USES).alias("end_use"),
            (
                col("l_shipdate").cast("timestamp")
                + F.make_interval(hours=col("l_linenumber") * 3)
            ).alias("timestamp_hour"),
            col("c_mktsegment").alias("meas"),
            "l_linenumber",
            col("l_quantity").alias("county_hourly_uncal_kwh"),
            col("l_extendedprice").alias("county_hourly_cal_kwh"),
        )
    )


FACTS_SQL = f"""{LINES_SQL},
facts AS (
  SELECT state AS "in.county", r_name AS "in.state",
    CASE WHEN l_linenumber % 2 = 0 THEN 'res' ELSE 'com' END AS sector,
    {TURNOVER_SQL} AS turnover, CAST(YEAR(l_shipdate) AS INTEGER) AS year,
    CASE WHEN l_linestatus = 'F' THEN 'Electric' ELSE 'Natural Gas' END AS fuel,
    {END_USE_SQL} AS end_use,
    l_shipdate + to_hours(l_linenumber * 3) AS timestamp_hour, c_mktsegment AS meas,
    l_linenumber, l_quantity AS county_hourly_uncal_kwh,
    l_extendedprice AS county_hourly_cal_kwh
  FROM lines JOIN nation n ON state = n.n_name JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def projection(t: Tables) -> DataFrame:
    """State totals by measure; a little more than the counties hold."""
    return (
        facts(t)
        .groupBy(col("in.state"), "sector", "meas", "end_use", "fuel", "year", "turnover")
        .agg(F.sum("county_hourly_uncal_kwh").alias("state_ann_kwh"))
    )


PROJECTION_SQL = f"""{FACTS_SQL},
projection AS (
  SELECT "in.state", sector, meas, end_use, fuel, year, turnover,
    SUM(county_hourly_uncal_kwh) AS state_ann_kwh
  FROM facts GROUP BY ALL)"""
