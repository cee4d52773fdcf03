"""Wide tables, combined tables and what is written to disk."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wattloom.functions.text import col
from wattloom.operators import calibrate, wide
from wattloom.plans import workflow
from wattloom.registry.core import LINES_SQL, ORDERS_SQL, Tables, query, rounded
from wattloom.registry.longtables import FACTS_SQL, PROJECTION_SQL, facts, projection
from wattloom.session import shared_folder
from wattloom.sources import writers

CAL, UNCAL = "county_hourly_cal_kwh", "county_hourly_uncal_kwh"


def _cells(value: str, prefix: str) -> str:
    return ",\n  ".join(
        f"ROUND(MAX(CASE WHEN end_use = '{label}' THEN {value} END), 2) AS {prefix}{stem}"
        for label, stem in wide.HOURLY_STEMS.items()
    )


def _wide_sql(baseline: bool) -> str:
    sign = "=" if baseline else "!="
    return f"""
WITH {FACTS_SQL},
hours AS (
  SELECT turnover, year + 1 AS year, sector, "in.state", "in.county", timestamp_hour, end_use,
    fuel, SUM(county_hourly_uncal_kwh) AS u, SUM(county_hourly_cal_kwh) AS c
  FROM facts GROUP BY ALL),
named AS (
  SELECT turnover AS scenario, year,
    CASE sector WHEN 'res' THEN 'Residential' WHEN 'com' THEN 'Commercial' ELSE sector END
      AS sector, "in.state" AS state, "in.county" AS county,
    TRY_CAST(year || '-' || strftime(timestamp_hour, '%m-%d %H:%M:%S') AS TIMESTAMP) AS date_time,
    end_use, u, c
  FROM hours WHERE turnover {sign} 'baseline' AND fuel = 'Electric')
SELECT scenario, county, date_time, sector, year, state,
  {_cells("u", "uncal_")},
  {_cells("c", "cal_")}
FROM named WHERE date_time IS NOT NULL
GROUP BY scenario, county, date_time, sector, year, state
"""


def _hours(t: Tables):
    """Hours by end use; the projection year is one after the weather year."""
    keys = ["turnover", "sector", "in.state", "in.county", "timestamp_hour", "end_use", "fuel"]
    return (
        facts(t)
        .groupBy(*[col(k) for k in keys], (col("year") + 1).alias("year"))
        .agg(F.sum(UNCAL).alias(UNCAL), F.sum(CAL).alias(CAL))
    )


def _round_all(df, keys, digits=2):
    return rounded(df, {n: digits for n in df.columns if n not in keys})


WIDE_KEYS = ("scenario", "county", "date_time", "sector", "year", "state")


@query("wide_hourly", _wide_sql(False))
def wide_hourly(t: Tables):
    """One column per end use, stamps moved to the projection year."""
    return _round_all(wide.wide_hourly(_hours(t)), WIDE_KEYS)


@query("wide_hourly_baseline", _wide_sql(True))
def wide_hourly_baseline(t: Tables):
    return _round_all(wide.wide_hourly(_hours(t), baseline=True), WIDE_KEYS)


@query(
    "unstampable_hours",
    f"""
WITH {FACTS_SQL}
SELECT CAST(year + 1 AS INTEGER) AS year, COUNT(*) AS n_rows FROM facts
WHERE MONTH(timestamp_hour) = 2 AND DAY(timestamp_hour) = 29
  AND NOT ((year + 1) % 4 = 0 AND ((year + 1) % 100 != 0 OR (year + 1) % 400 = 0))
GROUP BY ALL
""",
)
def unstampable_hours(t: Tables):
    """Rows lost to a day the target year does not have."""
    return wide.unstampable(facts(t).withColumn("year", (col("year") + 1).cast("int")))


def _annual_cells() -> str:
    out = []
    for eu, (stem, fuels) in wide.ANNUAL_STEMS.items():
        for alias in (*fuels, "electricity_uncalibrated", "electricity_calibrated"):
            out.append(
                f"ROUND(MAX(CASE WHEN a = '{alias}' AND eu = '{eu}' THEN kwh END), 2) "
                f'AS "{alias}.{stem}.kwh"'
            )
    return ",\n  ".join(out)


WIDE_ANNUAL_SQL = f"""
WITH {PROJECTION_SQL},
cells AS (
  SELECT "in.state" AS state, sector, turnover AS scenario, year,
    CASE fuel WHEN 'Electric' THEN 'electricity_uncalibrated' WHEN 'Propane' THEN 'propane'
      WHEN 'Natural Gas' THEN 'natural_gas' WHEN 'Biomass' THEN 'biomass' ELSE 'other' END AS a,
    lower(regexp_replace(end_use, '[^A-Za-z0-9]+', '_', 'g')) AS eu, SUM(state_ann_kwh) AS kwh
  FROM projection WHERE turnover {{0}} 'baseline' GROUP BY ALL
  UNION ALL
  SELECT "in.state", sector, turnover, year, 'electricity_calibrated',
    lower(regexp_replace(end_use, '[^A-Za-z0-9]+', '_', 'g')), SUM(county_hourly_cal_kwh)
  FROM facts WHERE turnover {{0}} 'baseline' AND fuel = 'Electric' GROUP BY ALL)
SELECT state, sector, scenario, year,
  {_annual_cells()}
FROM cells {{1}} GROUP BY state, sector, scenario, year
"""


@query(
    "wide_annual",
    WIDE_ANNUAL_SQL.format("!=", "WHERE year IN (1996, 1998, 2000)"),
)
def wide_annual(t: Tables):
    """Fuel x end use columns of the published years."""
    out = wide.wide_annual(projection(t), facts(t), years=(1996, 1998, 2000), state="in.state")
    return _round_all(out, ("state", "sector", "scenario", "year"))


@query("wide_annual_baseline", WIDE_ANNUAL_SQL.format("=", ""))
def wide_annual_baseline(t: Tables):
    out = wide.wide_annual(
        projection(t), facts(t), baseline=True, years=None, state="in.state"
    )
    return _round_all(out, ("state", "sector", "scenario", "year"))


@query(
    "electric_nonelectric",
    f"""
WITH {PROJECTION_SQL},
sums AS (
  SELECT turnover, year, "in.state", end_use AS fuel, SUM(state_ann_kwh) AS v
  FROM projection GROUP BY ALL)
SELECT turnover, year, "in.state",
  ROUND(MAX(CASE WHEN fuel = 'Lighting' THEN v END), 2) AS electricity,
  ROUND(MAX(CASE WHEN fuel != 'Lighting' THEN v END), 2) AS non_electric
FROM sums GROUP BY ALL
""",
)
def electric_nonelectric(t: Tables):
    """Electric next to the largest other fuel, per scenario."""
    five = projection(t).drop("fuel").withColumnRenamed("end_use", "fuel")
    out = wide.electric_and_other(
        five, ["turnover", "year", "in.state"], electric="Lighting"
    )
    return _round_all(out, ("turnover", "year", "in.state"))


@query(
    "fuel_columns_by_enduse",
    f"""
WITH {PROJECTION_SQL},
sums AS (
  SELECT turnover, year, "in.state", sector, end_use, fuel, SUM(state_ann_kwh) AS v
  FROM projection WHERE turnover = 'baseline' GROUP BY ALL),
picked AS (
  SELECT turnover, year, "in.state", sector, end_use,
    MAX(CASE WHEN fuel = 'Electric' THEN v END) AS uncal_elec,
    MAX(CASE WHEN fuel = 'Natural Gas' THEN v END) AS natural_gas,
    MAX(CASE WHEN fuel = 'Propane' THEN v END) AS propane
  FROM sums GROUP BY ALL),
hourly AS (
  SELECT turnover, year, "in.state", sector, end_use, SUM(county_hourly_cal_kwh) AS cal_elec
  FROM facts WHERE turnover = 'baseline' AND fuel = 'Electric' AND sector = 'com' GROUP BY ALL)
SELECT turnover, year, "in.state", sector, end_use, ROUND(uncal_elec, 2) AS uncal_elec,
  ROUND(natural_gas, 2) AS natural_gas, ROUND(propane, 2) AS propane,
  ROUND(cal_elec, 2) AS cal_elec
FROM picked FULL JOIN hourly USING (turnover, year, "in.state", sector, end_use)
""",
)
def fuel_columns_by_enduse(t: Tables):
    """One column per fuel, calibrated kWh joined on, end use kept as a row."""
    keys = ["turnover", "year", "in.state", "sector", "end_use"]
    names = [col(k) for k in keys]
    base = projection(t).filter(col("turnover") == "baseline")
    sums = base.groupBy(*names, "fuel").agg(F.sum("state_ann_kwh").alias("v"))
    fuels = {"Electric": "uncal_elec", "Natural Gas": "natural_gas", "Propane": "propane"}
    picked = wide.pick_columns(sums, keys, "fuel", fuels, {"v": ""})
    hourly = (
        facts(t)
        .filter(
            (col("turnover") == "baseline")
            & (col("fuel") == "Electric")
            & (col("sector") == "com")
        )
        .groupBy(*names)
        .agg(F.sum(CAL).alias("cal_elec"))
    )
    return _round_all(wide.merge_wide(picked, hourly, keys), keys)


@query(
    "state_totals_by_scenario",
    f"""
WITH {FACTS_SQL}
SELECT "in.county", timestamp_hour, turnover, "in.state", year, fuel, sector,
  ROUND(SUM(county_hourly_uncal_kwh), 2) AS county_hourly_uncal_kwh,
  ROUND(SUM(county_hourly_cal_kwh), 2) AS county_hourly_cal_kwh
FROM facts WHERE turnover != 'baseline' GROUP BY ALL
""",
)
def state_totals_by_scenario(t: Tables):
    """Hourly totals over end uses for all scenarios in one aggregation."""
    return rounded(workflow.air_quality(facts(t)), {UNCAL: 2, CAL: 2})


@query(
    "combined_sectors",
    f"""
WITH {FACTS_SQL}
SELECT "in.county", fuel, sector, year, ROUND(SUM(county_hourly_uncal_kwh), 2) AS kwh,
  COUNT(*) AS n_rows
FROM facts GROUP BY ALL
""",
)
def combined_sectors(t: Tables):
    """Sector tables united by column name."""
    f = facts(t)
    columns = ["in.county", "fuel", "sector", "year", UNCAL]
    parts = [f.filter(col("sector") == s).select(*[col(c) for c in order])
             for s, order in (("res", columns), ("com", columns[::-1]))]
    both = calibrate.combine(parts, columns)
    out = both.groupBy(*[col(c) for c in columns[:4]]).agg(
        F.sum(UNCAL).alias("kwh"), F.count(F.lit(1)).alias("n_rows")
    )
    return rounded(out, {"kwh": 2})


def _scratch(t: Tables) -> str:
    """A new folder all executors can reach."""
    return f"{shared_folder(t.spark)}/export-{uuid.uuid4().hex}"


ROUNDTRIP_SQL = f"""
WITH {ORDERS_SQL}
SELECT state, o_orderstatus, CAST(YEAR(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n_rows,
  ROUND(SUM(o_totalprice), 2) AS kwh
FROM placed_orders GROUP BY ALL
"""


def _summary(df):
    out = df.groupBy("state", "o_orderstatus", "year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_totalprice").alias("kwh")
    )
    return rounded(out, {"kwh": 2})


def _dated(t: Tables):
    return t.orders().withColumn("year", F.year("o_orderdate"))


@query("partitioned_roundtrip", ROUNDTRIP_SQL)
def partitioned_roundtrip(t: Tables):
    """Write by state and status, rerun one state's folders, read back."""
    path = _scratch(t) + "/orders"
    by = ["state", "o_orderstatus"]
    writers.write_partitioned(_dated(t), path, by, sort=["county"])
    one = _dated(t).filter(col("state") == "NATION_1")
    writers.replace_partitions(one, path, by)
    return _summary(t.spark.read.parquet(path))


@query("rerun_drops_old_folders", ROUNDTRIP_SQL.replace("GROUP BY", "WHERE o_orderstatus = 'F' GROUP BY"))
def rerun_drops_old_folders(t: Tables):
    """A rerun with fewer statuses leaves none of the earlier folders."""
    path = _scratch(t) + "/orders"
    by = ["state", "o_orderstatus"]
    writers.write_partitioned(_dated(t), path, by)
    writers.write_partitioned(_dated(t).filter(col("o_orderstatus") == "F"), path, by)
    return _summary(t.spark.read.parquet(path))


@query(
    "per_key_export",
    f"""
WITH {ORDERS_SQL}
SELECT state AS in_state, COUNT(*) AS n_rows, ROUND(SUM(o_totalprice), 2) AS kwh
FROM placed_orders GROUP BY ALL
""",
)
def per_key_export(t: Tables):
    """One folder per key from one write."""
    path = _scratch(t) + "/per_key"
    writers.export_per_key(_dated(t), path, "state", "in_state")
    back = t.spark.read.parquet(path)
    out = back.groupBy("in_state").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_totalprice").alias("kwh")
    )
    return rounded(out, {"kwh": 2})


@query("compact_files", ROUNDTRIP_SQL)
def compact_files(t: Tables):
    """Many small files rewritten as one file per folder in a new place."""
    folder = _scratch(t)
    scattered = _dated(t).repartition(6, "o_orderkey")
    scattered.write.partitionBy("state").parquet(f"{folder}/scattered")
    writers.compact(
        t.spark.read.parquet(f"{folder}/scattered"), f"{folder}/compacted", ["state"]
    )
    return _summary(t.spark.read.parquet(f"{folder}/compacted"))


@query(
    "appended_by_name",
    f"""
WITH {LINES_SQL}
SELECT state, l_returnflag, COUNT(*) AS n_rows, ROUND(SUM(l_quantity), 2) AS kwh
FROM lines GROUP BY ALL
""",
)
def appended_by_name(t: Tables):
    """Appends match columns by name, whatever their order."""
    path = _scratch(t) + "/appended"
    columns = ["state", "l_returnflag", "l_quantity"]
    lines = t.lines().select(*columns)
    lines.filter(col("l_returnflag") == "A").write.parquet(path)
    for flag in ("N", "R"):
        part = lines.filter(col("l_returnflag") == flag).select(*columns[::-1])
        writers.append_by_name(part, path)
    out = t.spark.read.parquet(path).groupBy("state", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("kwh")
    )
    return rounded(out, {"kwh": 2})
