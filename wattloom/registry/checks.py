"""Calibration, reconciliation and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.functions.text import col
from wattloom.operators import calibrate, mapping, reconcile, shares
from wattloom.operators.shares import targets
from wattloom.registry.core import ORDERS_SQL, PLACES_SQL, Tables, nudged, query, rounded
from wattloom.registry.longtables import FACTS_SQL, PROJECTION_SQL, facts, projection

GROUP = ["state", "group_ann", "end_use", "fuel"]


def multipliers(t: Tables):
    """Customer shares by segment; some groups have no usable total."""
    return shares.share_of_group(
        t.places().select(
            col("c_custkey").alias("county"),
            "state",
            col("c_mktsegment").alias("group_ann"),
            F.greatest(col("c_acctbal"), F.lit(0.0)).alias("v"),
        ),
        ["county", "state"],
        ["state", "group_ann"],
        {"v": col("v")},
        targets("v", "Other", ["Electric", "Propane"]),
        share_name="multiplier_annual",
    )


MULTIPLIERS_SQL = f"""{PLACES_SQL},
sums AS (
  SELECT county, state, c_mktsegment AS group_ann, SUM(GREATEST(c_acctbal, 0)) AS v
  FROM places GROUP BY ALL),
shared AS (
  SELECT *, v / NULLIF(SUM(v) OVER (PARTITION BY state, group_ann), 0) AS multiplier_annual
  FROM sums),
multipliers AS (
  SELECT county, state, group_ann, 'Other' AS end_use, fuel, multiplier_annual
  FROM shared CROSS JOIN (VALUES ('Electric'), ('Propane')) AS f(fuel))"""


@query(
    "multiplier_sum_check",
    f"""
WITH {MULTIPLIERS_SQL}
SELECT state, group_ann, end_use, fuel, ROUND(SUM(multiplier_annual), 6) AS multiplier_sum,
  COUNT(DISTINCT county) AS n_places
FROM multipliers WHERE multiplier_annual IS NOT NULL AND NOT isnan(multiplier_annual)
GROUP BY ALL
""",
)
def multiplier_sum_check(t: Tables):
    """Multipliers of a group sum to 1; how many places share it."""
    out = reconcile.multiplier_sums(multipliers(t), GROUP, place="county")
    return rounded(out, {"multiplier_sum": 6})


@query(
    "multiplier_sum_failures",
    f"""
WITH {PLACES_SQL},
sums AS (
  SELECT state, c_mktsegment AS group_ann, SUM(c_acctbal / 100000) AS multiplier_sum
  FROM places GROUP BY ALL)
SELECT state, group_ann, ROUND(multiplier_sum, 7) AS multiplier_sum
FROM sums WHERE multiplier_sum > 1.01 OR multiplier_sum < 0.99
  OR multiplier_sum IS NULL OR isnan(multiplier_sum)
""",
)
def multiplier_sum_failures(t: Tables):
    """Only the groups whose sum is off by more than 1 %."""
    sums = reconcile.multiplier_sums(
        t.places().select(
            "state",
            col("c_mktsegment").alias("group_ann"),
            (col("c_acctbal") / 100000).alias("m"),
        ),
        ["state", "group_ann"],
        "m",
    )
    return rounded(reconcile.off_by(sums), {"multiplier_sum": 7})


@query(
    "coverage_check",
    f"""
WITH {MULTIPLIERS_SQL},
placed_orders AS (
  SELECT o.*, p.* FROM orders o JOIN places p ON o.o_custkey = p.county),
used AS (
  SELECT DISTINCT state, CASE WHEN o_orderstatus = 'P' THEN 'UNKNOWN' ELSE c_mktsegment END
    AS group_ann, 'Other' AS end_use,
    CASE WHEN o_orderstatus = 'F' THEN 'Electric' ELSE 'Biomass' END AS fuel
  FROM placed_orders WHERE o_totalprice > 0),
sums_by AS (
  SELECT state, group_ann, end_use, fuel, SUM(multiplier_annual) AS s
  FROM multipliers WHERE multiplier_annual IS NOT NULL GROUP BY ALL)
SELECT u.state, u.group_ann, u.end_use, u.fuel, ROUND(s, 6) AS mult_sum
FROM used u LEFT JOIN sums_by USING (state, group_ann, end_use, fuel)
""",
)
def coverage_check(t: Tables):
    """Combinations that hold energy and the multiplier sum each one has, if any."""
    status = col("o_orderstatus")
    used = t.orders().filter(col("o_totalprice") > 0).select(
        "state",
        F.when(status == "P", "UNKNOWN").otherwise(col("c_mktsegment")).alias("group_ann"),
        F.lit("Other").alias("end_use"),
        F.when(status == "F", "Electric").otherwise("Biomass").alias("fuel"),
    )
    out = reconcile.coverage(used, multipliers(t), GROUP, "multiplier_annual")
    return rounded(out, {"mult_sum": 6})


@query(
    "unmapped_keys",
    f"""
WITH {ORDERS_SQL}
SELECT DISTINCT c_mktsegment AS meas, o_orderpriority AS end_use FROM placed_orders
EXCEPT
SELECT c_mktsegment, o_orderpriority FROM placed_orders
WHERE o_totalprice > 498500 AND o_orderstatus = 'O'
""",
)
def unmapped_keys(t: Tables):
    """(measure, end use) pairs the map does not cover."""
    used = t.orders().select(
        col("c_mktsegment").alias("meas"), col("o_orderpriority").alias("end_use")
    )
    known = t.orders().filter(
        (col("o_totalprice") > 498500) & (col("o_orderstatus") == "O")
    ).select(col("c_mktsegment").alias("meas"), col("o_orderpriority").alias("end_use"))
    return mapping.unmapped_measures(used, known)


@query(
    "unmapped_packages",
    """
SELECT DISTINCT p_name AS meas FROM part JOIN lineitem ON p_partkey = l_partkey
WHERE l_tax != 0
EXCEPT
(SELECT p_name FROM part WHERE p_size < 5 UNION ALL SELECT p_type FROM part)
""",
)
def unmapped_packages(t: Tables):
    """Packages with a non-zero metric that are neither a package nor a part."""
    scenario = t("lineitem").join(
        t("part"), col("l_partkey") == col("p_partkey")
    ).select(col("p_name").alias("meas"), F.lit("env").alias("metric"), col("l_tax").alias("value"))
    named = t("part").select(
        F.when(col("p_size") < 5, col("p_name")).alias("meas"),
        col("p_type").alias("meas_separated"),
    )
    return mapping.unmapped_packages(scenario, named, "env")


@query(
    "known_keys",
    """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase')
""",
)
def known_keys(t: Tables):
    """Rows whose key occurs in another table."""
    buyers = t("events").filter(col("event_type") == "purchase").select(
        col("user_id").alias("o_custkey")
    )
    return mapping.keep_known(t("orders"), buyers, ["o_custkey"]).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


def _levels(t: Tables):
    f = facts(t)
    annual = f.filter((col("l_linenumber") < 7) & (col("year") > 1995)).withColumnRenamed(
        "county_hourly_uncal_kwh", "county_ann_kwh"
    )
    hourly = f.filter(
        (col("county_hourly_uncal_kwh") > 1) & (col("end_use") != "Lighting")
    )
    planned = projection(t).filter(col("year") < 2001)
    return {
        "projection_kwh": (planned, "state_ann_kwh"),
        "ann_kwh": (annual, "county_ann_kwh"),
        "hr_kwh": (hourly, "county_hourly_uncal_kwh"),
    }


def _reconcile_sql(keys: list[str], hourly: bool = True) -> str:
    names = ", ".join(f'"{k}"' for k in keys)
    hr_cte = f""",
hr AS (
  SELECT {names}, SUM(county_hourly_uncal_kwh) AS hr_kwh
  FROM facts WHERE county_hourly_uncal_kwh > 1 AND end_use != 'Lighting' GROUP BY ALL)"""
    hr_join = f" FULL JOIN hr USING ({names})"
    hr_cols = """, ROUND(hr_kwh, 2) AS hr_kwh,
  ROUND(1 - hr_kwh / NULLIF(projection_kwh, 0), 8) AS per_diff_hr_kwh"""
    return f"""
WITH {PROJECTION_SQL},
planned AS (
  SELECT {names}, SUM(state_ann_kwh) AS projection_kwh FROM projection
  WHERE year < 2001 GROUP BY ALL),
ann AS (
  SELECT {names}, SUM(county_hourly_uncal_kwh) AS ann_kwh FROM facts
  WHERE l_linenumber < 7 AND year > 1995 GROUP BY ALL){hr_cte if hourly else ""}
SELECT {names}, ROUND(projection_kwh, 2) AS projection_kwh, ROUND(ann_kwh, 2) AS ann_kwh,
  ROUND(1 - ann_kwh / NULLIF(projection_kwh, 0), 8) AS per_diff_ann_kwh{hr_cols if hourly else ""}
FROM planned FULL JOIN ann USING ({names}){hr_join if hourly else ""}
"""


BASE_KEYS = ["turnover", "in.state", "sector", "fuel", "year"]
RECONCILED = {
    "projection_kwh": 2,
    "ann_kwh": 2,
    "hr_kwh": 2,
    "per_diff_ann_kwh": 8,
    "per_diff_hr_kwh": 8,
}


@query("reconcile_fuel", _reconcile_sql(BASE_KEYS))
def reconcile_fuel(t: Tables):
    """Projection, annual and hourly sums by fuel; every row keeps its keys."""
    return rounded(reconcile.reconcile(_levels(t), BASE_KEYS), RECONCILED)


@query("reconcile_enduse", _reconcile_sql([*BASE_KEYS, "end_use"]))
def reconcile_enduse(t: Tables):
    """The same by end use."""
    return rounded(reconcile.reconcile(_levels(t), [*BASE_KEYS, "end_use"]), RECONCILED)


@query("reconcile_measure", _reconcile_sql([*BASE_KEYS, "end_use", "meas"], hourly=False))
def reconcile_measure(t: Tables):
    """Projection against annual sums by measure."""
    levels = _levels(t)
    levels.pop("hr_kwh")
    return rounded(
        reconcile.reconcile(levels, [*BASE_KEYS, "end_use", "meas"]), RECONCILED
    )


@query(
    "reconcile_failures",
    f"""
WITH compared AS ({_reconcile_sql([*BASE_KEYS, "end_use"])})
SELECT * FROM compared
WHERE per_diff_ann_kwh > 0.001 OR per_diff_ann_kwh < -0.001
  OR (ann_kwh IS NOT NULL AND projection_kwh IS NULL)
  OR (ann_kwh IS NULL AND (projection_kwh != 0 OR projection_kwh IS NULL))
  OR per_diff_hr_kwh > 0.001 OR per_diff_hr_kwh < -0.001
  OR (hr_kwh IS NOT NULL AND projection_kwh IS NULL)
  OR (hr_kwh IS NULL AND (projection_kwh != 0 OR projection_kwh IS NULL))
""",
)
def reconcile_failures(t: Tables):
    """Only the rows off by more than 0.1 % or present on one side."""
    compared = rounded(
        reconcile.reconcile(_levels(t), [*BASE_KEYS, "end_use"]), RECONCILED
    )
    return reconcile.unreconciled(compared, "projection_kwh", ["ann_kwh", "hr_kwh"])


def _compare_sql(keys: str, kinds: str) -> str:
    return f"""
WITH {PROJECTION_SQL}
SELECT {keys}, ROUND(com, 2) AS commercial_sum, ROUND(res, 2) AS residential_sum,
  ROUND(pcom, 2) AS planned_commercial_sum, ROUND(pres, 2) AS planned_residential_sum,
  ROUND(1 - com / NULLIF(pcom, 0), 8) AS diff_commercial,
  ROUND(1 - res / NULLIF(pres, 0), 8) AS diff_residential
FROM (
  SELECT {keys}, SUM(CASE WHEN s = 'com' THEN v ELSE 0 END) AS com,
    SUM(CASE WHEN s = 'res' THEN v ELSE 0 END) AS res,
    SUM(CASE WHEN s = 'pcom' THEN v ELSE 0 END) AS pcom,
    SUM(CASE WHEN s = 'pres' THEN v ELSE 0 END) AS pres
  FROM (
    SELECT {kinds}, sector AS s, county_hourly_uncal_kwh AS v FROM facts
    UNION ALL
    SELECT {kinds}, 'p' || sector, state_ann_kwh FROM projection WHERE fuel = 'Electric')
  GROUP BY {keys})
"""


def _compare(t: Tables, keys: list[str]):
    f, p = facts(t), projection(t)
    uncal, ann = "county_hourly_uncal_kwh", "state_ann_kwh"
    com, res, electric = col("sector") == "com", col("sector") == "res", col("fuel") == "Electric"
    out = reconcile.compare_sources(
        {
            "commercial_sum": (f, uncal, com),
            "residential_sum": (f, uncal, res),
            "planned_commercial_sum": (p, ann, com & electric),
            "planned_residential_sum": (p, ann, res & electric),
        },
        keys,
        {
            "diff_commercial": ("commercial_sum", "planned_commercial_sum"),
            "diff_residential": ("residential_sum", "planned_residential_sum"),
        },
    )
    digits = {n: 8 if n.startswith("diff") else 2 for n in out.columns if n not in keys}
    return rounded(out, digits)


@query("sector_compare_enduse", _compare_sql("turnover, end_use, year", "turnover, end_use, year"))
def sector_compare_enduse(t: Tables):
    """Sector sums next to the projection's, by end use."""
    return _compare(t, ["turnover", "end_use", "year"])


@query("sector_compare_total", _compare_sql("turnover", "turnover"))
def sector_compare_total(t: Tables):
    """Sector sums next to the projection's, in total."""
    return _compare(t, ["turnover"])


@query(
    "calibration_ratio",
    f"""
WITH {FACTS_SQL},
modelled AS (
  SELECT sector, "in.state", CAST(MONTH(timestamp_hour) AS INTEGER) AS month, fuel, year,
    SUM(county_hourly_uncal_kwh) AS m FROM facts WHERE turnover = 'baseline' GROUP BY ALL),
measured AS (
  SELECT sector, "in.state", CAST(MONTH(timestamp_hour) AS INTEGER) AS month, fuel, year,
    SUM(county_hourly_cal_kwh) AS g FROM facts WHERE turnover = 'state' GROUP BY ALL)
SELECT sector, "in.state", month, fuel, ROUND(AVG(g / NULLIF(m, 0)), 6)
  AS calibration_multiplier
FROM modelled JOIN measured USING (sector, "in.state", month, fuel, year)
GROUP BY ALL
""",
)
def calibration_ratio(t: Tables):
    """Mean over the years of measured / modelled."""
    return rounded(ratios(t), {"calibration_multiplier": 6})


def ratios(t: Tables):
    f = facts(t).withColumn("month", F.month("timestamp_hour"))
    keys = ["sector", "in.state", "month", "fuel", "year"]
    names = [col(k) for k in keys]
    modelled = f.filter(col("turnover") == "baseline").groupBy(*names).agg(
        F.sum("county_hourly_uncal_kwh").alias("state_monthly_uncal_kwh")
    )
    measured = f.filter(col("turnover") == "state").groupBy(*names).agg(
        F.sum("county_hourly_cal_kwh").alias("gross.kWh")
    )
    return calibrate.calibration_ratios(modelled, measured)


RATIOS_SQL = """
ratios AS (
  SELECT sector, "in.state", month, fuel, AVG(g / NULLIF(m, 0)) AS r
  FROM (SELECT sector, "in.state", CAST(MONTH(timestamp_hour) AS INTEGER) AS month, fuel, year,
      SUM(CASE WHEN turnover = 'baseline' THEN county_hourly_uncal_kwh END) AS m,
      SUM(CASE WHEN turnover = 'state' THEN county_hourly_cal_kwh END) AS g
    FROM facts GROUP BY ALL)
  WHERE m IS NOT NULL AND g IS NOT NULL AND "in.state" != 'ASIA' GROUP BY ALL)"""


@query(
    "calibrated_hourly",
    f"""
WITH {FACTS_SQL}, {RATIOS_SQL},
hours AS (
  SELECT "in.county", "in.state", timestamp_hour, turnover, sector, fuel,
    SUM(county_hourly_uncal_kwh) AS county_hourly_uncal_kwh
  FROM facts GROUP BY ALL)
SELECT h.*, ROUND(county_hourly_uncal_kwh * COALESCE(r, 1) * (1 + 1e-12), 4)
  AS county_hourly_cal_kwh
FROM hours h LEFT JOIN ratios q ON q.sector = h.sector AND q."in.state" = h."in.state"
  AND q.month = MONTH(h.timestamp_hour) AND q.fuel = h.fuel
WHERE timestamp_hour IS NOT NULL
""",
)
def calibrated_hourly(t: Tables):
    """Hours x their month's ratio; 1 where a state has none."""
    hours = facts(t).groupBy(
        *[col(n) for n in ("in.county", "in.state", "timestamp_hour", "turnover", "sector", "fuel")]
    ).agg(F.sum("county_hourly_uncal_kwh").alias("county_hourly_uncal_kwh"))
    known = ratios(t).filter(col("in.state") != "ASIA")
    out = calibrate.calibrate_hours(hours, known)
    return rounded(nudged(out, "county_hourly_cal_kwh"), {"county_hourly_cal_kwh": 4})


@query(
    "calibration_audit",
    f"""
WITH {PROJECTION_SQL}, {RATIOS_SQL},
hourly AS (
  SELECT turnover, "in.state", sector, SUM(county_hourly_uncal_kwh) AS u,
    SUM(county_hourly_cal_kwh) AS c
  FROM facts WHERE "in.state" != 'AFRICA' GROUP BY ALL),
planned AS (
  SELECT turnover, "in.state", sector, SUM(state_ann_kwh) AS p
  FROM projection WHERE fuel = 'Electric' AND turnover != 'fossil' GROUP BY ALL),
means AS (SELECT "in.state", sector, AVG(r) AS a FROM ratios GROUP BY ALL)
SELECT turnover, "in.state", sector, ROUND(u, 2) AS kwh_uncal, ROUND(c, 2) AS kwh_cal,
  ROUND(p, 2) AS kwh_projection, ROUND(a, 6) AS multiplier_avg,
  ROUND(c / u, 6) AS multiplier_derived, ROUND(1 - c / p, 6) AS diff_energy,
  ROUND(1 - c / u / a, 6) AS diff_multiplier
FROM planned FULL JOIN hourly USING (turnover, "in.state", sector)
  FULL JOIN means USING ("in.state", sector)
""",
)
def calibration_audit(t: Tables):
    """Multiplier implied by the results next to the mean given one."""
    out = calibrate.calibration_audit(
        facts(t).filter(col("in.state") != "AFRICA"),
        projection(t).filter((col("fuel") == "Electric") & (col("turnover") != "fossil")),
        ratios(t).filter(col("in.state") != "ASIA"),
    )
    keys = ("turnover", "in.state", "sector")
    digits = {n: 2 if n.startswith("kwh") else 6 for n in out.columns if n not in keys}
    return rounded(out, digits)


@query(
    "distinct_coverage",
    f"""
WITH {PLACES_SQL},
uses AS (
  SELECT user_id AS county, date_trunc('day', ts) AS day,
    COUNT(DISTINCT event_type) AS n_uses
  FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY ALL)
SELECT u.county, day, n_uses, c_name, ROUND(c_acctbal, 2) AS c_acctbal
FROM uses u LEFT JOIN customer ON u.county = c_custkey
WHERE n_uses != 5
""",
)
def distinct_coverage(t: Tables):
    """Places and days that lack one of the five members."""
    lookup = t("customer").select(col("c_custkey").alias("county"), "c_name", "c_acctbal")
    out = reconcile.lacking_members(
        t("events")
        .withColumnRenamed("user_id", "county")
        .withColumn("day", F.date_trunc("day", "ts")),
        ["county", "day"],
        "event_type",
        5,
        "value",
        lookup=lookup,
    )
    return rounded(out, {"c_acctbal": 2})


@query(
    "shape_status",
    """
WITH wanted AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size NOT IN (1, 2)),
a AS (
  SELECT p_brand, p_type, SUM(l_quantity) AS n_weather
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE l_returnflag = 'A' AND p_size > 40 GROUP BY ALL),
b AS (
  SELECT p_brand, p_type, SUM(l_quantity) AS n_county
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE l_returnflag = 'R' AND p_size < 10 GROUP BY ALL)
SELECT p_brand, p_type, COALESCE(n_weather, 0) AS n_weather, COALESCE(n_county, 0) AS n_county,
  CASE WHEN n_weather IS NULL AND n_county IS NULL THEN 'check'
    WHEN n_weather IS NOT NULL AND n_weather < 1214 THEN 'check'
    WHEN n_county IS NOT NULL AND n_county < 3085 THEN 'check' ELSE 'ok' END AS status
FROM wanted LEFT JOIN a USING (p_brand, p_type) LEFT JOIN b USING (p_brand, p_type)
""",
)
def shape_status(t: Tables):
    """'ok' or 'check' for each wanted shape."""
    sold = t("lineitem").join(t("part"), col("l_partkey") == col("p_partkey"))
    return reconcile.shape_status(
        t("part").filter(~col("p_size").isin(1, 2)),
        sold.filter((col("l_returnflag") == "A") & (col("p_size") > 40)),
        sold.filter((col("l_returnflag") == "R") & (col("p_size") < 10)),
        ["p_brand", "p_type"],
        "l_quantity",
        ("n_weather", "n_county"),
        (1214, 3085),
    )
