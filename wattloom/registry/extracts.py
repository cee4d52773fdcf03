"""Analytic extracts: totals, peaks, seasons, changes, example profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.functions.text import col
from wattloom.operators import calibrate, mapping, peaks
from wattloom.plans import workflow
from wattloom.registry.core import Tables, nudged, query, rounded
from wattloom.registry.longtables import FACTS_SQL, PROJECTION_SQL, facts, projection

CAL, UNCAL = "county_hourly_cal_kwh", "county_hourly_uncal_kwh"


@query(
    "annual_by_enduse",
    f"""
WITH {FACTS_SQL}
SELECT "in.county", turnover, "in.state", year, sector, end_use, fuel,
  ROUND(SUM(county_hourly_cal_kwh), 2) AS county_ann_kwh
FROM facts WHERE county_hourly_cal_kwh >= 0 GROUP BY ALL
""",
)
def annual_by_enduse(t: Tables):
    """County totals by sector, end use and fuel."""
    out = workflow.extracts(facts(t), 1996, 2000)["county_ann_eu"]
    return rounded(out, {"county_ann_kwh": 2})


@query(
    "monthly_peak",
    f"""
WITH {FACTS_SQL},
hours AS (
  SELECT "in.county", turnover, "in.state", year, timestamp_hour,
    CAST(MONTH(timestamp_hour) AS INTEGER) AS month,
    SUM(county_hourly_cal_kwh) AS county_total_hourly_kwh
  FROM facts WHERE fuel = 'Electric' GROUP BY ALL)
SELECT h."in.county", h.turnover, h."in.state", h.year, h.timestamp_hour, h.month,
  ROUND(county_total_hourly_kwh, 2) AS county_total_hourly_kwh, 1 AS rank_num
FROM hours h JOIN (
  SELECT "in.county", turnover, "in.state", year, month, MAX(county_total_hourly_kwh) AS top
  FROM hours GROUP BY ALL) m
  ON h."in.county" = m."in.county" AND h.turnover = m.turnover AND h."in.state" = m."in.state"
    AND h.year = m.year AND h.month = m.month AND county_total_hourly_kwh = top
""",
)
def monthly_peak(t: Tables):
    """Largest hour of each county and month; ties stay."""
    out = workflow.extracts(facts(t), 1996, 2000)["county_monthly_maxes"]
    return rounded(out, {"county_total_hourly_kwh": 2})


@query(
    "peak_change",
    f"""
WITH {FACTS_SQL},
hours AS (
  SELECT "in.county", turnover, year, timestamp_hour, SUM(county_hourly_cal_kwh) AS kwh
  FROM facts WHERE fuel = 'Electric' GROUP BY ALL),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY "in.county", turnover, year
    ORDER BY kwh DESC) AS n FROM hours WHERE year IN (1996, 2000)),
peaks AS (
  SELECT "in.county", turnover, MAX(CASE WHEN year = 1996 THEN kwh END) AS b,
    MAX(CASE WHEN year = 2000 THEN kwh END) AS l
  FROM ranked WHERE n = 1 GROUP BY ALL)
SELECT "in.county", turnover, ROUND(b, 2) AS base_kwh, ROUND(l, 2) AS last_kwh,
  ROUND(l / NULLIF(b, 0) - 1, 6) AS percent_change
FROM peaks
""",
)
def peak_change(t: Tables):
    """Change of the peak hour between two years."""
    out = workflow.extracts(facts(t), 1996, 2000)["county_peak_hour"]
    return rounded(out, {"base_kwh": 2, "last_kwh": 2, "percent_change": 6})


WINTER_SQL = """SUM(CASE WHEN MONTH(timestamp_hour) IN (11, 12, 1, 2) THEN 1 ELSE 0 END)
  * 1.0 / COUNT(*)"""


@query(
    "winter_share_top100",
    f"""
WITH {FACTS_SQL},
ranked AS (
  SELECT "in.county", turnover, year, timestamp_hour,
    RANK() OVER (PARTITION BY "in.county", turnover, year
      ORDER BY SUM(county_hourly_cal_kwh) DESC) AS n
  FROM facts WHERE fuel = 'Electric'
  GROUP BY "in.county", turnover, year, timestamp_hour)
SELECT "in.county", turnover, year, ROUND(CAST({WINTER_SQL} AS DOUBLE), 8) AS share_winter
FROM ranked WHERE n <= 100 GROUP BY ALL
""",
)
def winter_share_top100(t: Tables):
    """Share of the top 100 hours that fall into winter."""
    out = workflow.extracts(facts(t), 1996, 2000)["county_share_winter"]
    return rounded(out, {"share_winter": 8})


@query(
    "top100_hours",
    f"""
WITH {FACTS_SQL},
hours AS (
  SELECT "in.county", turnover, "in.state", year, timestamp_hour,
    SUM(county_hourly_cal_kwh) AS county_total_hourly_kwh
  FROM facts WHERE fuel = 'Electric' GROUP BY ALL)
SELECT h."in.county", h.turnover, h."in.state", h.year, h.timestamp_hour,
  ROUND(h.county_total_hourly_kwh, 2) AS county_total_hourly_kwh,
  CAST(1 + COUNT(b.county_total_hourly_kwh) AS INTEGER) AS rank_num
FROM hours h LEFT JOIN hours b
  ON h."in.county" = b."in.county" AND h.turnover = b.turnover AND h."in.state" = b."in.state"
    AND h.year = b.year AND b.county_total_hourly_kwh > h.county_total_hourly_kwh
GROUP BY h."in.county", h.turnover, h."in.state", h.year, h.timestamp_hour, h.county_total_hourly_kwh
HAVING COUNT(b.county_total_hourly_kwh) < 100
""",
)
def top100_hours(t: Tables):
    """The 100 largest hours of each county and year."""
    keys = ["in.county", "turnover", "in.state", "year"]
    electric = facts(t).filter(col("fuel") == "Electric")
    hours = peaks.hourly_totals(electric, keys, CAL, "county_total_hourly_kwh")
    out = peaks.top_hours(hours, keys, "county_total_hourly_kwh", 100)
    return rounded(out, {"county_total_hourly_kwh": 2})


@query(
    "state_monthly",
    f"""
WITH {FACTS_SQL}
SELECT CAST(MONTH(timestamp_hour) AS INTEGER) AS month, turnover, sector, fuel, "in.state", year,
  ROUND(SUM(county_hourly_uncal_kwh), 2) AS state_monthly_uncal_kwh,
  ROUND(SUM(county_hourly_cal_kwh), 2) AS state_monthly_cal_kwh
FROM facts GROUP BY ALL
""",
)
def state_monthly(t: Tables):
    """State totals by month, calibrated and not."""
    out = workflow.extracts(facts(t), 1996, 2000)["state_monthly"]
    return rounded(out, {"state_monthly_uncal_kwh": 2, "state_monthly_cal_kwh": 2})


@query(
    "state_monthly_for_calibration",
    f"""
WITH {FACTS_SQL}
SELECT CAST(MONTH(timestamp_hour) AS INTEGER) AS month, turnover, sector, fuel, "in.state", year,
  ROUND(SUM(county_hourly_uncal_kwh), 2) AS state_monthly_uncal_kwh
FROM facts WHERE turnover = 'baseline' AND year < 2000 GROUP BY ALL
""",
)
def state_monthly_for_calibration(t: Tables):
    """Uncalibrated baseline months of the measured years."""
    base = facts(t).filter((col("turnover") == "baseline") & (col("year") < 2000))
    out = peaks.monthly_totals(
        base,
        ["turnover", "sector", "fuel", "in.state", "year"],
        {UNCAL: "state_monthly_uncal_kwh"},
    )
    return rounded(out, {"state_monthly_uncal_kwh": 2})


@query(
    "annual_calibration_factors",
    f"""
WITH {FACTS_SQL}
SELECT turnover, sector, "in.state", year, fuel,
  ROUND(SUM(county_hourly_cal_kwh), 2) AS annual_calibrated_kwh,
  ROUND(SUM(county_hourly_uncal_kwh), 2) AS annual_uncalibrated_kwh
FROM facts GROUP BY ALL
""",
)
def annual_calibration_factors(t: Tables):
    """Calibrated and uncalibrated totals by year."""
    out = peaks.totals(
        facts(t),
        ["turnover", "sector", "in.state", "year", "fuel"],
        {CAL: "annual_calibrated_kwh", UNCAL: "annual_uncalibrated_kwh"},
    )
    return rounded(out, {"annual_calibrated_kwh": 2, "annual_uncalibrated_kwh": 2})


@query(
    "measure_with_ratio",
    f"""
WITH {PROJECTION_SQL},
ratios AS (
  SELECT "in.state", year, turnover, sector, end_use,
    SUM(county_hourly_cal_kwh) / SUM(county_hourly_uncal_kwh) AS r
  FROM facts WHERE turnover != 'baseline' AND end_use != 'Other' GROUP BY ALL),
planned AS (
  SELECT meas, "in.state", year, end_use, fuel, turnover, sector, SUM(state_ann_kwh) AS s
  FROM projection WHERE turnover != 'baseline' GROUP BY ALL)
SELECT meas, "in.state", year, end_use, fuel, turnover, sector,
  ROUND(s, 2) AS state_ann_kwh_uncal, ROUND(s * r * (1 + 1e-12), 4) AS state_ann_kwh_cal
FROM planned LEFT JOIN ratios USING ("in.state", year, end_use, turnover, sector)
""",
)
def measure_with_ratio(t: Tables):
    """Measure kWh scaled with the ratio implied by the hourly results."""
    live = col("turnover") != "baseline"
    out = calibrate.scaled_by_group_ratio(
        projection(t).filter(live),
        facts(t).filter(live & (col("end_use") != "Other")),
        ["meas", "in.state", "year", "end_use", "fuel", "turnover", "sector"],
        ["in.state", "year", "end_use", "turnover", "sector"],
    )
    out = nudged(out, "state_ann_kwh_cal")
    return rounded(out, {"state_ann_kwh_uncal": 2, "state_ann_kwh_cal": 4})


FIXED = (("NATION_3", "Hot"), ("NATION_7", "Cold"), ("NATION_11", "High electric heat"))

EXAMPLES_SQL = f"""{FACTS_SQL},
sampled AS (
  SELECT state AS "in.county" FROM places GROUP BY state HAVING COUNT(county) >= 50),
annual AS (
  SELECT "in.county",
    SUM(CASE WHEN year = 1996 THEN county_hourly_cal_kwh END) AS b,
    SUM(CASE WHEN year = 2000 THEN county_hourly_cal_kwh END) AS l
  FROM facts JOIN sampled USING ("in.county")
  WHERE turnover = 'state' AND fuel = 'Electric' GROUP BY ALL),
changes AS (
  SELECT "in.county", (l - b) / NULLIF(b, 0) AS d FROM annual),
examples AS (
  SELECT * FROM (SELECT "in.county", 'Large decrease' AS example_type FROM changes
    WHERE d IS NOT NULL ORDER BY d, "in.county" LIMIT 2)
  UNION ALL
  SELECT * FROM (SELECT "in.county", 'Large increase' FROM changes
    WHERE d IS NOT NULL ORDER BY d DESC, "in.county" LIMIT 2)
  UNION ALL
  SELECT * FROM (VALUES {", ".join(f"('{p}', '{e}')" for p, e in FIXED)}) AS f(p, e))"""


def examples(t: Tables):
    sampled = peaks.sampled_places(
        t.places().withColumnRenamed("state", "in.county"), "in.county"
    )
    live = facts(t).filter((col("turnover") == "state") & (col("fuel") == "Electric"))
    changes = peaks.change_between(
        mapping.keep_known(live, sampled, ["in.county"]), ["in.county"], CAL, 1996, 2000
    )
    fixed = t.literal(list(FIXED), "`in.county` string, example_type string")
    return peaks.example_places(changes, "in.county", fixed)


@query("example_places", f"WITH {EXAMPLES_SQL}\nSELECT * FROM examples")
def example_places(t: Tables):
    """Two largest falls, two largest rises and a fixed list, in one plan."""
    return examples(t)


@query(
    "day_profiles",
    f"""
WITH {EXAMPLES_SQL},
hours AS (
  SELECT "in.county", example_type, year, turnover, timestamp_hour,
    CAST(MONTH(timestamp_hour) AS INTEGER) AS month,
    date_trunc('day', timestamp_hour) AS day,
    CAST(HOUR(timestamp_hour) + 1 AS INTEGER) AS hour_of_day,
    SUM(county_hourly_cal_kwh) AS kwh
  FROM facts JOIN examples USING ("in.county")
  WHERE year IN (1996, 2000) AND fuel = 'Electric' GROUP BY ALL),
days AS (
  SELECT DISTINCT "in.county", example_type, year, turnover, month,
    FIRST_VALUE(day) OVER (PARTITION BY "in.county", example_type, year, turnover, month
      ORDER BY kwh DESC, timestamp_hour) AS peak,
    FIRST_VALUE(day) OVER (PARTITION BY "in.county", example_type, year, turnover, month
      ORDER BY kwh ASC, timestamp_hour) AS low
  FROM hours),
picked AS (
  SELECT "in.county", example_type, year, month, turnover AS peak_source,
    'monthly_peak_day' AS day_type, peak AS day FROM days
  UNION ALL
  SELECT "in.county", example_type, year, month, turnover, 'monthly_min_peak_day', low
  FROM days)
SELECT "in.county", example_type, year, turnover, CAST(NULL AS VARCHAR) AS peak_source,
  'monthly_mean' AS day_type, month, hour_of_day, ROUND(AVG(kwh), 6) AS county_hourly_kwh,
  CAST(NULL AS TIMESTAMP) AS date
FROM hours GROUP BY ALL
UNION ALL
SELECT h."in.county", h.example_type, h.year, h.turnover, p.peak_source, p.day_type,
  h.month, h.hour_of_day, ROUND(h.kwh, 6), h.day
FROM hours h JOIN picked p USING ("in.county", example_type, year, month, day)
""",
)
def day_profiles(t: Tables):
    """Profiles of the monthly peak day, the minimum day and the mean day."""
    keys = ["in.county", "example_type", "year"]
    hours = (
        facts(t)
        .filter(col("year").isin(1996, 2000) & (col("fuel") == "Electric"))
        .join(examples(t), ["in.county"])
    )
    summed = peaks.hourly_totals(hours, [*keys, "turnover"], CAL, "county_hourly_kwh")
    out = peaks.day_profiles(summed, keys, "turnover", "county_hourly_kwh")
    return rounded(out, {"county_hourly_kwh": 6})


SEASON_SQL = """CASE WHEN MONTH({0}) BETWEEN 5 AND 9 THEN 'Summer'
      WHEN MONTH({0}) IN (11, 12, 1, 2) THEN 'Winter' ELSE 'Shoulder' END"""


@query(
    "season_ratio",
    f"""
WITH {FACTS_SQL},
hours AS (
  SELECT "in.county", turnover, year, timestamp_hour, SUM(county_hourly_cal_kwh) AS kwh
  FROM facts GROUP BY ALL),
seasons AS (
  SELECT "in.county", turnover, year,
    MAX(CASE WHEN s = 'Summer' THEN kwh END) AS summer,
    MAX(CASE WHEN s = 'Winter' THEN kwh END) AS winter,
    MAX(CASE WHEN s = 'Shoulder' THEN kwh END) AS shoulder
  FROM (SELECT *, {SEASON_SQL.format("timestamp_hour")} AS s FROM hours) GROUP BY ALL)
SELECT "in.county", turnover, year, ROUND(summer, 2) AS summer, ROUND(winter, 2) AS winter,
  ROUND(shoulder, 2) AS shoulder,
  ROUND(winter / NULLIF(summer, 0), 6) AS winter_to_summer,
  ROUND(log10(CASE WHEN winter / NULLIF(summer, 0) > 0 THEN winter / summer END), 6)
    AS log_winter_to_summer
FROM seasons
""",
)
def season_ratio(t: Tables):
    """Winter peak over summer peak, and its log10."""
    hours = peaks.hourly_totals(facts(t), ["in.county", "turnover", "year"], CAL, "kwh")
    out = peaks.season_ratio(
        hours, ["in.county", "turnover", "year"], F.month("timestamp_hour"), "kwh"
    )
    digits = {"summer": 2, "winter": 2, "shoulder": 2}
    return rounded(out, {**digits, "winter_to_summer": 6, "log_winter_to_summer": 6})


def _ratio_sql(value: str, name: str) -> str:
    return f"""
  SELECT "in.state", year, sector, fuel,
    MAX(CASE WHEN s = 'Winter' THEN kwh END) / NULLIF(MAX(CASE WHEN s = 'Summer' THEN kwh END), 0)
      AS {name}
  FROM (SELECT "in.state", year, sector, fuel, {SEASON_SQL.format("timestamp_hour")} AS s,
      MONTH(timestamp_hour) AS m, SUM({value}) AS kwh FROM facts GROUP BY ALL)
  GROUP BY ALL"""


@query(
    "ratio_quadrant",
    f"""
WITH {FACTS_SQL},
measured AS ({_ratio_sql("county_hourly_uncal_kwh", "a")}),
modelled AS ({_ratio_sql("county_hourly_cal_kwh", "b")})
SELECT "in.state", year, sector, fuel, ROUND(a, 6) AS measured_ratio, ROUND(b, 6) AS modelled_ratio,
  CASE WHEN a > 1 AND b > 1 THEN 'Both winter' WHEN a > 1 AND b < 1 THEN 'Measured winter'
    WHEN a < 1 AND b > 1 THEN 'Modelled winter' WHEN a < 1 AND b < 1 THEN 'Both summer'
    ELSE 'other' END AS peak_diff
FROM measured JOIN modelled USING ("in.state", year, sector, fuel)
""",
)
def ratio_quadrant(t: Tables):
    """Do measured and modelled months peak in the same season?"""
    keys = ["in.state", "year", "sector", "fuel"]
    monthly = peaks.monthly_totals(facts(t), keys, {UNCAL: "u", CAL: "c"})
    first = peaks.season_ratio(monthly, keys, col("month"), "u")
    second = peaks.season_ratio(monthly, keys, col("month"), "c")
    names = [col(k) for k in keys]
    out = peaks.ratio_quadrant(
        first.select(*names, col("winter_to_summer").alias("measured_ratio")),
        second.select(*names, col("winter_to_summer").alias("modelled_ratio")),
        keys,
        "measured_ratio",
        "modelled_ratio",
    )
    return rounded(out, {"measured_ratio": 6, "modelled_ratio": 6})


def _change_sql(keys: str) -> str:
    return f"""
WITH {FACTS_SQL},
annual AS (
  SELECT {keys}, SUM(CASE WHEN year = 1996 THEN county_hourly_cal_kwh END) AS b,
    SUM(CASE WHEN year = 2000 THEN county_hourly_cal_kwh END) AS l
  FROM facts WHERE year IN (1996, 2000) GROUP BY ALL),
changed AS (SELECT *, (l - b) / NULLIF(b, 0) AS d FROM annual)
SELECT {keys}, ROUND(b, 2) AS base_kwh, ROUND(l, 2) AS last_kwh,
  ROUND(d, 6) AS percent_difference,
  ROUND(CASE WHEN d > 3 THEN 3 ELSE ROUND(d / 0.1) * 0.1 END, 4) AS percent_binned
FROM changed
"""


def _change(t: Tables, keys: list[str]):
    out = peaks.change_between(facts(t), keys, CAL, 1996, 2000)
    out = out.withColumn("percent_binned", peaks.binned(col("percent_difference")))
    digits = {"base_kwh": 2, "last_kwh": 2, "percent_difference": 6, "percent_binned": 4}
    return rounded(out, digits)


@query("percent_change_binned", _change_sql('turnover, "in.state", "in.county"'))
def percent_change_binned(t: Tables):
    """Change of county totals between two years, binned and capped."""
    return _change(t, ["turnover", "in.state", "in.county"])


@query("percent_change_by_sector", _change_sql('turnover, "in.state", "in.county", sector'))
def percent_change_by_sector(t: Tables):
    return _change(t, ["turnover", "in.state", "in.county", "sector"])


@query("percent_change_by_enduse", _change_sql('turnover, "in.state", "in.county", end_use'))
def percent_change_by_enduse(t: Tables):
    return _change(t, ["turnover", "in.state", "in.county", "end_use"])


DESCRIPTIONS = (
    ("AUTOMOBILE", "Fossil", "Heat pump"),
    ("BUILDING", "Fossil", "Fossil"),
    ("FURNITURE", "Resistance", "Heat pump"),
    ("MACHINERY", "Resistance", "Resistance"),
)


@query(
    "tech_enrich_totals",
    f"""
WITH {FACTS_SQL},
names(meas, original, changed) AS (VALUES {", ".join(str(d) for d in DESCRIPTIONS)}),
long AS (
  SELECT meas, 'original_ann' AS tech_stage, original AS description FROM names
  UNION ALL
  SELECT meas, 'measure_ann', changed FROM names),
staged AS (
  SELECT *, CASE WHEN l_linenumber <= 3 THEN 'original_ann' ELSE 'measure_ann' END AS tech_stage
  FROM facts WHERE fuel = 'Electric'),
totals AS (
  SELECT year, sector, end_use, turnover, description,
    SUM(county_hourly_cal_kwh) / 1e6 AS twh
  FROM staged LEFT JOIN long USING (meas, tech_stage) GROUP BY ALL),
big AS (
  SELECT description FROM totals GROUP BY description HAVING SUM(twh) > 1)
SELECT year, sector, end_use, turnover, description, ROUND(twh, 8) AS twh
FROM totals WHERE description IN (SELECT description FROM big)
""",
)
def tech_enrich_totals(t: Tables):
    """National sums by technology description; descriptions below 1 are left out."""
    names = t.literal(
        list(DESCRIPTIONS), "meas string, original string, changed string"
    )
    stage = F.when(col("l_linenumber") <= 3, "original_ann").otherwise("measure_ann")
    staged = facts(t).filter(col("fuel") == "Electric").withColumn("tech_stage", stage)
    described = mapping.enrich_stage(
        staged,
        names,
        ["meas"],
        {"original": "original_ann", "changed": "measure_ann"},
        how="left",
    )
    sums = peaks.totals(
        described,
        ["year", "sector", "end_use", "turnover", "description"],
        {CAL: "kwh"},
    ).withColumn("twh", col("kwh") / 1e6).drop("kwh")
    return rounded(peaks.large_groups(sums, ["description"], "twh"), {"twh": 8})


@query(
    "scenario_max_day",
    f"""
WITH {FACTS_SQL},
hours AS (
  SELECT "in.county", year, turnover, date_trunc('day', timestamp_hour) AS day,
    timestamp_hour, SUM(county_hourly_cal_kwh) AS kwh
  FROM facts GROUP BY ALL),
best AS (
  SELECT "in.county", year, MAX(kwh) AS m FROM hours WHERE turnover != 'baseline' GROUP BY ALL),
days AS (
  SELECT DISTINCT "in.county", year, day FROM hours JOIN best USING ("in.county", year)
  WHERE turnover != 'baseline' AND kwh = m)
SELECT "in.county", year, turnover, day, timestamp_hour, ROUND(kwh, 2) AS kwh
FROM hours JOIN days USING ("in.county", year, day)
""",
)
def scenario_max_day(t: Tables):
    """All scenarios' hours on the day a county reaches its scenario maximum."""
    hours = peaks.hourly_totals(
        facts(t), ["in.county", "year", "turnover"], CAL, "kwh"
    ).withColumn("day", F.date_trunc("day", "timestamp_hour"))
    out = peaks.rows_of_maximum_day(
        hours, ["in.county", "year"], "day", "kwh", col("turnover") != "baseline"
    )
    return rounded(out, {"kwh": 2})
