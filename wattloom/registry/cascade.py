"""The disaggregation cascade: state totals -> counties -> hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.calendar import align_hour
from wattloom.functions.text import col
from wattloom.operators import disagg, mapping, reconcile, shapes, shares, vectors
from wattloom.operators.shares import Target
from wattloom.plans import workflow
from wattloom.registry.core import LINES_SQL, Tables, query, rounded

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
FLAGS = ("A", "N", "R")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SHAPES = ("click", "error", "purchase", "signup", "view")


def _rows(shift: int = 0) -> list[tuple[str, ...]]:
    """A measure map by rule: measure and end use pick groups and shapes."""
    out = []
    for i, meas in enumerate(SEGMENTS):
        for j, use in enumerate(FLAGS):
            out.append(
                (
                    meas,
                    use,
                    PRIORITIES[(i + j) % 5],
                    PRIORITIES[(i + 2 * j + 1) % 5],
                    SHAPES[(i + j + shift) % 5],
                    SHAPES[(2 * i + j + shift) % 5],
                    "com" if i % 2 else "res",
                )
            )
    return out


MAP_COLUMNS = "meas, end_use, original_ann, measure_ann, original_ts, measure_ts, sector"
MAP_SCHEMA = ", ".join(f"{n.strip()} string" for n in MAP_COLUMNS.split(","))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)


def measure_map(t: Tables, shift: int = 0) -> DataFrame:
    return t.literal(_rows(shift), MAP_SCHEMA)


def projection(t: Tables) -> DataFrame:
    """State totals by measure, end use, fuel, stage and projection year."""
    stage = F.when(col("l_linenumber") <= 3, "original_ann").otherwise("measure_ann")
    fuel = F.when(col("l_linestatus") == "F", "Electric").otherwise("Natural Gas")
    year = F.when(F.year("l_shipdate") < 1998, 2026).otherwise(2050)
    return (
        t.lines()
        .groupBy(
            col("c_mktsegment").alias("meas"),
            col("state").alias("reg"),
            col("l_returnflag").alias("end_use"),
            fuel.alias("fuel"),
            year.alias("year"),
            stage.alias("tech_stage"),
        )
        .agg(F.sum("l_extendedprice").alias("state_ann_kwh"))
        .withColumns({"turnover": F.lit("ref"), "run_id": F.lit("r1")})
    )


def annual_table(t: Tables) -> DataFrame:
    """Geographic multipliers: customers' order value in their nation."""
    rows = tuple(
        Target("v", use, fuel) for use in FLAGS for fuel in ("Electric", "Natural Gas")
    )
    return shares.share_of_group(
        t.orders().select(
            "county", col("state").alias("in.state"), "o_orderpriority", "o_totalprice"
        ).withColumnRenamed("o_orderpriority", "group_ann"),
        ["county", "in.state"],
        ["in.state", "group_ann"],
        {"v": col("o_totalprice")},
        rows,
        share_name="multiplier_annual",
        drop_null=["county", "in.state", "group_ann"],
    )


def hourly_table(t: Tables) -> DataFrame:
    """Hourly multipliers by customer and event type."""
    rows = tuple(
        Target("v", use, fuel) for use in FLAGS for fuel in ("Electric", "Natural Gas")
    )
    out = shapes.hourly_shape(
        t("events").select(
            col("user_id").alias("county"), col("event_type").alias("shape_ts"), "ts", "value"
        ),
        ["county"],
        ["shape_ts"],
        align_hour(col("ts"), None),
        {"v": col("value")},
        rows,
        drop_null=["county", "shape_ts"],
    )
    return out.withColumn("sector", F.lit("com"))


def year_of_hours(t: Tables) -> vectors.Calendar:
    """The hours that the readings cover."""
    return vectors.calendar_of(t("events").select(align_hour(col("ts"), None).alias(shapes.HOUR)))


def vector_table(t: Tables, calendar: vectors.Calendar) -> DataFrame:
    """Hourly multipliers by customer and event type, a year in a row."""
    sums = shares.sum_by(
        t("events").select(
            col("user_id").alias("county"), col("event_type").alias("shape_ts"),
            align_hour(col("ts"), None).alias(shapes.HOUR), "value",
        ).dropna(subset=["county", "shape_ts"]),
        ["county", "shape_ts", shapes.HOUR],
        {"v": col("value")},
    )
    rows = [Target("v", use, fuel) for use in FLAGS for fuel in ("Electric", "Natural Gas")]
    return vectors.share_vectors(sums, calendar, ["county", "shape_ts"], {"v": rows}, "com", sparse=True)


def county_annual(t: Tables) -> DataFrame:
    return disagg.disaggregate_annual(
        projection(t), disagg.stage_groups(measure_map(t)), annual_table(t)
    )


def county_hourly(t: Tables, **options) -> DataFrame:
    shift, hours = options.pop("shift", 0), options.pop("hours", None)
    return disagg.disaggregate_hourly(
        county_annual(t),
        disagg.stage_shapes(measure_map(t, shift)),
        hourly_table(t) if hours is None else hours,
        ["county"],
        carry=("county", "in.state", "year", "turnover", "run_id"),
        **options,
    )


PROJECTION_SQL = f"""{LINES_SQL},
projection AS (
  SELECT c_mktsegment AS meas, state AS reg, l_returnflag AS end_use,
    CASE WHEN l_linestatus = 'F' THEN 'Electric' ELSE 'Natural Gas' END AS fuel,
    CASE WHEN YEAR(l_shipdate) < 1998 THEN 2026 ELSE 2050 END AS year,
    CASE WHEN l_linenumber <= 3 THEN 'original_ann' ELSE 'measure_ann' END AS tech_stage,
    SUM(l_extendedprice) AS state_ann_kwh, 'ref' AS turnover, 'r1' AS run_id
  FROM lines GROUP BY ALL),
measure_map({MAP_COLUMNS}) AS (VALUES {_values(_rows())})"""

ANNUAL_SQL = f"""{PROJECTION_SQL},
stage_groups AS (
  SELECT meas, end_use, 'original_ann' AS tech_stage, original_ann AS group_ann, sector
  FROM measure_map
  UNION ALL
  SELECT meas, end_use, 'measure_ann', measure_ann, sector FROM measure_map),
place_sums AS (
  SELECT county, state, o_orderpriority AS group_ann, SUM(o_totalprice) AS v
  FROM placed_orders GROUP BY ALL),
place_shares AS (
  SELECT county, state, group_ann,
    v / NULLIF(SUM(v) OVER (PARTITION BY state, group_ann), 0) AS multiplier_annual
  FROM place_sums),
county_annual AS (
  SELECT p.*, g.sector, s.county, s.multiplier_annual,
    p.state_ann_kwh * s.multiplier_annual AS county_ann_kwh
  FROM projection p JOIN stage_groups g USING (meas, end_use, tech_stage)
    JOIN place_shares s ON g.group_ann = s.group_ann AND p.reg = s.state)"""


def _hourly_sql(map_table: str = "measure_map", suffix: str = "", first: bool = True) -> str:
    """CTEs from county_annual to hourly rows before the last sum."""
    hours = """
hour_sums AS (
  SELECT user_id AS county, event_type AS shape_ts,
    date_trunc('hour', ts) + INTERVAL 1 HOUR AS timestamp_hour, SUM(value) AS v
  FROM events GROUP BY ALL),
hour_shares AS (
  SELECT *, v / NULLIF(SUM(v) OVER (PARTITION BY county, shape_ts), 0) AS m
  FROM hour_sums),""" if first else ""
    return f"""{hours}
stage_shapes{suffix} AS (
  SELECT meas, end_use, 'original_ann' AS tech_stage, original_ts AS shape_ts FROM {map_table}
  UNION ALL
  SELECT meas, end_use, 'measure_ann', measure_ts FROM {map_table}),
presummed{suffix} AS (
  SELECT county, reg, year, turnover, run_id, end_use, fuel, shape_ts,
    SUM(county_ann_kwh) AS kwh
  FROM county_annual JOIN stage_shapes{suffix} USING (meas, end_use, tech_stage)
  GROUP BY ALL),
exploded{suffix} AS (
  SELECT a.county, a.reg, a.year, a.turnover, a.run_id, a.end_use, a.fuel, a.shape_ts,
    h.timestamp_hour, CASE WHEN h.county IS NOT NULL THEN 'com' END AS sector,
    a.kwh * h.m AS kwh
  FROM presummed{suffix} a LEFT JOIN hour_shares h
    ON a.county = h.county AND a.shape_ts = h.shape_ts)"""


HOURLY_SQL = ANNUAL_SQL + "," + _hourly_sql()


@query(
    "disaggregate_annual",
    f"""
WITH {ANNUAL_SQL}
SELECT county, reg AS "in.state", meas, end_use, fuel, year, tech_stage, turnover, run_id,
  sector, ROUND(state_ann_kwh, 2) AS state_ann_kwh,
  ROUND(multiplier_annual, 9) AS multiplier_annual, ROUND(county_ann_kwh, 4) AS county_ann_kwh
FROM county_annual
""",
)
def disaggregate_annual(t: Tables):
    """State kWh x geographic multiplier through the measure map."""
    return rounded(
        county_annual(t), {"state_ann_kwh": 2, "multiplier_annual": 9, "county_ann_kwh": 4}
    )


RESULT_SQL = """county, reg AS "in.state", year, turnover, run_id, end_use, fuel,
  timestamp_hour, sector"""


@query(
    "disaggregate_hourly",
    f"""
WITH {HOURLY_SQL}
SELECT {RESULT_SQL}, ROUND(SUM(kwh), 4) AS county_hourly_uncal_kwh
FROM exploded GROUP BY county, reg, year, turnover, run_id, end_use, fuel, timestamp_hour, sector
""",
)
def disaggregate_hourly(t: Tables):
    """County kWh x hourly multiplier; counties without a shape keep a NULL hour."""
    return rounded(county_hourly(t), {"county_hourly_uncal_kwh": 4})


@query(
    "disaggregate_hourly_blocks",
    f"""
WITH {HOURLY_SQL}
SELECT {RESULT_SQL}, ROUND(SUM(kwh), 4) AS county_hourly_uncal_kwh
FROM exploded GROUP BY county, reg, year, turnover, run_id, end_use, fuel, timestamp_hour, sector
""",
)
def disaggregate_hourly_blocks(t: Tables):
    """The same with every place's year split over several tasks."""
    return rounded(county_hourly(t, hour_blocks=4), {"county_hourly_uncal_kwh": 4})


@query(
    "hourly_vectors",
    f"""
WITH {HOURLY_SQL}
SELECT {RESULT_SQL}, ROUND(SUM(kwh), 4) AS county_hourly_uncal_kwh
FROM exploded GROUP BY county, reg, year, turnover, run_id, end_use, fuel, timestamp_hour, sector
""",
)
def hourly_vectors(t: Tables):
    """Counties to hours with a year as one vector: no join on hours, hours as rows at the end."""
    calendar = year_of_hours(t)
    out = vectors.disaggregate_vectors(
        county_annual(t),
        disagg.stage_shapes(measure_map(t)),
        vector_table(t, calendar),
        calendar,
        ["county"],
        carry=("county", "in.state", "year", "turnover", "run_id"),
    )
    return rounded(vectors.hour_rows(out, calendar), {"county_hourly_uncal_kwh": 4})


def _some_hours_unknown(hourly: DataFrame) -> DataFrame:
    unknown = F.hour("timestamp_hour") == 5
    return hourly.withColumn("timestamp_hour", F.when(~unknown, col("timestamp_hour")))


@query(
    "hourly_vectors_null_hours",
    f"""
WITH {HOURLY_SQL},
dated AS (
  SELECT * REPLACE (CASE WHEN HOUR(timestamp_hour) = 5 THEN NULL ELSE timestamp_hour END AS timestamp_hour)
  FROM exploded)
SELECT {RESULT_SQL}, ROUND(SUM(kwh), 4) AS county_hourly_uncal_kwh
FROM dated GROUP BY county, reg, year, turnover, run_id, end_use, fuel, timestamp_hour, sector
""",
)
def hourly_vectors_null_hours(t: Tables):
    """Vectors from a multiplier table of which some hours are not known; their energy stays."""
    calendar = year_of_hours(t)
    used = disagg.stage_shapes(measure_map(t))
    years = vectors.hourly_vectors(
        _some_hours_unknown(hourly_table(t)), calendar, ["county", "shape_ts", "end_use", "fuel"], used=used, sparse=True
    )
    out = vectors.disaggregate_vectors(
        county_annual(t), used, years, calendar, ["county"],
        carry=("county", "in.state", "year", "turnover", "run_id"),
    )
    return rounded(vectors.hour_rows(out, calendar), {"county_hourly_uncal_kwh": 4})


@query(
    "hourly_blocks_null_hours",
    f"""
WITH {HOURLY_SQL},
dated AS (
  SELECT * REPLACE (CASE WHEN HOUR(timestamp_hour) = 5 THEN NULL ELSE timestamp_hour END AS timestamp_hour)
  FROM exploded)
SELECT {RESULT_SQL}, ROUND(SUM(kwh), 4) AS county_hourly_uncal_kwh
FROM dated GROUP BY county, reg, year, turnover, run_id, end_use, fuel, timestamp_hour, sector
""",
)
def hourly_blocks_null_hours(t: Tables):
    """Multipliers without an hour keep their energy, however a year is split over tasks."""
    out = county_hourly(t, hours=_some_hours_unknown(hourly_table(t)), hour_blocks=4)
    return rounded(out, {"county_hourly_uncal_kwh": 4})


CITY, LONGITUDE = "in.weather_file_city", "in.weather_file_longitude"


def _weather(number) -> dict:
    """A weather place serves many counties and crosses states."""
    city = F.concat(F.lit("W"), (number % 7).cast("string"))
    return {CITY: city, LONGITUDE: (number % 3).cast("string")}


def weather_hours(t: Tables) -> DataFrame:
    """Hourly multipliers by weather place and event type."""
    rows = tuple(Target("v", use, fuel) for use in FLAGS for fuel in ("Electric", "Natural Gas"))
    series = t("events").select("user_id", col("event_type").alias("shape_ts"), "ts", "value")
    out = shapes.hourly_shape(
        series.withColumns(_weather(col("user_id"))),
        [CITY, LONGITUDE],
        ["shape_ts"],
        align_hour(col("ts"), None),
        {"v": col("value")},
        rows,
        drop_null=[CITY, LONGITUDE, "shape_ts"],
    )
    return out.withColumn("sector", F.lit("res"))


RES_HOURLY_SQL = f"""{ANNUAL_SQL},
hour_sums AS (
  SELECT 'W' || (user_id % 7) AS city, CAST(user_id % 3 AS VARCHAR) AS lon,
    event_type AS shape_ts, date_trunc('hour', ts) + INTERVAL 1 HOUR AS timestamp_hour, SUM(value) AS v
  FROM events GROUP BY ALL),
totals AS (SELECT city, lon, shape_ts, SUM(v) AS total FROM hour_sums GROUP BY ALL),
named AS (
  SELECT meas, end_use, s.tech_stage, CASE s.tech_stage WHEN 'original_ann' THEN original_ts ELSE measure_ts END AS shape_ts
  FROM measure_map, (VALUES ('original_ann'), ('measure_ann')) s(tech_stage)),
energy AS (
  SELECT a.county, a.reg, a.year, a.turnover, a.run_id, a.end_use, a.fuel, n.shape_ts,
    SUM(a.county_ann_kwh) AS kwh
  FROM county_annual a JOIN named n USING (meas, end_use, tech_stage) GROUP BY ALL)"""


@query(
    "res_county_hourly",
    f"""
WITH {RES_HOURLY_SQL}
SELECT e.county AS "in.county", e.reg AS "in.state", e.year, e.turnover, e.run_id, e.end_use, e.fuel,
  CAST(MONTH(h.timestamp_hour) AS INTEGER) AS month, CASE WHEN h.city IS NOT NULL THEN 'res' END AS sector,
  COUNT(DISTINCT COALESCE(h.timestamp_hour, TIMESTAMP '1900-01-01')) AS n_hours,
  ROUND(SUM(e.kwh * h.v / NULLIF(t.total, 0)), 3) AS kwh,
  ROUND(SUM(e.kwh * h.v / NULLIF(t.total, 0) * (DAY(h.timestamp_hour) * 24 + HOUR(h.timestamp_hour))), 1) AS kwh_by_hour
FROM energy e
  LEFT JOIN hour_sums h ON h.city = 'W' || (e.county % 7)
    AND h.lon = CAST(e.county % 3 AS VARCHAR) AND h.shape_ts = e.shape_ts
  LEFT JOIN totals t ON t.city = h.city AND t.lon = h.lon AND t.shape_ts = h.shape_ts
GROUP BY ALL
""",
)
def res_county_hourly(t: Tables):
    """Residential counties through the hours of their weather places, years split over tasks.

    Every county's hours by month: their number, their sum, and their sum weighted by the hour.
    """
    annual = county_annual(t).withColumns(_weather(col("county"))).withColumnRenamed("county", "in.county")
    totals = disagg.HourTotals(
        by={"month": F.month("timestamp_hour")},
        count="n_hours",
        sums={"kwh": None, "kwh_by_hour": F.dayofmonth("timestamp_hour") * 24 + F.hour("timestamp_hour")},
    )
    out = workflow.county_hourly(
        annual, measure_map(t), weather_hours(t), "res", hour_blocks=4, totals=totals
    )
    return rounded(out, {"kwh": 3, "kwh_by_hour": 1})


@query(
    "hourly_multiplier_sums",
    """
WITH hour_sums AS (
  SELECT 'W' || (user_id % 7) AS city, CAST(user_id % 3 AS VARCHAR) AS lon, event_type AS shape_ts, SUM(value) AS v
  FROM events GROUP BY ALL)
SELECT city AS "in.weather_file_city", lon AS "in.weather_file_longitude", shape_ts, end_use, fuel,
  CAST(CASE WHEN v <> 0 THEN 1 END AS DOUBLE) AS mult_sum
FROM hour_sums, (VALUES ('A'), ('N'), ('R')) u(end_use), (VALUES ('Electric'), ('Natural Gas')) f(fuel)
""",
)
def hourly_multiplier_sums(t: Tables):
    """The hours of every place, shape, end use and fuel sum to 1."""
    keys = [CITY, LONGITUDE, "shape_ts", "end_use", "fuel"]
    sums = reconcile.multiplier_sums(weather_hours(t), keys, "multiplier_hourly")
    return sums.select(*[col(k) for k in keys], F.round(col("multiplier_sum"), 6).alias("mult_sum"))


@query(
    "hourly_ungrouped",
    f"""
WITH {HOURLY_SQL}
SELECT {RESULT_SQL}, shape_ts, ROUND(kwh, 4) AS county_hourly_uncal_kwh
FROM exploded WHERE timestamp_hour IS NOT NULL
""",
)
def hourly_ungrouped(t: Tables):
    """Hourly kWh per shape, before the last sum."""
    out = county_hourly(t, group=False, keep_unmatched=False)
    return rounded(out, {"county_hourly_uncal_kwh": 4})


@query(
    "hourly_by_place_variant",
    f"""
WITH {ANNUAL_SQL},
electric AS (SELECT * FROM county_annual WHERE fuel = 'Electric'),
weather AS (SELECT county, c_mktsegment AS weather FROM places),
hour_sums AS (
  SELECT weather, event_type AS shape_ts,
    date_trunc('hour', ts) + INTERVAL 1 HOUR AS timestamp_hour, SUM(value) AS v
  FROM events JOIN weather ON user_id = county GROUP BY ALL),
hour_shares AS (
  SELECT *, v / NULLIF(SUM(v) OVER (PARTITION BY weather, shape_ts), 0) AS m
  FROM hour_sums),
stage_shapes AS (
  SELECT meas, end_use, 'original_ann' AS tech_stage, original_ts AS shape_ts FROM measure_map
  UNION ALL
  SELECT meas, end_use, 'measure_ann', measure_ts FROM measure_map),
presummed AS (
  SELECT reg, weather, year, turnover, end_use, shape_ts, SUM(county_ann_kwh) AS kwh
  FROM electric JOIN weather USING (county)
    JOIN stage_shapes USING (meas, end_use, tech_stage)
  GROUP BY ALL)
SELECT p.reg AS "in.state", p.year, p.turnover, p.end_use, h.timestamp_hour,
  'res' AS sector, ROUND(SUM(p.kwh * h.m), 4) AS county_hourly_uncal_kwh
FROM presummed p JOIN hour_shares h USING (weather, shape_ts)
GROUP BY p.reg, p.year, p.turnover, p.end_use, h.timestamp_hour
""",
)
def hourly_by_place_variant(t: Tables):
    """Electric only, hours keyed by a weather place behind the county, no NULL hours."""
    weather = t.places().select(
        col("c_custkey").alias("county"), col("c_mktsegment").alias("weather")
    )
    annual = disagg.annual_variant(
        projection(t),
        disagg.stage_groups(measure_map(t)),
        annual_table(t).filter(col("fuel") == "Electric").drop("fuel"),
    ).join(weather, "county")
    hours = shapes.hourly_shape(
        t("events")
        .join(weather, col("user_id") == col("county"))
        .select("weather", col("event_type").alias("shape_ts"), "ts", "value"),
        ["weather"],
        ["shape_ts"],
        align_hour(col("ts"), None),
        {"v": col("value")},
        tuple(Target("v", use, "Electric") for use in FLAGS),
        drop_null=["weather", "shape_ts"],
    ).withColumn("sector", F.lit("res"))
    out = disagg.disaggregate_hourly(
        annual,
        disagg.stage_shapes(measure_map(t)),
        hours,
        ["weather"],
        carry=("in.state", "year", "turnover"),
        match=("end_use",),
        keep_unmatched=False,
    )
    return rounded(out, {"county_hourly_uncal_kwh": 4})


KINDS = {"always gap": 0, "com gap": 1, "neither gap": 2}
KIND_SQL = ANNUAL_SQL + "".join(
    f",\nmap_{s}({MAP_COLUMNS}) AS (VALUES {_values(_rows(s))})" for s in (1, 2)
)
for _i, (_name, _shift) in enumerate(KINDS.items()):
    KIND_SQL += "," + _hourly_sql(
        f"map_{_shift}" if _shift else "measure_map", f"_{_shift}", first=_i == 0
    )
KIND_SQL += (
    ",\nkinds AS ("
    + " UNION ALL ".join(
        f"SELECT *, '{name}' AS kind FROM exploded_{shift}" for name, shift in KINDS.items()
    )
    + ")"
)


def kinds(t: Tables, calendar: vectors.Calendar) -> DataFrame:
    """Hourly kWh under three alternative maps in one plan, a year in a row."""
    annual = county_annual(t)
    maps = mapping.tagged_variants(
        {
            name: disagg.stage_shapes(measure_map(t, shift))
            for name, shift in KINDS.items()
        }
    )
    # The kind travels like a projection key: one presum, one product a county.
    return vectors.disaggregate_vectors(
        annual,
        maps,
        vector_table(t, calendar),
        calendar,
        ["county"],
        carry=("county", "in.state", "year", "turnover", "run_id", "kind"),
        keep_unmatched=False,
    )


@query(
    "whatif_map_kinds",
    f"""
WITH {KIND_SQL}
SELECT timestamp_hour, reg AS "in.state", year, end_use, kind,
  ROUND(SUM(kwh), 4) AS state_hourly_kwh
FROM kinds WHERE timestamp_hour IS NOT NULL
GROUP BY timestamp_hour, reg, year, end_use, kind
""",
)
def whatif_map_kinds(t: Tables):
    """State hours under what-if maps, tagged by kind."""
    calendar = year_of_hours(t)
    out = vectors.group_hours(kinds(t, calendar), ["in.state", "year", "end_use", "kind"], calendar)
    return rounded(out, {"state_hourly_kwh": 4})


COMBINATIONS = {
    "gap; com other": ("always gap", "com gap"),
    "gap": ("always gap",),
    "no gap": ("neither gap", "com gap"),
}


@query(
    "whatif_combinations",
    f"""
WITH {KIND_SQL},
months AS (
  SELECT kind, reg, year, end_use, CAST(MONTH(timestamp_hour) AS INTEGER) AS month,
    SUM(kwh) AS kwh
  FROM kinds WHERE timestamp_hour IS NOT NULL GROUP BY ALL),
members(kind, combination) AS (VALUES {", ".join(
        f"('{k}', '{c}')" for c, ks in COMBINATIONS.items() for k in ks)})
SELECT reg AS "in.state", year, month, end_use, combination AS kind,
  ROUND(kwh, 4) AS state_monthly_kwh
FROM months JOIN members USING (kind)
""",
)
def whatif_combinations(t: Tables):
    """Monthly totals per combination of kinds, one row per contributing kind."""
    calendar = year_of_hours(t)
    states = vectors.group_hours(kinds(t, calendar), ["in.state", "year", "end_use", "kind"], calendar)
    out = disagg.combination_totals(
        states.withColumn("month", F.month("timestamp_hour")),
        COMBINATIONS,
        ["in.state", "year", "month", "end_use"],
        value="state_hourly_kwh",
    )
    return rounded(out, {"state_monthly_kwh": 4})
