"""Hourly multipliers from the event series."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.functions.calendar import align_hour, epoch_nanos_to_timestamp
from wattloom.functions.text import col
from wattloom.operators import mapping, shapes
from wattloom.operators.shares import Target, targets
from wattloom.registry.core import PLACES_SQL, Tables, query, rounded

DIGITS = {"kwh": 4, "multiplier_hourly": 9}


@query(
    "hourly_shape",
    """
WITH hours AS (
  SELECT user_id, event_type AS shape_ts,
    date_trunc('hour', ts) + INTERVAL 1 HOUR AS timestamp_hour, SUM(value) AS v
  FROM events GROUP BY ALL),
totalled AS (
  SELECT *, SUM(v) OVER (PARTITION BY user_id, shape_ts) AS total FROM hours)
SELECT user_id, shape_ts, timestamp_hour, 'Cooling (Equip.)' AS end_use, fuel,
  ROUND(v, 4) AS kwh, ROUND(v / total, 9) AS multiplier_hourly
FROM totalled CROSS JOIN (VALUES ('Electric'), ('Natural Gas')) AS f(fuel)
WHERE total > 0
""",
)
def hourly_shape(t: Tables):
    """Hour-ending sums and their share of the year."""
    out = shapes.hourly_shape(
        t("events").withColumnRenamed("event_type", "shape_ts"),
        ["user_id"],
        ["shape_ts"],
        align_hour(col("ts"), None),
        {"v": col("value")},
        targets("v", "Cooling (Equip.)", ["Electric", "Natural Gas"], guard=True),
    )
    return rounded(out, DIGITS)


@query(
    "hourly_shape_wrap",
    f"""
WITH {PLACES_SQL},
shifted AS (
  SELECT state, event_type AS shape_ts,
    date_trunc('hour', ts + INTERVAL 336 DAY) + INTERVAL 1 HOUR AS ending,
    value * (1 + user_id % 3) AS v
  FROM events JOIN places ON user_id = county),
hours AS (
  SELECT state, shape_ts,
    CASE WHEN YEAR(ending) = 2025 THEN ending - INTERVAL 1 YEAR ELSE ending END
      AS timestamp_hour,
    SUM(CASE WHEN shape_ts != 'error' THEN v END) AS el, SUM(v) AS fossil
  FROM shifted GROUP BY ALL),
totalled AS (
  SELECT *, SUM(el) OVER w AS el_total, SUM(fossil) OVER w AS fossil_total
  FROM hours WINDOW w AS (PARTITION BY state, shape_ts))
SELECT state, shape_ts, timestamp_hour, 'Other' AS end_use, 'Electric' AS fuel,
  ROUND(el, 4) AS kwh, ROUND(el / NULLIF(el_total, 0), 9) AS multiplier_hourly
FROM totalled
UNION ALL
SELECT state, shape_ts, timestamp_hour, 'Other', 'Propane', ROUND(fossil, 4),
  ROUND(fossil / NULLIF(fossil_total, 0), 9)
FROM totalled
""",
)
def hourly_shape_wrap(t: Tables):
    """Nanosecond stamps, weights, and the last hour of the year wrapped back."""
    nanos = F.unix_micros(col("ts").cast("timestamp")) * 1000
    series = (
        t("events")
        .join(t.places().select(col("c_custkey").alias("user_id"), "state"), "user_id")
        .select(
            "state",
            col("event_type").alias("shape_ts"),
            (nanos + F.lit(336 * 86_400_000_000_000)).alias("timestamp"),
            (col("value") * (1 + col("user_id") % 3)).alias("v"),
        )
    )
    out = shapes.hourly_shape(
        series,
        ["state"],
        ["shape_ts"],
        align_hour(epoch_nanos_to_timestamp(col("timestamp")), 2025),
        {"el": F.when(col("shape_ts") != "error", col("v")), "fossil": col("v")},
        targets("el", "Other", ["Electric"]) + targets("fossil", "Other", ["Propane"]),
    )
    return rounded(out, DIGITS)


@query(
    "hourly_normalised_pieces",
    f"""
WITH {PLACES_SQL},
pieces AS (
  SELECT state, c_mktsegment AS weather, event_type AS shape_ts,
    date_trunc('hour', ts) + INTERVAL 1 HOUR AS timestamp_hour, SUM(value) AS kwh
  FROM events JOIN places ON user_id = county GROUP BY ALL),
merged AS (
  SELECT weather, shape_ts, 'Electric' AS fuel, 'res' AS sector, 'Other' AS end_use,
    timestamp_hour, SUM(kwh) AS kwh
  FROM pieces GROUP BY ALL),
totalled AS (
  SELECT *, SUM(kwh) OVER (PARTITION BY weather, shape_ts, fuel) AS total FROM merged)
SELECT weather, shape_ts, fuel, sector, end_use, timestamp_hour,
  ROUND(kwh, 4) AS kwh, ROUND(kwh / total, 9) AS multiplier_hourly
FROM totalled WHERE total > 0
""",
)
def hourly_normalised_pieces(t: Tables):
    """Hours filled per state are merged by weather place, then normalised."""
    pieces = (
        t("events")
        .join(
            t.places().select(
                col("c_custkey").alias("user_id"), "state", col("c_mktsegment").alias("weather")
            ),
            "user_id",
        )
        .groupBy(
            "state",
            "weather",
            col("event_type").alias("shape_ts"),
            align_hour(col("ts"), None).alias("timestamp_hour"),
        )
        .agg(F.sum("value").alias("kwh"))
        .withColumns(
            {"fuel": F.lit("Electric"), "sector": F.lit("res"), "end_use": F.lit("Other")}
        )
    )
    return rounded(shapes.hour_share(pieces, ["weather"]), DIGITS)


@query(
    "shape_difference",
    f"""
WITH {PLACES_SQL},
zones AS (
  SELECT n_name AS state, n_regionkey AS zone FROM nation),
hours AS (
  SELECT zone, date_trunc('hour', ts) + INTERVAL 1 HOUR AS timestamp_hour,
    SUM(CASE WHEN event_type IN ('click', 'purchase', 'view') THEN value ELSE 0 END)
    - SUM(CASE WHEN event_type = 'error' THEN value ELSE 0 END) AS kwh
  FROM events JOIN places ON user_id = county JOIN zones USING (state)
  GROUP BY ALL),
shares AS (
  SELECT zone, timestamp_hour, kwh,
    kwh / NULLIF(SUM(kwh) OVER (PARTITION BY zone), 0) AS m
  FROM hours)
SELECT state, timestamp_hour, ROUND(kwh, 4) AS kwh, ROUND(m, 9) AS multiplier_hourly
FROM shares JOIN zones USING (zone)
""",
)
def shape_difference(t: Tables):
    """What an upgrade adds per time zone, given to every place of the zone."""
    zones = t("nation").select(
        col("n_name").alias("state"), col("n_regionkey").alias("zone")
    )
    series = (
        t("events")
        .join(t.places().select(col("c_custkey").alias("user_id"), "state"), "user_id")
        .join(zones, "state")
    )
    per_zone = shapes.shape_difference(
        series,
        ["zone"],
        align_hour(col("ts"), None),
        col("value"),
        col("event_type") == "error",
        col("event_type").isin("click", "purchase", "view"),
    )
    return rounded(shapes.spread_to_places(per_zone, zones, ["zone"]), DIGITS)


@query(
    "series_share",
    """
WITH hours AS (
  SELECT user_id, date_trunc('hour', ts) AS ts, SUM(value) AS kwh
  FROM events GROUP BY ALL),
shared AS (
  SELECT *, kwh / NULLIF(SUM(kwh) OVER (PARTITION BY user_id), 0) AS m FROM hours)
SELECT user_id,
  CASE WHEN YEAR(ts) = 2019 THEN ts - INTERVAL 1 YEAR ELSE ts END AS timestamp_hour,
  ROUND(kwh, 4) AS kwh, ROUND(m, 9) AS multiplier_hourly, 'Electric' AS fuel, end_use
FROM shared CROSS JOIN (VALUES ('Gap'), ('Other'), ('Ventilation')) AS e(end_use)
""",
)
def series_share(t: Tables):
    """A ready hourly series shared over the year and copied to end uses."""
    hours = (
        t("events")
        .groupBy("user_id", F.date_trunc("hour", "ts").alias("ts"))
        .agg(F.sum("value").alias("v"))
    )
    out = shapes.series_share(
        hours,
        ["user_id"],
        F.when(F.year("ts") == 2019, col("ts") - F.expr("INTERVAL '1' YEAR")).otherwise(col("ts")),
        "v",
        ["Gap", "Other", "Ventilation"],
        "Electric",
    )
    return rounded(out, DIGITS)


PROFILES = (
    shapes.HourlyProfile(
        "heating",
        "CASE WHEN event_type != 'error' THEN value END",
        targets("primary", "Heating (Equip.)", ["Electric"], True)
        + targets("secondary", "Heating (Equip.)", ["Natural Gas", "Biomass"], True),
        secondary="value * 2",
        map_name="segments",
        keys=("c_mktsegment",),
    ),
    shapes.HourlyProfile(
        "lighting",
        "value + 1",
        (Target("primary", "Lighting", "Electric"),),
        shape="light_1",
    ),
)
SEGMENTS = (
    ("BUILDING", "0", "heat_1"),
    ("MACHINERY", "0", "heat_1"),
    ("MACHINERY", "0", "heat_2"),
    ("FURNITURE", "1", "heat_3"),
    ("HOUSEHOLD", "1", "heat_3"),
)
SEGMENTS_SQL = ", ".join(f"('{s}', '{u}', '{h}')" for s, u, h in SEGMENTS)


@query(
    "hourly_profiles",
    f"""
WITH {PLACES_SQL},
segments(c_mktsegment, upgrade, shape_ts) AS (VALUES {SEGMENTS_SQL}),
buildings AS (
  SELECT county AS user_id, state, c_mktsegment, CAST(county % 2 AS VARCHAR) AS upgrade
  FROM places),
hours AS (
  SELECT user_id, event_type, value,
    date_trunc('hour', ts) + INTERVAL 1 HOUR AS timestamp_hour,
    CAST(user_id % 2 AS VARCHAR) AS upgrade
  FROM events),
heat AS (
  SELECT state, s.shape_ts, timestamp_hour,
    SUM(CASE WHEN event_type != 'error' THEN value END) AS el, SUM(value * 2) AS fossil
  FROM hours h JOIN buildings b ON h.user_id = b.user_id AND h.upgrade = b.upgrade
    JOIN segments s ON b.c_mktsegment = s.c_mktsegment AND b.upgrade = s.upgrade
  GROUP BY ALL),
heat_total AS (
  SELECT *, SUM(el) OVER w AS el_total, SUM(fossil) OVER w AS fossil_total
  FROM heat WINDOW w AS (PARTITION BY state, shape_ts)),
light AS (
  SELECT state, 'light_1' AS shape_ts, timestamp_hour, SUM(value + 1) AS el
  FROM hours h JOIN buildings b ON h.user_id = b.user_id AND h.upgrade = b.upgrade
  WHERE b.upgrade = '0' GROUP BY ALL)
SELECT state, shape_ts, timestamp_hour, 'res' AS sector, 'Heating (Equip.)' AS end_use,
  'Electric' AS fuel, ROUND(el, 4) AS kwh, ROUND(el / el_total, 9) AS multiplier_hourly
FROM heat_total WHERE el_total > 0
UNION ALL
SELECT state, shape_ts, timestamp_hour, 'res', 'Heating (Equip.)', fuel,
  ROUND(fossil, 4), ROUND(fossil / fossil_total, 9)
FROM heat_total CROSS JOIN (VALUES ('Natural Gas'), ('Biomass')) AS f(fuel)
WHERE fossil_total > 0
UNION ALL
SELECT state, shape_ts, timestamp_hour, 'res', 'Lighting', 'Electric', ROUND(el, 4),
  ROUND(el / NULLIF(SUM(el) OVER (PARTITION BY state, shape_ts), 0), 9)
FROM light
""",
)
def hourly_profiles(t: Tables):
    """Several load profiles from one scan of the series."""
    upgrade = (col("user_id") % 2).cast("int").alias("upgrade")
    buildings = t.places().select(
        col("c_custkey").alias("user_id"),
        "state",
        "c_mktsegment",
        (col("c_custkey") % 2).cast("int").alias("upgrade"),
    )
    maps = {
        "segments": t.literal(
            list(SEGMENTS), "c_mktsegment string, upgrade string, shape_ts string"
        )
    }
    on = ("user_id", "upgrade")
    linked = shapes.building_shapes(buildings, maps, PROFILES, ["state"], on)
    sums = shapes.hourly_sums(
        t("events").select("*", upgrade),
        linked,
        PROFILES,
        ["state"],
        align_hour(col("ts"), None),
        on=on,
    )
    return rounded(shapes.hourly_multipliers(sums, PROFILES, ["state"], "res"), DIGITS)


@query(
    "map_melt",
    """
SELECT p_partkey, p_size, 'original_ann' AS tech_stage, p_brand AS group_ann FROM part
UNION ALL
SELECT p_partkey, p_size, 'measure_ann', p_type FROM part
""",
)
def map_melt(t: Tables):
    """Two map columns to stage rows in one scan."""
    return mapping.melt(
        t("part"),
        ["p_partkey", "p_size"],
        {"p_brand": "original_ann", "p_type": "measure_ann"},
        "tech_stage",
        "group_ann",
    )
