"""Stored forms of the tables: clustered series, runs, versions, kept sums and bitmaps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.calendar import align_hour
from wattloom.functions.text import col
from wattloom.operators import distinct, incremental, reconcile, shapes
from wattloom.registry import cascade
from wattloom.registry.core import LINES_SQL, ORACLE, ORDERS_SQL, Tables, query, rounded
from wattloom.registry.hourly import DIGITS, PROFILES, SEGMENTS
from wattloom.registry.publication import ROUNDTRIP_SQL, _dated, _scratch, _summary
from wattloom.sources import clustered, runs, writers


def clustered_sums(t: Tables) -> DataFrame:
    """Hourly sums of the profiles from a series and buildings in equal buckets."""
    upgrade = lambda user: (user % 2).cast("string").alias("upgrade")
    maps = {"segments": t.literal(list(SEGMENTS), "c_mktsegment string, upgrade string, shape_ts string")}
    buildings = t.places().select(
        col("c_custkey").alias("user_id"), "state", "c_mktsegment", upgrade(col("c_custkey"))
    )
    on = ("user_id", "upgrade")
    linked = shapes.building_shapes(buildings, maps, PROFILES, ["state"], on)
    series, known = clustered.write_pair(
        t("events").select("user_id", upgrade(col("user_id")), "ts", "event_type", "value"),
        linked, (f"series_{uuid.uuid4().hex}", f"buildings_{uuid.uuid4().hex}"), _scratch(t),
        on="user_id", buckets=8, time="ts",
    )
    return shapes.hourly_sums(
        series.read(t.spark), known.read(t.spark), PROFILES, ["state"], align_hour(col("ts"), None), on=on, collapse=True
    )


@query("hourly_profiles_clustered", ORACLE["hourly_profiles"])
def hourly_profiles_clustered(t: Tables):
    """Profiles from bucketed tables: collapse and join in the task that reads a bucket."""
    sums = clustered_sums(t)
    return rounded(shapes.hourly_multipliers(sums, PROFILES, ["state"], "res"), DIGITS)


AUDIT_KEYS = ["turnover", "in.state", "sector", "fuel", "year"]


def fuel_audit(t: Tables) -> DataFrame:
    """Projection, county and hourly energy by state, sector and fuel, and how far they are apart."""
    groups = cascade.disagg.stage_groups(cascade.measure_map(t))
    annual = cascade.county_annual(t)
    given = cascade.projection(t).join(groups, ["meas", "end_use", "tech_stage"]).withColumnRenamed("reg", "in.state")
    levels = {"scout_kwh": (given, "state_ann_kwh"), "bss_ann_kwh": (annual, "county_ann_kwh")}
    return reconcile.reconcile(levels, AUDIT_KEYS)


@query(
    "audit_appended",
    f"""
WITH {cascade.ANNUAL_SQL},
given AS (
  SELECT turnover, reg, sector, fuel, year, SUM(state_ann_kwh) AS a
  FROM projection JOIN stage_groups USING (meas, end_use, tech_stage) GROUP BY ALL),
spread AS (SELECT turnover, reg, sector, fuel, year, SUM(county_ann_kwh) AS b FROM county_annual GROUP BY ALL)
SELECT turnover, COALESCE(g.reg, s.reg) AS "in.state", sector, fuel, year, run,
  ROUND(a * f, 2) AS scout_kwh, ROUND(b * f, 2) AS bss_ann_kwh, ROUND(1 - b / a, 6) + 0.0 AS per_diff_bss_ann_kwh
FROM given g FULL JOIN spread s USING (turnover, reg, sector, fuel, year),
  (VALUES ('r1', 1), ('r2', 2)) r(run, f)
""",
)
def audit_appended(t: Tables):
    """The fuel audit of two runs appended, each tried twice: a run is in the table once."""
    table = runs.RunTable(_scratch(t) + "/fuel_audit", ("sector",))
    audited = fuel_audit(t).select(
        *[col(k) for k in AUDIT_KEYS], "scout_kwh", "bss_ann_kwh", "per_diff_bss_ann_kwh"
    )

    def wrong(rows: DataFrame) -> DataFrame:
        return rows.filter(col("scout_kwh").isNull() | (F.abs("per_diff_bss_ann_kwh") > 0.001))

    for run, factor in (("r1", 1), ("r2", 2), ("r1", 1), ("r2", 2)):
        scaled = audited.withColumns({c: col(c) * factor for c in ("scout_kwh", "bss_ann_kwh")})
        table.append(scaled, run, audit=wrong)
    out = table.read(t.spark)
    small = F.round("per_diff_bss_ann_kwh", 6) + F.lit(0.0)
    return rounded(out, {"scout_kwh": 2, "bss_ann_kwh": 2}).withColumn("per_diff_bss_ann_kwh", small)


@query(
    "versioned_replace",
    f"""
WITH {ORDERS_SQL},
changed AS (
  SELECT o_orderkey, state, o_orderstatus, CAST(YEAR(o_orderdate) AS INTEGER) AS year,
    CASE WHEN state IN ('NATION_1', 'NATION_2') AND o_orderkey % 3 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS price
  FROM placed_orders)
SELECT 'new' AS version, state, o_orderstatus, year, COUNT(*) AS n_rows, ROUND(SUM(price), 2) AS kwh
FROM changed GROUP BY ALL
UNION ALL
SELECT 'old', state, o_orderstatus, CAST(YEAR(o_orderdate) AS INTEGER), COUNT(*), ROUND(SUM(o_totalprice), 2)
FROM placed_orders GROUP BY ALL
""",
)
def versioned_replace(t: Tables):
    """Rows replaced by key in two states' folders; the version before stays readable."""
    table = runs.VersionedTable(_scratch(t) + "/orders", "state")
    orders = _dated(t).select("o_orderkey", "state", "o_orderstatus", "year", "o_totalprice")
    first = table.create(orders)
    some = orders.filter(col("state").isin("NATION_1", "NATION_2") & (col("o_orderkey") % 3 == 0))
    second = table.replace_rows(some.withColumn("o_totalprice", col("o_totalprice") * 2), ["o_orderkey"])
    parts = [
        _summary(table.read(t.spark, v)).withColumn("version", F.lit(name)) for name, v in (("old", first), ("new", second))
    ]
    return parts[0].unionByName(parts[1])


@query("compact_small_files", ROUNDTRIP_SQL)
def compact_small_files(t: Tables):
    """Only files below the bound are read and joined; the others stay where they are."""
    folder = _scratch(t)
    _dated(t).repartition(6, "o_orderkey").write.partitionBy("state").parquet(f"{folder}/scattered")
    sizes = runs.small_files(t.spark, f"{folder}/scattered", 1 << 40, 1 << 40).agg(F.percentile_approx("length", 0.6)).first()
    done = runs.compact_small(
        t.spark, f"{folder}/scattered", f"{folder}/joined", ["state"], bound=int(sizes[0] or 1), target=1 << 20
    )
    return _summary(done.read(t.spark))


@query(
    "distinct_merged",
    f"""
WITH {LINES_SQL}
SELECT l_returnflag AS end_use, l_linestatus AS fuel, COUNT(DISTINCT county) AS n_places
FROM lines GROUP BY ALL
""",
)
def distinct_merged(t: Tables):
    """Distinct places from the kept states of three runs, the last with places not seen before."""
    folder, keys = _scratch(t), ["end_use", "fuel", "year"]
    lines = t.lines().select(
        "county", col("l_returnflag").alias("end_use"), col("l_linestatus").alias("fuel"), F.year("l_shipdate").alias("year")
    )
    parts = [lines.filter(F.pmod("year", F.lit(3)) == k) for k in range(3)]
    numbers, states = None, []
    for k, part in enumerate(parts):
        distinct.number_places(part, ["county"], numbers).write.parquet(f"{folder}/numbers-{k}")
        numbers = t.spark.read.parquet(f"{folder}/numbers-{k}")
        distinct.distinct_states(part, keys, numbers, ["county"]).write.parquet(f"{folder}/states-{k}")
        states.append(t.spark.read.parquet(f"{folder}/states-{k}"))
    return distinct.distinct_counts(distinct.merge_states(states, keys), ["end_use", "fuel"])


@query(
    "conservation_grouping_sets",
    f"""
WITH {LINES_SQL},
rows AS (
  SELECT state AS reg, l_returnflag AS end_use, l_linestatus AS fuel, l_extendedprice AS b,
    l_extendedprice * (1 - l_discount) AS a FROM lines),
scoped AS (
  SELECT 'ALL_ROWS' AS scope, * FROM rows
  UNION ALL SELECT 'F_ONLY', * FROM rows WHERE fuel = 'F'),
sums AS (
  SELECT scope, CASE WHEN GROUPING(reg) = 1 THEN 'ALL' ELSE reg END AS reg,
    CASE WHEN GROUPING(end_use) = 1 THEN 'ALL' ELSE end_use END AS end_use,
    CASE WHEN GROUPING(fuel) = 1 THEN 'ALL' ELSE fuel END AS fuel,
    CAST(GROUPING(reg) + GROUPING(end_use) + GROUPING(fuel) AS INTEGER) AS level, SUM(b) AS b, SUM(a) AS a
  FROM scoped GROUP BY GROUPING SETS ((scope, reg, end_use, fuel), (scope, reg), (scope, end_use, fuel), (scope)))
SELECT reg, end_use, fuel, ROUND(b, 4) AS kwh_before, ROUND(a, 4) AS kwh_after, ROUND(a - b, 4) AS delta,
  ROUND((a - b) / b, 8) AS pct_delta, level, scope
FROM sums
""",
)
def conservation_grouping_sets(t: Tables):
    """Detail, subtotals by state and by use and fuel, and grand totals of two scopes in one aggregation."""
    lines = t.lines().select(
        col("state").alias("reg"), col("l_returnflag").alias("end_use"), col("l_linestatus").alias("fuel"),
        col("l_extendedprice").alias("kwh"), "l_discount",
    )
    after = lines.withColumn("kwh", col("kwh") * (1 - col("l_discount")))
    out = reconcile.conservation_sets(
        lines, after, ["reg", "end_use", "fuel"], "kwh",
        {"ALL_ROWS": F.lit(True), "F_ONLY": col("fuel") == "F"}, [["reg"], ["end_use", "fuel"], []],
    )
    return rounded(out, {"kwh_before": 4, "kwh_after": 4, "delta": 4, "pct_delta": 8})


@query(
    "incremental_reconcile",
    f"""
WITH {LINES_SQL}
SELECT state, l_linestatus AS fuel, ROUND(SUM(l_extendedprice), 2) AS given,
  ROUND(SUM(l_extendedprice * (CASE WHEN l_returnflag = 'A' THEN 1 - l_discount ELSE 1 END)), 2) AS spread,
  ROUND(1 - SUM(l_extendedprice * (CASE WHEN l_returnflag = 'A' THEN 1 - l_discount ELSE 1 END)) / SUM(l_extendedprice), 8) + 0.0
    AS per_diff_spread
FROM lines GROUP BY ALL
""",
)
def incremental_reconcile(t: Tables):
    """One folder of a level is rewritten; only it is summed again, and the levels are compared from sums."""
    folder, keys = _scratch(t), ["state", "fuel"]
    lines = t.lines().select(
        "state", col("l_linestatus").alias("fuel"), "l_returnflag", col("l_extendedprice").alias("kwh"), "l_discount"
    )
    levels = {}
    for name in ("given", "spread"):
        path = f"{folder}/{name}"
        writers.write_partitioned(lines, path, ["l_returnflag"])
        sums, _ = incremental.folder_sums(t.spark, path, keys, "kwh")
        sums.write.parquet(f"{folder}/{name}-sums-0")
        if name == "spread":
            flag = lines.filter(col("l_returnflag") == "A").withColumn("kwh", col("kwh") * (1 - col("l_discount")))
            writers.replace_partitions(flag, path, ["l_returnflag"])
        kept = t.spark.read.parquet(f"{folder}/{name}-sums-0")
        levels[name], scanned = incremental.folder_sums(t.spark, path, keys, "kwh", kept)
        assert len(scanned) == (name == "spread"), scanned
    out = rounded(incremental.reconcile_kept(levels, keys), {"given": 2, "spread": 2})
    return out.withColumn("per_diff_spread", F.round("per_diff_spread", 8) + F.lit(0.0))
