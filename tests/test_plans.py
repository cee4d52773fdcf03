"""What the plans must look like: scans, reuse, push-down."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattloom.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def final_plan(spark, name):
    df = QUERIES[name](spark, FOLDER)
    df._jdf.queryExecution().toRdd().count()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def scans(plan, table):
    return len(re.findall(rf"FileScan parquet [^\n]*/{table}\.parquet", plan))


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("annual_share_mapped", {"orders": 1}),
        ("hourly_shape", {"events": 1}),
        ("hourly_profiles", {"events": 1}),
        ("disaggregate_hourly", {"lineitem": 1, "events": 1}),
        ("metric_pivot_melt", {"lineitem": 1}),
        ("weighted_split", {"lineitem": 1}),
        ("stock_counts", {"lineitem": 1}),
        ("shares_three_levels", {"lineitem": 1}),
        ("day_profiles", {"lineitem": 1}),
        ("scenario_max_day", {"lineitem": 1}),
        ("conservation_grouping_sets", {"lineitem": 2}),
    ],
)
def test_facts_are_scanned_once(spark, name, expected):
    plan = final_plan(spark, name)
    assert {t: scans(plan, t) for t in expected} == expected


def test_share_needs_no_window_and_reuses_its_exchange(spark):
    plan = final_plan(spark, "annual_share_fanout")
    assert "ReusedExchange" in plan
    assert not re.search(r"\bWindow \[", plan)


def test_only_needed_columns_are_read(spark):
    plan = final_plan(spark, "hourly_shape")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def test_ranked_groups_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in final_plan(spark, "monthly_peak")


def test_series_scan_opens_only_the_upgrades_in_use(spark, tmp_path):
    """The folder filter does not depend on the size of the building table."""
    from wattloom.operators import shapes
    from wattloom.operators.shapes import HourlyProfile
    from wattloom.sources.readers import literal_table

    rows = [(f"{b}", f"{u}", datetime(2018, 1, 1), 1.0) for b in range(3) for u in range(5)]
    literal_table(spark, rows, "bldg_id string, upgrade string, ts timestamp, v double").write.partitionBy(
        "upgrade"
    ).parquet(f"{tmp_path}/series")
    series = spark.read.parquet(f"{tmp_path}/series")
    maps = {"m": literal_table(spark, [("x", 3, "s")], "kind string, upgrade int, shape_ts string")}
    profiles = [HourlyProfile("p", "v", (), map_name="m", keys=("kind",))]
    used = shapes.used_upgrades(maps, profiles)
    assert used == ["3"]
    places = literal_table(spark, [("1", "3", "c", "x")], "bldg_id string, upgrade string, place string, kind string")
    linked = shapes.building_shapes(places, maps, profiles, ["place"])
    sums = shapes.hourly_sums(series, linked, profiles, ["place"], F.col("ts"), upgrades=used)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*upgrade", plan)


def test_series_is_fanned_out_behind_the_last_shuffle(spark):
    """Readings, not their copies for profiles and shapes, are shuffled; the small totals come to the sums."""
    from wattloom.operators import shapes
    from wattloom.operators.shapes import HourlyProfile
    from wattloom.operators.shares import targets
    from wattloom.sources.readers import literal_table

    rows = [(f"{b}", "0", datetime(2018, 1, 1, h), float(b + 1)) for b in range(4) for h in range(3)]
    series = literal_table(spark, rows, "bldg_id string, upgrade string, timestamp timestamp, v double")
    places = literal_table(spark, [(f"{b}", "0", f"c{b % 2}") for b in range(4)], "bldg_id string, upgrade string, place string")
    profiles = [HourlyProfile(n, "v", targets("primary", n, ["El"]), shape="s") for n in ("p", "q")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        linked = shapes.building_shapes(places, {}, profiles, ["place"])
        sums = shapes.hourly_sums(series, linked, profiles, ["place"], F.col("timestamp"))
        sums.collect()
        plan = sums._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        shares = shapes.hourly_multipliers(sums, profiles, ["place"], "com")
        got = {(r["place"], r["end_use"], r["timestamp_hour"].hour): (r["kwh"], r["multiplier_hourly"]) for r in shares.collect()}
        joined = shares._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(place" in plan
    assert not any("hashpartitioning(" in line and "profile" in line for line in plan.split("\n"))
    assert "BroadcastHashJoin" in joined
    want = {"c0": 1.0 + 3.0, "c1": 2.0 + 4.0}
    assert got == {(c, n, h): (v, 1 / 3) for c, v in want.items() for n in ("p", "q") for h in range(3)}
