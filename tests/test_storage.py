from __future__ import annotations

import os
import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wattloom.functions import col
from wattloom.functions.calendar import align_hour
from wattloom.operators import distinct, incremental, reconcile, shapes
from wattloom.registry.hourly import PROFILES, SEGMENTS
from wattloom.sources import clustered, runs, writers


def final_plan(df):
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def counter(df, *names):
    return Counter(tuple(r) for r in df.select(*[col(n) for n in names]).collect())


@pytest.fixture
def parts(spark):
    """Series and buildings large enough to shuffle when nothing else is known."""
    series = spark.range(4000).select(
        (col("id") % 40).alias("user_id"), (col("id") % 2).cast("string").alias("upgrade"),
        F.timestamp_seconds(1704067200 + col("id") * 300).alias("ts"),
        F.when(col("id") % 7 == 0, "error").otherwise("click").alias("event_type"), (col("id") % 11).cast("double").alias("value"),
    )
    maps = {"segments": spark.createDataFrame(list(SEGMENTS), "c_mktsegment string, upgrade string, shape_ts string")}
    buildings = spark.range(45).select(
        col("id").alias("user_id"), F.concat(F.lit("S"), col("id") % 3).alias("state"),
        F.element_at(F.array(*[F.lit(s) for s in ("BUILDING", "MACHINERY", "FURNITURE")]), (col("id") % 3 + 1).cast("int")).alias("c_mktsegment"),
        (col("id") % 2).cast("string").alias("upgrade"),
    )
    on = ("user_id", "upgrade")
    return series, shapes.building_shapes(buildings, maps, PROFILES, ["state"], on), on


def test_clustered_series_reach_the_place_sum_without_an_exchange(spark, parts, tmp_path):
    series, linked, on = parts
    names = (f"s_{uuid.uuid4().hex}", f"b_{uuid.uuid4().hex}")
    left, right = clustered.write_pair(series, linked, names, str(tmp_path), on="user_id", buckets=4, time="ts")
    options = dict(place=["state"], hour=align_hour(col("ts"), None), on=on, collapse=True)
    want = shapes.hourly_sums(series, linked, PROFILES, **options)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = shapes.hourly_sums(left.read(spark), right.read(spark), PROFILES, **options)
        plan, other = final_plan(got), final_plan(shapes.hourly_sums(series, linked, PROFILES, **options))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1  # the sum by place, above join and collapse
    assert "hashpartitioning(state" in plan and len(re.findall(r"Exchange hashpartitioning", other)) > 1
    keys = ["state", "profile", "shape_ts", shapes.HOUR, "primary", "secondary"]
    assert counter(got, *keys) == counter(want, *keys)
    again = clustered.ClusteredTable(f"again_{uuid.uuid4().hex}", left.path, ("user_id",), 4, ("ts",))
    assert again.attach(spark, left.read(spark).schema).read(spark).count() == series.count()


def test_a_run_is_appended_once(spark, frame, tmp_path):
    table = runs.RunTable(f"{tmp_path}/t", ("s",))
    with pytest.raises(ValueError, match="no published run"):
        table.read(spark)
    one = frame([(1, "a", 1.0), (2, "b", 2.0)], "id int, s string, v double")
    assert table.append(one, "r1") and not table.append(one, "r1")
    assert table.append(one.select("v", "s", "id"), "r2")  # by name
    with pytest.raises(ValueError, match="columns differ"):
        table.append(one.drop("v"), "r3")
    with pytest.raises(runs.AuditFailed, match="r3"):
        table.append(one, "r3", audit=lambda rows: rows.filter("v > 1"))
    assert counter(table.read(spark), "id", "s", "v", "run") == Counter(
        (*r, run) for r in [(1, "a", 1.0), (2, "b", 2.0)] for run in ("r1", "r2")
    )
    assert table.read(spark, ["r2"]).count() == 2 and sorted(table.runs(spark)) == ["r1", "r2"]
    assert table.append(one.filter("false"), "empty") and table.read(spark).count() == 4


def test_versions_replace_rows_and_old_ones_stay(spark, frame, tmp_path):
    table = runs.VersionedTable(f"{tmp_path}/t", "s")
    schema = "id int, s string, v double"
    rows = [(i, s, float(i)) for i, s in enumerate("aabbc")] + [(9, None, 9.0), (None, "c", 0.0)]
    assert table.create(frame(rows, schema)) == 1
    before = {f for f in os.listdir(f"{tmp_path}/t/data")}
    # id 0 moves to another folder, id 9 is found by its folder of NULL, 20 is new, NULL equals NULL
    change = [(0, "b", 100.0), (9, None, 99.0), (20, "d", 20.0), (None, "c", 5.0)]
    assert table.replace_rows(frame(change, schema), ["id"]) == 2
    want = [r for r in rows if r[0] not in (0, 9, None)] + change
    assert counter(table.read(spark), "id", "s", "v") == Counter(want)
    assert counter(table.read(spark, 1), "id", "s", "v") == Counter(rows)
    assert table.versions(spark) == [1, 2]
    new = [f for f in os.listdir(f"{tmp_path}/t/data") if f not in before]
    assert len(new) == 1
    # untouched folders are not written again: only one row of folder a was touched
    assert table.replace_rows(frame([(2, "b", 0.5)], schema), ["id"]) == 3
    last = [f for f in os.listdir(f"{tmp_path}/t/data") if f not in before and f not in new][0]
    assert [d for d in os.listdir(f"{tmp_path}/t/data/{last}") if d.startswith("s=")] == ["s=b"]
    # a writer that began from the same version is refused
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        table._publish(spark, 3, table.read(spark).schema, {"x": "y"})
    empty = runs.VersionedTable(f"{tmp_path}/e", "s")
    assert empty.create(frame([], schema)) == 1 and empty.read(spark).count() == 0
    assert empty.replace_rows(frame([(1, "a", 1.0)], schema), ["id"]) == 2 and empty.read(spark).count() == 1


def test_compaction_leaves_large_files_alone(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(20000).selectExpr("id", "concat('a b%', id % 2) AS p", "uuid() AS u").repartition(1).write.partitionBy("p").parquet(path)
    spark.range(60).selectExpr("id", "concat('a b%', id % 3) AS p", "uuid() AS u").repartition(5, "id").write.mode("append").partitionBy("p").parquet(path)
    data = spark.read.parquet(path)
    want = counter(data, "id", "p", "u")
    files = lambda root: [os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")]
    large = [f for f in files(path) if os.path.getsize(f) > 100_000]
    done = runs.compact_small(spark, path, f"{tmp_path}/joined", ["p"], bound=100_000, target=1 << 20)
    assert counter(done.read(spark), "id", "p", "u") == want
    assert sorted(f.removeprefix("file:") for f in done.kept) == sorted(large) and len(large) == 2
    assert len(files(f"{tmp_path}/joined")) == 3 and counter(spark.read.parquet(path), "id", "p", "u") == want
    # what is compact already is not read
    again = runs.compact_small(spark, f"{tmp_path}/joined", f"{tmp_path}/again", ["p"], bound=100_000)
    assert again.path is None and not os.path.exists(f"{tmp_path}/again") and again.read(spark).count() == 60
    bins = runs.small_files(spark, path, 100_000, 1).count()
    assert bins == 0  # a bin of one file is left alone


def test_states_of_runs_merge_to_the_distinct_count(spark, frame, tmp_path):
    facts = spark.range(30000).selectExpr("id % 5 AS k", "pmod(hash(id), 7000) AS place", "id % 3 AS part")
    facts = facts.withColumn("place", F.when(col("place") % 50 > 0, col("place")))
    numbers, states = None, []
    for k in range(3):
        own = facts.filter(col("part") == k)
        distinct.number_places(own, ["place"], numbers).write.parquet(f"{tmp_path}/n{k}")
        numbers = spark.read.parquet(f"{tmp_path}/n{k}")
        states.append(distinct.distinct_states(own, ["k"], numbers, ["place"]))
    assert numbers.count() == numbers.select("place_number").distinct().count() == facts.select("place").dropna().distinct().count()
    got = counter(distinct.distinct_counts(distinct.merge_states(states, ["k"]), ["k"]), "k", "n_places")
    assert got == counter(facts.groupBy("k").agg(F.countDistinct("place").alias("n")), "k", "n")
    total = distinct.distinct_counts(distinct.merge_states(states, ["k"]), [])
    assert total.first()["n_places"] == numbers.count()
    old = {r["place"]: r["place_number"] for r in spark.read.parquet(f"{tmp_path}/n0").collect()}
    new = {r["place"]: r["place_number"] for r in numbers.collect()}
    assert all(new[p] == n for p, n in old.items())  # a number is for life


def test_only_changed_folders_are_summed_again(spark, frame, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(900).selectExpr("concat('a b/', id % 3, '%é') AS p", "id % 4 AS k", "cast(id AS double) AS v")
    writers.write_partitioned(df, path, ["p"])
    sums, scanned = incremental.folder_sums(spark, path, ["k"], "v")
    assert len(scanned) == 3
    sums.write.parquet(f"{tmp_path}/sums0")
    kept = spark.read.parquet(f"{tmp_path}/sums0")
    same, scanned = incremental.folder_sums(spark, path, ["k"], "v", kept)
    assert scanned == [] and counter(same, "k", "__sum") == counter(kept, "k", "__sum")
    plan = final_plan(same)
    assert plan.count("FileScan") == 1 and "/sums0]" in plan
    change = df.filter("p = 'a b/1%é'").withColumn("v", col("v") * 2)
    writers.replace_partitions(change, path, ["p"])
    sums, scanned = incremental.folder_sums(spark, path, ["k"], "v", kept)
    assert len(scanned) == 1
    now = spark.read.parquet(path)
    got = incremental.reconcile_kept({"now": sums, "before": kept}, ["k"])
    want = reconcile.reconcile({"now": (now, "v"), "before": (df, "v")}, ["k"])
    assert counter(got, "k", "now", "before", "per_diff_before") == counter(want, "k", "now", "before", "per_diff_before")
    assert incremental.unsummed(sums, ["k"], frame([(3,), (7,), (None,)], "k long")).count() == 2
    with pytest.raises(Exception, match="no Parquet files|PATH_NOT_FOUND"):
        incremental.folder_sums(spark, f"{tmp_path}/none", ["k"], "v")


def test_totals_by_sets_scan_once_and_keep_null_keys(spark, frame):
    before = frame([("a", "x", 1.0), ("a", None, 2.0), ("b", "x", 4.0)], "r string, f string, v double")
    after = frame([("a", "x", 1.0), ("b", "x", 2.0), ("c", "y", 1.0)], "r string, f string, v double")
    out = reconcile.conservation_sets(before, after, ["r", "f"], "v", {"ALL": F.lit(True), "X": col("f") == "x"}, [["r"], []])
    got = {(r["scope"], r["level"], r["r"], r["f"]): (r["kwh_before"], r["kwh_after"], r["pct_delta"]) for r in out.collect()}
    assert got["ALL", 0, "a", None] == (2.0, 0.0, -1.0)
    assert got["ALL", 1, "a", "ALL"] == (3.0, 1.0, pytest.approx(-2 / 3))
    assert got["ALL", 2, "ALL", "ALL"] == (7.0, 4.0, pytest.approx(-3 / 7))
    assert got["X", 2, "ALL", "ALL"] == (5.0, 3.0, pytest.approx(-0.4))
    assert got["ALL", 0, "c", "y"] == (0.0, 1.0, float("inf")) and len(got) == 4 + 3 + 1 + 2 + 2 + 1
    plan = final_plan(out)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_a_filter_of_the_small_side_is_below_the_shuffle(spark, tmp_path):
    """The buildings in use filter the series before it is shuffled."""
    spark.range(50000).selectExpr("id % 5000 AS b", "cast(id AS double) AS v").write.parquet(f"{tmp_path}/s")
    spark.range(5000).selectExpr("id AS b", "id % 100 AS kind").write.parquet(f"{tmp_path}/k")
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    from wattloom.session import RUNTIME_SETTINGS

    size = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    assert RUNTIME_SETTINGS[size] == spark.conf.get(size)
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        used = spark.read.parquet(f"{tmp_path}/k").filter("kind = 3")
        out = spark.read.parquet(f"{tmp_path}/s").join(used, "b").groupBy("kind").agg(F.sum("v"))
        plan = final_plan(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set(size, RUNTIME_SETTINGS[size])
    assert "might_contain" in plan
    # the filter stands below the exchange that deals the series
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "might_contain" in line)
    assert any("Exchange hashpartitioning(b" in line for line in lines[:at])
    assert out.count() == 1
