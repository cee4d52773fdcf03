from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wattloom.functions import col
from wattloom.sources import readers, schemas, writers


def files(folder):
    return [p for p in Path(folder).rglob("*.parquet") if not p.name.startswith(".")]


def test_delimited_types(spark, tmp_path):
    path = tmp_path / "res_ann_x.tsv"
    path.write_text('﻿group_ann\tdescription\tin.fuel\tupgrade\tapplicability\tn\ng1\t"a, ""b"""\tGas\t0\tTRUE\t3\n')
    df = readers.read_delimited(spark, str(path))
    assert dict(df.dtypes) == {
        "group_ann": "string", "description": "string", "in.fuel": "string",
        "upgrade": "string", "applicability": "string", "n": "bigint",
    }
    (r,) = df.collect()
    assert (r.description, r["in.fuel"], r.upgrade, r.applicability) == ('a, "b"', "Gas", "0", "TRUE")
    maps = readers.read_maps(spark, [str(path)])
    assert list(maps) == ["res_ann_x"]
    with pytest.raises(ValueError, match="tsv or .csv"):
        readers.read_delimited(spark, "x.txt")


def test_measure_map_column_is_named_end_use(spark, tmp_path):
    path = tmp_path / "measures.tsv"
    path.write_text("meas\tModel_end_use\toriginal_ann\nm\tCooking\tg\n")
    assert readers.read_measure_map(spark, str(path)).columns == ["meas", "end_use", "original_ann"]


def test_literal_table_is_local(frame):
    df = frame([("a", 1)], "`in.x` string, n int")
    assert "LocalRelation" in df._jdf.queryExecution().optimizedPlan().toString()


def test_conform(frame):
    df = frame([("c", 1.0)], "`in.county` string, kwh double")
    out = readers.conform(df, schemas.HOURLY_MULTIPLIERS["com"])
    assert out.columns == schemas.HOURLY_MULTIPLIERS["com"].fieldNames()
    assert out.schema["timestamp_hour"].dataType.simpleString() == "timestamp"


def table(spark, n=1000):
    return spark.range(n).select(
        F.when(col("id") % 3 == 0, "A").otherwise(F.concat(F.lit("S"), (col("id") % 5).cast("string"))).alias("in.state"),
        col("id").alias("v"),
        (col("id") % 2).cast("int").alias("year"),
    )


def test_partitioned_write_and_partial_rerun(spark, tmp_path):
    path = f"{tmp_path}/t"
    writers.write_partitioned(table(spark), path, ["in.state", "year"], sort=["v"])
    back = spark.read.parquet(path)
    assert back.count() == 1000
    assert (Path(path) / "in.state=A").is_dir()
    only = table(spark).filter((col("in.state") == "A") & (col("v") < 30))
    writers.replace_partitions(only, path, ["in.state", "year"])
    got = {r["in.state"]: r["count"] for r in spark.read.parquet(path).groupBy(col("in.state")).count().collect()}
    assert got["A"] == 10 and sum(got.values()) == 1000 - 334 + 10


def test_partition_pruning_reaches_the_scan(spark, tmp_path):
    path = f"{tmp_path}/t"
    writers.write_partitioned(table(spark), path, ["in.state"])
    df = spark.read.parquet(path).filter(col("in.state") == "A").select("v")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(in.state" in plan
    assert "ReadSchema: struct<v:bigint>" in plan


def test_hot_folder_is_split_and_small_ones_compacted(spark, tmp_path):
    scattered = f"{tmp_path}/scattered"
    table(spark).repartition(5, "v").write.partitionBy("in.state").parquet(scattered)
    writers.compact(spark.read.parquet(scattered), f"{tmp_path}/compact", ["in.state"])
    folders = {p.parent.name for p in files(f"{tmp_path}/compact")}
    assert len(files(f"{tmp_path}/compact")) == len(folders) == 6
    assert spark.read.parquet(f"{tmp_path}/compact").count() == 1000
    assert len(files(scattered)) > 6 and spark.read.parquet(scattered).count() == 1000
    # A folder beyond the advisory size is written by several tasks.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    try:
        hot = table(spark, 60_000).repartition(16)
        writers.write_partitioned(hot, f"{tmp_path}/hot", ["in.state"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(f"{tmp_path}/hot/in.state=A")) > 1


def test_append_matches_by_name(spark, frame, tmp_path):
    path = f"{tmp_path}/t"
    frame([("a", 1)], "k string, n int").write.parquet(path)
    writers.append_by_name(frame([(2, "b")], "n int, k string"), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 2)]


def test_export_per_key_and_extracts(spark, frame, tmp_path):
    df = table(spark, 100)
    writers.export_per_key(df, f"{tmp_path}/keys", "in.state", "in_state")
    assert spark.read.parquet(f"{tmp_path}/keys").filter("in_state = 'A'").count() == 34
    writers.write_both(df, str(tmp_path), "wide")
    csv = spark.read.option("header", True).csv(f"{tmp_path}/wide_csv")
    assert csv.count() == spark.read.parquet(f"{tmp_path}/wide_parquet").count() == 100
    assert csv.columns == ["in.state", "v", "year"]


def test_shared_folder_is_the_session_s(spark):
    from wattloom.session import shared_folder

    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == named.rstrip("/") if named else folder.startswith("file:///tmp/run-")
    assert shared_folder(spark) == folder


def test_rerun_leaves_no_old_folders(spark, tmp_path):
    rows = table(spark, 90)
    path = f"{tmp_path}/rerun"
    writers.write_partitioned(rows, path, ["in.state"])
    writers.write_partitioned(rows.filter("`in.state` = 'A'"), path, ["in.state"])
    assert [r[0] for r in spark.read.parquet(path).select("`in.state`").distinct().collect()] == ["A"]
