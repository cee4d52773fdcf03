"""Delimited files, maps, extracts and publication as queries: written, read back, compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.text import col
from wattloom.operators import mapping
from wattloom.plans import workflow
from wattloom.registry.core import ORDERS_SQL, Tables, query, rounded
from wattloom.registry.longtables import FACTS_SQL, facts
from wattloom.registry.publication import _scratch
from wattloom.sources import readers, writers


def _orders(t: Tables) -> DataFrame:
    """Orders with a code column that looks like a number and texts with marks."""
    return t.orders().select(
        "o_orderkey", "state", (col("county") % 3).cast("string").alias("upgrade"),
        F.concat(F.lit('a "b",\t'), col("c_mktsegment")).alias("note"), F.year("o_orderdate").alias("year"), "o_totalprice",
    )


ORDERS_ROWS_SQL = f"""
WITH {ORDERS_SQL}
SELECT o_orderkey, state, CAST(county % 3 AS VARCHAR) AS upgrade, 'a "b",' || chr(9) || c_mktsegment AS note,
  CAST(YEAR(o_orderdate) AS BIGINT) AS year, o_totalprice
FROM placed_orders
"""


@query("delimited_inferred", ORDERS_ROWS_SQL)
def delimited_inferred(t: Tables):
    """A sorted .csv extract read back with inferred types: integers widened, codes kept as text."""
    path = _scratch(t) + "/orders.csv"
    writers.write_extract(_orders(t), path, order=["state", "o_orderkey"])
    return readers.read_delimited(t.spark, path)


@query("delimited_typed", ORDERS_ROWS_SQL)
def delimited_typed(t: Tables):
    """A .tsv file read back with a schema."""
    path, rows = _scratch(t) + "/orders.tsv", _orders(t)
    writers.write_extract(rows, path, "\t")
    typed = readers.read_delimited(t.spark, path, rows.schema)
    return typed.withColumn("year", col("year").cast("long"))


@query(
    "extract_in_order",
    f"""
WITH {ORDERS_SQL}
SELECT COUNT(*) AS n_rows, 0 AS out_of_order FROM placed_orders
""",
)
def extract_in_order(t: Tables):
    """The files of a sorted extract, one after the other, are in order."""
    path = _scratch(t) + "/sorted.csv"
    writers.write_extract(_orders(t).select("o_orderkey", "o_totalprice"), path, order=["o_totalprice", "o_orderkey"])
    back = readers.read_delimited(t.spark, path, "o_orderkey long, o_totalprice double").select(
        "*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at")
    )
    row = F.struct("o_totalprice", "o_orderkey")
    # each file is sorted where no row is below one before it; files follow by their names
    files = back.groupBy("file").agg(
        F.min(row).alias("lo"), F.max(row).alias("hi"), F.count(F.lit(1)).alias("n"),
        F.min_by(row, "at").alias("first"), F.max_by(row, "at").alias("last"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("file", "lo", "hi")))
    wrong = files.agg(
        F.sum("n").alias("n_rows"),
        F.sum(((F.col("lo") != F.col("first")) | (F.col("hi") != F.col("last"))).cast("int")).alias("inside"),
        ordered.alias("files"),  # a few files, not their rows
    )
    later = F.slice(F.col("files"), 2, F.greatest(F.size("files") - 1, F.lit(0)))
    between = F.size(F.filter(F.arrays_zip(F.col("files.hi").alias("hi"), later["lo"].alias("lo")), lambda p: p["lo"] < p["hi"]))
    return wrong.select("n_rows", (F.col("inside") + between).cast("int").alias("out_of_order"))


@query(
    "dual_export",
    f"""
WITH {ORDERS_SQL}
SELECT kind, state, CAST(YEAR(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n_rows, ROUND(SUM(o_totalprice), 2) AS kwh
FROM placed_orders, (VALUES ('csv'), ('parquet')) k(kind) GROUP BY ALL
""",
)
def dual_export(t: Tables):
    """One table as CSV and as Parquet."""
    folder, rows = _scratch(t), _orders(t).select("state", "year", "o_totalprice")
    writers.write_both(rows, folder, "orders")
    parts = {
        "csv": t.spark.read.schema(rows.schema).option("header", True).csv(f"{folder}/orders_csv"),
        "parquet": t.spark.read.parquet(f"{folder}/orders_parquet"),
    }
    out = parts["csv"].withColumn("kind", F.lit("csv")).unionByName(parts["parquet"].withColumn("kind", F.lit("parquet")))
    summed = out.groupBy("kind", "state", "year").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_totalprice").alias("kwh"))
    return rounded(summed, {"kwh": 2})


@query(
    "map_directory",
    f"""
WITH {ORDERS_SQL}
SELECT state, map, COUNT(*) AS n_rows, ROUND(SUM(o_totalprice * factor), 2) AS kwh
FROM placed_orders JOIN (
  SELECT 'priority' AS map, o_orderpriority AS key, 1 + COUNT(*) % 5 AS factor FROM orders GROUP BY o_orderpriority
  UNION ALL
  SELECT 'segment', c_mktsegment, 1 + COUNT(*) % 7 FROM customer GROUP BY c_mktsegment) m
  ON (map = 'priority' AND key = o_orderpriority) OR (map = 'segment' AND key = c_mktsegment)
GROUP BY ALL
""",
)
def map_directory(t: Tables):
    """Maps of a directory, one file each, read by name and joined as views."""
    folder = _scratch(t)
    made = {
        "priority": t("orders").groupBy(col("o_orderpriority").alias("key")).agg((1 + F.count(F.lit(1)) % 5).alias("factor")),
        "segment": t("customer").groupBy(col("c_mktsegment").alias("key")).agg((1 + F.count(F.lit(1)) % 7).alias("factor")),
    }
    for name, df in made.items():
        writers.write_extract(df, f"{folder}/{name}.tsv", "\t")
    maps = readers.read_maps(t.spark, [f"{folder}/{name}.tsv" for name in made])
    out = None
    for name, key in (("priority", "o_orderpriority"), ("segment", "c_mktsegment")):
        part = t.orders().join(maps[name].withColumnRenamed("key", key), key).groupBy("state").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(col("o_totalprice") * col("factor")).alias("kwh")
        ).withColumn("map", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return rounded(out, {"kwh": 2})


@query(
    "replaced_map_rows",
    """
WITH map AS (SELECT p_partkey AS meas, p_brand AS end_use, p_type AS original_ts FROM part),
changed AS (
  SELECT * FROM map WHERE end_use IS DISTINCT FROM 'Brand#11'
  UNION ALL SELECT meas, end_use, 'gap' FROM map WHERE end_use = 'Brand#11' AND meas % 2 = 0)
SELECT end_use, COUNT(*) AS n_rows, SUM(CASE WHEN original_ts = 'gap' THEN 1 ELSE 0 END)::BIGINT AS n_gap
FROM changed GROUP BY ALL
""",
)
def replaced_map_rows(t: Tables):
    """A map variant: the rows of one end use are swapped for others."""
    known = t("part").select(
        col("p_partkey").alias("meas"), col("p_brand").alias("end_use"), col("p_type").alias("original_ts")
    )
    hit = col("end_use") == "Brand#11"
    new = known.filter(hit & (col("meas") % 2 == 0)).withColumn("original_ts", F.lit("gap"))
    changed = mapping.replace_rows(known, hit, new)
    return changed.groupBy("end_use").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum((col("original_ts") == "gap").cast("long")).alias("n_gap")
    )


@query(
    "published_totals",
    f"""
WITH {FACTS_SQL}
SELECT turnover, "in.state" AS state, CAST(year AS INTEGER) AS year, COUNT(DISTINCT ("in.county", timestamp_hour)) AS n_rows,
  ROUND(SUM(county_hourly_cal_kwh), 2) AS buildings_kwh
FROM facts WHERE fuel = 'Electric' GROUP BY ALL
""",
)
def published_totals(t: Tables):
    """County totals published by scenario, year and state, read back by folder."""
    path = _scratch(t) + "/published"
    writers.write_partitioned(workflow.county_totals(facts(t)), path, ["turnover", "year", "state"])
    out = t.spark.read.parquet(path).groupBy("turnover", "state", col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("buildings_kwh").alias("buildings_kwh")
    )
    return rounded(out, {"buildings_kwh": 2})
