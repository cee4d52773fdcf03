"""Reconciliation that sums a folder again only when its files changed.

For every folder of a partitioned table the sums by key are kept with a fingerprint of
its files.  A later check lists the files, scans the folders whose fingerprint differs, and
merges their sums with the kept ones; the comparison itself works on sums alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.text import col, cols
from wattloom.operators.joins import join_null_safe
from wattloom.operators.reconcile import reconcile

FOLDER, PRINT, SUM, ROWS = "__folder", "__print", "__sum", "__rows"
PLACE = "__place"


def folder_prints(spark: SparkSession, path: str) -> DataFrame:
    """``folder, print, place`` of a Parquet table: names, sizes and times of its files; no data is read.

    The folder is named as a scan reports it (with marks encoded), ``place`` is its path.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        .load(path).select("path", "length", "modificationTime", F.col("_metadata.file_path").alias("file"))
    )
    named = files.select(
        F.regexp_replace("file", "/[^/]*$", "").alias(FOLDER),
        F.regexp_replace("path", "/[^/]*$", "").alias(PLACE),
        F.concat_ws("|", "path", col("length").cast("string"), col("modificationTime").cast("string")).alias("f"),
    )
    return named.groupBy(FOLDER, PLACE).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list("f")), "\n"), 256).alias(PRINT)
    )


def folder_sums(
    spark: SparkSession, path: str, keys: Sequence[str], value: str, kept: DataFrame | None = None
) -> tuple[DataFrame, list[str]]:
    """Sums by folder and key, and the folders that were scanned for them.

    ``kept`` is the (written) result of an earlier call: folders whose files are as they were
    take their sums from it, folders that are gone drop out.  The folders' names (not their
    rows) reach the driver, as in planning any scan.
    """
    listed = folder_prints(spark, path).collect()
    prints, places = {r[FOLDER]: r[PRINT] for r in listed}, {r[FOLDER]: r[PLACE] for r in listed}
    known = {}
    if kept is not None:
        known = {r[FOLDER]: r[PRINT] for r in kept.select(FOLDER, PRINT).distinct().collect()}
    changed = sorted(f for f, p in prints.items() if known.get(f) != p)
    out = None
    if kept is not None:
        same = [f for f, p in prints.items() if known.get(f) == p]
        out = kept.filter(col(FOLDER).isin(same))
    if changed:
        rows = spark.read.option("basePath", path).parquet(*[places[f] for f in changed])
        folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias(FOLDER)
        sums = rows.select(folder, *cols(keys), col(value)).groupBy(FOLDER, *cols(keys)).agg(
            F.sum(col(value)).alias(SUM), F.count(F.lit(1)).alias(ROWS)
        )
        # one row a folder
        named = spark.createDataFrame([(f, prints[f]) for f in changed], f"{FOLDER} string, {PRINT} string")
        fresh = sums.join(F.broadcast(named), FOLDER).select(FOLDER, PRINT, *cols(keys), SUM, ROWS)
        out = fresh if out is None else out.unionByName(fresh)
    if out is None:
        raise ValueError(f"no Parquet files in {path}")
    return out, changed


def reconcile_kept(levels: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """``reconcile`` from the kept sums of each level (the first is the base)."""
    return reconcile({name: (sums, SUM) for name, sums in levels.items()}, keys)


def unsummed(sums: DataFrame, keys: Sequence[str], wanted: DataFrame) -> DataFrame:
    """Keys of ``wanted`` for which no folder has a row (coverage, from the sums alone)."""
    return join_null_safe(wanted.select(*cols(keys)).distinct(), sums.select(*cols(keys)).distinct(), keys, "left_anti")
