"""Tables that grow by named runs, tables with replaced rows, and compaction.

Data always goes to a folder of its own first.  A small pointer, written last and in one
file, makes it visible: a reader sees all of a run or version or nothing, and a job that was
lost in between leaves only a folder that nothing points to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.text import col, cols
from wattloom.operators.joins import join_null_safe
from wattloom.sources.writers import write_partitioned


class AuditFailed(ValueError):
    """Rows that an audit rejects; nothing of the run was published."""


def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def _exists(spark: SparkSession, path: str) -> bool:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        return not files.load(path).select("path").limit(1).isEmpty()
    except Exception as error:  # a path that is not there
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


@dataclass(frozen=True)
class RunTable:
    """A table that runs append to; a run is appended once, however often it is tried."""

    path: str
    by: tuple[str, ...] = ()

    def _pointers(self, spark: SparkSession) -> DataFrame | None:
        if not _exists(spark, f"{self.path}/runs"):
            return None
        schema = "folder string, schema string, run string"
        return spark.read.schema(schema).parquet(f"{self.path}/runs")

    def runs(self, spark: SparkSession) -> dict[str, tuple[str, T.StructType]]:
        """Published runs, their folders and schemas (one small file a run)."""
        pointers = self._pointers(spark)
        rows = pointers.collect() if pointers is not None else []
        return {r["run"]: (r["folder"], _schema(r["schema"])) for r in rows}

    def read(self, spark: SparkSession, runs: Sequence[str] | None = None) -> DataFrame:
        """Rows of the published runs, tagged ``run``; of unpublished folders nothing."""
        found = self.runs(spark)
        chosen = {r: f for r, f in found.items() if runs is None or r in runs}
        if not chosen:
            raise ValueError(f"no published run in {self.path}")
        out = None
        for run, (folder, schema) in sorted(chosen.items()):
            # the run is a literal of its folder: a filter on it reads no other folder
            part = spark.read.schema(schema).parquet(folder).withColumn("run", F.lit(run))
            out = part if out is None else out.unionByName(part)
        return out

    def append(
        self, df: DataFrame, run: str, audit: Callable[[DataFrame], DataFrame] | None = None
    ) -> bool:
        """Write, audit, publish; False and no work at all where the run is published already.

        ``audit`` gets the rows as written and returns those it rejects: any such row
        raises ``AuditFailed`` and the run stays unpublished.  Columns are matched by name.
        """
        spark = df.sparkSession
        published = self.runs(spark)
        if run in published:
            return False
        if published:
            names = next(iter(published.values()))[1].names
            if set(df.columns) != set(names):
                raise ValueError(f"columns differ from the table's: {sorted(set(df.columns) ^ set(names))}")
            df = df.select(*cols(names))
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        write_partitioned(df, folder, list(self.by), mode="errorifexists")
        if audit is not None:
            rejected = audit(spark.read.schema(df.schema).parquet(folder)).limit(5).collect()
            if rejected:
                raise AuditFailed(f"run {run} rejected by its audit, for example {rejected}")
        pointer = spark.createDataFrame([(folder, df.schema.json())], "folder string, schema string")
        # of two writers of one run the later pointer counts; either shows a whole run
        pointer.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/runs/run={run}")
        return True


@dataclass(frozen=True)
class VersionedTable:
    """Snapshots of a table in folders of ``by``; the newest complete pointer is the table."""

    path: str
    by: str

    def versions(self, spark: SparkSession) -> list[int]:
        if not _exists(spark, f"{self.path}/versions"):
            return []
        rows = self._pointers(spark).select("version").distinct().collect()
        return sorted(r["version"] for r in rows)

    def _pointers(self, spark: SparkSession) -> DataFrame:
        kind = "value string, root string, schema string, version int"
        return spark.read.schema(kind).parquet(f"{self.path}/versions")

    def _folders(self, spark: SparkSession, version: int | None) -> tuple[int, T.StructType, dict[str | None, str]]:
        every = self.versions(spark)
        if not every:
            raise ValueError(f"no version in {self.path}")
        chosen = every[-1] if version is None else version
        rows = self._pointers(spark).filter(col("version") == chosen).collect()
        return chosen, _schema(rows[0]["schema"]), {r["value"]: r["root"] for r in rows if r["root"] is not None}

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The newest version, or an older one."""
        _, schema, folders = self._folders(spark, version)
        roots: dict[str, list[str | None]] = {}
        for value, root in folders.items():
            roots.setdefault(root, []).append(value)
        out = None
        for root, values in sorted(roots.items()):
            table = spark.read.schema(schema).parquet(root)
            part = table.filter(self._is(values))  # pruned to these folders
            out = part if out is None else out.unionByName(part)
        return spark.createDataFrame([], schema) if out is None else out

    def _is(self, values: Sequence[str | None]):
        text = col(self.by).cast("string")
        hit = text.isin([v for v in values if v is not None])
        return hit | text.isNull() if None in values else hit

    def _publish(self, spark: SparkSession, version: int, schema: T.StructType, folders: dict[str | None, str]) -> int:
        # a version without rows has a pointer without a folder
        listed = [(value, root, schema.json()) for value, root in folders.items()] or [(None, None, schema.json())]
        rows = spark.createDataFrame(listed, "value string, root string, schema string")
        # another writer of the same version is refused, its snapshot stays
        rows.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/versions/version={version}")
        return version

    def create(self, df: DataFrame) -> int:
        """The first version, or a new one that replaces every row."""
        spark = df.sparkSession
        version = (self.versions(spark) or [0])[-1] + 1
        return self._publish(spark, version, df.schema, self._written(df))

    def _written(self, df: DataFrame) -> dict[str | None, str]:
        spark, root = df.sparkSession, f"{self.path}/data/{uuid.uuid4().hex}"
        write_partitioned(df, root, [self.by], mode="errorifexists")
        values = spark.read.schema(df.schema).parquet(root).select(col(self.by).cast("string").alias("v")).distinct().collect()
        return {r["v"]: root for r in values}

    def replace_rows(self, df: DataFrame, keys: Sequence[str]) -> int:
        """Rows of ``df`` in place of those with equal ``keys`` (NULLs are equal); others are added.

        Copy on write: only folders that hold such a key or receive a row are written anew, the
        others are taken over by the new pointer.  The version before stays readable.
        """
        spark = df.sparkSession
        version, schema, folders = self._folders(spark, None)
        now = self.read(spark, version)
        new = df.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        marked = new.select(*cols(keys)).distinct()
        held = join_null_safe(now, marked, keys, "left_semi")
        touched = held.select(col(self.by).cast("string").alias("v")).unionByName(
            new.select(col(self.by).cast("string").alias("v"))
        )
        values = [r["v"] for r in touched.distinct().collect()]
        if not values:
            return version
        kept = join_null_safe(now.filter(self._is(values)), marked, keys, "left_anti")
        written = self._written(kept.unionByName(new).select(*cols(schema.names)))
        rest = {v: root for v, root in folders.items() if v not in values}
        return self._publish(spark, version + 1, schema, {**rest, **written})


@dataclass(frozen=True)
class Compacted:
    """A table after ``compact_small``: files that were left alone, and the folder of new ones."""

    source: str
    kept: tuple[str, ...]
    path: str | None
    schema: T.StructType

    def read(self, spark: SparkSession) -> DataFrame:
        parts = []
        if self.kept:
            parts.append(spark.read.schema(self.schema).option("basePath", self.source).parquet(*self.kept))
        if self.path:
            parts.append(spark.read.schema(self.schema).parquet(self.path))
        if not parts:
            return spark.createDataFrame([], self.schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def small_files(spark: SparkSession, path: str, bound: int, target: int) -> DataFrame:
    """``path, file, folder, length, bin`` of the files to rewrite, from their sizes alone.

    ``file`` is the path as a scan reports it (with marks encoded).

    Files below ``bound`` bytes are packed, the smaller first, into bins of about ``target``
    bytes in each folder; a bin of one file is left alone.  No data is read.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        .load(path).select("path", "length", F.col("_metadata.file_path").alias("file")).filter(col("length") < bound)
        .withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    )
    order = Window.partitionBy("folder").orderBy("length", "path").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("length").over(order), F.lit(0))
    binned = files.withColumn("bin", F.floor(before / F.lit(target)))
    several = F.count(F.lit(1)).over(Window.partitionBy("folder", "bin")) > 1
    return binned.withColumn("several", several).filter("several").drop("several")


def compact_small(
    spark: SparkSession, path: str, out: str, by: Sequence[str] = (), bound: int = 64 << 20, target: int = 128 << 20
) -> Compacted:
    """Small part files of a table joined to larger ones in a new folder; all others stay as they are.

    Only files that ``small_files`` names are read.  The list of files reaches the driver
    (a path for each file, as in any read), their rows do not.  The source is not changed.
    """
    schema = spark.read.parquet(path).schema
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    every = [r["path"] for r in listing.load(path).select("path").collect()]
    bins = small_files(spark, path, bound, target).select("path", "file", "folder", "bin")
    chosen = [r["path"] for r in bins.select("path").collect()]
    kept = tuple(sorted(set(every) - set(chosen)))
    if not chosen:
        return Compacted(path, kept, None, schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*chosen)
    tagged = rows.select("*", F.col("_metadata.file_path").alias("__path"))
    # one row a small file
    dealt = bins.select(F.col("file").alias("__path"), F.struct("folder", "bin").alias("__bin"))
    placed = tagged.join(F.broadcast(dealt), "__path")
    one_file = placed.repartition("__bin").drop("__path", "__bin")
    writer = one_file.write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(out)
    return Compacted(path, kept, out, schema)
