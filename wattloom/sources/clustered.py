"""Series and buildings stored so that they meet without a shuffle.

Both tables are bucketed by the building into the same number of buckets and sorted
inside.  Collapsing a building's readings and joining its attributes then happens in
the task that reads the bucket; only the sums by place leave it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wattloom.functions.text import col, cols


@dataclass(frozen=True)
class ClusteredTable:
    """A bucketed Parquet table by its name and folder.

    ``buckets`` is fixed for the life of the table: about its expected size divided by
    the size a task should read; tables that are joined have the same number.
    """

    name: str
    path: str
    by: tuple[str, ...]
    buckets: int
    sort: tuple[str, ...] = ()

    def write(self, df: DataFrame) -> ClusteredTable:
        """Replace the table by ``df``: one file a bucket, sorted by ``by`` and ``sort``."""
        order = [*self.by, *[c for c in self.sort if c not in self.by]]
        (
            df.repartition(self.buckets, *cols(self.by))
            .write.mode("overwrite")
            .format("parquet")
            .bucketBy(self.buckets, *self.by)
            .sortBy(*order)
            .option("path", self.path)
            .saveAsTable(self.name)
        )
        return self

    def attach(self, spark: SparkSession, schema: T.StructType) -> ClusteredTable:
        """Make an existing folder known to this session."""
        quoted = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        order = ", ".join(f"`{c}`" for c in [*self.by, *[c for c in self.sort if c not in self.by]])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({quoted}) USING parquet "
            f"CLUSTERED BY ({', '.join(f'`{c}`' for c in self.by)}) SORTED BY ({order}) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        return self

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


def write_pair(
    series: DataFrame, buildings: DataFrame, names: tuple[str, str], folder: str, on: str = "bldg_id",
    buckets: int = 64, time: str = "timestamp", keep: Sequence[str] = (),
) -> tuple[ClusteredTable, ClusteredTable]:
    """A series and its buildings in equal buckets of ``on``; the series sorted by time as well."""
    left = ClusteredTable(names[0], f"{folder}/{names[0]}", (on,), buckets, (time,))
    right = ClusteredTable(names[1], f"{folder}/{names[1]}", (on,), buckets)
    chosen = series.select(*cols(keep)) if keep else series
    return left.write(chosen.filter(col(on).isNotNull())), right.write(buildings.filter(col(on).isNotNull()))
