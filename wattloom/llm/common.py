"""Shared folders, written intermediate tables and small column helpers."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.session import shared_folder


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks of one stage, and Python
    work below is not repeated by the branches above.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written intermediate tables of one operator, removed once its result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame, tag: str) -> DataFrame:
        path = new_path(self.spark, tag)
        df.write.option("compression", "zstd").parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        context = self.spark.sparkContext
        for name in self.paths:
            path = context._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        self.paths = []


def text_or_empty(name: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def quoted(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(taken: Iterable[str], wish: str) -> str:
    """``wish``, with marks added until no name of ``taken`` is equal to it in any case."""
    used, name = {t.lower() for t in taken}, f"__{wish}"
    while name.lower() in used:
        name += "_"
    return name


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids count as empty text."""
    key = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % F.lit(modulus)


def text_key(text: Column) -> Column:
    """128 bits that stand for a text, in two longs."""
    return F.struct(
        F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")
    )
