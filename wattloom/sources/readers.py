"""Reading delimited text, Parquet and scenario JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wattloom.functions.text import col
from wattloom.operators.joins import rename

SEPARATORS = {".tsv": "\t", ".csv": ","}
# Columns that hold codes; they stay text whatever they look like.
TEXT_COLUMNS = ("upgrade",)


def separator(path: str) -> str:
    for suffix, sep in SEPARATORS.items():
        if path.endswith(suffix):
            return sep
    raise ValueError(f"expected a .tsv or .csv file: {path}")


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    text_columns: Sequence[str] = TEXT_COLUMNS,
) -> DataFrame:
    """A headed .tsv or .csv file.

    Without a schema the types are inferred (an extra pass; meant for the small
    mapping files), with integers widened to long and code columns kept as text.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", separator(path))
        .option("quote", '"')
        .option("escape", '"')
    )
    if schema is not None:
        return reader.schema(schema).csv(path)
    inferred = reader.option("inferSchema", True).csv(path).schema
    fields = []
    for f in inferred.fields:
        kind = f.dataType
        if f.name in text_columns or isinstance(kind, T.BooleanType):
            kind = T.StringType()
        elif isinstance(kind, T.IntegerType):
            kind = T.LongType()
        fields.append(T.StructField(f.name.lstrip("﻿"), kind, True))
    return reader.schema(T.StructType(fields)).csv(path)


def read_maps(
    spark: SparkSession, paths: Mapping[str, str] | Sequence[str]
) -> dict[str, DataFrame]:
    """Mapping files by name; a list of paths is named after the files."""
    if not isinstance(paths, Mapping):
        paths = {p.rsplit("/", 1)[-1].rsplit(".", 1)[0]: p for p in paths}
    return {name: read_delimited(spark, path) for name, path in paths.items()}


def read_measure_map(spark: SparkSession, path: str) -> DataFrame:
    """The measure map; its end-use column (``..._end_use``) is named ``end_use``."""
    df = read_delimited(spark, path)
    names = {n: "end_use" for n in df.columns if n.lower().endswith("_end_use")}
    return rename(df, names)


def read_documents(
    spark: SparkSession, paths: str | Sequence[str], name: str = "scenario"
) -> DataFrame:
    """Whole JSON documents, one row per file, tagged with the file's name.

    All scenarios are one read; a file is the smallest unit because a JSON
    object cannot be split.
    """
    files = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.text(files, wholetext=True)
    file_name = F.col("_metadata.file_name")
    stem = F.regexp_replace(file_name, r"\.[^.]*$", "")
    return df.select(col("value"), stem.alias(name))


def literal_table(
    spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType
) -> DataFrame:
    """A small inline table (hand-picked places, what-if map rows).

    Passed as an Arrow table it becomes a local relation whose size the
    optimiser knows; a list of rows would be an RDD of unknown size, and the
    fact table would be shuffled to meet it.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = struct.fieldNames()
    records = [dict(zip(names, row, strict=True)) for row in rows]
    table = pa.Table.from_pylist(records, schema=to_arrow_schema(struct))
    return spark.createDataFrame(table, struct)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the columns of ``schema``; missing ones become NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (col(f.name) if f.name in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )
