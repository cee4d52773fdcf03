"""Writing partitioned Parquet and delimited extracts.

Every partitioned write asks for ``REBALANCE`` on its folder columns: rows of
one folder meet in few tasks, small folders share a task, and a hot folder (one
state with a third of the rows) is split by size, so no task grows with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from wattloom.functions.text import col, cols


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    mode: str = "overwrite",
    sort: Sequence[str] = (),
    compression: str = "snappy",
) -> None:
    """Parquet in folders ``by``; an overwrite replaces the whole table.

    Folders of an earlier run go as well, whatever the session's overwrite mode:
    a rerun without a scenario or year must not read back its old rows.
    ``sort`` clusters rows inside a file, so that row-group statistics prune on
    those columns.  File size follows the session's advisory partition size.
    """
    laid_out = df.hint("rebalance", *cols(by)) if by else df.hint("rebalance")
    if sort:
        laid_out = laid_out.sortWithinPartitions(*cols([*by, *sort]))
    writer = laid_out.write.mode(mode).option("compression", compression)
    writer = writer.option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def append_by_name(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Append to a Parquet table; columns are matched by name, never by position."""
    table = df.sparkSession.read.parquet(path)
    aligned = df.select(*cols(table.columns))
    writer = aligned.write.mode("append")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite only the folders ``df`` has rows for (idempotent reruns)."""
    (
        df.hint("rebalance", *cols(by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def export_per_key(df: DataFrame, path: str, key: str, folder: str) -> None:
    """One folder per key value (one write, not one query per key)."""
    write_partitioned(df.withColumn(folder, col(key)), path, [folder])


def compact(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Many part files rewritten as one file per folder.

    Only a folder larger than the advisory partition size gets more than one.
    The result goes to a new path; the source is left alone.
    """
    write_partitioned(df, path, by, mode="errorifexists")


def write_extract(
    df: DataFrame, path: str, sep: str = ",", order: Sequence[str] = ()
) -> None:
    """A headed delimited extract of a result.

    Written by as many tasks as the result has partitions; with ``order`` the
    files are range-sorted, so their concatenation is sorted.  Quotes inside a text
    are doubled, as ``read_delimited`` expects them.
    """
    out = df.orderBy(*cols(order)) if order else df
    writer = out.write.mode("overwrite").option("header", True).option("sep", sep)
    writer.option("quote", '"').option("escape", '"').csv(path)


def write_both(df: DataFrame, folder: str, name: str) -> None:
    """The same table as CSV and as Parquet."""
    write_extract(df, f"{folder}/{name}_csv")
    df.write.mode("overwrite").parquet(f"{folder}/{name}_parquet")
