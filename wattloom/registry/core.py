"""Registration and the base tables shared by the queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.text import col
from wattloom.session import tune
from wattloom.sources.readers import literal_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The driver's Parquet tables of one scale, read on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder
        self._read: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._read:  # a footer is read once per query
            path = f"{self.folder}/{name}.parquet"
            self._read[name] = self.spark.read.parquet(path)
        return self._read[name]

    def literal(self, rows, schema: str) -> DataFrame:
        return literal_table(self.spark, rows, schema)

    def places(self) -> DataFrame:
        """County (customer) with its state (nation)."""
        return self("customer").join(
            self("nation").select(
                col("n_nationkey").alias("c_nationkey"), col("n_name").alias("state")
            ),
            "c_nationkey",
        )

    def orders(self) -> DataFrame:
        """Orders with the customer's state and segment."""
        placed = self.places().select(
            col("c_custkey").alias("o_custkey"), "state", "c_mktsegment", "c_acctbal"
        )
        return self("orders").join(placed, "o_custkey").withColumnRenamed(
            "o_custkey", "county"
        )

    def lines(self) -> DataFrame:
        """Line items with everything known about their order."""
        return self("lineitem").join(
            self.orders().withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey"
        )


# The same base tables as SQL common table expressions.
PLACES_SQL = """
places AS (
  SELECT c_custkey AS county, n_name AS state, c_mktsegment, c_acctbal
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
ORDERS_SQL = (
    PLACES_SQL
    + """,
placed_orders AS (
  SELECT o.*, p.* FROM orders o JOIN places p ON o.o_custkey = p.county)"""
)
LINES_SQL = (
    ORDERS_SQL
    + """,
lines AS (
  SELECT l.*, o.* FROM lineitem l JOIN placed_orders o ON l.l_orderkey = o.o_orderkey)"""
)


def query(name: str, sql: str | None = None):
    """Register a query function ``f(tables)`` and its SQL text."""

    def wrap(func: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return func(Tables(spark, folder))

        run.__name__ = name
        run.__doc__ = func.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return func

    return wrap


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round the named columns; sums of doubles depend on the order of addition."""
    return df.select(
        *[
            F.round(col(n), digits[n]).alias(n) if n in digits else col(n)
            for n in df.columns
        ]
    )


def nudged(df: DataFrame, name: str) -> DataFrame:
    """Move exact decimal ties off the rounding boundary.

    Engines round a tie such as 0.00005 by the double or by its decimal text;
    the SQL text multiplies by the same ``1 + 1e-12``.
    """
    return df.withColumn(name, col(name) * (1 + 1e-12))
