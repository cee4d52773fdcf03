"""Exact deduplication against a persistent digest index.

The index is a Parquet table with one row per distinct text, bucketed and sorted
by its SHA-256 digest.  A batch is reduced to one row per digest (partial sums
before the shuffle, so a text held by a third of all rows costs one row per
task), anti-joined against the index by a sort-merge join that reads the index
without shuffling it, and appended.  Everything is DataFrame code.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm.common import free_name, new_path, quoted, text_or_empty, written

INDEX_SCHEMA = "digest BINARY, keep_id BIGINT, n BIGINT, batch STRING"


@dataclass(frozen=True)
class DigestIndex:
    """A digest index by its table name and folder.

    ``buckets`` is fixed for the life of the index: about its expected size
    divided by 200 MB.
    """

    table: str
    path: str
    buckets: int = 64

    def attach(self, spark: SparkSession) -> DigestIndex:
        """Make the table known to this session (existing files are used)."""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({INDEX_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )
        return self

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def append(self, groups: DataFrame) -> None:
        """Append distinct digests: one file per bucket, sorted."""
        (
            groups.repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.table)
        )


def new_index(spark: SparkSession, buckets: int = 64) -> DigestIndex:
    """An empty index in the shared folder."""
    name = f"digests_{uuid.uuid4().hex}"
    return DigestIndex(name, new_path(spark, "digests"), buckets).attach(spark)


def deduplicate(
    docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None
) -> DataFrame:
    """Add a batch of documents to the index and decide on each of its rows.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``, one row per row
    of ``docs``.  Texts are equal when identical; null counts as empty.  Of equal
    texts in the batch the row with the largest id stays, unless the index
    already holds the text: then none stays and ``keep_id`` is the indexed id.
    ``group_size`` counts the batch's rows with that text.  Null ids are smaller
    than all others; repeated rows with one id are one document and share its
    decision.  An empty batch leaves the index as it is.

    ``batch`` names the rows of this call for ever.  A second run under the same name, after
    a lost driver or a finished first run, gives the same decisions and appends only
    what the first run did not; another batch needs another name.  Without a name every
    call is a batch of its own.
    """
    thin, decided = _decide(docs, index, id_col, text_col, batch)
    return thin.join(decided, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _decide(
    docs: DataFrame, index: DigestIndex, id_col: str, text_col: str, batch: str | None
) -> tuple[DataFrame, DataFrame]:
    """The batch's ``doc_id, digest`` rows, and ``digest, group_size, keep_id, new``."""
    spark = docs.sparkSession
    batch = uuid.uuid4().hex if batch is None else batch
    thin = written(
        docs.select(
            quoted(id_col).cast("long").alias("doc_id"),
            F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("digest"),
        ),
        "digests-of-batch",
    )
    groups = thin.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    # what the index holds already, from this batch or others, is not appended again
    fresh = groups.join(index.read(spark).select("digest").hint("merge"), "digest", "left_anti")
    index.append(fresh.withColumn("batch", F.lit(batch)).select("digest", "keep_id", "n", "batch"))
    known = index.read(spark).select("digest", "keep_id", (F.col("batch") == batch).alias("new"))
    sizes = groups.select("digest", F.col("n").alias("group_size"))
    # written: a hot digest can then be split in the join with its rows
    return thin, written(sizes.join(known.hint("merge"), "digest"), "decisions")


def keep_new(
    docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one row for each new text.

    Rows are matched by digest and id, so ids need not be unique; of rows that
    repeat both, one stays.  ``batch`` as in ``deduplicate``; columns may have any names.
    """
    thin, decided = _decide(docs, index, id_col, text_col, batch)
    a, b = free_name(docs.columns, "a"), free_name(docs.columns, "b")
    stay = decided.filter("new").select(F.col("digest").alias(b), F.col("keep_id").alias(a))
    sha = F.unhex(F.sha2(text_or_empty(text_col), 256))
    same = quoted(id_col).cast("long").eqNullSafe(F.col(a)) & (sha == F.col(b))
    kept = docs.join(stay, same, "left_semi")
    repeated = thin.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if repeated.isEmpty():
        return kept
    keys = [quoted(id_col).cast("long").alias(a), sha.alias(b)]
    return kept.select("*", *keys).dropDuplicates([a, b]).drop(a, b)
