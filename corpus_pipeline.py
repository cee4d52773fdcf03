"""The corpus pipeline: documents through five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import exact_dedup, near_dedup, pack, quality, suffix_dedup
from wattloom.llm.common import new_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose learned quality reaches the threshold; all labels are learned from."""
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, model, name="__quality")
    return scored.filter(F.col("__quality") >= quality.THRESHOLD).drop("__quality")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.keep_new(docs, exact_dedup.new_index(spark), batch="documents")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, 80 %)."""
    return near_dedup.keep_one(docs, 5, 80)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that repeat anywhere; ``n_chars`` follows."""
    cut = suffix_dedup.remove_repeats(docs, 200)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids."""
    import public_tokenizers

    return pack.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048, 1)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("packing", pack_sequences),
]

# SQL cannot express a learned classifier, a tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
