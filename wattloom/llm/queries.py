"""The registered queries of this package and their SQL texts, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import (
    align, ann, bpe, chat, exact_dedup, langid, lm, near_dedup, negatives, pack, quality, suffix_dedup, toxicity,
)
from wattloom.llm.common import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(func):
        QUERIES[name] = func
        if sql is not None:
            ORACLE[name] = sql.strip()
        return func

    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    "op5_chat",
    r"""
WITH rows AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok'
  FROM (VALUES (0), (1)) v(k)),
marked AS (
  SELECT *, role IS DISTINCT FROM LAG(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS begins,
    length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</', '<\/')) AS safe,
    length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</', '<\/'), ':', '\:')) AS safe_role
  FROM rows)
SELECT conv_id, COUNT(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(SUM(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(COALESCE(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(SUM(safe + 7 + CASE WHEN begins THEN safe_role + 7 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
""",
)
def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Format every conversation, and one that holds the template's own marks."""
    text = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text")
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    done = chat.format_chats(rows.unionByName(probe))
    turns = done.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn(
        "loss", chat.trained_text(F.col("segments"))
    )
    spelled = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spelled, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query(
    "op8_exact_dedup",
    """
WITH t AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents),
g AS (SELECT text, MAX(doc_id) AS keep_id, COUNT(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM t JOIN g USING (text)
""",
)
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents against a new index."""
    return exact_dedup.deduplicate(table(spark, folder, "documents"), exact_dedup.new_index(spark), batch="documents")


def _tokens(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_pack")
def op1_pack(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    got = pack.pack(table(spark, folder, "documents"), _tokens("byte_bpe_50k.json"), 2048, 1, with_ids=False)
    return got.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op4_quality")
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document; a quarter of the ids is never learned from."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.learn(docs, labels.filter(fold(F.col("doc_id"), 4) != 2))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op7_langid")
def op7_langid(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document; a third of the ids is never learned from."""
    docs = table(spark, folder, "documents")
    model = langid.learn(docs.filter(fold(F.col("doc_id"), 3) != 1))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op9_bpe")
def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return bpe.digests(table(spark, folder, "documents"), _tokens("byte_bpe_50k.tiktoken"))


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Strings of 200 bytes that repeat anywhere in all documents."""
    return suffix_dedup.summary(table(spark, folder, "documents"), 200)


@query("op3_lm_score")
def op3_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """All documents under a model of six sevenths of them."""
    return lm.score_texts(table(spark, folder, "documents"), 7, 2)


@query("op6_near_dedup")
def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose four-word shingle sets are 80 % alike."""
    return near_dedup.find_groups(table(spark, folder, "documents"), 4, 80)


@query("op10_ann")
def op10_ann(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query(
    "op11_negatives",
    """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS vec_id, o.label = a.label AS same,
    CAST(list_dot_product(a.q, o.q) AS BIGINT) AS score
  FROM v a JOIN v o ON a.vec_id % 100 = 0 AND o.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) <= 5
""",
)
def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector and each of its five positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", label)
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0)


@query("op12_toxicity")
def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document; a quarter of the ids is never learned from."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.learn(docs, labels.filter(fold(F.col("doc_id"), 4) != 2))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op13_align")
def op13_align(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens by two tokenizers, grouped at shared cuts and linked."""
    docs = table(spark, folder, "documents")
    return align.link_quality(docs, _tokens("byte_bpe_50k.json"), _tokens("piece_bpe_32k.model"))
