"""The registered queries of this package, with SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.llm import (
    dialogue,
    exact,
    licences,
    mixing,
    ngrams,
    packing,
    quality,
    sentencepieces,
    simhash,
    token_files,
    tokens,
    topk,
    whitening,
)
from quillframe.llm.rows import hash_below_mod

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
KEEP_SCORE = 0.3
TOKEN_LIMIT = 512
ROOM = 2048
# Workers give large blocks back to the system when they are done with them.
WORKER_MEMORY = {
    "MALLOC_MMAP_THRESHOLD_": str(8 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(64 << 20),
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies, here and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Workers import this package; tell them where it lies, in case it is not installed there.
    for setting, value in {"PYTHONPATH": ROOT, **WORKER_MEMORY}.items():
        spark.sparkContext.environment.setdefault(setting, value)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.QualityModel:
    """Fitted on labelled rows whose crc32(doc_id as text) mod 5 is not 0."""
    return quality.fit_quality(docs, labels, usable=hash_below_mod(F.col("doc_id"), 5) != 0)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"), shingle=4, bits=4)
    return groups.select(
        F.col("key").alias("doc_id"),
        simhash.fingerprint_text(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokens.token_counts(docs, tokenizer_file("byte_bpe_50k.json"), TOKEN_LIMIT)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    packed = packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"), ROOM, end_id=0)
    return packed.withColumnRenamed("key", "doc_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("key").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id",
        (hash_below_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= KEEP_SCORE, 1).otherwise(0).alias("predicted"),
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    read = token_files.token_digests(docs, tokenizer_file("word_bpe_49k.json"), end_id=2)
    return read.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"))
    taken = mixing.taken_words(plan)
    return taken.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = hash_below_mod(F.col("doc_id"), 7) == 2
    model = ngrams.train(docs.where(~held_out))
    return ngrams.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digests = sentencepieces.piece_digests(docs, tokenizer_file("piece_bpe_32k.model"))
    return digests.withColumnRenamed("key", "doc_id")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitening.whitened_components(whitened).withColumnRenamed("key", "vec_id")


def op13_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaired = dialogue.repair(table(spark, sf_dir, "conversations"), hurt=True)
    return repaired.withColumnRenamed("conv", "conv_id")


OP4_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(q.ints, c.ints) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_licences,
        op3_token_counts,
        op4_topk,
        op5_packing,
        op6_exact_dedup,
        op7_quality,
        op8_token_files,
        op9_mixing,
        op10_lm_score,
        op11_pieces,
        op12_whitening,
        op13_dialogue,
    )
}

ORACLES = {"op4_topk": OP4_SQL, "op6_exact_dedup": OP6_SQL}
