"""A training-corpus pipeline: each stage calls one operator on all that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.llm import exact, mixing, packing, quality, simhash
from quillframe.llm.queries import KEEP_SCORE, ROOM, quality_model, table, tokenizer_file
from quillframe.sources.artifacts import shared_path

# ``docs`` of a stage is read from written files, so its rows are known by file and place.
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects; unlabelled and empty texts are scored like others."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.keep_quality(docs, model, KEEP_SCORE)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of texts equal but for white space: of the most code points, then
    of least doc_id, null ids last. Null and empty texts are one group; repeated rows leave one; an
    empty table stays empty."""
    return exact.drop_exact_duplicates(docs, at_rest=True)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the least doc_id of each group of fingerprints at most 4 bits apart, null ids last. Texts
    without words, null ones too, are one group; of equal ids one row stays; an empty table stays
    empty."""
    return simhash.drop_near_duplicates(docs, at_rest=True, shingle=4, bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their targets; rows in training order. A
    null source is one of its own; texts without words are in no pass; an empty table stays empty."""
    return mixing.mixed_documents(docs, at_rest=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences; a document read twice is packed twice, a null or empty text
    is its end id alone, and an empty table gives no sequences."""
    packed = packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"), ROOM, end_id=0)
    return packed.withColumnRenamed("key", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact),
    ("SimHash near-dedup", drop_near),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

# A fitted network, fingerprint links and an evolved packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again. Columns may be any besides those
    of the table; what a stage does with nulls, ties and repeated rows it says itself."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = shared_path(spark, f"stage{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
