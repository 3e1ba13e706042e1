"""The given tables in the roles of the usual example datasets, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.functions.hashing import hash_unit
from quillframe.operators.cleaning import inject_duplicates, inject_nulls
from quillframe.sources.tables import load_table

# The seed, the shares of values lost, and the rows repeated.
SEED = 42
LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
NULL_SHARES = dict(zip(FEATURES, (0.05, 0.03, 0.04, 0.02), strict=True))
N_DUPLICATES = 50
MEDIAN_VALUE = 34.59  # events.value


# --- Spark -----------------------------------------------------------------------------------


def lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Order lines: key, four numeric features, the net price as target."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    table = load_table(spark, sf_dir, "lineitem")
    return table.select(*LINE_KEY, *FEATURES, net.alias("net"), *more)


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoiled = inject_nulls(lines(spark, sf_dir), NULL_SHARES, LINE_KEY, SEED)
    return inject_duplicates(spoiled, N_DUPLICATES, LINE_KEY, SEED)


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with a true class and the score of a fixed rule, in place of a model."""
    table = load_table(spark, sf_dir, "lineitem")
    y = (F.col("l_returnflag") == "R").cast("int")
    prob = (hash_unit(LINE_KEY, SEED, "score") + 0.3 * y) / 1.3
    scored = table.select(
        *LINE_KEY, "l_returnflag", "l_linestatus", "l_quantity", y.alias("y"), prob.alias("prob")
    )
    return scored.withColumn("pred", (F.col("prob") >= 0.5).cast("int"))


def priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the net price and a rule's guess at it, which leaves the tax out."""
    guess = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return lines(spark, sf_dir).select(*LINE_KEY, "net", guess.alias("guess"))


def classed_lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Order lines with a class to learn: is the net price, blurred by noise, above 45,000?"""
    noise = (hash_unit(LINE_KEY, SEED, "class") - 0.5) * 30_000
    return lines(spark, sf_dir, *more).withColumn("label", (F.col("net") + noise > 45_000).cast("int"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 64 columns, with the parity of their label as class."""
    table = load_table(spark, sf_dir, "embeddings")
    return table.select(
        "vec_id",
        *[F.col("embedding")[i].cast("double").alias(f"v{i}") for i in range(64)],
        (F.col("label") % 2).alias("label"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents; label 1 = toxic."""
    documents = load_table(spark, sf_dir, "documents")
    labels = load_table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id").select(
        "doc_id", "text", "lang", "source", F.col("toxic").alias("label"), "quality"
    )


def scored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a fixed rule's class, and their language as group."""
    said = hash_unit(["doc_id"], SEED, "score") + 0.3 * F.col("label") >= 0.6
    return reviews(spark, sf_dir).select(
        "doc_id", "lang", F.col("label").alias("y"), said.cast("int").alias("pred")
    )


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a training log: a run per event type, an epoch per day, a step per event."""
    return load_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"),
        F.dayofmonth("ts").alias("epoch"),
        "ts",
        "event_id",
        F.col("value").alias("loss"),
        (F.col("value") > MEDIAN_VALUE).cast("int").alias("correct"),
        F.lit(1).alias("total"),
    )


# --- SQL -------------------------------------------------------------------------------------

KEYS_SQL = ", ".join(LINE_KEY)
FEATURES_SQL = ", ".join(FEATURES)


def hash_sql(tag: str, keys: str = KEYS_SQL) -> str:
    return f"md5(concat_ws('|', {keys}, '{tag}', '{SEED}'))"


def unit_sql(tag: str, keys: str = KEYS_SQL) -> str:
    return f"(('0x' || substr({hash_sql(tag, keys)}, 1, 8))::UBIGINT)::DOUBLE / 4294967296.0"


LINES_SQL = f"""lines AS (
  SELECT {KEYS_SQL}, {FEATURES_SQL}, l_returnflag, l_linestatus,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS net
  FROM lineitem)"""

CLASSED_SQL = f"""{LINES_SQL},
classed AS (SELECT *, (net + ({unit_sql('class')} - 0.5::DOUBLE) * 30000::DOUBLE > 45000::DOUBLE)::INT
                   AS label FROM lines)"""


def stratified_sql(table: str, label: str, keys: str) -> str:
    """CTEs ending in ``parted``: ``table`` with its side by rank inside each class."""
    return f"""k AS (SELECT {label}, count(*) AS n FROM {table} GROUP BY 1),
t AS (SELECT *, ceil((SELECT sum(n) FROM k)::DOUBLE * 0.2::DOUBLE) AS wanted,
             n * ceil((SELECT sum(n) FROM k)::DOUBLE * 0.2::DOUBLE)
             / (SELECT sum(n) FROM k)::DOUBLE AS share FROM k),
f AS (SELECT *, floor(share) AS base,
             row_number() OVER (ORDER BY round(share - floor(share), 9) DESC, {label}) AS place
      FROM t),
a AS (SELECT {label}, base + (place <= wanted - (SELECT sum(base) FROM f))::INT AS target FROM f),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {hash_sql('split', keys)})
                     AS place FROM {table}),
parted AS (SELECT ranked.*, CASE WHEN place <= target THEN 'test' ELSE 'train' END AS split
           FROM ranked JOIN a USING ({label}))"""


_BLANKED = ", ".join(
    f"CASE WHEN {unit_sql('null/' + c)} >= {share} THEN {c} END AS {c}"
    for c, share in NULL_SHARES.items()
)
DIRTY_SQL = f"""{LINES_SQL},
spoiled AS (SELECT {KEYS_SQL}, {_BLANKED}, net FROM lines),
again AS (SELECT * FROM spoiled ORDER BY {hash_sql('sample')}, {KEYS_SQL} LIMIT {N_DUPLICATES}),
dirty AS (SELECT * FROM spoiled UNION ALL SELECT * FROM again),
uniq AS (SELECT DISTINCT * FROM dirty)"""

SCORED_SQL = f"""scored0 AS (
  SELECT {KEYS_SQL}, l_returnflag, l_linestatus, l_quantity,
         (l_returnflag = 'R')::INT AS y, {unit_sql('score')} AS u
  FROM lineitem),
scored1 AS (SELECT *, (u + 0.3::DOUBLE * y) / 1.3::DOUBLE AS prob FROM scored0),
scored AS (SELECT *, (prob >= 0.5)::INT AS pred FROM scored1)"""

PRICED_SQL = f"""{LINES_SQL},
priced AS (SELECT {KEYS_SQL}, net, l_extendedprice * (1 - l_discount) AS guess FROM lines)"""

REVIEWS_SQL = f"""reviews AS (
  SELECT d.doc_id, d.text, d.lang, d.source, l.toxic AS label, l.quality
  FROM documents d JOIN labels l USING (doc_id)),
scored AS (
  SELECT doc_id, lang, label AS y,
         ({unit_sql('score', 'doc_id')} + 0.3::DOUBLE * label >= 0.6)::INT AS pred
  FROM reviews)"""

LOG_SQL = f"""log AS (
  SELECT event_type AS run, day(ts)::INT AS epoch, ts, event_id, value AS loss,
         (value > {MEDIAN_VALUE})::INT AS correct, 1 AS total
  FROM events)"""
