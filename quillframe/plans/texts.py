"""Words, vocabularies, encoded texts and the text classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillframe.operators import text as ops
from quillframe.operators.metrics import evaluate_scored
from quillframe.operators.splitting import stratified_split
from quillframe.plans.registry import query
from quillframe.plans.modelling import logistic_sql
from quillframe.plans.standins import REVIEWS_SQL, SEED, reviews, stratified_sql
from quillframe.sources.tables import load_table

VOCAB_SIZE = 5000
COUNTED_WORDS = 5  # few, since each is a column of the checking SQL

_WORDS = r"""words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS tokens FROM documents)"""


def _documents(spark, sf_dir):
    return load_table(spark, sf_dir, "documents").select("doc_id", "text")


@query(
    "tokenize",
    f"WITH {_WORDS} SELECT doc_id, len(tokens)::INT AS n_tokens,"
    " md5(array_to_string(tokens, ' ')) AS digest FROM words",
)
def tokenize(spark, sf_dir):
    tokens = ops.tokenize(_documents(spark, sf_dir))
    return tokens.select(
        "doc_id",
        F.size("tokens").alias("n_tokens"),
        F.md5(F.array_join("tokens", " ")).alias("digest"),
    )


_VOCAB = f"""{_WORDS},
counts AS (SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM words) GROUP BY 1),
vocab AS (SELECT token, n, (row_number() OVER (ORDER BY n DESC, token) + 1)::INT AS token_id
          FROM counts ORDER BY n DESC, token LIMIT {VOCAB_SIZE})"""


@query("build_vocab", f"WITH {_VOCAB} SELECT * FROM vocab")
def build_vocab(spark, sf_dir):
    return ops.build_vocab(_documents(spark, sf_dir), VOCAB_SIZE)


@query(
    "encode",
    f"""WITH {_VOCAB},
placed AS (SELECT doc_id, unnest(tokens[1:256]) AS token, unnest(range(1, least(len(tokens), 256) + 1))
                  AS pos FROM words),
ids AS (SELECT doc_id, string_agg(coalesce(token_id, 1)::VARCHAR, ' ' ORDER BY pos) AS ids
        FROM placed LEFT JOIN vocab USING (token) GROUP BY 1)
SELECT doc_id, trim(coalesce(ids, '') || repeat(' 0', 256 - least(len(tokens), 256)::INT)) AS input_ids,
       trim(repeat('1 ', least(len(tokens), 256)::INT) || repeat('0 ', 256 - least(len(tokens), 256)::INT))
       AS attention_mask
FROM words LEFT JOIN ids USING (doc_id)""",
)
def encode(spark, sf_dir):
    documents = _documents(spark, sf_dir)
    vocab = ops.build_vocab(documents, VOCAB_SIZE)
    encoded = ops.encode(documents, vocab, ["doc_id"])
    return encoded.select(
        "doc_id",
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.array_join(F.col("attention_mask").cast("array<string>"), " ").alias("attention_mask"),
    )


@query(
    "token_length_stats",
    f"""WITH {_WORDS}, lengths AS (SELECT len(tokens) AS n FROM words)
SELECT count(*) AS n_texts, round(avg(n), 6) AS avg_tokens, max(n)::BIGINT AS max_tokens,
       sum(n)::BIGINT AS total_tokens, count(*) FILTER (n > 256) AS n_truncated,
       round(avg((n > 256)::INT), 6) AS share_truncated
FROM lengths""",
)
def token_length_stats(spark, sf_dir):
    stats = ops.token_length_stats(_documents(spark, sf_dir))
    return stats.withColumns({c: F.round(c, 6) for c in ("avg_tokens", "share_truncated")})


def _split_reviews(spark, sf_dir):
    table = reviews(spark, sf_dir).select("doc_id", "text", "label")
    parted = stratified_split(table, 0.2, "label", ["doc_id"], SEED)
    return (parted.where(F.col("split") == side).drop("split") for side in ("train", "test"))


@query("fit_text_classifier")
def fit_text_classifier(spark, sf_dir):
    train, test = _split_reviews(spark, sf_dir)
    model = ops.fit_text_classifier(train)
    scored = ops.predict_sentiment(test.withColumn("y", F.col("label")), model)
    scored = scored.withColumn("pred", (F.col("positive_prob") > 0.5).cast("int"))
    return evaluate_scored(scored, "words", "y", "pred", "positive_prob")


@query("predict_sentiment")
def predict_sentiment(spark, sf_dir):
    train, _ = _split_reviews(spark, sf_dir)
    model = ops.fit_text_classifier(train)
    return ops.predict_sentiment(load_table(spark, sf_dir, "benchmark"), model)


_PLACES = range(1, COUNTED_WORDS + 1)
_COUNTED = rf"""{REVIEWS_SQL}, {stratified_sql('reviews', 'label', 'doc_id')},
worded AS (SELECT doc_id, label, split, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS tokens
           FROM parted),
said AS (SELECT doc_id, split, unnest(tokens) AS token FROM worded),
counts AS (SELECT token, count(*) AS n FROM said WHERE split = 'train' GROUP BY 1),
places AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS place FROM counts),
vocab AS (SELECT {', '.join(f'max(token) FILTER (place = {i}) AS t{i}' for i in _PLACES)} FROM places),
counted AS (SELECT worded.doc_id, any_value(label) AS label, any_value(worded.split) AS split,
                   {', '.join(f'count(*) FILTER (token = t{i})::DOUBLE AS n{i}' for i in _PLACES)}
            FROM worded LEFT JOIN said ON said.doc_id = worded.doc_id CROSS JOIN vocab GROUP BY 1),
shares AS (SELECT doc_id, label, split, {', '.join(
    f"n{i} / greatest({' + '.join(f'n{j}' for j in _PLACES)}, 1) AS s{i}" for i in _PLACES)} FROM counted),
train AS MATERIALIZED (SELECT * FROM shares WHERE split = 'train'),
{logistic_sql('train', [f's{i}' for i in _PLACES], 'fit')}"""
_WORD_SCORE = " + ".join(["w0", *[f"w{i} * s{i}" for i in _PLACES]])


@query(
    "fit_counted_classifier",
    f"WITH {_COUNTED} "
    + " UNION ALL ".join(
        f"SELECT t{i} AS token, round(w{i}, 3) AS weight FROM fit CROSS JOIN vocab" for i in _PLACES
    ),
)
def fit_counted_classifier(spark, sf_dir):
    """Weights of the most frequent words for the label."""
    train, _ = _split_reviews(spark, sf_dir)
    weights = ops.word_weights(spark, ops.fit_counted_classifier(train, COUNTED_WORDS))
    return weights.withColumn("weight", F.round("weight", 3))


@query(
    "predict_sentiment_counted",
    f"""WITH {_COUNTED},
told AS (SELECT doc_id, 1::DOUBLE / (1::DOUBLE + exp(-({_WORD_SCORE}))) AS p
         FROM shares CROSS JOIN fit WHERE split = 'test')
SELECT doc_id, CASE WHEN p > 0.5 THEN 'Positive' ELSE 'Negative' END AS label,
       round(greatest(p, 1 - p), 3) AS confidence, round(p, 3) AS positive_prob,
       round(1 - p, 3) AS negative_prob FROM told""",
)
def predict_sentiment_counted(spark, sf_dir):
    """Every test text by the shares of the most frequent words."""
    train, test = _split_reviews(spark, sf_dir)
    told = ops.predict_sentiment(test, ops.fit_counted_classifier(train, COUNTED_WORDS))
    probs = ("confidence", "positive_prob", "negative_prob")
    return told.select("doc_id", "label", *[F.round(c, 3).alias(c) for c in probs])


@query(
    "encode_labelled",
    f"""WITH {_VOCAB},
placed AS (SELECT doc_id, unnest(tokens[1:256]) AS token, unnest(range(1, least(len(tokens), 256) + 1))
                  AS pos FROM words),
ids AS (SELECT doc_id, string_agg(coalesce(token_id, 1)::VARCHAR, ' ' ORDER BY pos) AS ids
        FROM placed LEFT JOIN vocab USING (token) GROUP BY 1)
SELECT doc_id, toxic AS label,
       trim(coalesce(ids, '') || repeat(' 0', 256 - least(len(tokens), 256)::INT)) AS input_ids,
       least(len(tokens), 256)::INT AS n_real
FROM words JOIN labels USING (doc_id) LEFT JOIN ids USING (doc_id)""",
)
def encode_labelled(spark, sf_dir):
    """Labelled texts as ids with their label, ready to train on."""
    vocab = ops.build_vocab(_documents(spark, sf_dir), VOCAB_SIZE)
    labelled = reviews(spark, sf_dir).select("doc_id", "text", "label")
    encoded = ops.encode(labelled, vocab, ["doc_id"], carry=["label"])
    return encoded.select(
        "doc_id",
        "label",
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, b: a + b).alias("n_real"),
    )
