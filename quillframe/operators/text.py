"""Words, vocabularies, padded ids, and a linear classifier of texts.

Subword tokens and a fine-tuned transformer need a ready vocabulary and weights; here words, a
vocabulary counted from the texts and a linear model take their place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizerModel, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillframe.functions.scalars import map_codes
from quillframe.operators.joins import join_small
from quillframe.operators.models import logistic_estimator, training_rows

WORD = r"[\p{L}\p{N}]+"
PAD_ID = 0
UNKNOWN_ID = 1
FIRST_WORD_ID = 2
MAX_LENGTH = 256
SENTIMENTS = {0: "Negative", 1: "Positive"}


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def tokenize(df: DataFrame, text: str = "text", output: str = "tokens") -> DataFrame:
    return df.withColumn(output, words(F.col(text)))


def build_vocab(df: DataFrame, size: int, text: str = "text") -> DataFrame:
    """The ``size`` most frequent words: (token, n, token_id); ties go by spelling."""
    counts = (
        df.select(F.explode(words(F.col(text))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    kept = counts.orderBy(F.desc("n"), "token").limit(size)
    rank = F.row_number().over(W.orderBy(F.desc("n"), "token"))
    return kept.select("token", "n", (rank + (FIRST_WORD_ID - 1)).alias("token_id"))


def encode(
    df: DataFrame,
    vocab: DataFrame,
    key: Sequence[str],
    text: str = "text",
    max_len: int = MAX_LENGTH,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Texts as ``max_len`` word ids and a mask of the real ones; ``key`` identifies a text.

    Columns named in ``carry``, as a label, stay beside their text. A text is cut to ``max_len`` words. Its words are looked up by a join and gathered again in
    one list of at most ``max_len`` ids, put together before the shuffle.
    """
    cut = df.select(*key, *carry, F.slice(words(F.col(text)), 1, max_len).alias("_words"))
    placed = cut.select(*key, *carry, F.posexplode_outer("_words").alias("_pos", "token"))
    known = join_small(placed, vocab.select("token", "token_id"), ["token"], "left")
    entry = F.struct("_pos", F.coalesce("token_id", F.lit(UNKNOWN_ID)).alias("id"))
    gathered = known.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.when(F.col("_pos").isNotNull(), entry))).alias("_entries"),
        *[F.any_value(c).alias(c) for c in carry],
    )
    ids = gathered.select(*key, *carry, F.col("_entries.id").alias("_ids"))
    fill = F.lit(max_len) - F.size("_ids")
    return ids.select(
        *key,
        *carry,
        F.concat("_ids", F.array_repeat(F.lit(PAD_ID), fill)).alias("input_ids"),
        F.concat(
            F.array_repeat(F.lit(1), F.size("_ids")), F.array_repeat(F.lit(0), fill)
        ).alias("attention_mask"),
    )


def token_length_stats(df: DataFrame, text: str = "text", max_len: int = MAX_LENGTH) -> DataFrame:
    """Words per text, and how many texts an encoding to ``max_len`` cuts."""
    lengths = df.select(F.size(words(F.col(text))).alias("_n"))
    return lengths.agg(
        F.count("*").alias("n_texts"),
        F.avg("_n").alias("avg_tokens"),
        F.max("_n").cast("long").alias("max_tokens"),
        F.sum("_n").alias("total_tokens"),
        F.count_if(F.col("_n") > max_len).alias("n_truncated"),
        F.avg((F.col("_n") > max_len).cast("double")).alias("share_truncated"),
    )


def text_classifier(
    text: str = "text", label: str = "label", features: int = 1 << 14, reg: float = 0.01
) -> Pipeline:
    """Words, hashed counts, inverse document frequency, logistic regression."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=WORD, gaps=False),
            HashingTF(inputCol="_tokens", outputCol="_counts", numFeatures=features),
            IDF(inputCol="_counts", outputCol="features"),
            LogisticRegression(labelCol=label, featuresCol="features", regParam=reg),
        ]
    )


def fit_text_classifier(
    df: DataFrame,
    text: str = "text",
    label: str = "label",
    features: int = 1 << 14,
    reg: float = 0.01,
) -> PipelineModel:
    """Fit on labelled texts; a NULL text has no words. Words share ``features`` hashed places."""
    rows = df.select(
        F.coalesce(text, F.lit("")).alias("_text"), F.col(label).cast("double").alias(label)
    ).where(F.col(label).isNotNull())
    with training_rows(rows) as (train, _):
        return text_classifier("_text", label, features, reg).fit(train)


def fit_counted_classifier(
    df: DataFrame, size: int, text: str = "text", label: str = "label", c: float = 1.0
) -> PipelineModel:
    """Fit on the shares of the ``size`` most frequent words, each a place of its own.

    A NULL text has no words, and a text without known words is all zeros; rows without a label are
    left out. Only the ``size`` words of the vocabulary come to the driver. Texts without any word
    at all cannot be fitted.
    """
    rows = df.select(
        F.coalesce(text, F.lit("")).alias("_text"), F.col(label).cast("double").alias(label)
    ).where(F.col(label).isNotNull())
    with training_rows(rows) as (train, n):
        known = build_vocab(train, size, "_text").orderBy("token_id").select("token")
        vocabulary = [r.token for r in known.toLocalIterator()]
        if not vocabulary:
            raise ValueError("no words to fit on")
        counter = CountVectorizerModel.from_vocabulary(vocabulary, "_tokens", "_counts")
        stages = [
            RegexTokenizer(inputCol="_text", outputCol="_tokens", pattern=WORD, gaps=False),
            counter,
            Normalizer(p=1.0, inputCol="_counts", outputCol="features"),
            logistic_estimator(n, c, label=label),
        ]
        return Pipeline(stages=stages).fit(train)


def word_weights(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(token, weight) of a classifier of counted words: above 0 speaks for class 1."""
    words_ = model.stages[1].vocabulary
    weights = model.stages[-1].coefficients.toArray()
    pairs = [(w, float(x)) for w, x in zip(words_, weights, strict=True)]
    return spark.createDataFrame(pairs, "token string, weight double")


def predict_sentiment(
    df: DataFrame, model: PipelineModel, names: dict[int, str] = SENTIMENTS, text: str = "text"
) -> DataFrame:
    """Add label, confidence, positive_prob and negative_prob to each text; NULL has no words."""
    readable = df.withColumn("_text", F.coalesce(text, F.lit("")))
    scored = model.transform(readable).withColumn("_p", vector_to_array("probability"))
    return scored.select(
        *[c for c in df.columns if c != "label"],
        map_codes(F.col("prediction").cast("int"), names).alias("label"),
        F.array_max("_p").alias("confidence"),
        F.col("_p")[1].alias("positive_prob"),
        F.col("_p")[0].alias("negative_prob"),
    )
