from __future__ import annotations

import pytest
from conftest import SF_SMALL, rows_of
from pyspark.sql import functions as F

from quillframe.operators import text as ops
from quillframe.plans.standins import reviews


@pytest.fixture
def texts(table):
    return table(
        [(1, "The cat, the DOG!"), (2, "dog été 42"), (3, ""), (4, None), (5, "zebra the")],
        "id int, text string",
    )


def test_tokens_keep_letters_and_digits(texts):
    tokens = {r.id: r.tokens for r in ops.tokenize(texts).collect()}
    assert tokens == {
        1: ["the", "cat", "the", "dog"], 2: ["dog", "été", "42"], 3: [], 4: None, 5: ["zebra", "the"]
    }


def test_vocabulary_by_count_then_spelling(texts):
    assert [tuple(r) for r in ops.build_vocab(texts, 3).orderBy("token_id").collect()] == [
        ("the", 3, 2), ("dog", 2, 3), ("42", 1, 4)
    ]


def test_encoding_pads_cuts_and_masks(texts):
    vocab = ops.build_vocab(texts, 2)
    rows = {r.id: (r.input_ids, r.attention_mask) for r in ops.encode(texts, vocab, ["id"], max_len=3).collect()}
    assert rows == {
        1: ([2, 1, 2], [1, 1, 1]),  # cut after three words
        2: ([3, 1, 1], [1, 1, 1]),
        3: ([0, 0, 0], [0, 0, 0]),
        4: ([0, 0, 0], [0, 0, 0]),
        5: ([1, 2, 0], [1, 1, 0]),
    }


def test_encoding_by_shuffle_join_is_the_same(texts, monkeypatch):
    from quillframe.operators import joins

    vocab = ops.build_vocab(texts, 10)
    small = rows_of(ops.encode(texts, vocab, ["id"]))
    monkeypatch.setattr(joins.join_small, "__defaults__", ("inner", 1))
    assert rows_of(ops.encode(texts, vocab, ["id"])) == small


def test_token_lengths(texts):
    row = ops.token_length_stats(texts.where("id <> 4"), max_len=3).first()
    assert (row.n_texts, row.max_tokens, row.total_tokens, row.n_truncated) == (4, 4, 9, 1)
    assert row.avg_tokens == 2.25 and row.share_truncated == 0.25


def test_classifier_learns_its_texts(spark):
    df = reviews(spark, SF_SMALL)
    model = ops.fit_text_classifier(df)
    scored = ops.predict_sentiment(df.withColumn("y", F.col("label")), model)
    assert set(scored.columns) >= {"label", "confidence", "positive_prob", "negative_prob"}
    assert scored.where("abs(positive_prob + negative_prob - 1) > 1e-9").isEmpty()
    assert scored.where("confidence < 0.5").isEmpty()
    right = scored.where((F.col("label") == "Positive") == (F.col("y") == 1)).count()
    assert right / df.count() > 0.95


def test_a_missing_text_has_no_words(spark):
    rows = [("good fine", 1), ("bad poor", 0), (None, 1), ("", 0), ("good", None)]
    df = spark.createDataFrame(rows, "text string, label int").repartition(2)
    model = ops.fit_text_classifier(df, features=64)
    scored = {r.text: r.positive_prob for r in ops.predict_sentiment(df, model).collect()}
    assert scored[None] == scored[""] and scored["good fine"] > scored["bad poor"]


def test_counted_words_keep_their_weights(spark):
    rows = [("good fine good", 1), ("bad bad", 0), ("good", 1), ("bad poor", 0), (None, 1), ("", 0), ("x", None)]
    df = spark.createDataFrame(rows, "text string, label int").repartition(3)
    model = ops.fit_counted_classifier(df, 2)
    weights = {r.token: r.weight for r in ops.word_weights(spark, model).collect()}
    assert set(weights) == {"good", "bad"} and weights["good"] > 0 > weights["bad"]
    scored = {r.text: r.positive_prob for r in ops.predict_sentiment(df, model).collect()}
    assert scored[None] == scored[""] == scored["x"]  # no known word
    assert scored["good"] == pytest.approx(scored["good fine good"])  # shares, not lengths
    with pytest.raises(ValueError, match="no words"):
        ops.fit_counted_classifier(df.where("text = ''"), 2)


def test_encoding_keeps_the_label(texts):
    labelled = texts.withColumn("label", F.when(F.col("id") != 2, F.col("id") % 2))
    rows = ops.encode(labelled, ops.build_vocab(texts, 2), ["id"], max_len=2, carry=["label"]).collect()
    assert {r.id: (r.label, r.input_ids) for r in rows} == {
        1: (1, [2, 1]), 2: (None, [3, 1]), 3: (1, [0, 0]), 4: (0, [0, 0]), 5: (1, [1, 2])
    }
