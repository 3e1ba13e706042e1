from __future__ import annotations

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from quillframe import functions as fn
from quillframe.operators import ordered as ops


@pytest.fixture
def log(spark):
    # Run "a" holds most rows; run "c" is too short for any window.
    sizes = spark.createDataFrame([("a", 900), ("b", 40), ("c", 9)], "run string, n int")
    steps = sizes.select("run", F.explode(F.sequence(F.lit(1), "n")).alias("step_key"))
    return steps.select(
        "run",
        "step_key",
        (F.col("step_key") % 300 == 0).cast("int").alias("_"),
        F.floor((F.col("step_key") - 1) / 100).cast("int").alias("epoch"),
        F.round(F.abs(F.hash("run", "step_key")) / 1e9, 3).alias("loss"),
        (F.hash("step_key") % 2 == 0).cast("int").alias("correct"),
        F.lit(1).alias("total"),
    ).drop("_")


@pytest.mark.parametrize("chunk", [50, 64, 100_000])
def test_moving_average_matches_convolution(log, chunk):
    got = ops.moving_average(log, ["run"], ["step_key"], "loss", chunk=chunk).toPandas()
    pdf = log.toPandas().sort_values("step_key")
    assert sorted(got.run.unique()) == ["a", "b"]  # 9 // 5 = 1: no window
    for run, w in (("a", 50), ("b", 8)):
        loss = pdf.loss[pdf.run == run].to_numpy()
        mine = got[got.run == run].sort_values("step")
        assert set(mine.window) == {w}
        assert list(mine.step) == list(range(w - 1, len(loss)))
        assert np.allclose(mine.moving_avg, np.convolve(loss, np.ones(w) / w, mode="valid"))


def test_moving_average_of_fixed_width(log):
    got = ops.moving_average(log, ["run"], ["step_key"], "loss", window=20, chunk=30)
    counts = {r.run: r["count"] for r in got.groupBy("run").count().collect()}
    assert counts == {"a": 881, "b": 21}


def test_short_log_has_no_average(table):
    log = table([("r", i, 1.0) for i in range(4)], "run string, i int, loss double")
    assert ops.moving_average(log, ["run"], ["i"], "loss").isEmpty()


def test_running_totals_inside_hot_group(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 90)).alias("g"),
        "id",
        (F.col("id") % 11).alias("v"),
    )
    got = ops.running_totals(df.repartition(5), ["id"], {"upto": "v"}, ["g"]).toPandas()
    got = got.sort_values("id")
    assert len(got) == 30_000
    assert (got.groupby("g").v.cumsum() == got.upto).all()


def test_running_ratio_reports_first_and_every_50th(log):
    got = ops.running_ratio(log, ["run", "epoch"], ["step_key"]).toPandas()
    pdf = log.toPandas().sort_values("step_key")
    first = got[(got.run == "a") & (got.epoch == 0)].sort_values("step")
    assert list(first.step) == [1, 50, 100]
    epoch = pdf[(pdf.run == "a") & (pdf.epoch == 0)].correct.cumsum().to_numpy()
    assert np.allclose(first.running_accuracy, [epoch[0], epoch[49] / 50, epoch[99] / 100])


def test_epoch_summary_and_boundaries(spark):
    log = spark.createDataFrame(
        [("r", 1, "2024-01-01 00:00:00", 2.0, 1, 2), ("r", 1, "2024-01-02 01:01:01.5", 4.0, 2, 2),
         ("r", 2, "2024-01-02 01:02:00", 8.0, 0, 0)],
        "run string, epoch int, at string, loss double, correct int, total int",
    ).withColumn("ts", F.col("at").cast("timestamp_ntz"))
    summary = {r.epoch: r for r in ops.epoch_summary(log, ["run", "epoch"], "ts").collect()}
    assert (summary[1].avg_loss, summary[1].accuracy, summary[1].seconds) == (3.0, 0.75, 90061.5)
    assert summary[2].accuracy is None
    assert rows_of(ops.epoch_boundaries(log, ["run"], "epoch")) == [("r", 2, 2, 7.6, 2)]


def test_head_and_top_k(table):
    df = table([(i, i % 3) for i in range(9)], "id int, score int")
    assert [r.id for r in ops.head(df, 2, ["id"]).collect()] == [0, 1]
    assert rows_of(ops.top_k(df, "score", 4, ["id"])) == [(1, 2, 2), (2, 5, 2), (3, 8, 2), (4, 1, 1)]


def test_scalars(spark):
    one = spark.range(1)
    got = one.select(
        fn.preview(F.lit("abcdef"), 3).alias("cut"),
        fn.preview(F.lit("abc"), 3).alias("whole"),
        fn.confidence_bar(F.lit(0.54)).alias("bar"),
        fn.percent(F.lit(1), F.lit(8)).alias("percent"),
        fn.percent(F.lit(1), F.lit(0)).alias("none"),
        fn.signed_direction(F.lit(-0.5)).alias("down"),
        fn.round_to(F.lit(1.23456), 2).alias("rounded"),
        fn.zero_if_undefined(F.lit(0), F.lit(0)).alias("zero"),
    ).first()
    assert tuple(got) == ("abc...", "abc", "█" * 10 + "░" * 10, 12.5, None, "down", 1.23, 0.0)


def test_softmax_is_stable(spark):
    df = spark.createDataFrame([([1000.0, 1001.0, 1001.0],)], "logits array<double>")
    s = df.select(fn.softmax_argmax(F.col("logits")).alias("s")).first().s
    e = np.exp(-1)
    assert np.allclose(s.probabilities, [e / (2 + e), 1 / (2 + e), 1 / (2 + e)])
    assert s.prediction == 1 and s.confidence == pytest.approx(1 / (2 + e))


def test_hash_choices_are_uniform(spark):
    df = spark.range(20_000).select(
        fn.hash_unit(["id"], 42).alias("u"),
        fn.hash_normal(["id"], 42).alias("z"),
        fn.hash_below(["id"], 0.3, 42).alias("b"),
    )
    row = df.agg(
        F.avg("u"), F.min("u"), F.max("u"), F.avg("z"), F.stddev("z"),
        F.count_if(F.col("b") != (F.col("u") < 0.3)),
    ).first()
    assert row[0] == pytest.approx(0.5, abs=0.01) and row[1] >= 0 and row[2] < 1
    assert row[3] == pytest.approx(0, abs=0.03) and row[4] == pytest.approx(1, abs=0.03)
    assert row[5] == 0
