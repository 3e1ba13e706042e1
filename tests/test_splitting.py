from __future__ import annotations

import gc
import math
import weakref

import pytest
from conftest import SF_SMALL, rows_of
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from quillframe.operators import models, scaling
from quillframe.operators import splitting as ops
from quillframe.operators.sampling import sample_n
from quillframe.plans.standins import classed_lines

KEY = ["id"]


@pytest.fixture
def people(spark):
    # Two classes of nine, one holding a third, and a NULL class.
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 9)
        .cast("int").alias("label"),
        F.col("id").cast("double").alias("x"),
    )


def test_sample_sizes_and_layout(people):
    for parts in (4, 8):
        one = sample_n(people.repartition(1), 77, KEY, 1)
        other = sample_n(people.repartition(parts), 77, KEY, 1)
        assert one.count() == 77 and rows_of(one) == rows_of(other)
    assert rows_of(one) == rows_of(sample_n(people, 77, KEY, 1))
    assert sample_n(people, 5000, KEY, 1).count() == 3000
    assert sample_n(people, 0, KEY, 1).count() == 0


def test_sample_is_exact_when_copies_share_a_key(spark):
    hot = spark.range(900).select(F.when(F.col("id") < 600, 0).otherwise(F.col("id")).alias("id"))
    for n in (1, 50, 400, 700):
        assert sample_n(hot, n, KEY, 3).count() == n


def test_split_shares(people):
    rough = ops.split(people, 0.2, KEY)
    assert rough.where("split = 'test'").count() / 3000 == pytest.approx(0.2, abs=0.03)
    exact = ops.split(people.limit(2999), 0.2, KEY, exact=True)
    assert exact.where("split = 'test'").count() == math.ceil(2999 * 0.2)
    again = ops.split(people.repartition(8), 0.2, KEY, exact=True)
    assert rows_of(again) == rows_of(ops.split(people.repartition(1), 0.2, KEY, exact=True))


def test_copies_never_straddle_a_split(spark):
    hot = spark.range(900).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("id"))
    for parted in (ops.split(hot, 0.5, KEY), ops.split(hot, 0.5, KEY, exact=True)):
        sides = parted.groupBy("id").agg(F.countDistinct("split").alias("n"))
        assert sides.where("n > 1").isEmpty()


def test_stratified_split_keeps_class_shares(people):
    parted = ops.stratified_split(people, 0.2, "label", KEY)
    assert parted.count() == 3000
    assert parted.where("split = 'test'").count() == 600
    for r in parted.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")
    ).collect():
        assert abs(r.t - r.n * 0.2) <= 1
    audit = ops.split_audit(parted, "label")
    assert audit.agg(F.sum("n")).first()[0] == 3000


def test_folds_part_the_rows(people):
    folded = ops.stratified_kfold(people, 5, "label", KEY)
    assert folded.count() == 3000
    counts = folded.groupBy("label").pivot("fold", [0, 1, 2, 3, 4]).count().collect()
    for r in counts:
        sizes = [r[str(i)] for i in range(5)]
        assert max(sizes) - min(sizes) <= 1
    assert rows_of(folded) == rows_of(ops.stratified_kfold(people.repartition(8), 5, "label", KEY))


def test_class_smaller_than_the_folds(table):
    df = table([(i, 0) for i in range(20)] + [(100, 1), (101, 1)], "id int, label int")
    folded = ops.stratified_kfold(df, 5, "label", KEY)
    assert folded.where("label = 1").count() == 2
    assert folded.where("fold between 0 and 4").count() == 22


def test_scaler_uses_population_deviation_of_train(table):
    train = table([(float(i), 5.0) for i in range(1, 5)], "x double, c double")
    scaler = scaling.fit_scaler(train, ["x", "c"])
    assert {r.feature: round(r["std"], 4) for r in scaler.collect()} == {"x": 1.118, "c": 0.0}
    scaled = scaling.apply_scaler(train, scaler)
    check = scaling.scaling_check(scaled.select("x"), ["x"]).first()
    assert check["mean"] == pytest.approx(0) and check["std"] == pytest.approx(1)
    assert scaled.where("c <> 0").isEmpty()
    other = scaling.apply_scaler(table([(2.5, 5.0)], "x double, c double"), scaler).first()
    assert other.x == pytest.approx(0)


def test_cross_validation(spark):
    df = classed_lines(spark, SF_SMALL)
    features = ["l_extendedprice", "l_discount", "l_tax"]
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    folds, summary = ops.cross_validate(df, LogisticRegression(regParam=0.001), 5, features, "label", key)
    rows = folds.collect()
    assert sorted(r.fold for r in rows) == list(range(5))
    assert sum(r.n for r in rows) == df.count()
    mean = sum(r.accuracy for r in rows) / 5
    got = summary.first()
    assert got.cv_mean == pytest.approx(mean) and got.cv_mean > 0.85
    assert got.cv_std == pytest.approx((sum((r.accuracy - mean) ** 2 for r in rows) / 5) ** 0.5)


def test_cross_validation_scales_on_training_folds_only(table):
    seen = []

    def prepare(train, features):
        seen.append({r.id for r in train.collect()})
        return scaling.scaling.scale_and_assemble(train, features)

    df = table([(i, float(i), i % 2) for i in range(40)], "id int, x double, label int")
    ops.cross_validate(df, LogisticRegression(), 4, ["x"], "label", KEY, prepare=prepare)
    assert len(seen) == 4 and all(len(s) == 30 for s in seen)
    assert set.intersection(*seen) == set()


def test_rows_that_share_a_key_do_not_depend_on_the_layout(spark):
    hot = spark.range(10).selectExpr("0 AS k", "id AS x")
    samples = [rows_of(sample_n(hot.repartition(n), 4, ["k"], 1)) for n in (1, 4, 8)]
    assert len(samples[0]) == 4 and samples[0] == samples[1] == samples[2]
    for n in (1, 4, 8):
        parted = ops.split(hot.repartition(n), 0.2, ["k"], exact=True)
        assert parted.where("split = 'test'").count() == 2


def test_a_key_that_many_rows_share_is_divided(spark):
    rows = [(7, i, i % 2) for i in range(40)] + [(i, i, 0) for i in range(100, 110)]
    frame = spark.createDataFrame(rows, "id int, v int, label int").repartition(5)
    sides = ops.stratified_split(frame, 0.2, "label", ["id"]).groupBy("split", "label").count().collect()
    assert {(r.split, r.label): r["count"] for r in sides} == {
        ("test", 0): 6, ("train", 0): 24, ("test", 1): 4, ("train", 1): 16
    }
    folds = ops.stratified_kfold(frame, 5, "label", ["id"]).groupBy("fold", "label").count().collect()
    assert {(r.fold, r.label): r["count"] for r in folds} == {(f, y): 6 - 2 * y for f in range(5) for y in (0, 1)}
    again = ops.stratified_kfold(frame.repartition(3), 5, "label", ["id"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, ops.stratified_kfold(frame, 5, "label", ["id"]).collect()))


def test_folds_are_kept_without_their_keys(spark):
    rows = spark.range(60).selectExpr("id", "cast(id % 7 as double) AS a", "cast(id % 2 as int) AS label")
    seen = []

    def prepare(train, features):
        seen.append(train.columns)
        return scaling.scale_and_assemble(train, features)

    folds, _ = ops.cross_validate(rows, models.logistic_estimator, 2, ["a"], "label", ["id"], prepare=prepare)
    assert folds.count() == 2 and all("id" not in columns for columns in seen)


def test_fitted_classes_make_no_digests_again(spark):
    from quillframe.plans.modelling import fitted_classes

    ready, _ = fitted_classes(spark, SF_SMALL)
    assert "md5" not in ready._jdf.queryExecution().optimizedPlan().toString()
    assert ready.count() == 6000


def test_a_fold_is_scored_before_the_next_is_fitted_and_its_model_is_dropped(spark):
    rows = spark.range(90).selectExpr("id", "cast(id % 7 as double) AS a", "cast(id % 2 as int) AS label")
    made, alive = [], []

    class Noted(LogisticRegression):
        def _fit(self, dataset):
            gc.collect()
            alive.append(sum(m() is not None for m in made))
            model = super()._fit(dataset)
            made.append(weakref.ref(model))
            return model

    wanted = ops.cross_validate(rows, LogisticRegression(), 3, ["a"], "label", ["id"])
    found = ops.cross_validate(rows, Noted(), 3, ["a"], "label", ["id"], at_once=1)
    assert alive == [0, 0, 0]
    assert rows_of(found[0]) == rows_of(wanted[0]) and rows_of(found[1]) == rows_of(wanted[1])
