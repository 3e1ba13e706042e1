from __future__ import annotations

import json
import os

import numpy as np
import pytest
from conftest import SF_SMALL, rows_of
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from quillframe.operators import forests, metrics, models
from quillframe.operators.scaling import assemble, scale_and_assemble
from quillframe.plans.standins import FEATURES, classed_lines
from quillframe.sources import artifacts


@pytest.fixture
def exact_line(spark):
    df = spark.range(200).select(
        "id",
        (F.col("id") % 13).cast("double").alias("a"),
        (F.col("id") % 7).cast("double").alias("b"),
    )
    return df.withColumn("y", 2 * F.col("a") - 3 * F.col("b") + 1)


def test_linear_recovers_weights(spark, exact_line):
    model = models.fit_linear(assemble(exact_line, ["a", "b"]), "y")
    weights = {r.feature: r.weight for r in models.coefficients(spark, model, ["a", "b"]).collect()}
    assert weights == {"a": pytest.approx(2), "b": pytest.approx(-3), "intercept": pytest.approx(1)}
    scored = models.predict(model, assemble(exact_line, ["a", "b"]))
    assert metrics.r2(scored, "y", "prediction").first().r2 == pytest.approx(1)


def test_logistic_matches_newton(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 2))
    y = (x @ [1.0, -2.0] + rng.normal(size=300) > 0).astype(float)
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y, strict=True)]
    df = assemble(spark.createDataFrame(rows, "a double, b double, label double"), ["a", "b"])
    model = models.fit_logistic(df, c=1.0)
    # Minimise 0.5 |w|^2 + sum of log losses, free intercept.
    z, w = np.c_[x, np.ones(300)], np.zeros(3)
    penalty = np.diag([1.0, 1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ w))
        grad = z.T @ (p - y) + penalty @ w
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, grad)
    assert np.allclose([*model.coefficients, model.intercept], w, atol=1e-3)


def test_evaluate_gathers_all_metrics(spark):
    df = classed_lines(spark, SF_SMALL)
    ready = scale_and_assemble(df, FEATURES)(df)
    model = models.fit_logistic(ready)
    parts = metrics.evaluate(model, ready, "logistic")
    row = parts["metrics"].first()
    assert row.model == "logistic" and row.accuracy > 0.85 and row.roc_auc > 0.95
    assert parts["confusion"].agg(F.sum("n")).first()[0] == df.count()
    assert parts["report"].count() == 5
    assert parts["roc"].count() > 100


def test_forest_finds_the_feature_that_matters(spark):
    df = assemble(classed_lines(spark, SF_SMALL), FEATURES)
    model = models.fit_forest(df, trees=10, max_depth=5)
    ranked = models.feature_importance(spark, model, FEATURES, 2).collect()
    assert [r["rank"] for r in ranked] == [1, 2]
    assert ranked[0].feature == "l_extendedprice" and ranked[0].importance > 0.5
    scored = models.predict(model, df)
    assert metrics.binary_metrics(scored, "label", "prediction").first().accuracy > 0.9
    assert scored.where("prob < 0 or prob > 1").isEmpty()


def test_saved_model_scores_the_same(exact_line, tmp_path):
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features")])
    model = pipeline.fit(exact_line)
    fitted = models.fit_linear(model.transform(exact_line), "y")
    from pyspark.ml import PipelineModel

    whole = PipelineModel([*model.stages, fitted])
    path = str(tmp_path / "model")
    artifacts.save_model(whole, path)
    artifacts.save_model(whole, path)  # overwriting is fine
    loaded = artifacts.load_model(path)
    one, other = (m.transform(exact_line).select("id", "prediction") for m in (whole, loaded))
    assert rows_of(one) == rows_of(other)


def test_metadata_and_tables_are_written(spark, table, tmp_path):
    row = table([("m", 0.5, None)], "model string, accuracy double, note string", 1)
    artifacts.save_run_metadata(row, str(tmp_path / "meta"))
    file = next(f for f in os.listdir(tmp_path / "meta") if f.endswith(".json"))
    assert json.loads((tmp_path / "meta" / file).read_text()) == {
        "model": "m", "accuracy": 0.5, "note": None
    }
    artifacts.save_table(row, str(tmp_path / "table"))
    assert rows_of(spark.read.parquet(str(tmp_path / "table"))) == rows_of(row)


def test_materialized_table_lives_in_the_shared_folder(spark, table):
    df = table([(1, "a")], "x int, y string")
    kept = artifacts.materialize(df, "kept")
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert rows_of(kept) == rows_of(df)
    assert base.removeprefix("file:") in kept.inputFiles()[0]
    assert "ExistingRDD" not in kept._jdf.queryExecution().executedPlan().toString()


def test_training_rows_spread_and_release(spark):
    df = spark.range(100, numPartitions=1)
    with models.training_rows(df) as (rows, n):
        assert n == 100 and rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
        assert rows.storageLevel.useMemory
    assert not rows.storageLevel.useMemory


def test_forest_does_not_depend_on_the_layout(spark):
    rows = spark.range(400).selectExpr(
        "cast(id % 7 as double) AS a", "cast(id % 11 as double) AS b", "cast(id % 7 > 3 as int) AS label"
    )
    found = []
    for n in (1, 4, 8):
        ready = assemble(rows.repartition(n), ["a", "b"])
        forest = models.fit_forest(ready, trees=5, max_depth=3, partitions=6)
        found.append(forest.featureImportances.toArray().tolist())
    assert found[0] == found[1] == found[2]


def test_forest_grown_in_one_task_or_in_stages_is_the_same(spark):
    rows = spark.range(600).selectExpr(
        "cast(id % 37 as double) AS a", "cast(id % 23 as double) AS b", "cast(xxhash64(id) % 2 = 0 as int) AS label"
    )
    ready = assemble(rows, ["a", "b"])
    estimator = models.forest_estimator(trees=1, max_depth=30).setSeed(7)
    layout = F.xxhash64("a", "b", "label")
    found = []
    with models.training_rows(ready, layout, 4) as (train, n):
        for size in (10_000, 100):
            forest = forests.grow_forest(train, n, estimator, task_rows=size)
            scored = models.predict(forest, ready).select("a", "b", "label", "prediction", "prob")
            found.append((forest.totalNumNodes, forest.featureImportances.toArray().tolist(), rows_of(scored)))
    one, staged = found
    assert one[0] > 50
    assert staged[0] == one[0] and staged[2] == one[2] and np.allclose(staged[1], one[1])


def test_tree_splits_where_the_classes_part(spark):
    rows = assemble(spark.range(400).selectExpr(
        "cast(id as double) AS a", "cast(id % 2 as double) AS b", "cast(id >= 200 as int) AS label"
    ), ["a", "b"])
    for size in (10_000, 10):
        estimator = models.forest_estimator(trees=1, max_depth=5)
        with models.training_rows(rows, F.xxhash64("a"), 3) as (train, n):
            forest = forests.grow_forest(train, n, estimator, task_rows=size)
        rules = models.tree_rules(spark, forest, ["a", "b"]).collect()
        assert len(rules) == 2 and all(abs(r.conditions[0].threshold - 199.5) < 15 for r in rules)
        assert forest.featureImportances.toArray().tolist() == [1.0, 0.0]


def test_importances_of_a_grown_forest_load_no_nodes(spark, monkeypatch):
    rows = spark.range(500).selectExpr(
        "cast(id % 37 as double) AS a", "cast(id % 23 as double) AS b", "0.0D AS c",
        "cast(xxhash64(id) % 3 = 0 or id % 37 > 20 as int) AS label",
    )
    forest = models.fit_forest(assemble(rows, ["a", "b", "c"]), trees=7)
    wanted = forest.mllib.featureImportances
    forest._made.clear()
    monkeypatch.setattr(forests, "_written", lambda *_: pytest.fail("the nodes were taken to the driver"))
    found = forest.featureImportances
    assert found.size == wanted.size and np.allclose(found.toArray(), wanted.toArray(), rtol=1e-12)
    assert found.toArray()[2] == 0 and found.toArray()[0] > found.toArray()[1] > 0
    ranked = models.feature_importance(spark, forest, ["a", "b", "c"], 2).collect()
    assert [r.feature for r in ranked] == ["a", "b"]
    pure = assemble(rows.withColumn("label", F.lit(1)), ["a", "b", "c"])  # trees without a split
    assert models.fit_forest(pure, trees=2).featureImportances.toArray().tolist() == [0.0, 0.0, 0.0]


def test_forest_refuses_missing_and_broken_classes(spark):
    for label in ("if(id = 3, null, 1)", "id + 0.5", "-1"):
        rows = assemble(spark.range(9).selectExpr("cast(id as double) AS a", f"{label} AS label"), ["a"])
        with pytest.raises(Exception):
            models.fit_forest(rows, trees=2)


def test_grown_forest_scores_as_mllib_does_and_is_not_sent_whole(spark, monkeypatch):
    rows = spark.range(700).selectExpr(
        "id", "cast(id % 37 as double) AS a", "if(id % 50 = 0, double('nan'), cast(id % 23 as double)) AS b",
        "cast(pmod(xxhash64(id), 3) as int) AS label",
    )
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="keep").transform(rows)
    monkeypatch.setattr(forests, "SCORED_TREES", 3)
    monkeypatch.setattr(forests, "SCORED_ROWS", 150)
    forest = models.fit_forest(ready.where("id % 5 > 0"), trees=10)
    columns = ["rawPrediction", "probability", "prediction"]
    scored = forest.transform(ready).orderBy("id")
    assert scored.columns == [*ready.columns, *columns]
    got = scored.select("id", "label", *columns).collect()
    assert len(got) == 700 and forest._made == []
    assert forest.transform(ready.limit(0)).count() == 0
    assert got == forest.mllib.transform(ready).orderBy("id").select("id", "label", *columns).collect()
    assert forest.totalNumNodes == forest.mllib.totalNumNodes > 100
