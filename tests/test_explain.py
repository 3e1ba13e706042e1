from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillframe.operators import explain as ops
from quillframe.operators.models import fit_forest, fit_linear, predict
from quillframe.operators.scaling import assemble

FEATURES = ["a", "b", "c"]
KEY = ["id"]


@pytest.fixture(scope="module")
def data(spark):
    noise = lambda i: F.abs(F.hash("id", F.lit(i))) / 2**31
    return spark.range(400).select(
        "id", *[F.round(noise(i) * (i + 1), 4).alias(c) for i, c in enumerate(FEATURES)]
    ).persist()


@pytest.fixture(scope="module")
def forest(data):
    label = (F.col("a") * F.col("b") > F.lit(0.5)).cast("int")
    return fit_forest(assemble(data.withColumn("label", label), FEATURES), trees=15, max_depth=4)


def test_linear_contributions_add_up(data):
    weights = {"a": 2.0, "b": -3.0, "c": 0.5}
    long = ops.linear_shapley(data, weights, 1.0, KEY).toPandas()
    sums = long.groupby("id").agg({"contribution": "sum", "base": "first", "prediction": "first"})
    assert np.allclose(sums.contribution + sums.base, sums.prediction, atol=1e-9)
    pdf = data.toPandas().set_index("id").loc[sums.index]
    assert np.allclose(sums.prediction, 2 * pdf.a - 3 * pdf.b + 0.5 * pdf.c + 1)


def test_sampled_contributions_of_linear_model_are_exact(data):
    target = 2 * F.col("a") - 3 * F.col("b") + 1
    model = fit_linear(assemble(data.withColumn("y", target), FEATURES), "y")
    rows = data.where("id < 3")
    background = data.where("id >= 390")
    got = ops.sampled_shapley(rows, model, FEATURES, background, KEY, KEY, n_perm=2).toPandas()
    mean = background.toPandas()[FEATURES].mean()
    for r in got.itertuples():
        weight = {"a": 2, "b": -3, "c": 0}[r.feature]
        assert r.contribution == pytest.approx(weight * (r.value - mean[r.feature]), abs=1e-6)


def test_sampled_contributions_approach_the_definition(data, forest):
    """Against all 3! orders, by brute force on a few rows."""
    rows, background = data.where("id < 2"), data.where("id >= 395")
    got = ops.sampled_shapley(rows, forest, FEATURES, background, KEY, KEY, n_perm=200).toPandas()
    sums = got.groupby("id").agg({"contribution": "sum", "base": "first", "prediction": "first"})
    assert np.allclose(sums.contribution + sums.base, sums.prediction, atol=1e-9)

    xs, bs = rows.orderBy("id").toPandas(), background.toPandas()
    mixes = [
        (int(x.id), n, int(b.id), *[float((x if i in kept else b)[c]) for i, c in enumerate(FEATURES)])
        for _, x in xs.iterrows() for _, b in bs.iterrows()
        for n, kept in enumerate(map(set, itertools.chain.from_iterable(
            itertools.combinations(range(3), k) for k in range(4))))
    ]
    frame = data.sparkSession.createDataFrame(mixes, "id int, n int, bg int, a double, b double, c double")
    scores = predict(forest, assemble(frame, FEATURES)).groupBy("id", "n").agg(F.avg("prob")).collect()
    kept_sets = [frozenset(s) for s in itertools.chain.from_iterable(
        itertools.combinations(range(3), k) for k in range(4))]
    value = {(r[0], kept_sets[r[1]]): r[2] for r in scores}
    for r in got.itertuples():
        i = FEATURES.index(r.feature)
        exact = np.mean([
            value[r.id, frozenset(o[: o.index(i) + 1])] - value[r.id, frozenset(o[: o.index(i)])]
            for o in itertools.permutations(range(3))
        ])
        assert r.contribution == pytest.approx(exact, abs=0.01)


def test_rows_that_share_a_key_stay_apart(spark, data, forest):
    rows = data.where("id < 3").unionByName(data.where("id in (7, 8)").withColumn("id", F.lit(1).cast("long")))
    rows = rows.unionByName(data.where("id = 2"))  # and one that comes twice
    background = data.where("id >= 395")
    want = sorted(zip(*[rows.toPandas()[c] for c in FEATURES]))
    found = [
        ops.exact_shapley(rows, forest, FEATURES, background, KEY, KEY),
        ops.sampled_shapley(rows, forest, FEATURES, background, KEY, KEY, n_perm=3),
    ]
    line = fit_linear(assemble(data.withColumn("y", F.col("a") * 2), FEATURES), "y")
    found.append(ops.sampled_shapley(rows, line, FEATURES, background, KEY, KEY))
    for long in found:
        pdf = long.toPandas()
        assert len(pdf) == 3 * 6 and (pdf.groupby("id").size() == [3, 9, 6]).all()
        for c in FEATURES:
            assert sorted(pdf[pdf.feature == c].value) == sorted(v[FEATURES.index(c)] for v in want)
        sums = pdf.groupby("id")["contribution"].sum()
        ends = (pdf.groupby("id")["prediction"].sum() - pdf.groupby("id")["base"].sum()) / 3
        assert np.allclose(sums, ends, atol=1e-9)
    points = ops.dependence_points(ops.linear_pushes(rows, {"a": 1.0, "b": 2.0}, 0.0, KEY), "a", KEY)
    assert sorted(r.value for r in points.collect()) == sorted(v[0] for v in want)


def test_ranking_summary_and_breakdown(data):
    long = ops.linear_shapley(data, {"a": 0.0, "b": -3.0, "c": 0.5}, 1.0, KEY)
    ranked = ops.shapley_ranking(long, 2).collect()
    assert [r.feature for r in ranked] == ["b", "c"]
    points = ops.shapley_summary_points(long, KEY, 2)
    assert points.count() == 800
    assert points.where("scaled_value < 0 or scaled_value > 1").isEmpty()
    steps = ops.force_breakdown(long, {"id": 5}).orderBy("rank").collect()
    assert len(steps) == 3 and steps[-1].running == pytest.approx(steps[-1].prediction)
    assert abs(steps[0].contribution) >= abs(steps[1].contribution)
    assert all(abs(s.additivity_error) < 1e-9 for s in steps)


def test_dependence_picks_the_strongest_partner(data):
    linked = data.withColumn("c", F.col("a") * 2 + F.col("b") / 10)
    long = ops.linear_shapley(linked, {"a": 1.0, "b": 1.0, "c": 1.0}, 0.0, KEY)
    points = ops.dependence_points(long, "a", KEY)
    assert points.count() == 400
    assert points.select("partner").distinct().collect()[0].partner == "c"
    constant = data.withColumn("c", F.lit(1.0))
    long = ops.linear_shapley(constant, {"a": 1.0, "b": 1.0, "c": 1.0}, 0.0, KEY)
    assert ops.dependence_points(long, "a", KEY).first().partner == "b"


def test_surrogate_finds_the_driving_condition(data):
    label = (F.col("a") > 0.5).cast("int")
    model = fit_forest(assemble(data.withColumn("label", label), FEATURES), trees=10, max_depth=4)
    rows = data.where("a > 0.9").orderBy("id").limit(2)
    got = ops.local_surrogate(rows, model, data, FEATURES, KEY, n_samples=1000, k=2)
    pdf = got.toPandas()
    assert len(pdf) == 4 and pdf.id.nunique() == 2
    top = pdf[pdf["rank"] == 1]
    assert set(top.feature) == {"a"} and (top.weight > 0.2).all() and set(top.direction) == {"up"}
    assert top.condition.str.startswith("a > 0.7").all()
    again = ops.local_surrogate(rows, model, data.repartition(7), FEATURES, KEY, n_samples=1000, k=2)
    key = ["id", "rank"]
    assert np.allclose(
        pdf.sort_values(key).weight, again.toPandas().sort_values(key).weight, atol=1e-6
    )


def test_examples_with_and_without_errors(table):
    rows = [(1, 0, 0), (2, 1, 1), (3, 1, 0), (4, 0, 0), (5, 1, 1)]
    df = table(rows, "id int, y int, pred int")
    got = {r.example: r.id for r in ops.pick_examples(df, "y", "pred", KEY).collect()}
    assert got == {"correct_0": 1, "correct_1": 2, "wrong": 3}
    right = df.where("y = pred")
    got = {r.example: r.id for r in ops.pick_examples(right, "y", "pred", KEY).collect()}
    assert got == {"correct_0": 1, "correct_1": 2, "correct_1_second": 5}
    assert ops.pick_examples(df.where("id = 3"), "y", "pred", KEY).first().example == "wrong"


def test_exact_contributions_are_the_definition(data, forest):
    """Against all 3! orders, by brute force, with 20 background rows."""
    rows, background = data.where("id < 3"), data.where("id >= 380")
    got = ops.exact_shapley(rows, forest, FEATURES, background, KEY, KEY).toPandas()
    xs, bs = rows.toPandas(), background.toPandas()
    subsets = [frozenset(s) for k in range(4) for s in itertools.combinations(range(3), k)]
    mixes = [
        (int(x.id), n, *[float((x if i in own else b)[c]) for i, c in enumerate(FEATURES)])
        for _, x in xs.iterrows() for _, b in bs.iterrows() for n, own in enumerate(subsets)
    ]
    frame = data.sparkSession.createDataFrame(mixes, "id int, n int, a double, b double, c double")
    scores = predict(forest, assemble(frame, FEATURES)).groupBy("id", "n").agg(F.avg("prob")).collect()
    value = {(r[0], subsets[r[1]]): r[2] for r in scores}
    assert len(got) == 9 and len(bs) == 20
    for r in got.itertuples():
        i = FEATURES.index(r.feature)
        orders = list(itertools.permutations(range(3)))
        before = [frozenset(o[: o.index(i)]) for o in orders]
        want = np.mean([value[r.id, s | {i}] - value[r.id, s] for s in before])
        assert r.contribution == pytest.approx(want, abs=1e-9)
        assert r.base == pytest.approx(value[r.id, frozenset()], abs=1e-9)
        assert r.prediction == pytest.approx(value[r.id, frozenset(range(3))], abs=1e-9)
        assert r.value == xs.set_index("id").loc[r.id, r.feature]


def test_forest_query_takes_twenty_background_rows_and_all_orders(monkeypatch):
    from quillframe.plans import explaining

    monkeypatch.setattr(explaining, "split", lambda rows, *_: rows)
    monkeypatch.setattr(explaining, "_forest", lambda train: None)
    monkeypatch.setattr(explaining, "classed_lines", lambda *_: type("T", (), {"where": lambda s, _: s})())
    seen = {}
    monkeypatch.setattr(ops, "exact_shapley", lambda *_, **options: seen.update(options))
    explaining.sampled_shapley_forest(None, "")
    assert seen["n_background"] == 20


def test_shapley_of_trees_is_that_of_scoring_every_row(spark, monkeypatch):
    rows = spark.range(300).selectExpr(
        "id", "cast(id % 17 as double) AS a", "cast(id * 7 % 29 as double) AS b",
        "cast(id % 17 + id * 7 % 29 > 20 as int) AS label",
    )
    rows = rows.unionByName(rows.where("id < 5")).coalesce(2)
    odd = spark.createDataFrame([(900, float("nan"), 3.0, 0), (901, 1e9, -1e9, 1)], rows.schema)
    model = fit_forest(assemble(rows, ["a", "b"]), trees=4, max_depth=4)
    explained = lambda: {
        (r.id, r.feature, str(r.value), n): (r.contribution, r.base, r.prediction)
        for n, r in enumerate(sorted(
            ops.exact_shapley(rows.unionByName(odd), model, ["a", "b"], rows, ["id"], ["id"]).collect(),
            key=lambda r: (r.id, r.feature),
        ))
    }
    found = explained()
    monkeypatch.setattr(ops, "tree_cuts", lambda model, d: None)
    plain = explained()
    assert found.keys() == plain.keys() and len(found) == 2 * 307
    for k, v in plain.items():
        assert found[k] == pytest.approx(v, abs=1e-9)


def test_training_rows_of_a_surrogate_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def costly(i):
        made.add(1)
        return float(i % 50)

    plain = spark.range(400).select("id", (F.col("id") % 50).cast("double").alias("a"), (F.col("id") % 2).alias("label"))
    model = fit_forest(assemble(plain, ["a"]), trees=2, max_depth=2)
    train = spark.range(400).select(costly("id").alias("a"))
    ops.local_surrogate(plain.where("id = 3"), model, train, ["a"], ["id"], n_samples=50).collect()
    assert made.value == 400
