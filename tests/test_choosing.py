"""Boosted trees, components, thresholds and calibration against plain versions."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillframe.operators import calibration, fairness, metrics, models, reduction, thresholds
from quillframe.operators.scaling import assemble
from quillframe.operators.splitting import cross_validate, grid_search, split_validation


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.default_rng(5)
    x = np.c_[rng.integers(0, 9, 1200), rng.normal(size=(1200, 2)).round(2)]
    y = (x[:, 0] + 2 * x[:, 1] * x[:, 2] + rng.normal(size=1200) > 4).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label int").persist()


def test_boosted_trees_do_not_depend_on_partitions(spark, classes):
    found = []
    for parts in (1, 4, 8):
        rows = assemble(classes.repartition(parts), ["a", "b", "c"])
        model = models.fit_boosted(rows, rounds=3, max_depth=2, partitions=4)
        found.append(models.tree_rules(spark, model, ["a", "b", "c"]).collect())
    assert found[0] == found[1] == found[2]
    assert [r.tree for r in found[0]] == sorted(r.tree for r in found[0])
    assert {r.weight for r in found[0]} == {1.0, 0.1} and len({r.tree for r in found[0]}) == 3


def test_rules_score_like_the_model(spark, classes):
    rows = assemble(classes, ["a", "b", "c"])
    model = models.fit_boosted(rows, rounds=4, max_depth=3, partitions=4)
    rules = models.tree_rules(spark, model, ["a", "b", "c"]).collect()
    for row in models.predict(model, rows).limit(100).collect():
        score = 0.0
        for rule in rules:
            holds = [row[f] <= t if op == "<=" else row[f] > t for f, op, t in rule.conditions]
            score += rule.weight * rule.prediction if all(holds) else 0
        assert row.prob == pytest.approx(1 / (1 + np.exp(-2 * score)))


def test_boosting_stops_when_validation_gains_no_more(classes):
    rows = assemble(split_validation(classes, 0.2, 0.2, ["id"]), ["a", "b", "c"])
    assert {r.split for r in rows.select("split").distinct().collect()} == {"train", "validation", "test"}
    seen = rows.where("split <> 'test'").withColumn("held", F.col("split") == "validation")
    stopped = models.fit_boosted(seen, rounds=60, step=0.5, validation="held", tol=0.02, partitions=4)
    assert 1 < stopped.getNumTrees < 60
    area = metrics.evaluate(stopped, rows.where("split = 'test'"), "boosted")["metrics"].first()
    assert area.roc_auc > 0.8


def test_components_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) + [5.0, -2.0, 0.0, 1.0]
    frame = assemble(spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double"), list("abcd"))
    centred = x - x.mean(0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    values, axes = values[::-1], axes[:, ::-1]
    for k in (1, 3):
        found = reduction.fit_components(frame, k)
        assert np.allclose(found.variances, values[:k]) and np.allclose(found.shares, values[:k] / values.sum())
        assert np.allclose(np.abs(found.axes), np.abs(axes[:, :k]))
        assert all(found.axes[np.argmax(np.abs(found.axes[:, c])), c] > 0 for c in range(k))
        projected = np.array([r.projected for r in reduction.project(frame, found).collect()])
        assert np.allclose(np.sort(projected, axis=0), np.sort(centred @ found.axes, axis=0))
        error = reduction.reconstruction_error(frame, found).first()
        assert error.n == 300 and error.error == pytest.approx(values[k:].sum())


def test_whole_weights_are_repeated_rows(spark, classes):
    rows = assemble(classes, ["a", "b", "c"]).withColumn("w", (F.col("id") % 3).cast("double"))
    weighed = models.fit_logistic(rows, weight="w")
    often = rows.where("w > 0").withColumn("again", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))))
    repeated = models.fit_logistic(often)
    assert np.allclose([*weighed.coefficients, weighed.intercept], [*repeated.coefficients, repeated.intercept], atol=1e-5)


def test_balanced_groups(spark, classes):
    group = F.when(F.col("id") % 7 == 0, "few").when(F.col("id") % 5 > 0, "many")
    rows = classes.withColumn("g", group)
    weights = fairness.balance_weights(rows, "g", "label").toPandas()
    assert weights.weight.sum() == pytest.approx(1200) and len(weights) == 1200
    shares = weights.assign(g=weights.g.fillna("-")).groupby(["g", "label"]).weight.sum().unstack()
    assert np.allclose(shares[1] / shares.sum(axis=1), weights.label.mean())
    sizes = {r.g: r["count"] for r in rows.groupBy("g").count().collect()}
    copies = fairness.oversample(rows, "g", ["id"])
    found = {r.g: r["count"] for r in copies.groupBy("g").count().collect()}
    most = max(sizes.values())
    for g, n in sizes.items():
        assert abs(found[g] - most) < 4 * np.sqrt(n)
    assert found[max(sizes, key=sizes.get)] == most
    assert copies.where("copy = 0").select("id").distinct().count() == 1200
    again = fairness.oversample(rows.repartition(7), "g", ["id"])
    assert sorted((r.id, r.copy) for r in again.collect()) == sorted((r.id, r.copy) for r in copies.collect())


def test_grid_search_picks_by_mean_then_spread_then_order(spark, classes):
    folds, ranked = grid_search(
        classes, lambda n, c, max_iter: models.logistic_estimator(n, c, max_iter),
        {"c": [1e-6, 1.0, 1.0], "max_iter": [50]}, 3, ["a", "b", "c"], "label", ["id"],
    )
    rows = ranked.orderBy("rank").collect()
    assert [r.setting for r in rows] == [1, 2, 0] and rows[0].cv_mean > rows[2].cv_mean
    assert folds.columns == ["setting", "c", "max_iter", "fold", "n", "accuracy"]
    plain, summary = cross_validate(
        classes, lambda n: models.logistic_estimator(n, 1.0, 50), 3, ["a", "b", "c"], "label", ["id"]
    )
    one = {r.fold: (r.n, r.accuracy) for r in folds.where("setting = 1").collect()}
    assert one == {r.fold: (r.n, r.accuracy) for r in plain.collect()}
    assert summary.first().cv_mean == pytest.approx(rows[0].cv_mean)


# --- thresholds ------------------------------------------------------------------------------


def group_rows(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        g = rng.choice(["a", "a", "b", None])
        y = int(rng.random() < (0.3 if g == "a" else 0.6))
        rows.append((g, y, round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * y, 0.2))), 2)))
    return rows


def curve(rows):
    """(fp, tp, threshold) from nothing to everything."""
    out = [(0, 0, float("inf"))]
    for t in sorted({s for _, s in rows}, reverse=True):
        out.append((sum(1 - y for y, s in rows if s >= t), sum(y for y, s in rows if s >= t), t))
    return out


def fp_at(points, rate, pos):
    """Least false positives at a true-positive rate over mixtures of any two points."""
    best = float("inf")
    for (x0, y0, _), (x1, y1, _) in itertools.product(points, repeat=2):
        if y0 <= rate * pos + 1e-9 and y1 >= rate * pos - 1e-9:
            share = 0 if y1 == y0 else (rate * pos - y0) / (y1 - y0)
            best = min(best, x0 + share * (x1 - x0))
    return best


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("costs", [(1.0, 1.0), (1.0, 4.0), (3.0, 1.0), (0.0, 1.0)])
def test_equal_recall_against_all_mixtures(spark, seed, costs):
    rows = group_rows(seed) + [("none", 0, 0.5), ("only", 1, 0.5), ("a", None, 0.5), ("a", 1, None)]
    frame = spark.createDataFrame(rows, "g string, y int, s double").repartition(5)
    hull = thresholds.roc_hull(frame, "y", "s", "g")
    corners = {}
    for r in hull.collect():
        corners.setdefault(r.g, []).append((r.fp, r.tp, r.threshold))
    groups = {g: [(y, s) for h, y, s in rows if h == g and None not in (y, s)] for g in ("a", "b", None)}
    assert set(corners) == set(groups)
    points = {g: curve(v) for g, v in groups.items()}
    pos = {g: sum(y for y, _ in v) for g, v in groups.items()}
    for g, some in corners.items():
        assert set(some) <= set(points[g]) and len(some) >= 3
        hull_only = sorted(some)
        for rate in np.linspace(0, 1, 23):
            assert fp_at(hull_only, rate, pos[g]) == pytest.approx(fp_at(points[g], rate, pos[g]), abs=1e-6)
    cuts = {r.g: r for r in thresholds.equal_recall_thresholds(hull, "g", *costs).collect()}
    assert set(cuts) == set(groups) and len({r.tpr for r in cuts.values()}) == 1
    cost = lambda rate: sum(
        costs[0] * fp_at(points[g], rate, pos[g]) + costs[1] * pos[g] * (1 - rate) for g in groups
    )
    rates = {tp / pos[g] for g in groups for _, tp, _ in points[g]}
    rate = next(iter(cuts.values())).tpr
    assert cost(rate) == pytest.approx(min(map(cost, rates)), abs=1e-6)
    for g, r in cuts.items():
        at = {t: (fp, tp) for fp, tp, t in points[g]}
        reach = lambda i: at[r.upper][i] + r.share * (at[r.lower][i] - at[r.upper][i])
        assert 0 <= r.share <= 1 and reach(1) / pos[g] == pytest.approx(rate)
        assert reach(0) == pytest.approx(fp_at(points[g], rate, pos[g]), abs=1e-6)
        assert r.fpr * (len(groups[g]) - pos[g]) == pytest.approx(reach(0))


def test_threshold_for_recall(spark):
    rows = [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.5), (1, 0.2), (0, 0.1), (None, 0.95), (1, None)]
    frame = spark.createDataFrame(rows, "y int, s double")
    pick = lambda recall, f=frame: thresholds.threshold_for_recall(f, "y", "s", recall).first()
    assert pick(0.3) == (0.9, pytest.approx(1 / 3), 1.0, 0.0)
    assert pick(0.5) == (0.5, pytest.approx(2 / 3), 0.5, pytest.approx(2 / 3))  # ties go together
    assert pick(1.0).threshold == 0.2
    assert pick(0.5, frame.where("y = 0")) is None


# --- calibration -----------------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_isotonic_fit_equals_one_list(spark, monkeypatch, parts):
    monkeypatch.setattr(calibration, "FAN_IN", 3)
    rng = random.Random(parts)
    rows = [(int(rng.random() < s * s), s) for s in (round(rng.random(), 3) for _ in range(1500))]
    rows += [(1, 0.0)] * 5 + [(None, 0.3), (0, None)]
    frame = spark.createDataFrame(rows, "y int, s double").repartition(parts)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        steps = calibration.fit_isotonic(frame, "y", "s").orderBy("lo").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by = {}
    for y, s in rows:
        if y is not None and s is not None:
            by.setdefault(s, []).append(y)
    want = calibration.pool([(s, s, sum(v), len(v)) for s, v in sorted(by.items())])
    assert [tuple(r)[:4] for r in steps] == want
    # By the definition: the largest over starts of the smallest mean over ends.
    scores = sorted(by)[:60]
    sums = np.cumsum([0, *(sum(by[s]) for s in sorted(by))])
    sizes = np.cumsum([0, *(len(by[s]) for s in sorted(by))])
    for j, s in enumerate(scores):
        value = max(
            min((sums[j + 1 :] - sums[i]) / (sizes[j + 1 :] - sizes[i])) for i in range(j + 1)
        )
        assert next(r.value for r in steps if r.lo <= s <= r.hi) == pytest.approx(value)


def test_calibrated_scores(spark):
    frame = spark.createDataFrame([(0, 0.2), (1, 0.4), (0, 0.5), (1, 0.8)], "y int, s double")
    steps = calibration.fit_isotonic(frame, "y", "s")
    new = spark.createDataFrame([(0.1,), (0.2,), (0.45,), (0.5,), (0.9,), (None,)], "s double")
    found = [r.calibrated for r in calibration.calibrated(new, steps, "s").collect()]
    assert found == [0.0, 0.0, 0.5, 0.5, 1.0, None]
    none = calibration.fit_isotonic(frame.limit(0), "y", "s")
    assert none.count() == 0
    assert [r.calibrated for r in calibration.calibrated(new, none, "s").collect()] == [None] * 6


def test_calibration_by_group(spark):
    rows = [("a", 1, 1.0), ("a", 0, 0.9), ("a", 1, 0.25), (None, 0, 0.2), (None, 1, 0.2), ("a", None, 0.5)]
    frame = spark.createDataFrame(rows, "g string, y int, s double")
    table = calibration.calibration_table(frame, "y", "s", "g", bins=4)
    assert {(r.g, r.bin): (r.n, pytest.approx(r.mean_prob), r.observed) for r in table.collect()} == {
        ("a", 3): (2, 0.95, 0.5), ("a", 1): (1, 0.25, 1.0), (None, 0): (2, 0.2, 0.5)
    }
    errors = {r.g: (r.n, r.expected_error, r.largest_error) for r in calibration.calibration_error(table, "g").collect()}
    assert errors["a"] == (3, pytest.approx((0.45 * 2 + 0.75) / 3), pytest.approx(0.75))
    assert errors[None] == (2, pytest.approx(0.3), pytest.approx(0.3))
