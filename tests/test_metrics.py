from __future__ import annotations

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from quillframe.operators import fairness, metrics as ops
from quillframe.operators.models import best_model, leaderboard


@pytest.fixture
def cm4(table):
    return table([(1, 1), (1, 0), (0, 1), (0, 0)], "y int, pred int")


@pytest.fixture
def random_scores(spark):
    return spark.range(2000).select(
        "id",
        (F.hash("id") % 3 == 0).cast("int").alias("y"),
        F.round(F.abs(F.hash("id", F.lit(1))) / 2**31, 2).alias("prob"),
    ).withColumn("pred", (F.col("prob") > 0.5).cast("int"))


def test_half_right_is_half_everywhere(cm4):
    assert tuple(ops.binary_metrics(cm4, "y", "pred").first()) == (0.5,) * 4


def test_metrics_of_either_class(table):
    df = table([(1, 1)] * 3 + [(0, 1)] + [(1, 0)] * 2 + [(0, 0)] * 4, "y int, pred int")
    one, zero = (ops.binary_metrics(df, "y", "pred", p).first() for p in (1, 0))
    assert (one.precision, one.recall) == (0.75, 0.6)
    assert (zero.precision, zero.recall) == (pytest.approx(4 / 6), 0.8)
    assert one.accuracy == zero.accuracy == 0.7


def test_missing_class(table):
    df = table([(1, 1, 0.9), (1, 0, 0.2)], "y int, pred int, prob double")
    assert ops.roc_auc(df, "y", "prob").first().roc_auc is None
    assert ops.binary_metrics(df, "y", "pred", 0).first().recall == 0.0
    report = {r.label: r for r in ops.classification_report(df, "y", "pred").collect()}
    assert report["0"].support == 0 and report["0"].precision == 0.0
    assert rows_of(ops.confusion_matrix(df, "y", "pred")) == [(0, 0, 0), (0, 1, 0), (1, 0, 1), (1, 1, 1)]
    assert ops.roc_curve(df, "y", "prob").where("fpr is not null").count() == 1


def test_tied_scores_are_half(table):
    df = table([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)], "y int, prob double")
    assert ops.roc_auc(df, "y", "prob").first().roc_auc == 0.5


def test_auc_counts_pairs(random_scores):
    pdf = random_scores.toPandas()
    pos, neg = pdf.prob[pdf.y == 1].to_numpy(), pdf.prob[pdf.y == 0].to_numpy()
    wins = (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()
    assert ops.roc_auc(random_scores, "y", "prob").first().roc_auc == pytest.approx(wins, abs=1e-12)
    flipped = random_scores.withColumn("prob", -F.col("prob"))
    assert ops.roc_auc(flipped, "y", "prob").first().roc_auc == pytest.approx(1 - wins, abs=1e-12)
    other = ops.roc_auc(random_scores.repartition(1), "y", "prob").first().roc_auc
    assert other == pytest.approx(wins, abs=1e-12)


def test_area_under_curve_equals_auc(random_scores):
    curve = ops.roc_curve(random_scores, "y", "prob").toPandas().sort_values("threshold", ascending=False)
    assert (curve.fpr.iloc[0], curve.tpr.iloc[0]) == (0.0, 0.0)
    assert (curve.fpr.iloc[-1], curve.tpr.iloc[-1]) == (1.0, 1.0)
    assert curve.fpr.is_monotonic_increasing and curve.tpr.is_monotonic_increasing
    area = np.trapezoid(curve.tpr, curve.fpr)
    assert area == pytest.approx(ops.roc_auc(random_scores, "y", "prob").first().roc_auc)


def test_rounded_scores_come_near(random_scores):
    exact = ops.roc_auc(random_scores, "y", "prob").first().roc_auc
    assert ops.roc_auc(random_scores, "y", "prob", digits=1).first().roc_auc == pytest.approx(exact, abs=0.05)


def test_report_averages(random_scores):
    report = {r.label: r for r in ops.classification_report(random_scores, "y", "pred").collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert report["macro avg"].f1 == pytest.approx((report["0"].f1 + report["1"].f1) / 2)
    matrix = {(r.y_true, r.y_pred): r.n for r in ops.confusion_matrix(random_scores, "y", "pred").collect()}
    accuracy = (matrix[0, 0] + matrix[1, 1]) / sum(matrix.values())
    assert report["accuracy"].f1 == pytest.approx(accuracy)
    assert ops.binary_metrics(random_scores, "y", "pred").first().accuracy == pytest.approx(accuracy)
    assert report["1"].recall == pytest.approx(ops.binary_metrics(random_scores, "y", "pred").first().recall)


def test_confusion_matrix_of_float_predictions(table):
    df = table([(0, 0.0), (1, 0.0)], "y int, pred double")
    assert rows_of(ops.confusion_matrix(df, "y", "pred", [0, 1])) == [(0, 0, 1), (0, 1, 0), (1, 0, 1), (1, 1, 0)]


def test_regression_metrics(table):
    df = table([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0)], "y double, p double")
    row = ops.regression_report(df, "y", "p").first()
    assert (row.mae, row.mse) == (pytest.approx(0.5), pytest.approx(1.25 / 3))
    assert row.rmse == pytest.approx((1.25 / 3) ** 0.5) and row.r2 == pytest.approx(1 - 1.25 / 2)
    assert row.mae_money == pytest.approx(50_000) and row.good_fit is False
    assert ops.mae(df, "y", "p").first().mae == row.mae
    assert ops.r2(df, "y", "p").first().r2 == row.r2
    line = ops.actual_vs_predicted(df, "y", "p").first()
    assert (line.line_lo, line.line_hi) == (1.0, 3.0)


def test_r2_of_constant_target(table):
    assert ops.r2(table([(2.0, 2.0), (2.0, 2.0)], "y double, p double"), "y", "p").first().r2 == 1.0
    assert ops.r2(table([(2.0, 2.0), (2.0, 3.0)], "y double, p double"), "y", "p").first().r2 == 0.0


def test_best_model_takes_first_of_a_tie(random_scores):
    rows = [ops.evaluate_scored(random_scores, n, "y", "pred", "prob") for n in ("b", "a")]
    board = leaderboard(*rows)
    assert board.count() == 2 and best_model(board).first().model == "b"


def test_group_metrics_and_rule(table):
    rows = [("x", 1, 1)] * 4 + [("x", 0, 0)] * 4 + [("y", 1, 1)] + [("y", 1, 0)] * 3
    metrics = fairness.group_metrics(table(rows, "g string, y int, pred int"), "g", "y", "pred")
    by = {r.g: r for r in metrics.collect()}
    assert (by["x"].n, by["x"].accuracy, by["x"].selection_rate) == (8, 1.0, 0.5)
    assert (by["y"].recall, by["y"].precision, by["y"].selection_rate) == (0.25, 1.0, 0.25)
    impact = fairness.disparate_impact(metrics).first()
    assert (impact.ratio, impact.violated) == (0.5, True)
    table_ = {r.g: r for r in fairness.four_fifths_table(metrics, "g").collect()}
    assert table_["x"].passes and not table_["y"].passes
    assert table_["y"].needed_rate == pytest.approx(0.4)


def test_no_one_selected_gives_no_verdict(table):
    metrics = fairness.group_metrics(
        table([("x", 1, 0), ("y", 0, 0)], "g string, y int, pred int"), "g", "y", "pred"
    )
    impact = fairness.disparate_impact(metrics).first()
    assert impact.ratio is None and impact.violated is None
    assert {r.f1 for r in metrics.collect()} == {0.0}


def test_assigned_groups_are_even_and_repeatable(spark):
    df = spark.range(9000)
    grouped = fairness.assign_group(df, ["id"])
    counts = {r.value: r.percent for r in fairness.group_counts(grouped, "age_group").collect()}
    assert set(counts) == set(fairness.AGE_GROUPS)
    assert all(abs(p - 100 / 3) < 2 for p in counts.values())
    assert grouped.exceptAll(fairness.assign_group(df.repartition(5), ["id"])).isEmpty()
