"""Metrics and fairness over tables scored by a fixed rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillframe.operators import fairness, models
from quillframe.operators import metrics as ops
from quillframe.plans.registry import query
from quillframe.plans.standins import (
    KEYS_SQL,
    LINE_KEY,
    PRICED_SQL,
    REVIEWS_SQL,
    SCORED_SQL,
    SEED,
    priced_lines,
    scored_lines,
    scored_reviews,
    unit_sql,
)


def _round(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- numbers ---------------------------------------------------------------------------------

_SIMPLE = {
    "mae": ("round(avg(abs(net - guess)), 4)", ops.mae),
    "mse": ("round(avg((net - guess) * (net - guess)), 2)", ops.mse),
    "rmse": ("round(sqrt(avg((net - guess) * (net - guess))), 4)", ops.rmse),
    "r2": ("round(1 - avg((net - guess) * (net - guess)) / var_pop(net), 6)", ops.r2),
}


def _register_simple(name, expression, metric):
    digits = {"mse": 2, "r2": 6}.get(name, 4)

    @query(name, f"WITH {PRICED_SQL} SELECT {expression} AS {name} FROM priced")
    def run(spark, sf_dir):
        return _round(metric(priced_lines(spark, sf_dir), "net", "guess"), digits, name)


for _name, (_expression, _metric) in _SIMPLE.items():
    _register_simple(_name, _expression, _metric)


@query(
    "regression_report",
    f"WITH {PRICED_SQL} SELECT count(*) AS n, "
    + ", ".join(f"{e} AS {n}" for n, (e, _) in _SIMPLE.items())
    + ", round(avg(abs(net - guess)) * 100000, 0) AS mae_money,"
    " 1 - avg((net - guess) * (net - guess)) / var_pop(net) > 0.5::DOUBLE AS good_fit FROM priced",
)
def regression_report(spark, sf_dir):
    report = ops.regression_report(priced_lines(spark, sf_dir), "net", "guess")
    report = _round(_round(report, 4, "mae", "rmse"), 0, "mae_money")
    return _round(_round(report, 2, "mse"), 6, "r2")


@query(
    "actual_vs_predicted",
    f"WITH {PRICED_SQL}, e AS (SELECT least(min(net), min(guess)) AS lo,"
    " greatest(max(net), max(guess)) AS hi FROM priced)"
    " SELECT round(net, 6) AS actual, round(guess, 6) AS predicted, round(lo, 6) AS line_lo,"
    " round(hi, 6) AS line_hi FROM priced CROSS JOIN e",
)
def actual_vs_predicted(spark, sf_dir):
    points = ops.actual_vs_predicted(priced_lines(spark, sf_dir), "net", "guess")
    return _round(points, 6, *points.columns)


# --- classes ---------------------------------------------------------------------------------


@query(
    "confusion_matrix",
    f"WITH {SCORED_SQL}, g AS (SELECT a AS y_true, b AS y_pred FROM (VALUES (0), (1)) t(a)"
    " CROSS JOIN (VALUES (0), (1)) u(b))"
    " SELECT y_true, y_pred, count(y) AS n FROM g LEFT JOIN scored ON y = y_true AND pred = y_pred"
    " GROUP BY 1, 2",
)
def confusion_matrix(spark, sf_dir):
    return ops.confusion_matrix(scored_lines(spark, sf_dir), "y", "pred")


@query(
    "confusion_matrix_labels",
    f"WITH {SCORED_SQL}, g AS (SELECT a AS y_true, b AS y_pred FROM (VALUES ('A'), ('N'), ('R')) t(a)"
    " CROSS JOIN (VALUES ('A'), ('N'), ('R')) u(b))"
    " SELECT y_true, y_pred, count(l_returnflag) AS n FROM g LEFT JOIN scored"
    " ON l_returnflag = y_true AND (CASE WHEN pred = 1 THEN 'R' ELSE 'A' END) = y_pred GROUP BY 1, 2",
)
def confusion_matrix_labels(spark, sf_dir):
    said = F.when(F.col("pred") == 1, "R").otherwise("A")
    scored = scored_lines(spark, sf_dir).withColumn("said", said)
    return ops.confusion_matrix(scored, "l_returnflag", "said", ["A", "N", "R"])


def rates_sql(table: str, by: str = "", pos: int = 1, suffix: str = "") -> str:
    """CTEs ending in ``m<suffix>``: rates per group."""
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return f"""c{suffix} AS (SELECT {lead}count(*) AS n,
  count(*) FILTER (y = {pos} AND pred = {pos})::DOUBLE AS tp,
  count(*) FILTER (y <> {pos} AND pred = {pos})::DOUBLE AS fp,
  count(*) FILTER (y = {pos} AND pred <> {pos})::DOUBLE AS fn,
  count(*) FILTER (y <> {pos} AND pred <> {pos})::DOUBLE AS tn FROM {table}{group}),
m{suffix} AS (SELECT {lead}n, (tp + tn) / n AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
  (tp + fp) / n AS selection_rate FROM c{suffix})"""


_RATES = ("accuracy", "precision", "recall", "f1")
_ROUNDED_RATES = ", ".join(f"round({c}, 6) AS {c}" for c in _RATES)


@query("binary_metrics", f"WITH {SCORED_SQL}, {rates_sql('scored')} SELECT {_ROUNDED_RATES} FROM m")
def binary_metrics(spark, sf_dir):
    return _round(ops.binary_metrics(scored_lines(spark, sf_dir), "y", "pred"), 6, *_RATES)


@query(
    "binary_metrics_class0",
    f"WITH {SCORED_SQL}, {rates_sql('scored', pos=0)} SELECT {_ROUNDED_RATES} FROM m",
)
def binary_metrics_class0(spark, sf_dir):
    return _round(ops.binary_metrics(scored_lines(spark, sf_dir), "y", "pred", 0), 6, *_RATES)


def report_sql(table: str) -> str:
    """The rest of a query: the class report of two classes."""
    return f"""per_class AS (SELECT label::VARCHAR AS label,
             count(*) FILTER (y = label AND pred = label)::DOUBLE AS tp,
             count(*) FILTER (y = label) AS support, count(*) FILTER (pred = label) AS said
      FROM {table}, (VALUES (0), (1)) t(label) GROUP BY 1),
parts AS (SELECT label, coalesce(tp / nullif(said, 0), 0) AS precision,
             coalesce(tp / nullif(support, 0), 0) AS recall,
             coalesce(2 * tp / nullif(said + support, 0), 0) AS f1, support, tp FROM per_class),
averaged AS (SELECT label, precision, recall, f1, support FROM parts
UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support),
                 sum(tp) / sum(support), sum(support) FROM parts
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM parts
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
                 sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
                 sum(support) FROM parts)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       support::BIGINT AS support FROM averaged"""


@query("classification_report", f"WITH {SCORED_SQL}, {report_sql('scored')}")
def classification_report(spark, sf_dir):
    report = ops.classification_report(scored_lines(spark, sf_dir), "y", "pred")
    return _round(report, 6, "precision", "recall", "f1")


# --- scores ----------------------------------------------------------------------------------


def auc_sql(score: str, table: str = "scored", suffix: str = "") -> str:
    """CTEs ending in ``auc<suffix>``."""
    return f"""b{suffix} AS (SELECT {score} AS s, count(*) FILTER (y = 1)::DOUBLE AS pos,
  count(*) FILTER (y <> 1)::DOUBLE AS neg FROM {table} GROUP BY 1),
r{suffix} AS (SELECT *, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      AS upto FROM b{suffix}),
auc{suffix} AS (SELECT sum(pos * (upto - neg / 2)) / (sum(pos) * sum(neg)) AS roc_auc
      FROM r{suffix})"""


@query("roc_auc", f"WITH {SCORED_SQL}, {auc_sql('prob')} SELECT round(roc_auc, 6) AS roc_auc FROM auc")
def roc_auc(spark, sf_dir):
    return _round(ops.roc_auc(scored_lines(spark, sf_dir), "y", "prob"), 6, "roc_auc")


@query(
    "roc_auc_ties",
    f"WITH {SCORED_SQL}, {auc_sql('l_quantity')} SELECT round(roc_auc, 6) AS roc_auc FROM auc",
)
def roc_auc_ties(spark, sf_dir):
    return _round(ops.roc_auc(scored_lines(spark, sf_dir), "y", "l_quantity"), 6, "roc_auc")


@query(
    "roc_curve",
    f"""WITH {SCORED_SQL},
b AS (SELECT prob AS threshold, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y <> 1) AS neg
      FROM scored GROUP BY 1),
r AS (SELECT threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM b
      WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
t AS (SELECT sum(pos)::DOUBLE AS pos, sum(neg)::DOUBLE AS neg FROM b)
SELECT round(threshold, 9) AS threshold, round(fp::DOUBLE / neg, 6) AS fpr,
       round(tp::DOUBLE / pos, 6) AS tpr FROM r CROSS JOIN t
UNION ALL SELECT 'Infinity'::DOUBLE, 0, 0""",
)
def roc_curve(spark, sf_dir):
    curve = ops.roc_curve(scored_lines(spark, sf_dir), "y", "prob")
    finite = F.when(F.col("threshold") < 2, F.round("threshold", 9)).otherwise(F.col("threshold"))
    return _round(curve.withColumn("threshold", finite), 6, "fpr", "tpr")


_BOARD_SQL = f"""{SCORED_SQL}, {rates_sql('scored')}, {auc_sql('prob')},
scored_q AS (SELECT y, l_quantity AS prob, (l_quantity > 25)::INT AS pred FROM scored),
{rates_sql('scored_q', suffix='2')}, {auc_sql('prob', 'scored_q', suffix='2')},
board AS (
  SELECT 'rule' AS model, accuracy, precision, recall, f1, roc_auc, 0 AS listed FROM m CROSS JOIN auc
  UNION ALL
  SELECT 'quantity', accuracy, precision, recall, f1, roc_auc, 1 FROM m2 CROSS JOIN auc2)
"""
_BOARD_COLUMNS = f"model, {_ROUNDED_RATES}, round(roc_auc, 6) AS roc_auc, listed"


def _board(spark, sf_dir):
    scored = scored_lines(spark, sf_dir)
    by_quantity = scored.select(
        "y", F.col("l_quantity").alias("prob"), (F.col("l_quantity") > 25).cast("int").alias("pred")
    )
    return models.leaderboard(
        ops.evaluate_scored(scored, "rule", "y", "pred", "prob"),
        ops.evaluate_scored(by_quantity, "quantity", "y", "pred", "prob"),
    )


@query(
    "evaluate_scored",
    f"WITH {_BOARD_SQL} SELECT model, {_ROUNDED_RATES}, round(roc_auc, 6) AS roc_auc FROM board"
    " WHERE model = 'rule'",
)
def evaluate_scored(spark, sf_dir):
    row = ops.evaluate_scored(scored_lines(spark, sf_dir), "rule", "y", "pred", "prob")
    return _round(row, 6, *_RATES, "roc_auc")


@query("leaderboard", f"WITH {_BOARD_SQL} SELECT {_BOARD_COLUMNS} FROM board")
def leaderboard(spark, sf_dir):
    return _round(_board(spark, sf_dir), 6, *_RATES, "roc_auc")


@query(
    "best_model",
    f"WITH {_BOARD_SQL} SELECT {_BOARD_COLUMNS} FROM board ORDER BY board.roc_auc DESC, listed LIMIT 1",
)
def best_model(spark, sf_dir):
    return _round(models.best_model(_board(spark, sf_dir)), 6, *_RATES, "roc_auc")


# --- fairness --------------------------------------------------------------------------------

_GROUP = (
    f"CASE floor({unit_sql('group')} * {len(fairness.AGE_GROUPS)})::INT "
    + " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(fairness.AGE_GROUPS))
    + " END"
)
GROUPED_SQL = f"{SCORED_SQL}, grouped AS (SELECT *, {_GROUP} AS age_group FROM scored)"


def grouped_lines(spark, sf_dir):
    return fairness.assign_group(scored_lines(spark, sf_dir), LINE_KEY, seed=SEED)


@query("assign_group", f"WITH {GROUPED_SQL} SELECT {KEYS_SQL}, age_group FROM grouped")
def assign_group(spark, sf_dir):
    return grouped_lines(spark, sf_dir).select(*LINE_KEY, "age_group")


@query(
    "group_counts",
    f"WITH {GROUPED_SQL} SELECT age_group AS value, count(*) AS n,"
    " round(count(*) * 100::DOUBLE / (SELECT count(*) FROM grouped), 6) AS percent"
    " FROM grouped GROUP BY 1",
)
def group_counts(spark, sf_dir):
    return _round(fairness.group_counts(grouped_lines(spark, sf_dir), "age_group"), 6, "percent")


_GROUP_METRICS = f"n, {_ROUNDED_RATES}, round(selection_rate, 6) AS selection_rate"


@query(
    "group_metrics",
    f"WITH {GROUPED_SQL}, {rates_sql('grouped', 'age_group')}"
    f" SELECT age_group, {_GROUP_METRICS} FROM m",
)
def group_metrics(spark, sf_dir):
    metrics = fairness.group_metrics(grouped_lines(spark, sf_dir), "age_group", "y", "pred")
    return _round(metrics, 6, *_RATES, "selection_rate")


@query(
    "group_metrics_lang",
    f"WITH {REVIEWS_SQL}, {rates_sql('scored', 'lang')} SELECT lang, {_GROUP_METRICS} FROM m",
)
def group_metrics_lang(spark, sf_dir):
    metrics = fairness.group_metrics(scored_reviews(spark, sf_dir), "lang", "y", "pred")
    return _round(metrics, 6, *_RATES, "selection_rate")


@query(
    "disparate_impact",
    f"WITH {REVIEWS_SQL}, {rates_sql('scored', 'lang')},"
    " d AS (SELECT min(selection_rate) AS min_rate, max(selection_rate) AS max_rate FROM m)"
    " SELECT round(min_rate, 6) AS min_rate, round(max_rate, 6) AS max_rate,"
    " round(min_rate / nullif(max_rate, 0), 6) AS ratio,"
    " min_rate / nullif(max_rate, 0) < 0.8::DOUBLE AS violated FROM d",
)
def disparate_impact(spark, sf_dir):
    metrics = fairness.group_metrics(scored_reviews(spark, sf_dir), "lang", "y", "pred")
    return _round(fairness.disparate_impact(metrics), 6, "min_rate", "max_rate", "ratio")


@query(
    "four_fifths_table",
    f"WITH {REVIEWS_SQL}, {rates_sql('scored', 'lang')}"
    " SELECT lang, n, round(selection_rate, 6) AS selection_rate,"
    " round((SELECT max(selection_rate) FROM m) * 0.8::DOUBLE, 6) AS needed_rate,"
    " selection_rate >= (SELECT max(selection_rate) FROM m) * 0.8::DOUBLE AS passes FROM m",
)
def four_fifths_table(spark, sf_dir):
    metrics = fairness.group_metrics(scored_reviews(spark, sf_dir), "lang", "y", "pred")
    table = fairness.four_fifths_table(metrics, "lang")
    return _round(table, 6, "selection_rate", "needed_rate")
