"""Thresholds and calibration, by group."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillframe.operators import calibration, thresholds
from quillframe.plans.evaluating import GROUPED_SQL, grouped_lines
from quillframe.plans.registry import query
from quillframe.plans.standins import SCORED_SQL, scored_lines

COST_FP, COST_FN = 1.0, 2.0


def _round(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query(
    "threshold_for_recall",
    f"""WITH {SCORED_SQL},
b AS (SELECT prob AS threshold, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y <> 1) AS neg
      FROM scored GROUP BY 1),
r AS (SELECT threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM b
      WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
t AS (SELECT sum(pos)::DOUBLE AS pos, sum(neg)::DOUBLE AS neg FROM b)
SELECT round(threshold, 9) AS threshold, round(tp / pos, 6) AS recall, round(tp / (tp + fp), 6) AS precision,
       round(fp / neg, 6) AS fpr
FROM r CROSS JOIN t WHERE tp / pos >= 0.95::DOUBLE ORDER BY r.threshold DESC LIMIT 1""",
)
def threshold_for_recall(spark, sf_dir):
    found = thresholds.threshold_for_recall(scored_lines(spark, sf_dir), "y", "prob", 0.95)
    return _round(_round(found, 9, "threshold"), 6, "recall", "precision", "fpr")


# Scores of few values, so that every pair of points can be compared in SQL.
_HULL_SQL = f"""{GROUPED_SQL},
b AS (SELECT age_group, l_quantity AS threshold, count(*) FILTER (y = 1) AS pos,
             count(*) FILTER (y <> 1) AS neg FROM grouped GROUP BY 1, 2),
r AS (SELECT age_group, threshold, sum(neg) OVER w AS fp, sum(pos) OVER w AS tp FROM b
      WINDOW w AS (PARTITION BY age_group ORDER BY threshold DESC)
      UNION ALL SELECT DISTINCT age_group, 'Infinity'::DOUBLE, 0, 0 FROM b),
t AS (SELECT age_group, sum(pos)::BIGINT AS pos, sum(neg)::BIGINT AS neg FROM b GROUP BY 1),
turns AS (SELECT r.age_group, r.threshold, r.fp, r.tp,
       min(CASE WHEN l.threshold > r.threshold THEN CASE WHEN l.fp = r.fp THEN 'Infinity'::DOUBLE
           ELSE (r.tp - l.tp)::DOUBLE / (r.fp - l.fp) END END) AS before,
       max(CASE WHEN l.threshold < r.threshold THEN CASE WHEN l.fp = r.fp THEN 'Infinity'::DOUBLE
           ELSE (l.tp - r.tp)::DOUBLE / (l.fp - r.fp) END END) AS behind
  FROM r JOIN r l USING (age_group) GROUP BY ALL),
hull AS MATERIALIZED (
  SELECT age_group, threshold, fp::BIGINT AS fp, tp::BIGINT AS tp, fp::DOUBLE / neg AS fpr,
         tp::DOUBLE / pos AS tpr, pos, neg FROM turns JOIN t USING (age_group)
  WHERE before IS NULL OR behind IS NULL OR before > behind + 1e-12::DOUBLE)"""


def _hull(spark, sf_dir):
    return thresholds.roc_hull(grouped_lines(spark, sf_dir), "y", "l_quantity", "age_group")


@query(
    "roc_hull",
    f"WITH {_HULL_SQL} SELECT age_group, threshold, fp, tp, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr,"
    " pos, neg FROM hull",
)
def roc_hull(spark, sf_dir):
    return _round(_hull(spark, sf_dir), 6, "fpr", "tpr")


@query(
    "equal_recall_thresholds",
    f"""WITH {_HULL_SQL},
s AS (SELECT age_group, lag(tpr) OVER w AS tpr0, tpr AS tpr1, lag(fp) OVER w AS fp0, fp AS fp1,
             lag(threshold) OVER w AS upper, threshold AS lower, pos, neg FROM hull
      WINDOW w AS (PARTITION BY age_group ORDER BY tpr, fpr)),
c AS (SELECT DISTINCT tpr AS rate FROM hull),
m AS (SELECT rate, age_group, min(fp0 + (rate - tpr0) / (tpr1 - tpr0) * (fp1 - fp0)) AS fp, any_value(pos) AS pos
      FROM c JOIN s ON rate BETWEEN tpr0 AND tpr1 AND tpr1 > tpr0 GROUP BY ALL),
best AS (SELECT rate FROM m GROUP BY rate
         ORDER BY round(sum({COST_FP}::DOUBLE * fp + {COST_FN}::DOUBLE * pos * (1 - rate)), 6), rate LIMIT 1),
cut AS (SELECT *, (rate - tpr0) / (tpr1 - tpr0) AS share FROM s JOIN best ON rate BETWEEN tpr0 AND tpr1 AND tpr1 > tpr0
        QUALIFY row_number() OVER (PARTITION BY age_group ORDER BY tpr0) = 1)
SELECT age_group, round(rate, 6) AS tpr, upper, lower, round(share, 6) AS share,
       round((fp0 + share * (fp1 - fp0)) / neg, 6) AS fpr FROM cut""",
)
def equal_recall_thresholds(spark, sf_dir):
    cuts = thresholds.equal_recall_thresholds(_hull(spark, sf_dir), "age_group", COST_FP, COST_FN)
    return _round(cuts, 6, "tpr", "share", "fpr")


_BINS_SQL = f"""{GROUPED_SQL},
bins AS (SELECT age_group, least(floor(prob * 10), 9)::INT AS bin, count(*) AS n, avg(prob) AS mean_prob,
                avg(y::DOUBLE) AS observed FROM grouped GROUP BY 1, 2)"""


def _bins(spark, sf_dir):
    return calibration.calibration_table(grouped_lines(spark, sf_dir), "y", "prob", "age_group")


@query(
    "calibration_table",
    f"WITH {_BINS_SQL} SELECT age_group, bin, n, round(mean_prob, 6) AS mean_prob,"
    " round(observed, 6) AS observed FROM bins",
)
def calibration_table(spark, sf_dir):
    return _round(_bins(spark, sf_dir), 6, "mean_prob", "observed")


@query(
    "calibration_error",
    f"WITH {_BINS_SQL} SELECT age_group, sum(n)::BIGINT AS n,"
    " round(sum(abs(mean_prob - observed) * n) / sum(n), 6) AS expected_error,"
    " round(max(abs(mean_prob - observed)), 6) AS largest_error FROM bins GROUP BY 1",
)
def calibration_error(spark, sf_dir):
    errors = calibration.calibration_error(_bins(spark, sf_dir), "age_group")
    return _round(errors, 6, "expected_error", "largest_error")


@query(
    "fit_isotonic",
    f"""WITH {SCORED_SQL},
b AS (SELECT round(prob, 2) AS score, count(*) FILTER (y = 1) AS pos, count(*) AS n FROM scored GROUP BY 1),
u AS (SELECT score, sum(pos) OVER w AS pos, sum(n) OVER w AS n, sum(pos) OVER w - pos AS pos0,
             sum(n) OVER w - n AS n0 FROM b WINDOW w AS (ORDER BY score)),
low AS (SELECT a.score AS start, j.score, min((k.pos - a.pos0)::DOUBLE / (k.n - a.n0)) AS least
        FROM u a JOIN u j ON a.score <= j.score JOIN u k ON k.score >= j.score GROUP BY 1, 2)
SELECT score, round(max(least), 6) AS value FROM low GROUP BY 1""",
)
def fit_isotonic(spark, sf_dir):
    """The fitted value at each score, over steps found by pooling."""
    rows = scored_lines(spark, sf_dir).select("y", F.round("prob", 2).alias("score"))
    steps = calibration.fit_isotonic(rows, "y", "score", digits=None)
    found = calibration.calibrated(rows.select("score").distinct(), steps, "score", "value")
    return _round(found, 6, "value")
