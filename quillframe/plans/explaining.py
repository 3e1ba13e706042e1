"""Contributions, surrogates and example rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillframe.operators import explain as ops
from quillframe.operators.joins import settle
from quillframe.operators.models import fit_forest, predict
from quillframe.operators.scaling import assemble
from quillframe.operators.splitting import split
from quillframe.plans.modelling import FIT_SQL, fitted_line
from quillframe.plans.registry import query
from quillframe.plans.standins import (
    FEATURES,
    KEYS_SQL,
    LINE_KEY,
    LINES_SQL,
    SCORED_SQL,
    SEED,
    classed_lines,
    hash_sql,
    lines,
    scored_lines,
)
from quillframe.sources.artifacts import materialize

WEIGHTS = dict(zip(FEATURES, (2.0, 0.95, -38_000.0, 36_000.0), strict=True))
INTERCEPT = 100.0

_W = [f"({w}::DOUBLE)" for w in WEIGHTS.values()]
_MEANS = ", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(FEATURES))
_BASE = f"{INTERCEPT}::DOUBLE + " + " + ".join(f"{w} * m{i}" for i, w in enumerate(_W))
_PREDICTION = " + ".join(
    ["base", *[f"{w} * ({c} - m{i})" for i, (c, w) in enumerate(zip(FEATURES, _W, strict=True))]]
)
_PUSHES = " UNION ALL ".join(
    f"SELECT {KEYS_SQL}, '{c}' AS feature, {c} AS value, {w} * ({c} - m{i}) AS contribution, base,"
    f" {_PREDICTION} AS prediction FROM lines CROSS JOIN base"
    for i, (c, w) in enumerate(zip(FEATURES, _W, strict=True))
)
SHAP_SQL = f"""{LINES_SQL},
means AS (SELECT {_MEANS} FROM lines),
base AS (SELECT *, {_BASE} AS base FROM means),
shap AS ({_PUSHES})"""


def _contributions(spark, sf_dir):
    return ops.linear_shapley(lines(spark, sf_dir), WEIGHTS, INTERCEPT, LINE_KEY)


def _round(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query(
    "linear_shapley",
    f"WITH {SHAP_SQL} SELECT {KEYS_SQL}, feature, value, round(contribution, 3) AS contribution,"
    " round(base, 3) AS base, round(prediction, 4) AS prediction FROM shap",
)
def linear_shapley(spark, sf_dir):
    contributions = _round(_contributions(spark, sf_dir), 3, "contribution", "base")
    return _round(contributions, 4, "prediction")


_RANKING = """ranking AS (SELECT feature, avg(abs(contribution)) AS mean_abs FROM shap GROUP BY 1),
ranked AS (SELECT (row_number() OVER (ORDER BY mean_abs DESC, feature))::INT AS rank, * FROM ranking)"""


@query(
    "shapley_ranking",
    f"WITH {SHAP_SQL}, {_RANKING} SELECT rank, feature, round(mean_abs, 4) AS mean_abs FROM ranked",
)
def shapley_ranking(spark, sf_dir):
    return _round(ops.shapley_ranking(_contributions(spark, sf_dir)), 4, "mean_abs")


@query(
    "shapley_summary_points",
    f"""WITH {SHAP_SQL}, {_RANKING},
v AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM shap GROUP BY 1)
SELECT rank, feature, {KEYS_SQL}, round(contribution, 2) AS contribution,
       round((value - lo) / nullif(hi - lo, 0), 6) AS scaled_value
FROM shap JOIN ranked USING (feature) JOIN v USING (feature)""",
)
def shapley_summary_points(spark, sf_dir):
    points = ops.shapley_summary_points(_contributions(spark, sf_dir), LINE_KEY)
    return _round(_round(points, 2, "contribution"), 6, "scaled_value")


@query(
    "force_breakdown",
    f"""WITH {SHAP_SQL},
first AS (SELECT {KEYS_SQL} FROM lines ORDER BY {KEYS_SQL} LIMIT 1),
one AS (SELECT shap.* FROM shap JOIN first USING ({KEYS_SQL}))
SELECT (row_number() OVER w)::INT AS rank, feature, value, round(contribution, 4) AS contribution,
       CASE WHEN contribution > 0 THEN 'up' ELSE 'down' END AS direction, round(base, 4) AS base,
       round(base + sum(contribution) OVER w, 4) AS running, round(prediction, 4) AS prediction,
       0::DOUBLE AS additivity_error
FROM one WINDOW w AS (ORDER BY abs(contribution) DESC, feature)""",
)
def force_breakdown(spark, sf_dir):
    first = lines(spark, sf_dir).select(*LINE_KEY).orderBy(*LINE_KEY).first().asDict()
    steps = ops.force_breakdown(_contributions(spark, sf_dir), first)
    steps = _round(steps, 4, "contribution", "base", "running", "prediction")
    return steps.withColumn("additivity_error", F.abs(F.round("additivity_error", 6)))


_PARTNERS = " UNION ALL ".join(
    f"SELECT '{c}' AS partner, abs(corr(l_extendedprice, {c})) AS strength FROM lines"
    for c in FEATURES
    if c != "l_extendedprice"
)

_PARTNER_VALUES = " ".join(f"WHEN '{c}' THEN {c}" for c in FEATURES if c != "l_extendedprice")


@query(
    "dependence_points",
    f"""WITH {LINES_SQL}, partners AS ({_PARTNERS}),
best AS (SELECT partner FROM partners ORDER BY strength DESC, partner DESC LIMIT 1),
mean AS (SELECT avg(l_extendedprice) AS m FROM lines)
SELECT {KEYS_SQL}, l_extendedprice AS value,
       round({WEIGHTS['l_extendedprice']}::DOUBLE * (l_extendedprice - (SELECT m FROM mean)), 2)
           AS contribution,
       (SELECT partner FROM best) AS partner,
       CASE (SELECT partner FROM best) {_PARTNER_VALUES} END AS partner_value
FROM lines""",
)
def dependence_points(spark, sf_dir):
    pushes = ops.linear_pushes(lines(spark, sf_dir), WEIGHTS, INTERCEPT, LINE_KEY)
    points = ops.dependence_points(pushes, "l_extendedprice", LINE_KEY)
    return _round(points, 2, "contribution")


N_BACKGROUND = 20
_LINEAR_PUSHES = " UNION ALL ".join(
    f"SELECT {KEYS_SQL}, '{c}' AS feature, {c} AS value, w{i + 1} * ({c} - g{i}) AS contribution,"
    f" w0 + w1 * g0 + w2 * g1 + w3 * g2 + w4 * g3 AS base, prediction FROM explained"
    for i, c in enumerate(FEATURES)
)


@query(
    "sampled_shapley",
    f"""WITH {FIT_SQL},
near AS (SELECT * FROM train ORDER BY {hash_sql('sample')}, {KEYS_SQL} LIMIT {N_BACKGROUND}),
g AS (SELECT {', '.join(f'avg({c}) AS g{i}' for i, c in enumerate(FEATURES))} FROM near),
explained AS (SELECT *, w0 + w1 * l_quantity + w2 * l_extendedprice + w3 * l_discount + w4 * l_tax
                     AS prediction FROM parted CROSS JOIN fit CROSS JOIN g
              WHERE split = 'test'),
shap AS ({_LINEAR_PUSHES})
SELECT {KEYS_SQL}, feature, value, round(contribution, 2) AS contribution, round(base, 2) AS base,
       round(prediction, 2) AS prediction FROM shap""",
)
def sampled_shapley(spark, sf_dir):
    """Every test row; a linear model's sampled contributions need no walks."""
    ready, model = fitted_line(spark, sf_dir)
    plain = ready.drop("features")
    found = ops.sampled_shapley(
        plain.where("split = 'test'"), model, FEATURES, plain.where("split = 'train'"), LINE_KEY,
        LINE_KEY, n_background=N_BACKGROUND, seed=SEED,
    )
    return _round(found, 2, "contribution", "base", "prediction")


def _forest(train):
    return fit_forest(assemble(train, FEATURES), trees=20, max_depth=8, min_leaf=5)


@query("sampled_shapley_forest")
def sampled_shapley_forest(spark, sf_dir):
    """Every test row of a forest fitted on the training side, over all orders of the features."""
    parted = split(classed_lines(spark, sf_dir), 0.2, LINE_KEY, SEED)
    train, test = parted.where("split = 'train'"), parted.where("split = 'test'")
    return ops.exact_shapley(
        test, _forest(train), FEATURES, train, LINE_KEY, LINE_KEY, n_background=N_BACKGROUND,
        seed=SEED,
    )


@query(
    "pick_examples",
    f"""WITH {SCORED_SQL},
right0 AS (SELECT * FROM scored WHERE y = pred AND y = 0 ORDER BY {KEYS_SQL} LIMIT 1),
right1 AS (SELECT * FROM scored WHERE y = pred AND y = 1 ORDER BY {KEYS_SQL} LIMIT 1),
wrong AS (SELECT * FROM scored WHERE y <> pred ORDER BY {KEYS_SQL} LIMIT 1),
chosen AS (SELECT *, 'correct_0' AS example FROM right0 UNION ALL
           SELECT *, 'correct_1' AS example FROM right1 UNION ALL
           SELECT *, 'wrong' AS example FROM wrong)
SELECT {KEYS_SQL}, y, pred, round(prob, 6) AS prob, example FROM chosen""",
)
def pick_examples(spark, sf_dir):
    scored = scored_lines(spark, sf_dir).select(*LINE_KEY, "y", "pred", "prob")
    return _round(ops.pick_examples(scored, "y", "pred", LINE_KEY), 6, "prob")


@query("local_surrogate")
def local_surrogate(spark, sf_dir):
    """Explain a right row of each class and a wrong one, as scored by a forest."""
    parted = split(classed_lines(spark, sf_dir), 0.2, LINE_KEY, SEED)
    train, test = parted.where("split = 'train'"), parted.where("split = 'test'")
    model = _forest(train)
    scored = predict(model, assemble(test, FEATURES)).select(
        *LINE_KEY, *FEATURES, "label", "prediction"
    )
    scored = materialize(scored, "scored")  # read once per kind of example
    rows = ops.pick_examples(scored, "label", "prediction", LINE_KEY)
    return ops.local_surrogate(
        settle(rows).select("example", *FEATURES), model, train, FEATURES, ["example"]
    )
