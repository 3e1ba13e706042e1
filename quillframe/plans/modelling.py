"""Fitting, applying and choosing models."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from quillframe.operators import fairness, metrics, models
from quillframe.operators.joins import settle
from quillframe.operators.scaling import assemble, scale_and_assemble
from quillframe.operators.splitting import cross_validate, grid_search, split, stratified_split
from quillframe.plans.evaluating import auc_sql, rates_sql, report_sql
from quillframe.plans.registry import query
from quillframe.plans.standins import (
    CLASSED_SQL,
    FEATURES,
    FEATURES_SQL,
    KEYS_SQL,
    LINE_KEY,
    LINES_SQL,
    SEED,
    classed_lines,
    hash_sql,
    lines,
    stratified_sql,
    unit_sql,
    vectors,
)
from quillframe.sources import artifacts

VECTOR_FEATURES = [f"v{i}" for i in range(64)]


def least_squares_sql(table: str, features: list[str], target: str) -> str:
    """CTEs ending in ``fit`` (w0 = intercept, w1.. = weights): least squares by taking from each
    feature what the earlier ones explain."""
    p = len(features)
    ks = range(1, p + 1)
    means = ", ".join(f"avg({c}) AS m{k}" for k, c in zip(ks, features, strict=True))
    centred = ", ".join(f"{c} - m{k} AS x{k}" for k, c in zip(ks, features, strict=True))
    ctes = [
        f"means AS (SELECT {means}, avg({target}) AS m0 FROM {table})",
        f"e1 AS (SELECT {centred}, {target} - m0 AS y FROM {table} CROSS JOIN means)",
    ]
    for j in ks:
        slopes = [f"sum(y * x{j}) / sum(x{j} * x{j}) AS c{j}"]
        slopes += [f"sum(x{k} * x{j}) / sum(x{j} * x{j}) AS b{k}_{j}" for k in ks if k > j]
        ctes.append(f"s{j} AS (SELECT {', '.join(slopes)} FROM e{j})")
        if j < p:
            rest = [f"x{k} - b{k}_{j} * x{j} AS x{k}" if k > j else f"x{k}" for k in ks]
            ctes.append(f"e{j + 1} AS (SELECT {', '.join(rest)}, y FROM e{j} CROSS JOIN s{j})")
    weights = {p: f"c{p}"}
    for j in reversed(range(1, p)):
        weights[j] = f"(c{j} - " + " - ".join(f"b{k}_{j} * {weights[k]}" for k in ks if k > j) + ")"
    joined = " CROSS JOIN ".join(["means", *[f"s{j}" for j in ks]])
    shown = ", ".join(f"{weights[j]} AS w{j}" for j in ks)
    ctes.append(f"w AS (SELECT *, {shown} FROM {joined})")
    ctes.append(f"fit AS (SELECT *, m0 - {' - '.join(f'w{j} * m{j}' for j in ks)} AS w0 FROM w)")
    return ",\n".join(ctes)


FIT_SQL = f"""{LINES_SQL},
parted AS (SELECT *, CASE WHEN substr({hash_sql('split')}, 1, 8) < '33333334' THEN 'test'
                     ELSE 'train' END AS split FROM lines),
train AS (SELECT * FROM parted WHERE split = 'train'),
{least_squares_sql('train', FEATURES, 'net')},
tested AS (SELECT {KEYS_SQL}, net, w0 + w1 * l_quantity + w2 * l_extendedprice + w3 * l_discount
                  + w4 * l_tax AS prediction
           FROM parted CROSS JOIN fit WHERE split = 'test')"""

_REPORT_SQL = """SELECT count(*) AS n, round(avg(abs(net - prediction)), 4) AS mae,
  round(sqrt(avg((net - prediction) * (net - prediction))), 4) AS rmse,
  round(1 - avg((net - prediction) * (net - prediction)) / var_pop(net), 6) AS r2 FROM tested"""


def fitted_line(spark, sf_dir):
    """The split lines, and least squares fitted on the train side."""
    parted = split(lines(spark, sf_dir), 0.2, LINE_KEY, SEED)
    ready = assemble(parted, FEATURES)
    model = models.fit_linear(ready.where("split = 'train'"), "net")
    return ready, model


def _report(scored):
    report = metrics.regression_report(scored, "net", "prediction").select("n", "mae", "rmse", "r2")
    return report.withColumns(
        {"mae": F.round("mae", 4), "rmse": F.round("rmse", 4), "r2": F.round("r2", 6)}
    )


@query("fit_linear", f"WITH {FIT_SQL} {_REPORT_SQL}")
def fit_linear(spark, sf_dir):
    """Split, fit, predict and measure: the regression from end to end."""
    ready, model = fitted_line(spark, sf_dir)
    return _report(models.predict(model, ready.where("split = 'test'")))


@query(
    "coefficients",
    f"WITH {FIT_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(w{i}, 3) AS weight FROM fit"
        for i, c in enumerate(["intercept", *FEATURES])
    ),
)
def coefficients(spark, sf_dir):
    _, model = fitted_line(spark, sf_dir)
    weights = models.coefficients(spark, model, FEATURES)
    return weights.withColumn("weight", F.round("weight", 3))


@query(
    "predict",
    f"WITH {FIT_SQL} SELECT {KEYS_SQL}, round(prediction, 1) AS prediction FROM tested",
)
def predict(spark, sf_dir):
    ready, model = fitted_line(spark, sf_dir)
    scored = models.predict(model, ready.where("split = 'test'"))
    return scored.select(*LINE_KEY, F.round("prediction", 1).alias("prediction"))


@query("save_model", f"WITH {FIT_SQL} {_REPORT_SQL}")
def save_model(spark, sf_dir):
    """Fit a pipeline, save it, load it, and score with what was loaded."""
    parted = split(lines(spark, sf_dir), 0.2, LINE_KEY, SEED)
    pipeline = Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="features"),
            LinearRegression(labelCol="net", solver="normal", regParam=0.0),
        ]
    )
    path = artifacts.shared_path(spark, "model")
    artifacts.save_model(pipeline.fit(parted.where("split = 'train'")), path)
    loaded = artifacts.load_model(path)
    return _report(models.predict(loaded, parted.where("split = 'test'")))


def logistic_sql(
    rows: str, features: list[str], name: str, c: float = 1.0, weight: str = "1"
) -> str:
    """CTEs ending in ``<name>`` (w0 = intercept, w1.. = weights): L2 logistic regression with
    C = ``c``, rows counting ``weight`` times, on the scaled columns of the CTE ``rows``, by Newton steps whose linear systems are
    solved by elimination, one row at a time."""
    p = len(features)
    x = ["1::DOUBLE", *features]
    js = range(p + 1)
    penalty = f" + 1::DOUBLE / {c}::DOUBLE"
    ctes = [f"{name}_w0 AS (SELECT {', '.join(f'0::DOUBLE AS w{j}' for j in js)})"]
    for step in range(1, NEWTON_STEPS + 1):
        w = f"{name}_w{step - 1}"
        score = " + ".join(f"w{j} * {x[j]}" for j in js)
        gram = [
            f"sum({weight} * p * (1 - p) * {x[i]} * {x[j]}){penalty if i == j > 0 else ''} AS a{i}_{j}"
            for i in js
            for j in js
            if i <= j
        ]
        pull = [
            f"sum({weight} * (label - p) * {x[j]}){f' - any_value(w{j}) / {c}::DOUBLE' if j else ''} AS b{j}"
            for j in js
        ]
        at = f"{name}_g{step}"
        ctes.append(
            f"{at}_0 AS MATERIALIZED (SELECT {', '.join(gram + pull)} FROM (SELECT *,"
            f" 1::DOUBLE / (1::DOUBLE + exp(-({score}))) AS p FROM {rows} CROSS JOIN {w}))"
        )
        for j in range(p):
            cells = [
                f"a{i}_{k} - a{j}_{i} / a{j}_{j} * a{j}_{k} AS a{i}_{k}" if i > j else f"a{i}_{k}"
                for i in js
                for k in js
                if i <= k
            ]
            cells += [
                f"b{i} - a{j}_{i} / a{j}_{j} * b{j} AS b{i}" if i > j else f"b{i}" for i in js
            ]
            ctes.append(f"{at}_{j + 1} AS MATERIALIZED (SELECT {', '.join(cells)} FROM {at}_{j})")
        moves: dict[int, str] = {}
        last = f"{at}_{p}"
        for j in reversed(js):
            known = "".join(f" - a{j}_{k} * d{k}" for k in js if k > j)
            moves[j] = f"(b{j}{known}) / a{j}_{j} AS d{j}"
            ctes.append(
                f"{at}_d{j} AS MATERIALIZED (SELECT *, {moves[j]} FROM {last})"
            )
            last = f"{at}_d{j}"
        ctes.append(
            f"{name}_w{step} AS MATERIALIZED (SELECT "
            + ", ".join(f"w{j} + d{j} AS w{j}" for j in js)
            + f" FROM {w} CROSS JOIN {last})"
        )
    ctes.append(f"{name} AS (SELECT * FROM {name}_w{NEWTON_STEPS})")
    return ",\n".join(ctes)


NEWTON_STEPS = 9
_MEAN_STD = ", ".join(
    f"avg({c}) AS mean_{i}, stddev_pop({c}) AS std_{i}" for i, c in enumerate(FEATURES)
)
_SCALED = ", ".join(f"({c} - mean_{i}) / std_{i} AS {c}" for i, c in enumerate(FEATURES))
_SCORE = " + ".join(["w0", *[f"w{i + 1} * {c}" for i, c in enumerate(FEATURES)]])
CLASSES_SQL = f"""{CLASSED_SQL}, {stratified_sql('classed', 'label', KEYS_SQL)},
scaler AS (SELECT {_MEAN_STD} FROM parted WHERE split = 'train'),
scaled AS (SELECT {KEYS_SQL}, label, split, {_SCALED} FROM parted CROSS JOIN scaler),
train AS MATERIALIZED (SELECT * FROM scaled WHERE split = 'train'),
{logistic_sql('train', FEATURES, 'fit')},
scored0 AS (SELECT {KEYS_SQL}, label AS y, 1::DOUBLE / (1::DOUBLE + exp(-({_SCORE}))) AS prob
            FROM scaled CROSS JOIN fit WHERE split = 'test'),
scored AS MATERIALIZED (SELECT *, (prob > 0.5)::INT AS pred FROM scored0)"""


def fitted_classes(spark, sf_dir):
    """Classed lines split by class, scaled by the train side, and a logistic model of them."""
    parted = stratified_split(classed_lines(spark, sf_dir), 0.2, "label", LINE_KEY, SEED)
    # Read by the scaler, the fit and the scores, which need no digests again.
    parted = artifacts.materialize(parted.select(*LINE_KEY, *FEATURES, "label", "split"), "parted")
    ready = scale_and_assemble(parted.where("split = 'train'"), FEATURES)(parted)
    return ready, models.fit_logistic(ready.where("split = 'train'"))


@query(
    "fit_logistic",
    f"WITH {CLASSES_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(w{i}, 4) AS weight FROM fit"
        for i, c in enumerate(["intercept", *FEATURES])
    ),
)
def fit_logistic(spark, sf_dir):
    _, model = fitted_classes(spark, sf_dir)
    weights = models.coefficients(spark, model, FEATURES)
    return weights.withColumn("weight", F.round("weight", 4))


@query(
    "predict_classes",
    f"WITH {CLASSES_SQL} SELECT {KEYS_SQL}, y AS label, pred AS prediction FROM scored",
)
def predict_classes(spark, sf_dir):
    ready, model = fitted_classes(spark, sf_dir)
    scored = models.predict(model, ready.where("split = 'test'"))
    return scored.select(*LINE_KEY, "label", F.col("prediction").cast("int").alias("prediction"))


_RATES = ["accuracy", "precision", "recall", "f1"]
_SHOWN = ", ".join(f"round({c}, 6) AS {c}" for c in _RATES)


@query(
    "evaluate",
    f"WITH {CLASSES_SQL}, {rates_sql('scored')}, {auc_sql('prob')}"
    f" SELECT 'logistic' AS model, {_SHOWN}, round(roc_auc, 6) AS roc_auc FROM m CROSS JOIN auc",
)
def evaluate(spark, sf_dir):
    ready, model = fitted_classes(spark, sf_dir)
    row = metrics.evaluate(model, ready.where("split = 'test'"), "logistic")["metrics"]
    return row.withColumns({c: F.round(c, 6) for c in [*_RATES, "roc_auc"]})


@query(
    "evaluate_report",
    f"WITH {CLASSES_SQL}, {report_sql('scored')}",
)
def evaluate_report(spark, sf_dir):
    ready, model = fitted_classes(spark, sf_dir)
    report = metrics.evaluate(model, ready.where("split = 'test'"), "logistic")["report"]
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "predict_probabilities",
    f"WITH {CLASSES_SQL} SELECT {KEYS_SQL}, y AS label, round(prob, 3) AS prob FROM scored",
)
def predict_probabilities(spark, sf_dir):
    """P(class 1) of every test row."""
    ready, model = fitted_classes(spark, sf_dir)
    scored = models.predict(model, ready.where("split = 'test'"))
    return scored.select(*LINE_KEY, "label", F.round("prob", 3).alias("prob"))


@query(
    "evaluate_confusion",
    f"WITH {CLASSES_SQL}, g AS (SELECT a AS y_true, b AS y_pred FROM (VALUES (0), (1)) t(a)"
    " CROSS JOIN (VALUES (0), (1)) u(b))"
    " SELECT y_true, y_pred, count(y) AS n FROM g LEFT JOIN scored ON y = y_true AND pred = y_pred"
    " GROUP BY 1, 2",
)
def evaluate_confusion(spark, sf_dir):
    ready, model = fitted_classes(spark, sf_dir)
    return metrics.evaluate(model, ready.where("split = 'test'"), "logistic")["confusion"]


@query(
    "evaluate_roc",
    f"""WITH {CLASSES_SQL},
roc_b AS (SELECT round(prob, 2) AS threshold, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y <> 1) AS neg
      FROM scored GROUP BY 1),
roc_r AS (SELECT threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM roc_b
      WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
roc_t AS (SELECT sum(pos)::DOUBLE AS pos, sum(neg)::DOUBLE AS neg FROM roc_b)
SELECT threshold, round(fp::DOUBLE / neg, 6) AS fpr, round(tp::DOUBLE / pos, 6) AS tpr FROM roc_r CROSS JOIN roc_t
UNION ALL SELECT 'Infinity'::DOUBLE, 0, 0""",
)
def evaluate_roc(spark, sf_dir):
    """The curve of the fitted model over scores of two digits."""
    ready, model = fitted_classes(spark, sf_dir)
    scored = models.predict(model, ready.where("split = 'test'"))
    curve = metrics.roc_curve(scored, "label", "prob", digits=2)
    return curve.withColumns({c: F.round(c, 6) for c in ("fpr", "tpr")})


def _fitted_forest(spark, sf_dir, trees=200):
    parted = stratified_split(vectors(spark, sf_dir), 0.2, "label", ["vec_id"], SEED)
    ready = assemble(parted, VECTOR_FEATURES)
    return ready, models.fit_forest(ready.where("split = 'train'"), trees=trees)


@query("fit_forest")
def fit_forest(spark, sf_dir):
    ready, model = _fitted_forest(spark, sf_dir)
    return metrics.evaluate(model, ready.where("split = 'test'"), "forest")["metrics"]


@query("feature_importance")
def feature_importance(spark, sf_dir):
    _, model = _fitted_forest(spark, sf_dir)
    return models.feature_importance(spark, model, VECTOR_FEATURES, 15)


def _fold_sql(fold: int) -> str:
    """CTEs ending in ``accuracy<fold>``: scaled and fitted without the fold, scored on it."""
    return f"""{_fold_rows_sql(fold)},
{_fold_fit_sql(fold)}"""


def _fold_rows_sql(fold: int) -> str:
    return f"""scaler{fold} AS (SELECT {_MEAN_STD} FROM folded WHERE fold <> {fold}),
scaled{fold} AS MATERIALIZED (SELECT label, fold, {_SCALED} FROM folded CROSS JOIN scaler{fold}),
train{fold} AS MATERIALIZED (SELECT * FROM scaled{fold} WHERE fold <> {fold})"""


def _fold_fit_sql(fold: int, c: float = 1.0, tag: str = "") -> str:
    return f"""{logistic_sql(f'train{fold}', FEATURES, f'fit{fold}{tag}', c)},
accuracy{fold}{tag} AS (
  SELECT {fold} AS fold, count(*) AS n, avg((({_SCORE} > 0)::INT = label)::INT) AS accuracy
  FROM scaled{fold} CROSS JOIN fit{fold}{tag} WHERE fold = {fold})"""


def _folded_sql(k: int) -> str:
    cuts = " + ".join(f"(place > n * {i} // {k})::INT" for i in range(1, k))
    return f"""{CLASSED_SQL},
places AS (
  SELECT *, count(*) OVER (PARTITION BY label) AS n,
         row_number() OVER (PARTITION BY label ORDER BY {hash_sql('fold')}) AS place
  FROM classed),
folded AS MATERIALIZED (SELECT {FEATURES_SQL}, label, ({cuts})::INT AS fold FROM places)"""


FOLDS_SQL = f"""{_folded_sql(5)},
{', '.join(_fold_sql(f) for f in range(5))},
folds AS ({' UNION ALL '.join(f'SELECT * FROM accuracy{f}' for f in range(5))})"""


def _logistic_folds(spark, sf_dir):
    table = classed_lines(spark, sf_dir)
    return cross_validate(table, models.logistic_estimator, 5, FEATURES, "label", LINE_KEY, SEED)


@query(
    "cross_validate", f"WITH {FOLDS_SQL} SELECT fold, n, round(accuracy, 6) AS accuracy FROM folds"
)
def cross_validate_folds(spark, sf_dir):
    folds, _ = _logistic_folds(spark, sf_dir)
    return folds.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "cross_validate_summary",
    f"WITH {FOLDS_SQL} SELECT round(avg(accuracy), 6) AS cv_mean,"
    " round(stddev_pop(accuracy), 6) AS cv_std FROM folds",
)
def cross_validate_summary(spark, sf_dir):
    _, summary = _logistic_folds(spark, sf_dir)
    return summary.withColumns({c: F.round(c, 6) for c in ("cv_mean", "cv_std")})


GRID = [0.0001, 1.0]
_GRID_SQL = f"""{_folded_sql(2)},
{', '.join(_fold_rows_sql(f) for f in range(2))},
{', '.join(_fold_fit_sql(f, c, f's{i}') for i, c in enumerate(GRID) for f in range(2))},
folds AS ({' UNION ALL '.join(f'SELECT {i} AS setting, {c}::DOUBLE AS c, * FROM accuracy{f}s{i}'
                              for i, c in enumerate(GRID) for f in range(2))}),
means AS (SELECT setting, c, avg(accuracy) AS cv_mean, stddev_pop(accuracy) AS cv_std FROM folds GROUP BY 1, 2)"""


@query(
    "grid_search",
    f"""WITH {_GRID_SQL} SELECT (row_number() OVER (ORDER BY round(cv_mean, 12) DESC, round(cv_std, 12), setting))::INT
  AS rank, setting, c, round(cv_mean, 6) AS cv_mean, round(cv_std, 6) AS cv_std FROM means""",
)
def grid_search_settings(spark, sf_dir):
    _, ranked = grid_search(
        classed_lines(spark, sf_dir), models.logistic_estimator, {"c": GRID}, 2, FEATURES, "label",
        LINE_KEY, SEED,
    )
    return ranked.withColumns({c: F.round(c, 6) for c in ("cv_mean", "cv_std")})


_WEIGHTED_SQL = f"""{CLASSED_SQL},
cells AS (SELECT l_returnflag, label, count(*) AS cell FROM lines0 GROUP BY 1, 2),
sizes AS (SELECT *, sum(cell) OVER (PARTITION BY l_returnflag) AS of_group,
                 sum(cell) OVER (PARTITION BY label) AS of_class, sum(cell) OVER () AS whole FROM cells),
weighted AS MATERIALIZED (SELECT {FEATURES_SQL}, label, of_group::DOUBLE * of_class / (whole * cell) AS weight
  FROM lines0 JOIN sizes USING (l_returnflag, label))""".replace("lines0", "classed")


def _weighted(spark, sf_dir):
    rows = classed_lines(spark, sf_dir, "l_returnflag")
    return fairness.balance_weights(rows, "l_returnflag", "label")


@query(
    "balance_weights",
    f"WITH {_WEIGHTED_SQL} SELECT label, count(*) AS n, round(sum(weight), 4) AS weight,"
    " round(min(weight), 6) AS least, round(max(weight), 6) AS most FROM weighted GROUP BY 1",
)
def balance_weights(spark, sf_dir):
    found = _weighted(spark, sf_dir).groupBy("label").agg(
        F.count("*").alias("n"),
        F.round(F.sum("weight"), 4).alias("weight"),
        F.round(F.min("weight"), 6).alias("least"),
        F.round(F.max("weight"), 6).alias("most"),
    )
    return found


@query(
    "fit_weighted",
    f"""WITH {_WEIGHTED_SQL},
scaler AS (SELECT {_MEAN_STD} FROM weighted),
train AS MATERIALIZED (SELECT label, weight, {_SCALED} FROM weighted CROSS JOIN scaler),
{logistic_sql('train', FEATURES, 'fit', weight='weight')} """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(w{i}, 4) AS weight FROM fit"
        for i, c in enumerate(["intercept", *FEATURES])
    ),
)
def fit_weighted(spark, sf_dir):
    rows = _weighted(spark, sf_dir)
    ready = scale_and_assemble(rows, FEATURES)(rows)
    model = models.fit_logistic(ready, weight="weight")
    return models.coefficients(spark, model, FEATURES).withColumn("weight", F.round("weight", 4))


@query(
    "oversample",
    f"""WITH {CLASSED_SQL},
n AS (SELECT label, count(*) AS n FROM classed GROUP BY 1),
r AS (SELECT label, max(n) OVER ()::DOUBLE / n AS rate FROM n),
t AS (SELECT {KEYS_SQL}, label, (floor(rate) + ({unit_sql('copy')} < rate - floor(rate))::INT)::BIGINT AS times
      FROM classed JOIN r USING (label))
SELECT {KEYS_SQL}, label, unnest(range(times)) AS copy FROM t""",
)
def oversample(spark, sf_dir):
    copies = fairness.oversample(classed_lines(spark, sf_dir), "label", LINE_KEY, SEED)
    return copies.select(*LINE_KEY, "label", "copy")


@query("choose_classifier")
def choose_classifier(spark, sf_dir):
    """Split, scale, fit two classifiers, measure, cross-validate, and keep the better one."""
    table = vectors(spark, sf_dir)
    parted = stratified_split(table, 0.2, "label", ["vec_id"], SEED)
    ready = scale_and_assemble(parted.where("split = 'train'"), VECTOR_FEATURES)(parted)
    ready = ready.select("vec_id", "label", "split", "features").persist()
    try:
        train, test = ready.where("split = 'train'"), ready.where("split = 'test'")
        n_train = train.count()
        estimators = {
            "logistic": models.logistic_estimator,
            "forest": lambda n: models.forest_estimator(),
        }

        def measured(name):
            estimator = estimators[name]
            row = metrics.evaluate(estimator(n_train).fit(train), test, name)["metrics"]
            _, summary = cross_validate(table, estimator, 5, VECTOR_FEATURES, "label", ["vec_id"])
            return row.withColumns({c: summary.select(c).scalar() for c in ("cv_mean", "cv_std")})

        with ThreadPool(len(estimators)) as pool:
            rows = pool.map(measured, estimators, 1)
        return settle(models.best_model(models.leaderboard(*rows)))
    finally:
        ready.unpersist()
