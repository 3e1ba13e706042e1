"""Fitting, applying and comparing models, on MLlib."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.operators.forests import grow_forest
from quillframe.operators.ordered import top_k


# Forests draw their samples per partition, so the number of partitions is part of the model.
FOREST_PARTITIONS = 64


@contextmanager
def training_rows(
    df: DataFrame, layout: Column | None = None, partitions: int = FOREST_PARTITIONS
) -> Iterator[tuple[DataFrame, int]]:
    """Cached rows for an iterative fit, and how many there are.

    Rows with a ``layout`` digest go to ``partitions`` by it and are sorted by it inside, so that
    what is drawn per partition depends on the rows alone. Without one, an input of fewer
    partitions than cores is spread, which changes the speed and not the fit.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if layout is not None:
        named = df.withColumn("_layout", layout)
        rows = named.repartition(partitions, "_layout").sortWithinPartitions("_layout").drop("_layout")
    else:
        rows = df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
    rows = rows.persist()
    try:
        yield rows, rows.count()
    finally:
        rows.unpersist()


def fit_linear(df: DataFrame, label: str = "label", features: str = "features") -> Model:
    """Least squares with an intercept; the normal equations need one pass."""
    return LinearRegression(
        labelCol=label, featuresCol=features, solver="normal", regParam=0.0
    ).fit(df)


def logistic_estimator(
    n_train: int,
    c: float = 1.0,
    max_iter: int = 10_000,
    tol: float = 1e-12,
    label: str = "label",
    features: str = "features",
) -> LogisticRegression:
    """L2 logistic regression where ``c`` weighs the summed loss against the penalty.

    MLlib averages the loss instead, hence ``regParam = 1 / (c * n_train)``. Features are expected
    to be scaled already. The fit runs until the loss no longer moves.
    """
    return LogisticRegression(
        labelCol=label,
        featuresCol=features,
        regParam=1.0 / (c * n_train),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tol,
    )


def fit_logistic(
    df: DataFrame,
    label: str = "label",
    features: str = "features",
    c: float = 1.0,
    weight: str | None = None,
) -> Model:
    """``weight`` names a column of how often a row counts; a whole number is as that many rows."""
    if weight is None:
        with training_rows(df.select(label, features)) as (train, n):
            return logistic_estimator(n, c, label=label, features=features).fit(train)
    with training_rows(df.select(label, features, weight)) as (train, _):
        total = train.agg(F.sum(weight)).first()[0]
        return logistic_estimator(total, c, label=label, features=features).setWeightCol(weight).fit(train)


# Up to this depth open nodes are few, and a row's way from the root is shorter than its nodes kept
# for every tree.
SHALLOW_DEPTH = 10


class StagedForest(RandomForestClassifier):
    """MLlib's settings and model; deep trees grow by :func:`forests.grow_forest`.

    The forest depends on the rows, the seed and ``partitions``, not on the input's layout.
    """

    partitions = FOREST_PARTITIONS

    def _fit(self, dataset: DataFrame) -> Model:
        label, features = self.getLabelCol(), self.getFeaturesCol()
        layout = F.xxhash64(vector_to_array(features), F.col(label))
        with training_rows(dataset.select(label, features), layout, self.partitions) as (train, n):
            if self.getMaxDepth() <= SHALLOW_DEPTH:
                return super()._fit(train)
            return grow_forest(train, n, self)


def forest_estimator(
    trees: int = 200,
    max_depth: int = 30,
    min_leaf: int = 1,
    seed: int = 42,
    label: str = "label",
    features: str = "features",
) -> RandomForestClassifier:
    """A forest grown as deep as MLlib allows (30 levels).

    MLlib has no least size for a node to split; the nearest setting is the least size of a leaf.
    """
    return StagedForest(
        labelCol=label,
        featuresCol=features,
        numTrees=trees,
        maxDepth=max_depth,
        minInstancesPerNode=min_leaf,
        seed=seed,
    )


def fit_forest(
    df: DataFrame,
    label: str = "label",
    features: str = "features",
    trees: int = 200,
    max_depth: int = 30,
    min_leaf: int = 1,
    seed: int = 42,
    partitions: int = FOREST_PARTITIONS,
) -> Model:
    """A forest that depends on the rows, the seed and ``partitions``, not on the input's layout."""
    estimator = forest_estimator(trees, max_depth, min_leaf, seed, label, features)
    estimator.partitions = partitions
    return estimator.fit(df)


def fit_boosted(
    df: DataFrame,
    label: str = "label",
    features: str = "features",
    rounds: int = 100,
    max_depth: int = 3,
    step: float = 0.1,
    max_bins: int = 64,
    validation: str | None = None,
    tol: float = 0.01,
    seed: int = 42,
    partitions: int = FOREST_PARTITIONS,
) -> Model:
    """Boosted trees for classes 0 and 1: each tree fits what the earlier ones leave of the loss.

    ``validation`` names a boolean column: its rows are held out, and growing ends when a further
    tree lowers their loss by less than ``tol`` of it; the trees up to the best are kept. The model
    depends on the rows, the seed and ``partitions``, not on the input's layout.
    """
    held = [] if validation is None else [validation]
    layout = F.xxhash64(vector_to_array(features), F.col(label), *held)
    estimator = GBTClassifier(
        labelCol=label,
        featuresCol=features,
        maxIter=rounds,
        maxDepth=max_depth,
        stepSize=step,
        maxBins=max_bins,
        seed=seed,
        validationTol=tol,
        cacheNodeIds=True,
    )
    if validation is not None:
        estimator = estimator.setValidationIndicatorCol(validation)
    with training_rows(df.select(label, features, *held), layout, partitions) as (train, _):
        return estimator.fit(train)


_RULE = re.compile(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)|( *)Predict: (\S+)|\s*Tree (\d+) \(weight (\S+)\):")


def tree_rules(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """The leaves of a fitted ensemble of trees over continuous features: (tree, weight, leaf,
    conditions, prediction), trees and leaves numbered from 0.

    ``conditions`` has (feature, op, threshold) on the way from the root. The table is of the size of
    the model.
    """
    rows, way = [], []
    tree, weight, leaf, lead = 0, 1.0, 0, None
    for line in _final(model).toDebugString.splitlines():
        found = _RULE.match(line)
        if found is None:
            continue
        if found[8] is not None:
            tree, weight, leaf, way, lead = int(found[8]), float(found[9]), 0, [], None
        elif found[2] is not None:
            lead = len(found[1]) if lead is None else lead
            way = way[: len(found[1]) - lead]
            way.append((names[int(found[3])], found[4], float(found[5])))
        else:
            rows.append((tree, weight, leaf, list(way), float(found[7])))
            leaf += 1
    return spark.createDataFrame(
        rows,
        "tree int, weight double, leaf int,"
        " conditions array<struct<feature:string,op:string,threshold:double>>, prediction double",
    )


MAX_LISTED_NODES = 100_000


def tree_cuts(model: Model, n_features: int) -> list[list[float]] | None:
    """Rising thresholds of each feature of an ensemble of trees; its scores differ between cells of
    them only. None for other models, trees over categories and large ensembles."""
    fitted = _final(model)
    if getattr(fitted, "totalNumNodes", MAX_LISTED_NODES + 1) > MAX_LISTED_NODES:
        return None
    found: list[set[float]] = [set() for _ in range(n_features)]
    for line in fitted.toDebugString.splitlines():
        rule = _RULE.match(line)
        if rule is None and " in {" in line:
            return None
        if rule is not None and rule[2] is not None:
            found[int(rule[3])].add(float(rule[5]))
    return [sorted(cuts) for cuts in found]


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Add ``prediction`` and, for a classifier, ``prob`` = P(class 1) as plain columns."""
    scored = model.transform(df)
    if "probability" not in scored.columns:
        return scored
    prob = vector_to_array(F.col("probability"))[1]
    return scored.withColumn("prob", prob).drop("rawPrediction", "probability")


def _final(model: Model) -> Model:
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def coefficients(spark, model: Model, names: Sequence[str]) -> DataFrame:
    """(feature, weight) of a linear or logistic model, and its ``intercept`` row."""
    fitted = _final(model)
    rows = [(n, float(w)) for n, w in zip(names, fitted.coefficients, strict=True)]
    return spark.createDataFrame(
        [*rows, ("intercept", float(fitted.intercept))], "feature string, weight double"
    )


def feature_importance(spark, model: Model, names: Sequence[str], k: int = 15) -> DataFrame:
    """The ``k`` features that lower impurity most: (rank, feature, importance)."""
    values = _final(model).featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values, strict=True)]
    return top_k(
        spark.createDataFrame(rows, "feature string, importance double"), "importance", k, ["feature"]
    )


def leaderboard(*metrics: DataFrame) -> DataFrame:
    """One row per model, numbered in the order given."""
    rows = [m.withColumn("listed", F.lit(i)) for i, m in enumerate(metrics)]
    board = rows[0]
    for row in rows[1:]:
        board = board.unionByName(row, allowMissingColumns=True)
    return board


def best_model(board: DataFrame, by: str = "roc_auc") -> DataFrame:
    """The model of highest AUC; of equal ones the first listed."""
    return board.orderBy(F.desc_nulls_last(by), "listed").limit(1)
