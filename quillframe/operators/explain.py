"""Explaining predictions: Shapley contributions, local surrogates, example rows.

Contributions are a long table: key columns, feature, value, contribution, base, prediction; the
contributions of a row and its base add up to its prediction.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillframe.functions.hashing import hash_hex, hash_normal, hash_unit
from quillframe.functions.scalars import signed_direction
from quillframe.operators.joins import join_small
from quillframe.operators.models import predict, tree_cuts
from quillframe.operators.ordered import top_k
from quillframe.operators.quantiles import quantiles
from quillframe.operators.sampling import sample_n
from quillframe.sources.artifacts import materialize


def linear_pushes(
    df: DataFrame,
    weights: Mapping[str, float],
    intercept: float,
    key: Sequence[str],
    background: DataFrame | None = None,
) -> DataFrame:
    """``linear_shapley`` with a row for each row: (key, pushes, base, prediction).

    ``pushes`` has (feature, value, contribution) for each feature, so rows that share a key stay
    apart, and what compares features of a row needs no shuffle.
    """
    features = list(weights)
    means = (df if background is None else background).agg(*[F.avg(c).alias(c) for c in features])
    mean = means.first().asDict()
    base = intercept + math.fsum(weights[c] * mean[c] for c in features)
    pushes = {c: F.lit(weights[c]) * (F.col(c) - F.lit(mean[c])) for c in features}
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"), pushes[c].alias("contribution"))
        for c in features
    ]
    total = sum((pushes[c] for c in features), F.lit(base))
    return df.select(
        *key, F.array(*rows).alias("pushes"), F.lit(base).alias("base"), total.alias("prediction")
    )


def spread(pushes: DataFrame) -> DataFrame:
    """The long table of contributions from one with a row for each row."""
    others = [c for c in pushes.columns if c not in ("pushes", "base", "prediction")]
    return pushes.select(*others, F.inline("pushes"), "base", "prediction")


def linear_shapley(
    df: DataFrame,
    weights: Mapping[str, float],
    intercept: float,
    key: Sequence[str],
    background: DataFrame | None = None,
) -> DataFrame:
    """Exact contributions ``w * (x - mean)`` of a linear model with independent features.

    For a logistic model they are in log-odds. Means are those of ``background`` (default: the
    table itself).
    """
    return spread(linear_pushes(df, weights, intercept, key, background))


def model_scores(model: Model) -> Callable[[DataFrame], DataFrame]:
    """Adds ``_score``: P(class 1) of a classifier, the prediction of a regressor."""

    def score(df: DataFrame) -> DataFrame:
        scored = predict(model, df)
        return scored.withColumn("_score", F.col("prob" if "prob" in scored.columns else "prediction"))

    return score


def sampled_shapley(
    rows: DataFrame,
    model: Model,
    features: Sequence[str],
    background: DataFrame,
    key: Sequence[str],
    background_key: Sequence[str],
    n_perm: int = 50,
    n_background: int = 20,
    seed: int = 42,
) -> DataFrame:
    """Shapley contributions of any model by sampling feature orders.

    Every row is walked toward from each of ``n_background`` sampled rows, along ``n_perm`` random
    feature orders and their reverses; a feature earns the change in score at its step. Work is
    ``rows * n_background * 2 n_perm * (features + 1)`` scores, so pass only the rows to explain. All
    walks of a linear model gain the same at a feature, so one projection has their mean. Rows that
    share a key stay apart.
    """
    if isinstance(model, LinearRegressionModel):
        weights = dict(zip(features, map(float, model.coefficients), strict=True))
        near = sample_n(background, n_background, background_key, seed)
        plain = rows.withColumns({c: F.col(c).cast("double") for c in features})
        return linear_shapley(plain, weights, float(model.intercept), key, near)
    d = len(features)
    vector = F.array(*[F.col(c).cast("double") for c in features])
    # At most n_background short arrays.
    starts = (
        sample_n(background, n_background, background_key, seed)
        .agg(F.sort_array(F.collect_list(vector)))
        .scalar()
    )
    walks = (
        rows.select(*key, vector.alias("_x"), F.posexplode(starts).alias("_b", "_from"))
        .withColumn("_perm", F.explode(F.sequence(F.lit(1), F.lit(n_perm))))
        .withColumn("_walk", hash_hex([*key, "_b", "_perm"], seed, "walk"))
    )
    index = F.sequence(F.lit(0), F.lit(d - 1))
    draw = F.transform(index, lambda i: F.struct(F.md5(F.concat_ws("|", "_walk", i)), i.alias("i")))
    ordered = walks.withColumn("_order", F.array_sort(draw)["i"]).withColumn(
        "_order", F.explode(F.array("_order", F.reverse("_order")))
    )
    steps = ordered.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    mixed = F.transform(
        index,
        lambda i: F.when(
            F.array_position("_order", i) <= F.col("_step"), F.get("_x", i)
        ).otherwise(F.get("_from", i)),
    )
    scored = model_scores(model)(
        steps.select(*key, "_x", "_order", "_step", array_to_vector(mixed).alias("features"))
    )
    entry = lambda i, part: F.struct(i.cast("int").alias("_i"), part.alias("_part"))
    score = F.col("_score").cast("double")
    gained = F.when(F.col("_step") > 0, entry(F.get("_order", F.col("_step") - 1), score))
    lost = F.when(F.col("_step") < d, entry(F.get("_order", F.col("_step")), -score))
    base = F.when(F.col("_step") == 0, entry(F.lit(-1), score))
    end = F.when(F.col("_step") == d, entry(F.lit(-2), score))
    parts = scored.select(
        *key, "_x", F.inline(F.filter(F.array(gained, lost, base, end), lambda e: e.isNotNull()))
    )
    mean = lambda i: F.avg(F.when(F.col("_i") == i, F.col("_part")))
    sums = parts.groupBy(*key, "_x").agg(
        F.count_if(F.col("_i") == -1).alias("_times"),
        # A step has two parts, so their mean is half of what the feature earns.
        *[(mean(i) * 2).alias(f"_push{i}") for i in range(d)],
        mean(-1).alias("base"),
        mean(-2).alias("prediction"),
    )
    return _explained(sums, F.size(starts) * 2 * n_perm, features, key)


def _explained(sums: DataFrame, walks: Column, features: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Contributions from one row for each key and vector ``_x``, as often as such rows came:
    ``_times`` over ``walks``."""
    entries = [
        F.struct(
            F.lit(c).alias("feature"),
            F.get("_x", F.lit(i)).alias("value"),
            F.col(f"_push{i}").alias("contribution"),
        )
        for i, c in enumerate(features)
    ]
    copies = F.sequence(F.lit(1), (F.col("_times") / walks).cast("int"))
    wide = sums.withColumn("_copy", F.explode(copies))
    return wide.select(*key, F.inline(F.array(*entries)), "base", "prediction")


def exact_shapley(
    rows: DataFrame,
    model: Model,
    features: Sequence[str],
    background: DataFrame,
    key: Sequence[str],
    background_key: Sequence[str],
    n_background: int = 20,
    seed: int = 42,
) -> DataFrame:
    """Shapley contributions of any model over all feature orders, against sampled rows.

    Every row is mixed with each of ``n_background`` sampled rows, once for each subset of features
    that are its own; a feature earns what it adds to the subsets without it, weighted by the share
    of orders in which they come before it. Work is ``rows * n_background * 2 ** features`` scores,
    so there are 12 features at most. Rows that share a key stay apart.
    """
    d = len(features)
    if d > 12:
        raise ValueError("too many features for all their subsets; use sampled_shapley")
    vector = F.array(*[F.col(c).cast("double") for c in features])
    # At most n_background short arrays.
    starts = (
        sample_n(background, n_background, background_key, seed)
        .agg(F.sort_array(F.collect_list(vector)))
        .scalar()
    )
    cuts = tree_cuts(model, d)
    if cuts is None:
        sums = _subset_sums(rows.select(*key, vector.alias("_x")), [*key, "_x"], starts, model, d)
        return _explained(sums, F.size(starts), features, key)
    cell = [f"_cell{i}" for i in range(d)]
    # NaN is above all thresholds; a missing value has no cell, and is an error as in any vector.
    at = [
        F.when(F.get("_x", F.lit(i)).isNotNull(), _bin_of(F.get("_x", F.lit(i)), cuts[i])).alias(cell[i])
        for i in range(d)
    ]
    placed = rows.select(*key, vector.alias("_x")).select(*key, "_x", *at)
    # A cell is scored at the thresholds that close it.
    corner = F.array(
        *[F.get(F.array(*[F.lit(e) for e in [*cuts[i], math.inf]]), F.col(cell[i])) for i in range(d)]
    )
    cells = materialize(placed.select(*cell).distinct(), "cells")
    sums = _subset_sums(cells.select(*cell, corner.alias("_x")), cell, starts, model, d)
    found = materialize(sums.drop("_times"), "contributions")
    joined = join_small(placed, found, cell).withColumn("_times", F.lit(1))
    return _explained(joined, F.lit(1), features, key)


def _subset_sums(vectors: DataFrame, by: Sequence[str], starts: Column, model: Model, d: int) -> DataFrame:
    """Per group the contributions ``_push0``.., base and prediction of its vector ``_x`` over all
    subsets of features, and how many mixes began at the sampled rows."""
    mixes = vectors.withColumn("_from", F.explode(starts)).withColumn(
        "_own", F.explode(F.sequence(F.lit(0), F.lit(2**d - 1)))
    )
    mixed = F.array(
        *[
            F.when(F.col("_own").bitwiseAND(F.lit(1 << i)) > 0, F.get("_x", F.lit(i))).otherwise(
                F.get("_from", F.lit(i))
            )
            for i in range(d)
        ]
    )
    scored = model_scores(model)(
        mixes.select(*by, "_own", array_to_vector(mixed).alias("features"))
    )
    score = F.col("_score").cast("double")

    def weight(i: int, own: int) -> float:
        n = own.bit_count()
        if own >> i & 1:
            return math.factorial(n - 1) * math.factorial(d - n) / math.factorial(d)
        return -math.factorial(n) * math.factorial(d - n - 1) / math.factorial(d)

    def push(i: int) -> Column:
        weights = F.array(*[F.lit(weight(i, own)) for own in range(2**d)])
        return (F.avg(score * F.get(weights, F.col("_own"))) * 2**d).alias(f"_push{i}")

    return scored.groupBy(*by).agg(
        F.count_if(F.col("_own") == 0).alias("_times"),
        *[push(i) for i in range(d)],
        F.avg(F.when(F.col("_own") == 0, score)).alias("base"),
        F.avg(F.when(F.col("_own") == 2**d - 1, score)).alias("prediction"),
    )


def shapley_ranking(contributions: DataFrame, k: int | None = None) -> DataFrame:
    """Features by mean absolute contribution: (rank, feature, mean_abs); all, or the first ``k``."""
    means = contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))
    if k is None:
        # One row per feature.
        rank = F.row_number().over(W.orderBy(F.desc("mean_abs"), "feature"))
        return means.select(rank.alias("rank"), "feature", "mean_abs")
    return top_k(means, "mean_abs", k, ["feature"])


def shapley_summary_points(contributions: DataFrame, key: Sequence[str], k: int = 20) -> DataFrame:
    """Points of the summary plot: contribution and value scaled to 0..1, top ``k`` features."""
    facts = contributions.groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs"),
        F.min("value").alias("_lo"),
        F.max("value").alias("_hi"),
    )
    top = top_k(facts, "mean_abs", k, ["feature"]).drop("mean_abs")
    joined = join_small(contributions, top, ["feature"])
    scaled = F.try_divide(F.col("value") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return joined.select("rank", "feature", *key, "contribution", scaled.alias("scaled_value"))


def force_breakdown(contributions: DataFrame, row: Mapping[str, Any]) -> DataFrame:
    """One row's contributions, largest first, with the sum so far and the additivity error."""
    one = contributions
    for c, v in row.items():
        one = one.where(F.col(c) == F.lit(v))
    # A row has one entry per feature, so these windows stay small.
    largest = W.orderBy(F.desc(F.abs("contribution")), "feature")
    return one.select(
        F.row_number().over(largest).alias("rank"),
        "feature",
        "value",
        "contribution",
        signed_direction(F.col("contribution")).alias("direction"),
        "base",
        (F.col("base") + F.sum("contribution").over(largest)).alias("running"),
        "prediction",
        (F.col("prediction") - F.col("base") - F.sum("contribution").over(W.partitionBy())).alias(
            "additivity_error"
        ),
    )


def dependence_points(
    contributions: DataFrame, feature: str, key: Sequence[str]
) -> DataFrame:
    """A feature's value against its contribution, with its strongest partner's value.

    The partner is the other feature whose values correlate most with the contributions; a
    partner that never varies has no correlation and is never chosen while another does.
    ``contributions`` has a row for each row (``linear_pushes``), or is the long table, in which keys
    must be unique.
    """
    if "pushes" in contributions.columns:
        own = F.get(F.filter("pushes", lambda p: p["feature"] == F.lit(feature)), 0)
        others = F.filter("pushes", lambda p: p["feature"] != F.lit(feature))
        rows = contributions.select(
            *key,
            own["value"].alias("value"),
            own["contribution"].alias("contribution"),
            F.transform(others, lambda p: F.struct(p["feature"].alias("feature"), p["value"].alias("value"))).alias(
                "_others"
            ),
        )
    else:
        own = lambda c: F.max(F.when(F.col("feature") == feature, F.col(c))).alias(c)
        other = F.when(F.col("feature") != feature, F.struct("feature", "value"))
        rows = contributions.groupBy(*key).agg(
            own("value"), own("contribution"), F.collect_list(other).alias("_others")
        )
    wide = materialize(rows, "wide")  # read twice
    pairs = wide.select("contribution", F.inline("_others").alias("partner", "partner_value"))
    # corr() fails on a constant column under ANSI rules.
    correlation = F.try_divide(
        F.covar_pop("contribution", "partner_value"),
        F.stddev_pop("contribution") * F.stddev_pop("partner_value"),
    )
    strength = pairs.groupBy("partner").agg(
        F.coalesce(F.abs(correlation), F.lit(-1.0)).alias("_strength")
    )
    best = strength.agg(F.max_by("partner", F.struct("_strength", "partner"))).first()[0]
    partner = F.filter("_others", lambda x: x["feature"] == F.lit(best))
    return wide.select(
        *key,
        "value",
        "contribution",
        F.lit(best).alias("partner"),
        F.get(partner, 0)["value"].alias("partner_value"),
    )


def pick_examples(scored: DataFrame, y: str, pred: str, key: Sequence[str]) -> DataFrame:
    """Rows worth explaining: the first right one of class 0, the first right one of class 1, and
    the first wrong one, or a second right one of class 1 when none is wrong."""
    right = F.col(y) == F.col(pred)
    kinds = {
        "correct_0": (right & (F.col(y) == 0), 1),
        "correct_1": (right & (F.col(y) == 1), 2),
        "wrong": (~right, 1),
    }
    found = None
    for place, (kind, (condition, n)) in enumerate(kinds.items()):
        # A top-n per kind: each task keeps n rows, however common the kind is.
        rows = scored.where(condition).orderBy(*key).limit(n)
        rows = rows.select("*", F.lit(kind).alias("example"), F.lit(place).alias("_place"))
        found = rows if found is None else found.unionByName(rows)
    # Four rows at most.
    nth = F.row_number().over(W.partitionBy("example").orderBy(*key))
    n_wrong = F.count_if(F.col("example") == "wrong").over(W.partitionBy())
    chosen = found.withColumns({"_nth": nth, "_n_wrong": n_wrong}).where(
        (F.col("_nth") == 1) | (F.col("_n_wrong") == 0)
    )
    name = F.when(F.col("_nth") == 2, F.lit("correct_1_second")).otherwise(F.col("example"))
    return chosen.withColumn("example", name).drop("_place", "_nth", "_n_wrong")


# --- local surrogate -------------------------------------------------------------------------


def _bin_of(col: str | Column, edges: Sequence[float]) -> Column:
    """How many edges lie below the value: values on an edge belong to the bin it closes."""
    value = F.col(col) if isinstance(col, str) else col
    return sum(((value > F.lit(e)).cast("int") for e in edges), F.lit(0))


def _condition(feature: str, edges: Sequence[float], i: int) -> str:
    if i == 0:
        return f"{feature} <= {edges[0]:.2f}"
    if i == len(edges):
        return f"{feature} > {edges[-1]:.2f}"
    return f"{edges[i - 1]:.2f} < {feature} <= {edges[i]:.2f}"


def _solver(
    keys: list[str],
    names: list[str],
    conditions: dict[str, list[str]],
    k: int,
    alpha: float,
    is_class: bool,
) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The per-row fit. Everything it needs is nested here, so workers import nothing of ours."""
    width = math.sqrt(len(names)) * 0.75

    def ridge(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
        zm, ym = np.average(z, axis=0, weights=w), np.average(y, weights=w)
        zw = (z - zm) * w[:, None]
        coef = np.linalg.solve(zw.T @ (z - zm) + alpha * np.eye(z.shape[1]), zw.T @ (y - ym))
        return coef, float(ym - zm @ coef)

    def explain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_sample", ignore_index=True)
        z = np.vstack(pdf["_z"].to_numpy())
        y = pdf["_score"].to_numpy(float)
        if is_class and pdf["prediction"].iloc[0] != 1:
            y = 1.0 - y
        distance = np.sqrt((1.0 - z).sum(axis=1))
        w = np.sqrt(np.exp(-(distance**2) / width**2))
        weights, _ = ridge(z, y, w)
        chosen = np.argsort(-np.abs(weights), kind="stable")[:k]
        weights, intercept = ridge(z[:, chosen], y, w)
        fitted = z[:, chosen] @ weights + intercept
        spread = np.average((y - np.average(y, weights=w)) ** 2, weights=w)
        fit = 1.0 - np.average((y - fitted) ** 2, weights=w) / spread if spread > 0 else 0.0
        order = np.argsort(-np.abs(weights), kind="stable")
        own = pdf["_own"].iloc[0]
        features = [names[chosen[i]] for i in order]
        return pd.DataFrame(
            {
                **{c: pdf[c].iloc[0] for c in keys},
                "rank": np.arange(1, len(order) + 1),
                "feature": features,
                "condition": [
                    conditions[f][own[chosen[i]]] for f, i in zip(features, order, strict=True)
                ],
                "weight": weights[order],
                "intercept": intercept,
                "local_prediction": fitted[0],
                "model_prediction": y[0],
                "fit_r2": fit,
            }
        )

    return explain


def local_surrogate(
    rows: DataFrame,
    model: Model,
    train: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    n_samples: int = 5000,
    k: int = 10,
    seed: int = 42,
    alpha: float = 1.0,
) -> DataFrame:
    """The ``k`` conditions that weigh most around each row: (key..., rank, condition, weight, ...).

    Features are cut at the training quartiles. Each row is perturbed ``n_samples`` times by drawing
    bins as often as they occur and values from the bin; the model scores the samples, and a ridge
    weighted by closeness explains its class from "same bin as the row". The solve sees the
    ``n_samples`` samples of one row, so its group has a fixed size.
    """
    names = list(features)
    # Read for the quartiles and again for the bins.
    doubles = materialize(train.select(*[F.col(c).cast("double").alias(c) for c in names]), "train")
    edges: dict[str, list[float]] = {c: [] for c in names}
    for r in quantiles(doubles, names, [0.25, 0.5, 0.75]).toLocalIterator():
        edges[r["feature"]].append(r["value"])
    edges = {c: sorted(set(e)) for c, e in edges.items()}
    cells = [
        F.struct(F.lit(c).alias("feature"), _bin_of(c, edges[c]).alias("bin"), F.col(c).alias("value"))
        for c in names
    ]
    bins = (
        doubles.select(F.inline(F.array(*cells)))
        .groupBy("feature", "bin")
        .agg(
            F.count("*").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
        )
    )
    # At most four bins per feature.
    facts: dict[str, list] = {c: [] for c in names}
    for r in bins.orderBy("feature", "bin").toLocalIterator():
        facts[r["feature"]].append(r)

    base = rows.select(*key, *[F.col(c).cast("double").alias(c) for c in names])
    base = base.withColumns({f"_own_{i}": _bin_of(c, edges[c]) for i, c in enumerate(names)})
    samples = base.withColumn("_sample", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))))
    draw_key = [*key, "_sample"]
    is_row = F.col("_sample") == 0
    drawn, perturbed = {}, {}
    for i, c in enumerate(names):
        total = sum(r["n"] for r in facts[c])
        upto, choice = 0, None
        for r in facts[c]:
            upto += r["n"]
            u = hash_unit(draw_key, seed, f"bin/{c}") < upto / total
            choice = F.when(u, r["bin"]) if choice is None else choice.when(u, r["bin"])
        drawn[f"_bin_{i}"] = F.when(is_row, F.col(f"_own_{i}")).otherwise(choice)
        noise, value = hash_normal(draw_key, seed, f"value/{c}"), F.when(is_row, F.col(c))
        for r in facts[c]:
            near = F.greatest(F.lit(r["lo"]), F.least(F.lit(r["hi"]), r["mean"] + r["std"] * noise))
            value = value.when(F.col(f"_bin_{i}") == r["bin"], near)
        perturbed[f"_value_{i}"] = value
    samples = samples.withColumns(drawn).withColumns(perturbed)
    same = [
        (F.col(f"_bin_{i}") == F.col(f"_own_{i}")).cast("double") for i in range(len(names))
    ]
    ready = samples.select(
        *key,
        "_sample",
        F.array(*same).alias("_z"),
        F.array(*[F.col(f"_own_{i}") for i in range(len(names))]).alias("_own"),
        array_to_vector(F.array(*[F.col(f"_value_{i}") for i in range(len(names))])).alias("features"),
    )
    scored = model_scores(model)(ready).select(
        *key, "_sample", "_z", "_own", "prediction", "_score"
    )
    is_class = "probabilityCol" in [p.name for p in getattr(model, "stages", [model])[-1].params]
    keys = list(key)
    conditions = {c: [_condition(c, edges[c], i) for i in range(len(edges[c]) + 1)] for c in names}
    explain = _solver(keys, names, conditions, k, alpha, is_class)
    key_types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys)
    schema = (
        f"{key_types}, rank int, feature string, condition string, weight double,"
        " intercept double, local_prediction double, model_prediction double, fit_r2 double"
    )
    explained = scored.groupBy(*keys).applyInPandas(explain, schema)
    return explained.withColumn("direction", signed_direction(F.col("weight")))
