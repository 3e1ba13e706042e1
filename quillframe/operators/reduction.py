"""Principal components: fewer columns that keep most of the variance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Components:
    """Principal components of a vector column; ``axes`` has one per column, with its sign set."""

    model: PCAModel
    mean: np.ndarray
    signs: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    shares: np.ndarray


def fit_components(df: DataFrame, k: int, features: str = "features") -> Components:
    """The ``k`` directions of most variance, from products summed on the executors.

    Only a matrix of features by features reaches the driver. Variances have divisor n; a share is
    of the variance of all features. A direction's sign is open: the entry of largest absolute value
    is made positive, the first of equal ones.
    """
    model = PCA(k=k, inputCol=features, outputCol="_projected").fit(df)
    facts = df.agg(
        Summarizer.metrics("mean", "variance", "count").summary(F.col(features)).alias("_s")
    ).first()["_s"]
    spread = facts["variance"].toArray() * (facts["count"] - 1) / facts["count"]
    axes = model.pc.toArray()
    largest = np.argmax(np.abs(axes).round(12), axis=0)
    signs = np.where(axes[largest, np.arange(k)] < 0, -1.0, 1.0)
    shares = model.explainedVariance.toArray()
    return Components(
        model, facts["mean"].toArray(), signs, axes * signs, shares * spread.sum(), shares
    )


def component_table(spark: SparkSession, found: Components, names: Sequence[str]) -> DataFrame:
    """(component, feature, weight, variance, share), components numbered from 1."""
    rows = [
        (c + 1, name, float(found.axes[i, c]), float(found.variances[c]), float(found.shares[c]))
        for c in range(found.axes.shape[1])
        for i, name in enumerate(names)
    ]
    return spark.createDataFrame(
        rows, "component int, feature string, weight double, variance double, share double"
    )


def project(df: DataFrame, found: Components, features: str = "features") -> DataFrame:
    """Add ``projected``: each row less the mean, along the components."""
    centre = found.axes.T @ found.mean
    place = vector_to_array(F.col("_projected"))
    entries = [
        F.get(place, F.lit(c)) * F.lit(float(s)) - F.lit(float(m))
        for c, (s, m) in enumerate(zip(found.signs, centre))
    ]
    scored = found.model.setInputCol(features).transform(df)
    return scored.withColumn("projected", F.array(*entries)).drop("_projected")


def reconstruction_error(df: DataFrame, found: Components, features: str = "features") -> DataFrame:
    """(n, error): the mean squared distance between rows and what the components say of them."""
    square = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x)
    mean = F.array(*[F.lit(float(m)) for m in found.mean])
    apart = F.zip_with(vector_to_array(F.col(features)), mean, lambda x, m: x - m)
    # Axes are of unit length and at right angles, so what is left is a difference of squares.
    lost = F.greatest(square(apart) - square(F.col("projected")), F.lit(0.0))
    return project(df, found, features).agg(F.count("*").alias("n"), F.avg(lost).alias("error"))
