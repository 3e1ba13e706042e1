"""Standardising features, with values fitted on the training rows only."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import isfinite

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.functions.scalars import known
from quillframe.operators.joins import settle


def fit_scaler(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, mean, std) with the population deviation, in one pass."""
    wide = train.agg(
        *[F.avg(known(c)).alias(f"mean_{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(known(c)).alias(f"std_{i}") for i, c in enumerate(cols)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"mean_{i}").alias("mean"),
            F.col(f"std_{i}").alias("std"),
        )
        for i, c in enumerate(cols)
    ]
    return settle(wide.select(F.inline(F.array(*rows))))


def apply_scaler(df: DataFrame, scaler: DataFrame) -> DataFrame:
    """Replace each fitted column by (x - mean) / std; a constant column becomes 0.

    The scaler has one row per column, so its values enter the plan as constants.
    """
    fitted = {r["feature"]: (r["mean"], r["std"] or 1.0) for r in scaler.toLocalIterator()}

    def scaled(c: str) -> Column | str:
        name = "`" + c.replace("`", "``") + "`"
        if c not in fitted:
            return name
        mean, std = fitted[c]
        # One text is read many times faster than a column is put together from Python.
        if isinstance(mean, float) and isinstance(std, float) and isfinite(mean) and isfinite(std):
            return F.expr(f"({name} - ({mean!r}D)) / ({std!r}D)").alias(c)
        return ((F.col(name) - F.lit(mean)) / F.lit(std)).alias(c)

    return df.select(*[scaled(c) for c in df.columns])


def scaling_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population deviation over all scaled cells together."""
    cells = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    cells = cells.unpivot([], list(cols), "feature", "value")
    return cells.agg(F.avg(known("value")).alias("mean"), F.stddev_pop(known("value")).alias("std"))


def assemble(df: DataFrame, cols: Sequence[str], output: str = "features") -> DataFrame:
    """Columns to one vector column; a NULL among them is an error, as for any model input."""
    return VectorAssembler(inputCols=list(cols), outputCol=output).transform(df)


def scale_and_assemble(train: DataFrame, features: Sequence[str]) -> Callable:
    """A function that scales by ``train`` and assembles, for :func:`cross_validate`."""
    scaler = fit_scaler(train, features)
    return lambda df: assemble(apply_scaler(df, scaler), features)
