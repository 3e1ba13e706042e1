"""Describing tables: shapes, counts, summaries, and the tables behind plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.functions.scalars import known, percent
from quillframe.operators.joins import join_small
from quillframe.operators.quantiles import quantile_columns, quantiles
from quillframe.operators.sampling import sample_n


def shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns")
    )


def schema_table(df: DataFrame) -> DataFrame:
    """(position, column, type, n_known): each column with its number of values, in one pass.

    Pass a table read without a declared schema to see what its files hold. NaN counts as missing.
    """
    floating = ("double", "float")
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    counts = df.agg(
        *[F.count(known(c) if t in floating else F.col(c)).alias(f"_{i}") for i, (c, t) in enumerate(fields)]
    )
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.lit(t).alias("type"),
            F.col(f"_{i}").alias("n_known"),
        )
        for i, (c, t) in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n, percent of all rows), most frequent first."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    return counts.select("value", "n", percent(F.col("n"), total).alias("percent")).orderBy(
        F.desc("n"), "value"
    )


def describe(
    df: DataFrame,
    cols: Sequence[str],
    digits: int | None = None,
    by: Sequence[str] = (),
    exact: bool = True,
) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max per column and group."""
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    long = doubles.unpivot(list(by), list(cols), "feature", "value")
    value = known("value")
    base = long.groupBy(*by, "feature").agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    table = quantiles(df, cols, [0.25, 0.5, 0.75], by, exact)
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("value")))
    quartiles = table.groupBy(*by, "feature").agg(
        at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75")
    )
    joined = join_small(base, quartiles, [*by, "feature"], "left")
    numbers = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    shown = [F.round(c, digits).alias(c) if digits is not None else F.col(c) for c in numbers]
    return joined.select(*by, "feature", "count", *shown)


def group_mean(df: DataFrame, by: str, col: str, headroom: float = 1.2) -> DataFrame:
    """Mean per group in ascending order, with the axis top (largest mean × headroom)."""
    means = df.groupBy(by).agg(F.avg(known(col)).alias("mean"))
    top = means.agg(F.max("mean") * headroom).scalar()
    return means.select(by, "mean", top.alias("axis_top")).orderBy("mean", by)


def histogram(df: DataFrame, by: str, col: str, bins: int = 15) -> DataFrame:
    """Counts in equal-width bins, edges from each group's own range, empty bins included.

    Every bin is closed on the left; the last one also on the right.
    """
    values = df.select(by, col).where(known(col).isNotNull())
    ranges = values.groupBy(by).agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    # A group with a single value gets a bin range of width 1 around it.
    flat = F.col("lo") == F.col("hi")
    ranges = ranges.select(
        by,
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    placed = join_small(values, ranges, [by]).select(
        by,
        F.least(
            F.width_bucket(F.col(col), F.col("lo"), F.col("hi"), F.lit(bins)), F.lit(bins)
        ).cast("int").alias("bin"),
    )
    counts = placed.groupBy(by, "bin").agg(F.count("*").alias("n"))
    grid = ranges.select(by, "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return join_small(grid, counts, [by, "bin"], "left").select(
        by,
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * width).alias("left"),
        (F.col("lo") + F.col("bin") * width).alias("right"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, by: str, col: str, exact: bool = True) -> DataFrame:
    """Quartiles, whisker ends (furthest values within 1.5 IQR of the box) and outliers."""
    values = df.select(by, col).where(known(col).isNotNull())
    box = quantile_columns(values, col, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by], exact)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(col).between(F.col("q1") - reach, F.col("q3") + reach)
    whiskers = join_small(values, box, [by]).groupBy(by).agg(
        F.least(F.min(F.when(inside, F.col(col))), F.min("q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(inside, F.col(col))), F.max("q3")).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )
    return join_small(box, whiskers, [by])


def scatter_points(
    df: DataFrame,
    x: str,
    y: str,
    hue: str,
    n: int | None = None,
    key: Sequence[str] = (),
    seed: int = 42,
) -> DataFrame:
    """All points of a plot, or with ``n`` a repeatable sample of so many."""
    if n is None:
        return df.select(x, y, hue)
    columns = dict.fromkeys([*key, x, y, hue])
    return sample_n(df.select(*columns), n, key, seed).select(x, y, hue)
