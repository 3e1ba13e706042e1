"""Comparing a classifier's results between groups of rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillframe.functions.hashing import hash_unit
from quillframe.operators.joins import join_small
from quillframe.operators.metrics import class_counts, rates
from quillframe.operators.profiling import value_counts

# The synthetic groups, and the four-fifths rule.
AGE_GROUPS = ("Young (<40)", "Middle (40-60)", "Senior (>60)")
FOUR_FIFTHS = 0.80


def assign_group(
    df: DataFrame,
    key: Sequence[str],
    groups: Sequence[str] = AGE_GROUPS,
    seed: int = 42,
    output: str = "age_group",
) -> DataFrame:
    """Give each row a seeded synthetic group, all equally likely."""
    place = F.floor(hash_unit(key, seed, "group") * len(groups)).cast("int") + 1
    return df.withColumn(output, F.element_at(F.array(*[F.lit(g) for g in groups]), place))


def balance_weights(df: DataFrame, by: str, label: str, output: str = "weight") -> DataFrame:
    """Add weights under which group and class are independent.

    A row counts with the rows that its group and class would share if they were, over those that
    they do share: ``n(group) * n(class) / (n * n(group, class))``. Weights add up to the number of
    rows; a NULL group or class is one of its own.
    """
    cells = df.groupBy(by, label).agg(F.count("*").alias("_n"))
    # One row for each group and class.
    of = lambda c: F.sum("_n").over(W.partitionBy(c)).cast("double")
    whole = F.sum("_n").over(W.partitionBy())
    weights = cells.select(by, label, (of(by) * of(label) / (whole * F.col("_n"))).alias(output))
    return join_small(df, weights, [by, label])


def oversample(
    df: DataFrame, by: str, key: Sequence[str], seed: int = 42, output: str = "copy"
) -> DataFrame:
    """Repeat rows until every group is about as large as the largest; ``copy`` numbers them from 0.

    With the largest group r times as large as a row's, the row comes floor(r) times, and once more
    if a digest of its key says so, with the chance that is left. No row is lost, and a row's copies
    depend on its key and the sizes alone. A NULL group is one of its own.
    """
    sizes = df.groupBy(by).agg(F.count("*").alias("_n"))
    largest = F.max("_n").over(W.partitionBy()).cast("double")  # one row for each group
    rates = sizes.select(by, (largest / F.col("_n")).alias("_rate"))
    more = hash_unit(key, seed, "copy") < F.col("_rate") - F.floor("_rate")
    last = F.floor("_rate") + more.cast("long") - 1
    joined = join_small(df, rates, [by])
    return joined.withColumn(output, F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("_rate")


def group_counts(df: DataFrame, by: str) -> DataFrame:
    return value_counts(df, by)


def group_metrics(
    scored: DataFrame, by: str, y: str, pred: str, pos_label: Any = 1
) -> DataFrame:
    """Per group: n, accuracy, precision, recall, F1, and the share predicted positive."""
    counts = class_counts(y, pred, pos_label)
    grouped = scored.groupBy(by).agg(
        F.count("*").alias("n"),
        *[c.alias(name) for name, c in counts.items()],
        F.avg((F.col(pred) == F.lit(pos_label)).cast("double")).alias("selection_rate"),
    )
    return grouped.select(by, "n", *rates(), "selection_rate")


def disparate_impact(metrics: DataFrame, threshold: float = FOUR_FIFTHS) -> DataFrame:
    """Lowest over highest selection rate, and whether it breaks the four-fifths rule.

    When no group selects anyone the ratio and the flag are NULL: nothing can be said.
    """
    rates_ = metrics.agg(
        F.min("selection_rate").alias("min_rate"), F.max("selection_rate").alias("max_rate")
    )
    ratio = F.try_divide(F.col("min_rate"), F.col("max_rate"))
    return rates_.select(
        "min_rate", "max_rate", ratio.alias("ratio"), (ratio < threshold).alias("violated")
    )


def four_fifths_table(metrics: DataFrame, by: str, threshold: float = FOUR_FIFTHS) -> DataFrame:
    """Each group's rate beside the rate it has to reach."""
    needed = metrics.agg(F.max("selection_rate") * threshold).scalar()
    return metrics.select(
        by,
        "n",
        "selection_rate",
        needed.alias("needed_rate"),
        (F.col("selection_rate") >= needed).alias("passes"),
    )
