"""Choosing the score from which a row is called positive."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillframe.functions.scalars import known, zero_if_undefined
from quillframe.operators.ordered import running_totals
from quillframe.sources.artifacts import materialize


def roc_counts(
    scored: DataFrame, y: str, prob: str, by: str | None = None, pos_label: Any = 1
) -> DataFrame:
    """(by, threshold, pos, neg, tp, fp): rows at each distinct score, and from it up.

    Rows are counted per score first and then range-sorted by falling score, so neither a group nor
    a common score has to fit a task. Rows without class or score are left out.
    """
    keys = [by] if by else []
    rows = scored.where(F.col(y).isNotNull() & known(prob).isNotNull())
    counts = rows.groupBy(*keys, F.col(prob).alias("threshold")).agg(
        F.count_if(F.col(y) == F.lit(pos_label)).alias("pos"),
        F.count_if(F.col(y) != F.lit(pos_label)).alias("neg"),
    )
    falling = counts.withColumn("_down", -F.col("threshold"))
    return running_totals(falling, ["_down"], {"tp": "pos", "fp": "neg"}, keys).drop("_down")


def threshold_for_recall(
    scored: DataFrame, y: str, prob: str, recall: float, pos_label: Any = 1
) -> DataFrame:
    """(threshold, recall, precision, fpr): the highest score that finds a share of the positives.

    Rows that tie at the threshold are all called positive, so the recall reached may be more than
    asked for. Without positives there is no such score and no row.
    """
    counts = materialize(roc_counts(scored, y, prob, pos_label=pos_label), "roc")
    sizes = counts.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    whole = lambda c: sizes.select(F.col(c).cast("double")).scalar()
    reached = F.try_divide(F.col("tp").cast("double"), whole("pos"))
    # One pass over the sorted counts; of the scores that reach the recall the highest.
    best = counts.where(reached >= recall).agg(
        F.max_by(F.struct("threshold", "tp", "fp"), "threshold").alias("_best")
    )
    tp, fp = F.col("_best.tp"), F.col("_best.fp")
    return best.where(F.col("_best").isNotNull()).select(
        F.col("_best.threshold").alias("threshold"),
        F.try_divide(tp.cast("double"), whole("pos")).alias("recall"),
        zero_if_undefined(tp, tp + fp).alias("precision"),
        zero_if_undefined(fp, whole("neg")).alias("fpr"),
    )


def upper_hull(points: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """Corners of the upper convex hull of (fp, tp, threshold), given by rising fp and tp.

    Points on a line between two others are no corners. Counts are whole, so nothing is rounded.
    """
    hull: list[tuple[int, int, float]] = []
    for point in points:
        while len(hull) > 1:
            (x0, y0, _), (x1, y1, _) = hull[-2], hull[-1]
            if (x1 - x0) * (point[1] - y0) < (y1 - y0) * (point[0] - x0):
                break
            hull.pop()
        hull.append(point)
    return hull


def roc_hull(scored: DataFrame, y: str, prob: str, by: str, pos_label: Any = 1) -> DataFrame:
    """(by, threshold, fp, tp, fpr, tpr, pos, neg): corners of each group's ROC convex hull.

    The first corner calls nothing positive (threshold infinity), the last everything. A task takes
    the hull of its own stretch of a group's curve; the hull of those corners, of which there are
    few, is the group's. Groups without positives or without negatives have no curve.
    """
    points = materialize(roc_counts(scored, y, prob, by, pos_label), "roc")
    sizes = points.groupBy(F.col(by).alias("_by")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    kind = points.schema[by].dataType.simpleString()
    schema = f"`{by}` {kind}, threshold double, fp long, tp long"
    order = [by, "tp", "fp"]
    stretches = points.select(by, F.col("threshold").cast("double"), "fp", "tp")
    stretches = stretches.repartitionByRange(*order).sortWithinPartitions(*order)

    def corners(part: pd.DataFrame) -> pd.DataFrame:
        hull = upper_hull(list(zip(part["fp"].tolist(), part["tp"].tolist(), part["threshold"].tolist())))
        return pd.DataFrame(
            {
                by: [part[by].iloc[0]] * len(hull),
                "threshold": [p[2] for p in hull],
                "fp": [p[0] for p in hull],
                "tp": [p[1] for p in hull],
            }
        )

    def of_stretch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(by, dropna=False, sort=False):
                yield corners(part)

    start = points.select(by).distinct().select(
        by, F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("fp"), F.lit(0).cast("long").alias("tp")
    )
    some = stretches.mapInPandas(of_stretch, schema).unionByName(start)
    hull = some.groupBy(by).applyInPandas(lambda part: corners(part.sort_values(["fp", "tp"])), schema)
    whole = hull.join(sizes, F.col(by).eqNullSafe(F.col("_by"))).where("pos > 0 AND neg > 0")
    return whole.select(
        by,
        "threshold",
        "fp",
        "tp",
        (F.col("fp") / F.col("neg")).alias("fpr"),
        (F.col("tp") / F.col("pos")).alias("tpr"),
        "pos",
        "neg",
    )


def equal_recall_thresholds(
    hull: DataFrame, by: str, cost_fp: float = 1.0, cost_fn: float = 1.0
) -> DataFrame:
    """(by, tpr, upper, lower, share, fpr): a cut for each group, all with one true-positive rate.

    The rate is the one of least total cost, the smallest of equal ones; ``hull`` is that of
    ``roc_hull``. A group reaches it by calling rows from ``lower`` up positive with chance
    ``share``, and otherwise those from ``upper`` up, the two being neighbours on its hull; ``fpr`` is
    the false-positive rate this gives.

    Along a hull each further positive costs more negatives, so the total cost falls and then
    rises: its slope is summed over the corners of all groups in order of rate, and the least lies
    where the sum reaches zero.
    """
    hull = materialize(hull, "hull")
    along = W.partitionBy(by).orderBy("tpr", "fpr")
    ends = hull.select(
        by,
        F.lag("tpr").over(along).alias("tpr0"),
        F.col("tpr").alias("tpr1"),
        F.lag("fp").over(along).alias("fp0"),
        F.col("fp").alias("fp1"),
        F.lag("threshold").over(along).alias("upper"),
        F.col("threshold").alias("lower"),
        "neg",
    )
    segments = ends.where("tpr1 > tpr0").withColumn(
        "slope", F.lit(cost_fp) * (F.col("fp1") - F.col("fp0")) / (F.col("tpr1") - F.col("tpr0"))
    )
    climbing = W.partitionBy(by).orderBy("tpr0")
    jumps = segments.select(
        F.col("tpr0").alias("rate"),
        (F.col("slope") - F.coalesce(F.lag("slope").over(climbing), F.lit(0.0))).alias("jump"),
    )
    gain = hull.where("threshold = double('infinity')").agg(F.sum("pos") * F.lit(cost_fn)).first()[0] or 0.0
    steps = running_totals(
        jumps.groupBy("rate").agg(F.sum("jump").alias("jump")), ["rate"], {"slope": "jump"}
    )
    turn = steps.where(F.col("slope") >= gain * (1 - 1e-12)).agg(F.min("rate")).first()[0]
    rate = 1.0 if turn is None else turn
    here = segments.where((F.col("tpr0") <= rate) & (F.col("tpr1") >= rate))
    first = F.min_by(F.struct("tpr0", "tpr1", "fp0", "fp1", "upper", "lower", "neg"), "tpr0").alias("_s")
    s = lambda c: F.col(f"_s.{c}")
    share = (F.lit(rate) - s("tpr0")) / (s("tpr1") - s("tpr0"))
    return here.groupBy(by).agg(first).select(
        by,
        F.lit(rate).alias("tpr"),
        s("upper").alias("upper"),
        s("lower").alias("lower"),
        share.alias("share"),
        ((s("fp0") + share * (s("fp1") - s("fp0"))) / s("neg")).alias("fpr"),
    )
