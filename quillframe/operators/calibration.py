"""Do scores mean what they say? Calibration tables, and isotonic regression to mend scores."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.functions.scalars import known
from quillframe.sources.artifacts import materialize

DIGITS = 6  # of a score that tell steps apart: at most 10 ** DIGITS + 1 steps for scores of 0 to 1
FAN_IN = 16  # neighbouring stretches merged in one task


def calibration_table(
    scored: DataFrame, y: str, prob: str, by: str, bins: int = 10, pos_label: Any = 1
) -> DataFrame:
    """(by, bin, n, mean_prob, observed): mean score and share of positives per group and bin.

    Bins cut 0 to 1 evenly, the last one with its upper end. Rows without class or score are left
    out; a NULL group is a group of its own.
    """
    rows = scored.where(F.col(y).isNotNull() & known(prob).isNotNull())
    place = F.least(F.floor(F.col(prob) * bins), F.lit(bins - 1)).cast("int")
    return rows.groupBy(by, place.alias("bin")).agg(
        F.count("*").alias("n"),
        F.avg(prob).alias("mean_prob"),
        F.avg((F.col(y) == F.lit(pos_label)).cast("double")).alias("observed"),
    )


def calibration_error(table: DataFrame, by: str) -> DataFrame:
    """(by, n, expected_error, largest_error) from a ``calibration_table``: how far mean scores are
    from what is observed, on average over rows and at most over bins."""
    apart = F.abs(F.col("mean_prob") - F.col("observed"))
    return table.groupBy(by).agg(
        F.sum("n").alias("n"),
        (F.sum(apart * F.col("n")) / F.sum("n")).alias("expected_error"),
        F.max(apart).alias("largest_error"),
    )


def pool(blocks: list[tuple[float, float, int, int]]) -> list[tuple[float, float, int, int]]:
    """Pool neighbouring (lo, hi, positives, rows) until shares of positives rise.

    Blocks come by rising score; equal shares are pooled too. Counts are whole, so pooling parts
    first and then the whole gives the same blocks.
    """
    out: list[tuple[float, float, int, int]] = []
    for block in blocks:
        while out and out[-1][2] * block[3] >= block[2] * out[-1][3]:
            lo, _, pos, n = out.pop()
            block = (lo, block[1], pos + block[2], n + block[3])
        out.append(block)
    return out


def fit_isotonic(
    scored: DataFrame, y: str, prob: str, pos_label: Any = 1, digits: int | None = DIGITS
) -> DataFrame:
    """(lo, hi, pos, n, value): the rising step function of the score nearest to the classes.

    Rows are counted per score, rounded to ``digits`` (None: not), and range-sorted; each task pools
    the violators of its stretch, and neighbouring stretches are merged, ``FAN_IN`` at a time, where
    blocks that violate at the seam are pooled on. Rows without class or score are left out; no rows
    give no steps.
    """
    score = F.col(prob) if digits is None else F.round(prob, digits)
    rows = scored.where(F.col(y).isNotNull() & known(prob).isNotNull())
    counts = rows.groupBy(score.cast("double").alias("lo")).agg(
        F.count_if(F.col(y) == F.lit(pos_label)).alias("pos"), F.count("*").alias("n")
    )
    ranged = counts.repartitionByRange("lo").sortWithinPartitions("lo")
    sorted_rows = ranged.select(
        F.spark_partition_id().cast("long").alias("stretch"), "lo", F.col("lo").alias("hi"), "pos", "n"
    )
    schema = "stretch long, lo double, hi double, pos long, n long"

    def frame(stretch: int, blocks: list[tuple[float, float, int, int]]) -> pd.DataFrame:
        out = pd.DataFrame(blocks, columns=["lo", "hi", "pos", "n"])
        out.insert(0, "stretch", stretch)
        return out

    def blocks_of(part: pd.DataFrame) -> list[tuple[float, float, int, int]]:
        return list(zip(*(part[c].tolist() for c in ("lo", "hi", "pos", "n"))))

    def of_stretch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[float, float, int, int]] = []
        stretch = 0
        for batch in batches:
            if len(batch):
                stretch = int(batch["stretch"].iloc[0])
                held = pool([*held, *blocks_of(batch)])
        if held:
            yield frame(stretch, held)

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        return frame(int(part["stretch"].iloc[0]) // FAN_IN, pool(blocks_of(part.sort_values("lo"))))

    steps = materialize(sorted_rows.mapInPandas(of_stretch, schema), "pooled")
    while (last := steps.agg(F.max("stretch")).first()[0]) and last > 0:
        nearby = F.expr(f"stretch div {FAN_IN}")
        steps = materialize(steps.groupBy(nearby).applyInPandas(merged, schema), "pooled")
    return steps.select("lo", "hi", "pos", "n", (F.col("pos") / F.col("n")).alias("value"))


def calibrated(df: DataFrame, steps: DataFrame, prob: str, output: str = "calibrated") -> DataFrame:
    """Add the value of the step a score lies on: the last that begins at or below it, or the first.

    The steps are a model, sent to every task; fitted on rounded scores they are bounded by
    ``DIGITS``. A NULL score stays NULL, and so does everything when there are no steps.
    """
    table = steps.select("lo", "value").orderBy("lo").toArrow()
    if not table.num_rows:
        return df.withColumn(output, F.lit(None).cast("double"))
    starts = table["lo"].to_numpy()
    values = table["value"].to_numpy()

    @F.pandas_udf("double")
    def step(scores: pd.Series) -> pd.Series:
        at = np.searchsorted(starts, scores.to_numpy(float), "right") - 1
        return pd.Series(values[np.maximum(at, 0)]).where(scores.notna().to_numpy())

    score: Column = F.col(prob).cast("double")
    return df.withColumn(output, step(score))
