"""A classifier's results by group and time window, and alerts when they drift.

A stream of scored events is counted per window and group. State is bounded by the watermark: a
window is forgotten when no event may still come for it. Each micro-batch writes the windows it
changed to a folder of its own, so a batch that is run again after a failure overwrites what it
wrote before; the newest row of a window and group is its result. Counts add up, so the table is at
any time what a batch query over the same events gives.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillframe.operators.fairness import FOUR_FIFTHS
from quillframe.operators.metrics import class_counts, rates

COUNTS = ("n", "tp", "fp", "fn", "tn")


def windowed_counts(
    scored: DataFrame,
    time: str,
    by: str,
    y: str,
    pred: str,
    width: str = "1 day",
    delay: str | None = None,
    pos_label: Any = 1,
) -> DataFrame:
    """(window_start, by, n, tp, fp, fn, tn) per window of ``width`` and group; for a table or a
    stream.

    Rows without a time, a true or a predicted class are left out; a NULL group is a group of its
    own. A time without a zone is taken in the session's. ``delay`` is how late a row of a stream may come behind the latest one; a window that ends
    earlier than that is closed, and what comes for it later is not counted.
    """
    rows = scored.where(F.col(time).isNotNull() & F.col(y).isNotNull() & F.col(pred).isNotNull())
    rows = rows.withColumn(time, F.col(time).cast("timestamp"))  # what a watermark needs
    if delay is not None:
        rows = rows.withWatermark(time, delay)
    counts = {"n": F.count("*"), **class_counts(y, pred, pos_label)}
    grouped = rows.groupBy(F.window(time, width).alias("_window"), by).agg(
        *[counts[c].alias(c) for c in COUNTS]
    )
    return grouped.select(F.col("_window.start").alias("window_start"), by, *COUNTS)


def watch(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the ``windowed_counts`` of a stream in ``path`` until all there is has been read.

    ``checkpoint`` holds what was read and the open windows: a query started again with it, after
    an end or a failure, goes on where the last whole batch ended.
    """
    spark = counts.sparkSession
    # Readable before the first batch, and if there never is one.
    spark.createDataFrame([], counts.schema).write.mode("overwrite").parquet(f"{path}/batch=-1")

    def keep(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
    )


def watched(spark: SparkSession, path: str, by: str) -> DataFrame:
    """The newest counts of each window and group that ``watch`` has written."""
    written = spark.read.option("mergeSchema", "false").parquet(path)
    newest = F.max_by(F.struct(*COUNTS), "batch").alias("_newest")
    return written.groupBy("window_start", by).agg(newest).select("window_start", by, "_newest.*")


def metrics_over_time(counts: DataFrame, by: str) -> DataFrame:
    """Accuracy, precision, recall, F1 and selection rate for each row of counts; 0 where undefined."""
    selected = F.try_divide((F.col("tp") + F.col("fp")).cast("double"), F.col("n"))
    return counts.select(
        "window_start", by, "n", *rates(), F.coalesce(selected, F.lit(0.0)).alias("selection_rate")
    )


def drift_alerts(
    over_time: DataFrame,
    by: str,
    metric: str = "accuracy",
    history: int = 7,
    tolerance: float = 0.1,
    least: int = 30,
    threshold: float = FOUR_FIFTHS,
) -> DataFrame:
    """Each window and group beside what its group's earlier windows let expect.

    ``expected`` is the metric over the group's ``history`` windows before, weighted by their rows
    (NULL until there are so many); ``drifted`` tells that the metric is more than ``tolerance``
    below it, in a window of ``least`` rows or more. ``ratio`` is the lowest over the highest
    selection rate among the groups of the window, ``unequal`` that it breaks the four-fifths rule
    (both NULL when no group selects anyone). There is a row per window and group, so the windows
    over them stay small however many events they count.
    """
    before = W.partitionBy(by).orderBy("window_start").rowsBetween(-history, -1)
    together = W.partitionBy("window_start")
    weighed = F.try_divide(
        F.sum(F.col(metric) * F.col("n")).over(before), F.sum("n").over(before).cast("double")
    )
    expected = F.when(F.count("*").over(before) == history, weighed)
    ratio = F.try_divide(
        F.min("selection_rate").over(together), F.max("selection_rate").over(together)
    )
    marked = over_time.withColumns({"expected": expected, "ratio": ratio})
    return marked.select(
        "window_start",
        by,
        "n",
        metric,
        "expected",
        F.coalesce(
            (F.col("n") >= least) & (F.col(metric) < F.col("expected") - tolerance), F.lit(False)
        ).alias("drifted"),
        "selection_rate",
        "ratio",
        (F.col("ratio") < threshold).alias("unequal"),
    )
