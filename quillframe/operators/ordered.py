"""Row numbers, running totals, moving averages and rankings.

A window without a partition, or with one hot partition, runs in a single task. The operators
here cut the order into range partitions instead, number rows inside each, and add what the
earlier partitions hold.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillframe.operators.joins import join_small, settle
from quillframe.sources.artifacts import materialize

# Low bits of monotonically_increasing_id: the position of a row inside its partition.
_POSITION_MASK = (1 << 33) - 1

LARGEST_WINDOW = 50


def _range_marked(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sort globally and note each row's range partition ``_part`` and place in it ``_pos``.

    The input position breaks ties, so many rows that share a key still spread over partitions.
    Written out, because bounds are sampled anew each time the plan runs.
    """
    by = [*order, "_tie"]
    ranged = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
    )
    marked = ranged.select(
        *df.columns,
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(_POSITION_MASK).alias("_pos"),
    )
    return materialize(marked, "ranged")


def _before(window: W, col: str) -> Column:
    """Sum of ``col`` over the rows before this one."""
    earlier = F.sum(col).over(window.rowsBetween(W.unboundedPreceding, -1))
    return F.coalesce(earlier, F.lit(0).cast("long"))


def add_row_index(df: DataFrame, key: Sequence[str], name: str = "row_index") -> DataFrame:
    """Number all rows 0..n-1 in the order of ``key``."""
    marked = _range_marked(df, key)
    sizes = marked.groupBy("_part").agg(F.count("*").alias("_size"))
    # One row per range partition.
    starts = sizes.select("_part", _before(W.orderBy("_part"), "_size").alias("_start"))
    joined = join_small(marked, starts, ["_part"])
    return joined.select(*df.columns, (F.col("_start") + F.col("_pos")).alias(name))


def running_totals(
    df: DataFrame, order: Sequence[str], totals: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Add cumulative sums ``{new column: summed column}`` along ``order`` inside each group.

    A group of any size is split over range partitions: sums run inside a partition and start
    from the sum of the group's earlier partitions.
    """
    marked = _range_marked(df, [*by, *order])
    per_part = marked.groupBy(*by, "_part").agg(
        *[F.sum(col).alias(f"_sum_{new}") for new, col in totals.items()]
    )
    across = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = per_part.select(
        *by, "_part", *[F.sum(f"_sum_{new}").over(across).alias(f"_start_{new}") for new in totals]
    )
    inside = W.partitionBy(*by, "_part").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    running = marked.select(
        *df.columns, "_part", *[F.sum(col).over(inside).alias(new) for new, col in totals.items()]
    )
    joined = join_small(running, starts, [*by, "_part"])
    return joined.select(
        *df.columns,
        *[
            (F.col(new) + F.coalesce(F.col(f"_start_{new}"), F.lit(0))).alias(new)
            for new in totals
        ],
    )


def smoothing_window(n: Column) -> Column:
    """Width of the moving average for ``n`` steps: a fifth of them, at most 50."""
    return F.least(F.lit(LARGEST_WINDOW).cast("long"), F.floor(n / 5))


def moving_average(
    log: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    col: str,
    window: int | None = None,
    chunk: int = 100_000,
) -> DataFrame:
    """Trailing mean of ``col`` per run over full windows: (by, step, window, moving_avg).

    ``step`` counts from 0 in the run. Without ``window`` each run takes its own width
    ``min(50, n // 5)``; a width of 1 or less gives no rows. A run is cut into chunks of rows,
    and the last ``width - 1`` rows of a chunk are repeated at the head of the next, so one long
    run spreads over many tasks and every window is still whole.
    """
    indexed = add_row_index(log.select(*by, *order, col), [*by, *order], "_row")
    width = smoothing_window(F.col("_n")) if window is None else F.lit(window).cast("long")
    runs = (
        indexed.groupBy(*by)
        .agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
        .withColumn("window", width)
        .where((F.col("window") > 1) & (F.col("window") <= F.col("_n")))
    )
    runs = settle(runs)
    widest = window or LARGEST_WINDOW
    chunk = max(chunk, widest)

    def averaged(runs: DataFrame, mean: Callable[[W], Column]) -> DataFrame:
        home = F.floor(F.col("step") / chunk)
        at_tail = (F.col("step") % chunk) > F.lit(chunk) - F.col("window")
        chunks = F.when(at_tail, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
        spread = (
            join_small(indexed, runs, by)
            .withColumn("step", F.col("_row") - F.col("_first"))
            .withColumn("_home", home)
            .withColumn("_chunk", F.explode(chunks))
        )
        frame = W.partitionBy(*by, "_chunk").orderBy("step").rowsBetween(1 - widest, 0)
        means = spread.select(*by, "step", "window", "_chunk", "_home", mean(frame))
        whole = (F.col("_chunk") == F.col("_home")) & (F.col("step") >= F.col("window") - 1)
        return means.where(whole).select(*by, "step", "window", "moving_avg")

    def tail_mean(frame: W) -> Column:
        seen = F.collect_list(F.struct(F.col(col).alias("v"))).over(frame)
        width = F.least(F.col("window").cast("int"), F.size(seen))
        known = F.filter(F.slice(seen, F.size(seen) - width + 1, width), lambda x: x.v.isNotNull())
        total = F.aggregate(known, F.lit(0.0), lambda acc, x: acc + x.v)
        return F.try_divide(total, F.size(known).cast("double")).alias("moving_avg")

    # A frame has one fixed width, so runs with a narrower window average the tail of it.
    full = averaged(
        runs.where(F.col("window") == widest), lambda frame: F.avg(col).over(frame).alias("moving_avg")
    )
    if window is not None:
        return full
    return full.unionByName(averaged(runs.where(F.col("window") < widest), tail_mean))


def running_ratio(
    log: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    correct: str = "correct",
    total: str = "total",
    every: int = 50,
) -> DataFrame:
    """Accuracy so far inside each epoch, at its first step and at every 50th."""
    counted = running_totals(
        log.select(*by, *order, correct, total, F.lit(1).cast("long").alias("_one")),
        order,
        {"running_correct": correct, "running_total": total, "step": "_one"},
        by,
    )
    reported = counted.where((F.col("step") == 1) | (F.col("step") % every == 0))
    return reported.select(
        *by,
        "step",
        "running_correct",
        "running_total",
        F.try_divide(
            F.col("running_correct").cast("double"), F.col("running_total").cast("double")
        ).alias("running_accuracy"),
    )


def epoch_summary(
    log: DataFrame,
    by: Sequence[str],
    ts: str,
    loss: str = "loss",
    correct: str = "correct",
    total: str = "total",
) -> DataFrame:
    """Per epoch: steps, plain mean of step losses, accuracy, seconds from first to last step."""
    # Parts of the interval, which do not depend on the session's time zone.
    passed = F.max(ts) - F.min(ts)
    part = lambda unit: F.extract(F.lit(unit), passed).cast("double")
    seconds = ((part("DAY") * 24 + part("HOUR")) * 60 + part("MINUTE")) * 60 + part("SECOND")
    return log.groupBy(*by).agg(
        F.count("*").alias("steps"),
        F.avg(loss).alias("avg_loss"),
        F.try_divide(F.sum(correct).cast("double"), F.sum(total).cast("double")).alias("accuracy"),
        seconds.alias("seconds"),
    )


def epoch_boundaries(
    log: DataFrame, run: Sequence[str], epoch: str, loss: str = "loss", headroom: float = 0.95
) -> DataFrame:
    """Where each epoch after the first begins: steps before it, and a label height.

    Counting steps per epoch is enough, so the windows see one row per epoch, not per step.
    """
    epochs = log.groupBy(*run, epoch).agg(
        F.count("*").alias("_steps"), F.max(loss).alias("_peak")
    )
    in_order = W.partitionBy(*run).orderBy(epoch)
    marked = epochs.select(
        *run,
        epoch,
        _before(in_order, "_steps").alias("boundary_step"),
        (F.max("_peak").over(W.partitionBy(*run)) * headroom).alias("label_height"),
        F.row_number().over(in_order).alias("epoch_number"),
    )
    return marked.where(F.col("epoch_number") > 1)


def head(df: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the order of ``key``."""
    return df.orderBy(*key).limit(n)


def top_k(
    df: DataFrame, score: str | Column, k: int, tie: Sequence[str] = (), rank: str = "rank"
) -> DataFrame:
    """The ``k`` rows of highest score with their rank; ranks are given after the cut."""
    score = F.col(score) if isinstance(score, str) else score
    cut = df.withColumn("_score", score).orderBy(F.desc("_score"), *tie).limit(k)
    ranks = F.row_number().over(W.orderBy(F.desc("_score"), *tie))
    return cut.select(ranks.alias(rank), *df.columns)
