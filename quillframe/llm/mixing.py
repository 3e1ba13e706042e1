"""Mixing sources to target weights over a time-varying curriculum.

Every source has a share of the mix and a schedule of weights over training time 0 to 1. The
integral of the schedule, scaled to the source's target, is its cumulative demand; a document that
covers some stretch of the source's words is read when the demand reaches that stretch, which the
inverse of the integral tells. Range-sorting by that time is the order of training.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.functions.hashing import hash_hex
from quillframe.llm.rows import identified, numbered, running_sums
from quillframe.operators.ordered import add_row_index
from quillframe.sources.artifacts import materialize

# Weights of sources by code point, repeating, and their share of all words.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_PASSES = 2
# The schedule of a source runs in a line from the one to the other; odd sources the other way.
RAMP = (1.5, 0.5)


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, weights: Sequence[int], share: float, most: float
) -> DataFrame:
    """(source, size, rank, target) for the (source, size) of each source, null last.

    ``share`` of all words goes to the sources by weight; none gets more than ``most`` times its
    own, and the excess goes by weight to those below, until none is above. Every round settles
    all sources that are above, so there are few; what a round needs is one row of sums.
    """
    named = sizes.withColumn("_null", F.col("source").isNull())
    ranked = add_row_index(named, ["_null", "source"], "rank").drop("_null")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")
    )
    ranked = materialize(ranked.withColumn("_weight", weight), "sources")
    cap = F.col("size") * F.lit(float(most))
    total = ranked.agg(F.sum("size")).first()[0] or 0
    level, filled = 0.0, F.lit(False)
    while True:
        open_ = F.when(~filled, F.col("_weight")).otherwise(0.0)
        held = F.when(filled, cap).otherwise(0.0)
        row = ranked.agg(F.sum(open_).alias("weight"), F.sum(held).alias("held")).first()
        if not row["weight"]:
            break
        reached = max(level, (share * total - row["held"]) / row["weight"])
        if reached == level:
            break
        level = reached
        filled = F.col("_weight") * level >= cap
    return ranked.select("source", "size", "rank", F.least(cap, F.col("_weight") * level).alias("target"))


def _when(done: Column, start: Column, end: Column) -> Column:
    """The time at which a schedule from weight ``start`` to ``end`` has spent the share ``done``.

    The integral of ``start + (end - start) t`` over its whole is solved for t.
    """
    whole = (start + end) / 2
    slope = end - start
    root = F.sqrt(F.greatest(start * start + 2 * slope * whole * done, F.lit(0.0)))
    return F.when(slope == 0, done).otherwise((root - start) / slope)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_PASSES,
    ramp: tuple[float, float] = RAMP,
    seed: int = 42,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """Plan of a mix in training order: (uid, key, source, size, source_size, target, pass, words,
    position), one row for each pass over a document, range-sorted by position.

    The documents of a source follow each other in an order fixed by digests of their keys, one
    pass after the other, until its target is reached: the last document of it is read in part.
    ``words`` are the words read, ``position`` the time in (0, 1] at which the document is done. A
    document that is not read has one row with pass 0, no words and no position; so have empty and
    null texts. A null source is a source of its own. Any layout of the same rows gives the same
    plan, up to which of rows with equal keys comes first. An empty table gives an empty plan.
    """
    return _plan(identified(docs), weights, share, most, ramp, seed, text, key, source)


def _plan(
    rows: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_PASSES,
    ramp: tuple[float, float] = RAMP,
    seed: int = 42,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """``mix`` for rows (uid, row)."""
    row = F.col("row")
    rows = rows.select(
        "uid",
        row[key].alias("key"),
        row[source].alias("source"),
        word_count(row[text]).alias("size"),
    )
    rows = rows.withColumn("_order", hash_hex([F.coalesce(F.col("key").cast("string"), F.lit(""))], seed))
    rows = materialize(rows, "sizes")  # words are counted once
    placed = running_sums(rows, ["_order", "uid"], "size", by="source").drop("_order")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("size"))
    goals = targets(sizes, weights, share, most).select(
        F.col("source").alias("_source"), F.col("size").alias("source_size"), "rank", "target"
    )
    planned = placed.join(goals, F.col("source").eqNullSafe(F.col("_source")))
    goal = F.round("target").cast("long")
    passes = int(-(-most // 1))
    read = []
    for i in range(passes):
        start = F.col("before") + F.lit(i) * F.col("source_size")
        words = F.least(F.greatest(goal - start, F.lit(0)), F.col("size"))
        done = F.try_divide((start + words).cast("double"), goal.cast("double"))
        early, late = (F.when(F.col("rank") % 2 == 0, a).otherwise(b) for a, b in (ramp, ramp[::-1]))
        read.append(
            F.struct(
                F.lit(i + 1).alias("pass"),
                words.alias("words"),
                _when(done, early.cast("double"), late.cast("double")).alias("position"),
            )
        )
    none = F.struct(
        F.lit(0).alias("pass"), F.lit(0).cast("long").alias("words"), F.lit(None).cast("double").alias("position")
    )
    taken = F.filter(F.array(*read), lambda x: x["words"] > 0)
    taken = F.when(F.size(taken) > 0, taken).otherwise(F.array(none))
    columns = ["uid", "key", "source", "size", "source_size", "target"]
    spread = planned.select(*columns, F.inline(taken))
    return spread.repartitionByRange("position", "uid").sortWithinPartitions("position", "uid")


def taken_words(plan: DataFrame) -> DataFrame:
    """(uid, key, size, source_size, target, taken) for each document of a plan."""
    columns = ["uid", "key", "size", "source_size", "target"]
    return plan.groupBy(*columns).agg(F.sum("words").alias("taken"))


def mixed_documents(docs: DataFrame, at_rest: bool = False, **options) -> DataFrame:
    """``docs`` as the mix reads them, in training order: a row for each pass over a document.

    A pass that reads at least half of a document gives the whole of it, any other gives none, so
    that no text is cut. Empty and null texts are in no pass; an empty table gives an empty mix;
    column names of ``docs`` may be any. Rows are written once with their numbers, so that the plan
    meets the rows it was made for; not if they are ``at_rest`` (``rows.numbered``).
    """
    rows = numbered(docs, at_rest=at_rest)
    plan = _plan(rows, **options).where(F.col("words") * 2 >= F.col("size")).where("words > 0")
    plan = plan.select(F.col("uid").alias("_uid"), F.col("position").alias("_position"))
    rows = rows.join(plan, F.col("uid") == F.col("_uid"))
    ordered = rows.repartitionByRange("_position", "uid").sortWithinPartitions("_position", "uid")
    return ordered.select("row.*")
