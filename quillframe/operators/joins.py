"""Joining a table with its own per-group results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.sources.artifacts import materialize

# A broadcast side is copied to every executor, so it has to stay small whatever the data does.
MAX_BROADCAST_ROWS = 100_000


def settle(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Compute a result table once.

    Up to ``max_rows`` rows become a local table; a larger one is written to the shared folder.
    Either way what reads it later does not run its plan again.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return materialize(df, "settled")
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join rows with a per-group table (NULL groups match each other).

    ``small`` is broadcast only after counting that it has at most ``max_rows`` rows, which spares
    ``big`` the shuffle. Beyond that it is a shuffle join, whose hot keys the adaptive skew join
    splits, since ``big`` is the streamed side.
    """
    renamed = small.select(
        *[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in small.columns if c not in on]
    )
    rows = renamed.limit(max_rows + 1).toArrow()
    if rows.num_rows <= max_rows:
        renamed = F.broadcast(big.sparkSession.createDataFrame(rows, schema=renamed.schema))
    matches = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    )
    return big.join(renamed, matches, how).drop(*[f"_on_{c}" for c in on])
