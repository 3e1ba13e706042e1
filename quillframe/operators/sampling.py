"""Exact-size random choices without sorting the table.

Rows are ordered by a digest of their key. To take the first ``r`` rows of that order it is enough
to know the digest of the last one: counts per digest prefix find the prefix that holds rank ``r``,
and only that prefix (1 row in 65,536) is looked at closely. The rows themselves are then labelled
by comparing digests, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillframe.functions.hashing import hash_hex
from quillframe.operators.joins import join_small, settle
from quillframe.sources.artifacts import materialize

_PREFIX = 4  # hex digits
_KEY_DIGITS = 32  # of a row's digest are its key's
_NAMED_PREFIXES = 256


def hash_cutoffs(
    hashed: DataFrame,
    targets: Callable[[DataFrame], DataFrame],
    by: Sequence[str] = (),
    digest: str = "_h",
    key_digest: Column | None = None,
) -> DataFrame:
    """Digest of the row at each wanted rank: (by..., slot, cutoff).

    ``targets`` turns the group sizes (by..., n) into (by..., slot, target), with ``target`` rows
    wanted at or below the cutoff; a target of 0 gives an empty cutoff, below every digest. Sizes
    come from the prefix counts, so the rows are read twice in all. ``key_digest`` is what the digest
    begins with, where that is cheaper: whole digests are then made for the rows near a rank only.
    """
    by = list(by)
    prefix = F.substring(digest if key_digest is None else key_digest, 1, _PREFIX)
    counts = materialize(
        hashed.groupBy(*by, prefix.alias("_prefix")).agg(
            F.count("*").alias("_count")
        ),
        "prefixes",
    )
    sizes = counts.groupBy(*by).agg(F.coalesce(F.sum("_count"), F.lit(0)).alias("n"))
    wanted = settle(targets(sizes))
    if wanted.isEmpty():
        return wanted.select(*by, "slot", F.lit("").alias("cutoff"))
    # At most 65,536 prefixes per group.
    in_order = W.partitionBy(*by).orderBy("_prefix")
    upto = counts.withColumn(
        "_upto", F.sum("_count").over(in_order.rowsBetween(W.unboundedPreceding, 0))
    )
    if by:
        offered = join_small(upto, wanted, by)
    else:
        slots = [
            F.struct(F.lit(r["slot"]).alias("slot"), F.lit(r["target"]).alias("target"))
            for r in wanted.toLocalIterator()
        ]
        offered = upto.select("*", F.inline(F.array(*slots)))
    holds = (F.col("target") > F.col("_upto") - F.col("_count")) & (
        F.col("target") <= F.col("_upto")
    )
    boundary = settle(
        offered.where(holds).select(
            *by,
            "slot",
            "_prefix",
            (F.col("target") - (F.col("_upto") - F.col("_count"))).alias("_rest"),
        )
    )
    named = boundary.select("_prefix").distinct().limit(_NAMED_PREFIXES + 1).toArrow()["_prefix"]
    offered = hashed
    if len(named) <= _NAMED_PREFIXES:
        offered = hashed.where(prefix.isin(named.to_pylist()))
    # Copies share a digest, so count digests first: a hot key is one row from here on.
    near = (
        join_small(
            offered.select(*by, digest, F.substring(digest, 1, _PREFIX).alias("_prefix")),
            boundary.select(*by, "_prefix").distinct(),
            [*by, "_prefix"],
        )
        .groupBy(*by, "_prefix", digest)
        .agg(F.count("*").alias("_count"))
    )
    within = W.partitionBy(*by, "_prefix").orderBy(digest)
    placed = near.withColumn(
        "_upto", F.sum("_count").over(within.rowsBetween(W.unboundedPreceding, 0))
    )
    found = (
        join_small(placed, boundary, [*by, "_prefix"])
        .where(F.col("_upto") >= F.col("_rest"))
        .groupBy(*by, "slot")
        .agg(F.min(digest).alias("cutoff"))
    )
    none = wanted.where(F.col("target") <= 0).select(*by, "slot", F.lit("").alias("cutoff"))
    return settle(found.unionByName(none))


def row_digest(df: DataFrame, key: Sequence[str], seed: int, tag: str) -> Column:
    """Digest of the key, then of the whole row: only identical rows have the same."""
    return F.concat(hash_hex(key, seed, tag), F.hex(F.xxhash64(*df.columns)))


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """A repeatable random subset of exactly ``n`` rows (all rows when there are fewer).

    Rows are chosen by the digest of their key, those that share a key by the digest of the row,
    so any layout of the same rows gives the same sample.
    """
    hashed = df.withColumn("_h", row_digest(df, key, seed, "sample"))
    below_n = lambda sizes: sizes.where(F.col("n") > n).select(
        F.lit(0).alias("slot"), F.lit(n).cast("long").alias("target")
    )
    own = hash_hex(key, seed, "sample")
    cutoff = hash_cutoffs(hashed, below_n, key_digest=own).first()
    if cutoff is None:
        return df
    # The key's part alone turns nearly all rows away, before the digest of the row is made.
    edge = cutoff["cutoff"][:_KEY_DIGITS]
    below = hashed.where((own <= edge) & (F.col("_h") < cutoff["cutoff"]))
    # Rows at the cutoff are identical, so it does not matter which of them fill the sample.
    at = hashed.where((own == edge) & (F.col("_h") == cutoff["cutoff"])).limit(max(n - below.count(), 0))
    return below.unionByName(at).drop("_h")
