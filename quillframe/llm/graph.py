"""Connected components of a table of links, without gathering a component anywhere."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.sources.artifacts import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another; ``root`` is the least node reachable.

    Each round points every node at the least of its neighbours and replaces links by links between
    those, which at least halves what is left of a chain or star. Every round is an aggregate and
    two joins on one node each; hot nodes are counted down before the shuffle, or split by the
    adaptive join. Tables of every round are written, so a lost executor costs no round twice.
    """

    def settled(x, y):
        ends = F.least(x, y).alias("a"), F.greatest(x, y).alias("b")
        return links_now.where(x != y).select(*ends).distinct()

    links_now = links
    left = materialize(settled(F.col(a), F.col(b)), "links")
    maps = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        low = materialize(low.select("node", F.least("node", "least").alias("root")), "roots")
        maps.append(low)
        ends = [low.select(F.col("node").alias(f"n{c}"), F.col("root").alias(f"r{c}")) for c in "ab"]
        links_now = left.join(ends[0], F.col("a") == F.col("na")).join(
            ends[1], F.col("b") == F.col("nb")
        )
        left = materialize(settled(F.col("ra"), F.col("rb")), "links")
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = maps.pop()
    while maps:
        later = found.select(F.col("node").alias("_via"), F.col("root").alias("_last"))
        found = (
            maps.pop()
            .join(later, F.col("root") == F.col("_via"), "left")
            .select("node", F.coalesce("_last", "root").alias("root"))
        )
    return found


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node to the least of its component, for links that fit in memory."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        np.minimum.at(label, before[x], low)
        np.minimum.at(label, before[y], low)
        label = label[label]
        if np.array_equal(label, before):
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]
