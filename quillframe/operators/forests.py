"""Growing a forest in stages, as MLlib grows one node by node, and scoring by it.

MLlib's tasks send statistics of every open node, reached by their rows or not, so a forest of deep
trees costs tasks times nodes. Here only nodes of many rows are split from sums over all tasks. A
smaller node's rows come together in one task, which grows the tree below it; such a node has at most
``TASK_ROWS`` rows of a bootstrap sample, however large the table is.

MLlib also sends the whole forest with every task that scores. Here some rows meet some trees in a
task, and the votes of a row are added in the order of the trees.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.operators.joins import join_small
from quillframe.sources.artifacts import materialize, shared_path

TASK_ROWS = 32_768
# Nodes whose sums one pass over the rows makes, and the most a task of small nodes looks at together.
PASS_NODES = 4_096
CHUNK_NODES = 512
_SAMPLE_ROWS = 10_000
# Trees and rows that a task scores together.
SCORED_TREES = 8
SCORED_ROWS = 65_536

_NODE = (
    "struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,"
    "gain:double,leftChild:int,rightChild:int,"
    "split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
)


def _thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """Cuts half-way between neighbouring values: all of them, or ``most`` at even ranks."""
    found, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    at = np.arange(max(len(found) - 1, 0))
    if len(at) > most:
        ranks = counts.sum() / (most + 1) * np.arange(1, most + 1)
        at = np.unique(np.minimum(np.searchsorted(np.cumsum(counts), ranks), len(found) - 2))
    return (found[at] + found[at + 1]) / 2


def _steps(d: int, m: int, n_bins: int, n_classes: int, min_leaf: int, seed: int) -> dict[str, Callable]:
    """The arithmetic of splits. Nested, so that workers import nothing of ours."""

    def candidates(tree: int, node: int, n: int = 1) -> np.ndarray:
        """The columns each of ``n`` nodes may split by, in the order in which equal splits win."""
        if m == d:
            return np.tile(np.arange(d), (n, 1))
        draw = np.random.default_rng([seed, tree, node]).random((n, d))
        return np.argsort(draw, axis=1)[:, :m]

    def sums(bins, y, w, slot, chosen) -> np.ndarray:
        """Rows by (slot, candidate, bin, class)."""
        n = len(chosen)
        seen = np.take_along_axis(bins, chosen[slot], axis=1)
        cell = (slot[:, None] * m + np.arange(m)) * n_bins + seen
        cell = cell * n_classes + y[:, None]
        found = np.bincount(cell.ravel(), np.repeat(w, m), n * m * n_bins * n_classes)
        return found.reshape(n, m, n_bins, n_classes)

    def best(found: np.ndarray, chosen: np.ndarray):
        """(gain, column, bin, classes on the left) of the split of least Gini impurity."""
        n = len(found)
        whole = found[:, 0].sum(axis=1)
        left = found.cumsum(axis=2)[:, :, :-1].reshape(n, -1, n_classes)
        right = whole[:, None] - left
        nl, nr = left.sum(axis=2), right.sum(axis=2)
        fits = (nl >= max(min_leaf, 1)) & (nr >= max(min_leaf, 1))
        score = (left**2).sum(axis=2) / np.maximum(nl, 1) + (right**2).sum(axis=2) / np.maximum(nr, 1)
        score[~fits] = -np.inf
        place = score.argmax(axis=1)
        rows = np.arange(n)
        total = whole.sum(axis=1)
        gain = (score[rows, place] - (whole**2).sum(axis=1) / total) / total
        gain[gain < 1e-12] = 0.0
        return gain, chosen[rows, place // (n_bins - 1)], place % (n_bins - 1), left[rows, place]

    return {"candidates": candidates, "sums": sums, "best": best}


def _row_matrix() -> Callable[[pa.Array, int], np.ndarray]:
    """Binary values of one length as rows of a matrix."""

    def rows(column: pa.Array, width: int) -> np.ndarray:
        joined = b"".join(column.to_pylist())
        return np.frombuffer(joined, np.uint8).reshape(len(column), width)

    return rows


def _binner(cuts: list[np.ndarray]) -> Callable[[pa.Array], np.ndarray]:
    """Feature arrays as a matrix of bins."""

    def binned(column: pa.Array) -> np.ndarray:
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(cuts))
        bins = np.empty(x.shape, dtype=np.uint8)
        for i, cut in enumerate(cuts):
            bins[:, i] = np.searchsorted(cut, x[:, i])
        return bins

    return binned


class _Top:
    """The nodes split by sums over all tasks: per tree, in the order they were made."""

    def __init__(self, trees: int, n_classes: int) -> None:
        self.feature = [[-1] for _ in range(trees)]
        self.cut = [[0] for _ in range(trees)]
        self.left = [[-1] for _ in range(trees)]
        self.depth = [[0] for _ in range(trees)]
        self.gain = [[0.0] for _ in range(trees)]
        self.counts: list[list] = [[None] for _ in range(trees)]

    def split(self, tree: int, node: int, gain: float, feature: int, cut: int, left, right) -> None:
        self.feature[tree][node], self.cut[tree][node] = feature, cut
        self.gain[tree][node], self.left[tree][node] = gain, len(self.feature[tree])
        self.counts[tree][node] = np.add(left, right)
        for counts in (left, right):
            self.feature[tree].append(-1)
            self.cut[tree].append(0)
            self.left[tree].append(-1)
            self.gain[tree].append(0.0)
            self.depth[tree].append(self.depth[tree][node] + 1)
            self.counts[tree].append(np.asarray(counts))

    def walker(self) -> Callable[[int, np.ndarray], np.ndarray]:
        """The node of each row in a tree, from its bins."""
        ways = [
            tuple(np.array(x, dtype=np.int32) for x in way)
            for way in zip(self.feature, self.cut, self.left, strict=True)
        ]
        steps = [max(depth) for depth in self.depth]

        def walk(tree: int, bins: np.ndarray) -> np.ndarray:
            feature, cut, left = ways[tree]
            at, rows = np.zeros(len(bins), dtype=np.int32), np.arange(len(bins))
            for _ in range(steps[tree]):
                inner = feature[at]
                right = bins[rows, np.maximum(inner, 0)] > cut[at]
                at = np.where(inner >= 0, left[at] + right, at)
            return at

        return walk


def _points(
    train: DataFrame, label: str, features: str, cuts: list[np.ndarray], trees: int, seed: int
) -> DataFrame:
    """Rows as (class, bins, how often each tree draws the row), written once."""
    bins_of = _binner(cuts)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        draws = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            n = batch.num_rows
            bins = bins_of(batch.column(1))
            drawn = np.minimum(draws.poisson(1.0, (n, trees)), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([row.tobytes() for row in bins], pa.binary()),
                    pa.array([row.tobytes() for row in drawn], pa.binary()),
                ],
                names=["y", "bins", "drawn"],
            )

    known = F.col(label).cast("int")
    named = train.select(
        F.coalesce(known, F.raise_error(F.lit("a class is missing")).cast("int")).alias("y"),
        vector_to_array(features).alias("x"),
    )
    return materialize(named.mapInArrow(binned, "y int, bins binary, drawn binary"), "points")


def _split_large(
    points: DataFrame, top: _Top, open_nodes: list[tuple[int, int]], d: int, trees: int,
    steps: dict[str, Callable], m: int, n_bins: int, n_classes: int,
) -> list:
    """The best split of each of some nodes of many rows, from sums over all tasks."""
    walk, candidates, sums, best = top.walker(), steps["candidates"], steps["sums"], steps["best"]
    rows_of = _row_matrix()
    shape = (m, n_bins, n_classes)
    slots: dict[int, tuple] = {}
    for tree in dict.fromkeys(t for t, _ in open_nodes):
        nodes = [node for t, node in open_nodes if t == tree]
        slot = np.full(len(top.feature[tree]), -1, dtype=np.int64)
        slot[nodes] = np.arange(len(nodes))
        slots[tree] = (nodes, slot, np.vstack([candidates(tree, node) for node in nodes]))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for batch in batches:
            y = batch.column(0).to_numpy()
            bins = rows_of(batch.column(1), d)
            drawn = rows_of(batch.column(2), trees)
            for tree, (_, slot, chosen) in slots.items():
                at = slot[walk(tree, bins)]
                w = drawn[:, tree]
                mine = np.flatnonzero((at >= 0) & (w > 0))
                if len(mine):
                    part = sums(bins[mine], y[mine], w[mine].astype(float), at[mine], chosen)
                    found[tree] = found[tree] + part if tree in found else part
        for tree, part in found.items():
            nodes = slots[tree][0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tree] * len(nodes), pa.int32()),
                    pa.array(nodes, pa.int32()),
                    pa.array([x.tobytes() for x in part], pa.binary()),
                ],
                names=["tree", "node", "sums"],
            )

    def chosen_split(table: pa.Table) -> pa.Table:
        tree, nodes, total = table.column("tree")[0].as_py(), table.column("node").to_pylist(), {}
        for node, part in zip(nodes, table.column("sums"), strict=True):
            part = np.frombuffer(part.as_py()).reshape(shape)
            total[node] = total[node] + part if node in total else part
        nodes = sorted(total)
        columns = np.vstack([candidates(tree, node) for node in nodes])
        both = np.stack([total[node] for node in nodes])
        gain, feature, cut, left = best(both, columns)
        whole = both[:, 0].sum(axis=1)
        return pa.table(
            {
                "tree": pa.array([tree] * len(nodes), pa.int32()),
                "node": pa.array(nodes, pa.int32()),
                "gain": gain,
                "feature": feature.astype(np.int32),
                "cut": cut.astype(np.int32),
                "left": pa.array(left.tolist(), pa.list_(pa.float64())),
                "right": pa.array((whole - left).tolist(), pa.list_(pa.float64())),
            }
        )

    parts = points.mapInArrow(summed, "tree int, node int, sums binary")
    found = parts.groupBy("tree").applyInArrow(
        chosen_split,
        "tree int, node int, gain double, feature int, cut int, left array<double>, right array<double>",
    )
    return sorted(found.collect(), key=lambda r: (r["tree"], r["node"]))


def _subtrees(
    points: DataFrame, top: _Top, small: list[tuple[int, int]], d: int, trees: int,
    steps: dict[str, Callable], m: int, n_bins: int, n_classes: int, max_depth: int,
    cuts: list[np.ndarray],
) -> DataFrame:
    """The tree below each node of few rows, grown in one task: (tree, node, nodes), the nodes with
    their place, the node itself at 0."""
    walk, candidates, sums, best = top.walker(), steps["candidates"], steps["sums"], steps["best"]
    rows_of, chunk, depths = _row_matrix(), CHUNK_NODES, top.depth
    wanted: dict[int, np.ndarray] = {}
    for tree, node in small:
        flags = wanted.setdefault(tree, np.zeros(len(top.feature[tree]), dtype=bool))
        flags[node] = True

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(0).to_numpy().astype(np.uint8)
            bins = rows_of(batch.column(1), d)
            drawn = rows_of(batch.column(2), trees)
            for tree, flags in wanted.items():
                at, w = walk(tree, bins), drawn[:, tree]
                mine = np.flatnonzero(flags[at] & (w > 0))
                if not len(mine):
                    continue
                mine = mine[np.argsort(at[mine], kind="stable")]
                nodes, starts = np.unique(at[mine], return_index=True)
                parts = np.split(mine, starts[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([tree] * len(nodes), pa.int32()),
                        pa.array(nodes.astype(np.int32)),
                        pa.array([bins[p].tobytes() for p in parts], pa.binary()),
                        pa.array([y[p].tobytes() for p in parts], pa.binary()),
                        pa.array([w[p].tobytes() for p in parts], pa.binary()),
                    ],
                    names=["tree", "node", "bins", "y", "w"],
                )

    def grow(bins, y, w, tree: int, node: int) -> dict[str, np.ndarray]:
        """Level by level, all open nodes of a level together."""
        counts = [np.bincount(y, w, n_classes)[None, :]]
        feature, cut, gain, left = [], [], [], []
        first, level = 0, 0  # place of the level's first node
        at = np.zeros(len(y), dtype=np.int64)  # place within the level
        while len(counts[-1]):
            now = counts[-1]
            n = len(now)
            f, c, g = np.full(n, -1), np.zeros(n, dtype=np.int64), np.zeros(n)
            below = np.full(n, -1)
            kids = []
            mixed = (now > 0).sum(axis=1) > 1
            if depths[tree][node] + level < max_depth and mixed.any():
                live = np.flatnonzero(mixed)
                rank = np.full(n, -1)
                rank[live] = np.arange(len(live))
                slot = rank[at]
                keep = slot >= 0
                bins, y, w, at, slot = bins[keep], y[keep], w[keep], at[keep], slot[keep]
                order = np.argsort(slot, kind="stable")
                bins, y, w, at, slot = bins[order], y[order], w[order], at[order], slot[order]
                starts = np.searchsorted(slot, np.arange(len(live) + 1))
                chosen = candidates(tree, node * 64 + level + 1, len(live))
                lefts = np.zeros((len(live), n_classes))
                for a in range(0, len(live), chunk):
                    b = min(a + chunk, len(live))
                    part = slice(starts[a], starts[b])
                    found = sums(bins[part], y[part], w[part], slot[part] - a, chosen[a:b])
                    own = live[a:b]
                    g[own], f[own], c[own], lefts[a:b] = best(found, chosen[a:b])
                splits = g[live] > 0
                f[live[~splits]] = -1
                own, lefts = live[splits], lefts[splits]
                below[own] = 2 * np.arange(len(own))
                kids = np.stack([lefts, now[own] - lefts], axis=1).reshape(-1, n_classes)
                keep = f[at] >= 0
                bins, y, w, at = bins[keep], y[keep], w[keep], at[keep]
                right = bins[np.arange(len(at)), f[at]] > c[at]
                at = below[at] + right
                below[own] += first + n
            feature.append(f)
            cut.append(c)
            gain.append(g)
            left.append(below)
            if not len(kids):
                break
            counts.append(kids)
            first, level = first + n, level + 1
        return {
            "counts": np.vstack(counts[: len(feature)]),
            "feature": np.concatenate(feature),
            "cut": np.concatenate(cut),
            "gain": np.concatenate(gain),
            "left": np.concatenate(left),
        }

    def pruned(grown: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """Two leaves of one class become one, from below, as MLlib does."""
        said, left = grown["counts"].argmax(axis=1), grown["left"].copy()
        gone = np.zeros(len(left), dtype=bool)
        while True:
            inner = np.flatnonzero(left >= 0)
            l, r = left[inner], left[inner] + 1
            same = (left[l] < 0) & (left[r] < 0) & (said[l] == said[r])
            if not same.any():
                break
            gone[l[same]] = gone[r[same]] = True
            left[inner[same]] = -1
        place = np.cumsum(~gone) - 1
        leaf = left < 0
        shown = {k: v[~gone] for k, v in grown.items()}
        shown["left"] = np.where(leaf, -1, place[np.maximum(left, 0)])[~gone]
        shown["feature"] = np.where(leaf, -1, grown["feature"])[~gone]
        return shown

    def grown(table: pa.Table) -> pa.Table:
        tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        joined = lambda c: np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint8)
        found = pruned(
            grow(joined("bins").reshape(-1, d), joined("y").astype(np.int64),
                 joined("w").astype(float), tree, node)
        )
        n = len(found["left"])
        at = np.array([
            cuts[f][c] if f >= 0 else np.nan
            for f, c in zip(found["feature"].tolist(), found["cut"].tolist(), strict=True)
        ])
        return pa.table(
            {
                "tree": pa.array([tree] * n, pa.int32()),
                "node": pa.array([node] * n, pa.int32()),
                "place": pa.array(np.arange(n), pa.int32()),
                "left": pa.array(found["left"].astype(np.int32)),
                "feature": pa.array(found["feature"].astype(np.int32)),
                "threshold": pa.array(at, pa.float64()),
                "gain": pa.array(found["gain"], pa.float64()),
                "counts": pa.array(found["counts"].tolist(), pa.list_(pa.float64())),
            }
        )

    rows = points.mapInArrow(sent, "tree int, node int, bins binary, y binary, w binary")
    return rows.groupBy("tree", "node").applyInArrow(
        grown,
        "tree int, node int, place int, left int, feature int, threshold double, gain double,"
        " counts array<double>",
    )


def _numbered(
    top: _Top, grown: dict[tuple[int, int], Any], n_classes: int, cuts: list[np.ndarray]
) -> tuple[list[tuple], list[tuple]]:
    """Nodes of the top as (tree, id, left, feature, threshold, gain, counts), and for each subtree
    (tree, node, its own id, the id before which its others begin)."""
    rows, starts = [], []
    for tree, features in enumerate(top.feature):
        said, gone = [0] * len(features), [False] * len(features)
        leaf = [f < 0 and not (r := grown.get((tree, i))) or f < 0 and r["n"] == 1 for i, f in enumerate(features)]
        for i in reversed(range(len(features))):
            own = grown.get((tree, i))
            counts = own["counts"] if own else top.counts[tree][i]
            top.counts[tree][i] = [0.0] * n_classes if counts is None else list(counts)
            said[i] = int(np.argmax(top.counts[tree][i]))
            left = top.left[tree][i]
            if features[i] >= 0 and leaf[left] and leaf[left + 1] and said[left] == said[left + 1]:
                leaf[i] = gone[left] = gone[left + 1] = True
                features[i] = top.left[tree][i] = -1
        kept = [i for i in range(len(features)) if not gone[i]]
        place = {i: at for at, i in enumerate(kept)}
        upto = len(kept)
        for i in kept:
            own = grown.get((tree, i))
            if own and own["n"] > 1:
                starts.append((tree, i, place[i], upto - 1))
                upto += own["n"] - 1
                continue
            f, inner = features[i], features[i] >= 0
            rows.append((
                tree, place[i], place[top.left[tree][i]] if inner else -1, f,
                float(cuts[f][top.cut[tree][i]]) if inner else None, float(top.gain[tree][i]),
                [float(c) for c in top.counts[tree][i]],
            ))
    return rows, starts


def _written(estimator: RandomForestClassifier, nodes: DataFrame, d: int, n_classes: int):
    """The nodes as a model, by the way of MLlib's files."""
    spark, path = nodes.sparkSession, shared_path(nodes.sparkSession, "forest")
    own = estimator.extractParamMap()
    plain = {p.name: v for p, v in own.items() if estimator.isSet(p)}
    default = {p.name: v for p, v in own.items() if not estimator.isSet(p)}

    def said(kind: str, uid: str, **more: int) -> str:
        params = {"paramMap": plain, "defaultParamMap": default}
        if kind.startswith("Decision"):
            extra = ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")
            params = {k: {n: v for n, v in p.items() if n not in extra} for k, p in params.items()}
        return json.dumps({
            "class": f"org.apache.spark.ml.classification.{kind}Model",
            "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
            **params, **more,
        })

    trees = estimator.getNumTrees()
    whole = said("RandomForestClassification", estimator.uid, numFeatures=d, numClasses=n_classes, numTrees=trees)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = [
        (i, said("DecisionTreeClassification", f"{estimator.uid}_{i}", numFeatures=d, numClasses=n_classes), 1.0)
        for i in range(trees)
    ]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    total = F.aggregate("counts", F.lit(0.0), lambda a, c: a + c)
    share = lambda c: F.try_divide(c, total) * F.try_divide(c, total)
    inner = F.col("left") >= 0
    entries = {
        "id": F.col("id"),
        "prediction": (F.array_position("counts", F.array_max("counts")) - 1).cast("double"),
        "impurity": F.when(
            total > 0, 1 - F.aggregate("counts", F.lit(0.0), lambda a, c: a + share(c))
        ).otherwise(0.0),
        "impurityStats": F.col("counts"),
        "rawCount": total.cast("long"),
        "gain": F.when(inner, F.col("gain")).otherwise(-1.0),
        "leftChild": F.col("left"),
        "rightChild": F.when(inner, F.col("left") + 1).otherwise(-1),
        "split": F.struct(
            F.when(inner, F.col("feature")).otherwise(-1).alias("featureIndex"),
            F.when(inner, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias(
                "leftCategoriesOrThreshold"
            ),
            F.lit(-1).alias("numCategories"),
        ),
    }
    data = F.struct(*[c.alias(n) for n, c in entries.items()]).cast(_NODE)
    nodes.select(F.col("tree").alias("treeID"), data.alias("nodeData")).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


def _packed(nodes: DataFrame, n_classes: int, cuts: list[np.ndarray]) -> DataFrame:
    """One row for each tree, its nodes by id: (tree, left, feature, cut, votes), and what its splits by
    each column lower impurity (lowered), written once."""

    def packed(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("id").to_numpy())
        column = lambda name: table.column(name).to_numpy()[order]
        feature, threshold = column("feature"), column("threshold")
        cut = np.zeros(len(order), dtype=np.uint8)
        for f in np.unique(feature[feature >= 0]):
            cut[feature == f] = np.searchsorted(cuts[f], threshold[feature == f])
        counts = pa.concat_arrays([c.flatten() for c in table.column("counts").chunks]).to_numpy()
        counts = counts.reshape(-1, n_classes)[order]
        total = counts.sum(axis=1, keepdims=True)
        votes = np.divide(counts, total, out=np.zeros_like(counts), where=total > 0)
        inner = feature >= 0
        lowered = np.bincount(feature[inner], column("gain")[inner] * total[inner, 0], len(cuts))
        parts = {
            "left": column("left"), "feature": feature, "cut": cut, "votes": votes,
            "lowered": lowered.astype(float),
        }
        tree = table.column("tree").slice(0, 1).cast(pa.int32())
        return pa.table({"tree": tree} | {k: pa.array([v.tobytes()], pa.binary()) for k, v in parts.items()})

    shown = nodes.select("tree", "id", "left", "feature", "threshold", "gain", "counts")
    schema = "tree int, left binary, feature binary, cut binary, votes binary, lowered binary"
    return materialize(shown.groupBy("tree").applyInArrow(packed, schema), "trees")


def _votes(rows: DataFrame, trees: DataFrame, n_classes: int, cuts: list[np.ndarray], n_trees: int) -> DataFrame:
    """(_row, raw): the votes of all trees for the rows (_row, x), added in the order of the trees."""
    d, bins_of = len(cuts), _binner(cuts)
    buckets = max(1, -(-rows.count() // SCORED_ROWS))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, bins = batch.column(0).to_numpy(), bins_of(batch.column(1))
            for bucket in np.unique(row % buckets).tolist():
                mine = row % buckets == bucket
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bucket], pa.int32()),
                        pa.array([row[mine].tobytes()], pa.binary()),
                        pa.array([bins[mine].tobytes()], pa.binary()),
                    ],
                    names=["bucket", "rows", "bins"],
                )

    def leaves(bins: np.ndarray, left: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        at, live = np.zeros(len(bins), dtype=np.int32), np.arange(len(bins))
        while len(live := live[feature[at[live]] >= 0]):
            node = at[live]
            at[live] = left[node] + (bins[live, feature[node]] > cut[node])
        return at

    def scored(part: pa.Table, some: pa.Table) -> pa.Table:
        joined = lambda c, kind: np.frombuffer(b"".join(part.column(c).to_pylist()), kind)
        row, bins, some = joined("rows", np.int64), joined("bins", np.uint8).reshape(-1, d), some.sort_by("tree")
        found = np.empty((len(row), some.num_rows, n_classes))
        for i, tree in enumerate(some.to_pylist()):
            votes = np.frombuffer(tree["votes"]).reshape(-1, n_classes)
            at = leaves(
                bins, np.frombuffer(tree["left"], np.int32), np.frombuffer(tree["feature"], np.int32),
                np.frombuffer(tree["cut"], np.uint8),
            )
            found[:, i] = votes[at]
        ends = pa.array(np.arange(len(row) + 1, dtype=np.int32) * some.num_rows)
        block = np.full(len(row), some.column("block")[0].as_py(), np.int32)
        shown = {"_row": pa.array(row), "block": pa.array(block)}
        for c in range(n_classes):
            shown[f"votes{c}"] = pa.ListArray.from_arrays(ends, pa.array(found[:, :, c].ravel()))
        return pa.table(shown)

    named = [f"votes{c}" for c in range(n_classes)]
    blocks = -(-n_trees // SCORED_TREES)
    to_all = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    parts = rows.mapInArrow(sent, "bucket int, rows binary, bins binary").withColumn("block", to_all(blocks))
    block = F.floor(F.col("tree") / SCORED_TREES).cast("int")
    trees = trees.drop("lowered").withColumn("block", block).withColumn("bucket", to_all(buckets))
    schema = ", ".join(["_row long, block int", *[f"{c} array<double>" for c in named]])
    met = parts.groupBy("block", "bucket").cogroup(trees.groupBy("block", "bucket"))
    met = met.applyInArrow(scored, schema)
    met = met.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("block", *named))).alias("met"))
    add = lambda c: F.aggregate(F.flatten(F.col(f"met.{c}")), F.lit(0.0), lambda a, v: a + v)
    return met.select("_row", F.array(*[add(c) for c in named]).alias("raw"))


class GrownForest(Model):
    """A forest whose nodes are a table; what is not given here is asked of MLlib's model of them,
    which is made then."""

    def __init__(
        self, estimator: RandomForestClassifier, nodes: DataFrame, n_classes: int, cuts: list[np.ndarray]
    ) -> None:
        super().__init__()
        self._estimator, self._nodes, self._n_classes, self._cuts = estimator.copy(), nodes, n_classes, cuts
        self._trees = _packed(nodes, n_classes, cuts)
        self._made: list[RandomForestClassificationModel] = []

    @property
    def mllib(self) -> RandomForestClassificationModel:
        if not self._made:
            self._made.append(_written(self._estimator, self._nodes, len(self._cuts), self._n_classes))
        return self._made[0]

    @property
    def featureImportances(self) -> SparseVector:
        """As MLlib has them: a column's part of what a tree's splits lower impurity, its mean over the
        trees. The driver sees a number for each tree and column, no nodes."""
        each = self._trees.select("tree", "lowered").orderBy("tree").collect()
        lowered = np.array([np.frombuffer(r["lowered"]) for r in each])
        whole = lowered.sum(axis=1, keepdims=True)
        found = np.divide(lowered, whole, out=np.zeros_like(lowered), where=whole != 0).sum(axis=0)
        found = found / (found.sum() or 1.0)
        return Vectors.sparse(len(found), np.flatnonzero(found), found[found != 0])

    def __getattr__(self, name: str) -> Any:
        if name.startswith("_"):
            raise AttributeError(name)
        return getattr(self.mllib, name)

    def transform(self, dataset: DataFrame, params: dict | None = None) -> DataFrame:
        own = self._estimator
        if params or own.isSet(own.thresholds) or own.getLeafCol():
            return self.mllib.transform(dataset, params)
        return super().transform(dataset)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """The rows, written with a number of their own, and MLlib's three columns."""
        own, said = self._estimator, F.col("raw")
        rows = materialize(dataset.withColumn("_row", F.monotonically_increasing_id()), "unscored")
        x = vector_to_array(own.getFeaturesCol()).alias("x")
        raw = _votes(rows.select("_row", x), self._trees, self._n_classes, self._cuts, own.getNumTrees())
        total = F.aggregate(said, F.lit(0.0), lambda a, v: a + v)
        share = F.transform(said, lambda v: F.when(total != 0, F.try_divide(v, total)).otherwise(v))
        shown = {
            own.getRawPredictionCol(): array_to_vector(said),
            own.getProbabilityCol(): array_to_vector(share),
            own.getPredictionCol(): (F.array_position(said, F.array_max(said)) - 1).cast("double"),
        }
        return rows.join(raw, "_row").select(*dataset.columns, *[c.alias(n) for n, c in shown.items()])


def grow_forest(
    train: DataFrame, n: int, estimator: RandomForestClassifier, task_rows: int = TASK_ROWS
) -> GrownForest:
    """The forest ``estimator`` asks for, of ``n`` rows whose partitions and order depend on them alone.

    Bootstrap samples, cuts at even ranks of a sample, the square root of the columns as candidates of
    a node, Gini impurity and pruning are as in MLlib; the draws are other ones.
    """
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    trees, seed, bins = estimator.getNumTrees(), estimator.getSeed() % 2**63, estimator.getMaxBins()
    max_depth, min_leaf = estimator.getMaxDepth(), estimator.getMinInstancesPerNode()
    if n == 0:
        raise ValueError("no rows to fit a forest on")
    facts = train.agg(F.min(label), F.max(label), F.count_if(F.col(label) != F.floor(label))).first()
    if facts[0] is None or facts[0] < 0 or facts[2]:
        raise ValueError("classes must be whole numbers from 0")
    n_classes = max(int(facts[1]) + 1, 2)
    share = min(1.0, _SAMPLE_ROWS / n)
    sample = train if share == 1.0 else train.sample(False, share, seed)
    seen = sample.select(vector_to_array(features).alias("x")).toArrow().column("x")
    if not len(seen):
        seen = train.select(vector_to_array(features).alias("x")).limit(_SAMPLE_ROWS).toArrow().column("x")
    values = np.vstack([x.flatten().to_numpy().reshape(len(x), -1) for x in seen.chunks if len(x)])
    d = values.shape[1]
    cuts = [_thresholds(values[:, i], bins - 1) for i in range(d)]
    m = d if trees == 1 else max(1, int(np.ceil(np.sqrt(d))))
    n_bins = max(max(map(len, cuts)) + 1, 2)
    steps = _steps(d, m, n_bins, n_classes, min_leaf, seed)
    points = _points(train, label, features, cuts, trees, seed)

    top = _Top(trees, n_classes)
    mixed = lambda t, i: top.depth[t][i] < max_depth and np.count_nonzero(top.counts[t][i]) > 1
    size = lambda t, i: sum(top.counts[t][i])
    roots = [(t, 0) for t in range(trees)]
    small = roots if n <= task_rows else []
    large = roots if n > task_rows and max_depth > 0 else []
    if not small and not large:
        small = roots  # trees of no split
    while large:
        ahead = []
        for i in range(0, len(large), PASS_NODES):
            part = large[i : i + PASS_NODES]
            found = _split_large(points, top, part, d, trees, steps, m, n_bins, n_classes)
            for r in found:
                t, node = r["tree"], r["node"]
                top.counts[t][node] = np.add(r["left"], r["right"])
                if r["gain"] <= 0:
                    continue
                top.split(t, node, r["gain"], r["feature"], r["cut"], r["left"], r["right"])
                kids = [(t, k) for k in (top.left[t][node], top.left[t][node] + 1) if mixed(t, k)]
                ahead += [k for k in kids if size(*k) > task_rows]
                small += [k for k in kids if size(*k) <= task_rows]
        large = ahead

    grown = {}
    shown = ["tree", "id", "left", "feature", "threshold", "gain", "counts"]
    schema = "tree int, id int, left int, feature int, threshold double, gain double, counts array<double>"
    if small:
        below = materialize(
            _subtrees(points, top, small, d, trees, steps, m, n_bins, n_classes, max_depth, cuts),
            "subtrees",
        )
        sizes = below.groupBy("tree", "node").agg(
            F.count("*").alias("n"), F.max(F.when(F.col("place") == 0, F.col("counts"))).alias("counts")
        )
        grown = {(r["tree"], r["node"]): r for r in sizes.toLocalIterator()}
    rows, starts = _numbered(top, grown, n_classes, cuts)
    nodes = train.sparkSession.createDataFrame(rows, schema)
    if starts:
        ids = train.sparkSession.createDataFrame(starts, "tree int, node int, own int, ahead int")
        joined = join_small(below, ids, ["tree", "node"])
        placed = joined.select(
            "tree",
            F.when(F.col("place") == 0, F.col("own")).otherwise(F.col("ahead") + F.col("place")).alias("id"),
            F.when(F.col("left") < 0, -1).otherwise(F.col("ahead") + F.col("left")).alias("left"),
            "feature", "threshold", "gain", "counts",
        )
        nodes = nodes.unionByName(placed)
    return GrownForest(estimator, nodes.select(*shown), n_classes, cuts)
