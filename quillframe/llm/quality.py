"""A quality classifier over random-indexing word vectors.

Every token has an index vector: a few ones and minus ones at places its hash chooses. A token's
word vector is its own index vector plus what stands beside it in all texts of the corpus, added up and
scaled to length 1. A document is pooled to the mean of its word vectors, the mean of their squares,
the mean product of the index vectors of neighbours (high where tokens repeat), and the spread of its
token kinds; a two-layer network on those gives a probability, calibrated by a temperature.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.functions.hashing import hash_hex
from quillframe.llm.rows import balanced, cut_at_space, identified
from quillframe.sources.artifacts import materialize

DIM = 32
ONES = 4  # places of an index vector that are not 0
BUCKETS = 1 << 15  # word vectors kept unless asked for more: 8 MB, whatever the corpus
SLICES = 256  # parts in which counts of neighbours are added up, small for many tasks' sake
LANE = 1024  # tasks whose sums meet first: 16 MB
SLICE_BYTES = 1 << 20
STEP = 4096  # tokens pooled at a time
TRAINING_ROWS = 12_000  # bound of the labelled sample that is fitted on
HIDDEN = 16
EPOCHS = 400
SEED = 42

# Tokens are runs of lower-case letters and all that is not ASCII (0), of capitals (1), of digits
# (2), and of anything else (3); white space (4) parts them.
KINDS = 4
_KIND = np.full(256, 3, np.uint8)
_KIND[97:123] = _KIND[128:] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[32, *range(9, 14)]] = 4


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers scrambled, so that any of their bits can be used alone (the splitmix64 steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# What each byte adds to the polynomial that is a token's digest; white space adds nothing.
_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE[_KIND == 4] = 0
_BASE = np.uint64(0xD6E8FEB86659FD93)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, digest, kind) of every token of ``texts``, which hold no nulls, in order."""
    offsets, sizes = _offsets(texts)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    kinds = _KIND[data]
    first = np.ones(len(data), bool)
    first[1:] = kinds[1:] != kinds[:-1]
    first[offsets[:-1][sizes > 0]] = True
    starts = np.flatnonzero(first & (kinds != 4))
    if not len(starts):
        return starts, starts.astype(np.uint64), starts.astype(np.uint8)
    rows = np.searchsorted(offsets, starts, "right") - 1
    # White space after a token goes with it and adds 0.
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    powers = np.full(int(lengths.max()), _BASE)
    np.cumprod(powers, out=powers)
    terms = powers[place]
    terms *= _BYTE[data[starts[0] :]]
    return rows, _mixed(np.add.reduceat(terms, starts - starts[0])), kinds[starts]


def _offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    wide = pa.types.is_large_string(texts.type)
    held = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = held[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return offsets, np.diff(offsets)


def buckets_of(digests: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    return (digests % np.uint64(buckets)).astype(np.int64)


def index_vectors(digests: np.ndarray) -> np.ndarray:
    """The index vector of each token: ``ONES`` ones and minus ones at places its digest chooses."""
    out = np.zeros((len(digests), DIM))
    bits, each = _mixed(digests ^ np.uint64(SEED)), np.arange(len(digests))
    for _ in range(ONES):
        sign = 1.0 - 2.0 * (bits // np.uint64(DIM) & np.uint64(1)).astype(np.float64)
        out[each, (bits % np.uint64(DIM)).astype(np.int64)] += sign
        bits = bits // np.uint64(2 * DIM)
    return out


def neighbour_sums(texts: DataFrame, n_buckets: int = BUCKETS) -> np.ndarray:
    """Index vectors of the tokens beside each bucket's tokens, added up over ``texts`` (text).

    Each task adds up its texts and sends a few slices of the table, which are added up again, those
    of ``LANE`` tasks first and then those sums; the driver gets the one table of ``n_buckets`` rows.
    """
    width = -(-n_buckets // SLICES)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((width * SLICES, DIM), np.int32)
        for batch in batches:
            for _, part in balanced(batch.column(0), SLICE_BYTES, cut_at_space):
                rows, digests, _ = tokens_of(part)
                known, place = np.unique(digests, return_inverse=True)
                buckets, index = buckets_of(known, n_buckets)[place], index_vectors(known)
                pairs = np.flatnonzero(rows[1:] == rows[:-1])
                for d in range(DIM):
                    value = index[place, d]
                    table[:, d] += (
                        np.bincount(buckets[pairs], value[pairs + 1], len(table))
                        + np.bincount(buckets[pairs + 1], value[pairs], len(table))
                    ).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(SLICES), pa.int32()),
                pa.array([TaskContext.get().partitionId() // LANE] * SLICES, pa.int32()),
                pa.array([table[i * width : (i + 1) * width].tobytes() for i in range(SLICES)]),
            ],
            names=["slice", "lane", "sums"],
        )

    def summed(kind: type) -> Callable[[pa.Table], pa.Table]:
        def run(group: pa.Table) -> pa.Table:
            whole = np.zeros(width * DIM, np.int64)
            for x in group["sums"]:
                whole += np.frombuffer(x.as_py(), kind)
            return pa.table({"slice": group["slice"][:1], "sums": [whole.tobytes()]})

        return run

    parts = texts.mapInArrow(added, "slice int, lane int, sums binary")
    lanes = parts.groupBy("slice", "lane").applyInArrow(summed(np.int32), "slice int, sums binary")
    rows = lanes.groupBy("slice").applyInArrow(summed(np.int64), "slice int, sums binary").collect()
    out = np.zeros((SLICES, width * DIM), np.int64)
    for row in rows:
        out[row["slice"]] = np.frombuffer(row["sums"], np.int64)
    return out.reshape(-1, DIM)[:n_buckets]


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def features(table: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Pooled features of each text, whole; an empty one has zeros. ``table`` has rows of length 1."""
    n = len(texts)
    sums = np.zeros((n, 3 * DIM + KINDS + 2))
    count = np.zeros(n)
    pairs_of = np.zeros(n)
    for numbers, part in balanced(texts, SLICE_BYTES, cut_at_space):
        rows, digests, kinds = tokens_of(part)
        if not len(rows):
            continue
        known, one, place = np.unique(digests, return_index=True, return_inverse=True)
        index = index_vectors(known)
        vectors = _unit(table[buckets_of(known, len(table))] + _unit(index))
        kind = np.eye(KINDS)[kinds[one]]
        each = np.concatenate([vectors, vectors * vectors, kind, index], axis=1)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1, [len(rows)]])
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
            doc, size = numbers[rows[start]], end - start
            for at in range(start, end, STEP):
                # One token more, for the pair that a step's last one makes.
                codes = place[at : min(at + STEP + 1, end)]
                own = each[codes]
                added = own[:STEP, : 2 * DIM + KINDS].sum(axis=0)
                sums[doc, : 2 * DIM] += added[: 2 * DIM]
                sums[doc, 3 * DIM : 3 * DIM + KINDS] += added[2 * DIM :]
                beside = own[:, 2 * DIM + KINDS :]
                sums[doc, 2 * DIM : 3 * DIM] += (beside[1:] * beside[:-1]).sum(axis=0)
                sums[doc, 3 * DIM + KINDS] += np.count_nonzero(codes[1:] == codes[:-1])
            count[doc] += size
            pairs_of[doc] += size - 1
    out = np.zeros_like(sums)
    out[:, : 2 * DIM] = sums[:, : 2 * DIM] / np.maximum(count, 1)[:, None]
    out[:, 2 * DIM : 3 * DIM] = sums[:, 2 * DIM : 3 * DIM] / np.maximum(pairs_of, 1)[:, None]
    out[:, 3 * DIM : 3 * DIM + KINDS] = sums[:, 3 * DIM : 3 * DIM + KINDS] / np.maximum(count, 1)[:, None]
    out[:, 3 * DIM + KINDS] = sums[:, 3 * DIM + KINDS] / np.maximum(pairs_of, 1)
    out[:, 3 * DIM + KINDS + 1] = np.log1p(count)
    return out


@dataclass
class Network:
    """Two layers over standardised features, and the temperature of its probability."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.logits(x) / self.temperature, -50, 50)
        return 1 / (1 + np.exp(-z))


def fit_network(x: np.ndarray, y: np.ndarray, held: np.ndarray) -> Network:
    """Fit by Adam on the rows not ``held``; set the temperature on those held."""
    rng = np.random.default_rng(SEED)
    train, target = x[~held], y[~held].astype(np.float64)
    mean = train.mean(axis=0) if len(train) else np.zeros(x.shape[1])
    scale = np.maximum(train.std(axis=0), 1e-3) if len(train) else np.ones(x.shape[1])
    net = Network(
        mean,
        scale,
        rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, HIDDEN),
        0.0,
    )
    if not len(train):
        return net
    inputs = (train - mean) / scale
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    m = [np.zeros_like(p) for p in params]
    v = [np.zeros_like(p) for p in params]
    for step in range(1, EPOCHS + 1):
        hidden = np.tanh(inputs @ params[0] + params[1])
        p = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -50, 50)))
        error = (p - target) / len(target)
        back = np.outer(error, params[2]) * (1 - hidden**2)
        slopes = [
            inputs.T @ back + 1e-4 * params[0],
            back.sum(axis=0),
            hidden.T @ error + 1e-4 * params[2],
            np.array([error.sum()]),
        ]
        for i, g in enumerate(slopes):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            rate = 0.02 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            params[i] -= rate * m[i] / (np.sqrt(v[i]) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    if held.any():
        z, t = net.logits(x[held]), y[held].astype(np.float64)
        # Rows that the network tells apart without fail are no reason to be surer than it is.
        grid = np.exp(np.linspace(0, 3, 61))
        loss = [np.mean(np.logaddexp(0, z / g) - t * z / g) for g in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


@dataclass
class QualityModel:
    """Word vectors of a bounded number of buckets, and the network on what they pool to."""

    table: np.ndarray
    network: Network

    def score(self, rows: DataFrame, text: str) -> DataFrame:
        """``rows``, whose last column is ``text``, with ``score`` (P of label 1) in its place."""
        model = rows.sparkSession.sparkContext.broadcast(self)  # some 8 MB
        kept = rows.columns[:-1]

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fitted = model.value
            table = _unit(fitted.table)
            for batch in batches:
                x = features(table, batch.column(len(kept)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(fitted.network.probabilities(x))],
                    names=[*kept, "score"],
                )

        return rows.mapInArrow(scored, rows.drop(text).schema.add("score", "double"))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    usable: Column | None = None,
    rows: int = TRAINING_ROWS,
    n_buckets: int = BUCKETS,
    text: str = "text",
    key: str = "doc_id",
) -> QualityModel:
    """Fit on at most ``rows`` labelled rows, those of least digest of their key.

    Word vectors come from all texts of ``docs``, labelled or not; tokens share ``n_buckets`` of them
    (256 bytes each), more of which tell more words apart. ``usable`` is a condition on ``key`` that
    the labelled rows must meet; a fifth of them sets the temperature. Only labels 0 and 1 count; a key with both, or an
    unlabelled one, is not used. Without usable rows every score is one half.
    """
    clear = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    clear = clear.groupBy(F.col(key).alias("_key")).agg(
        F.min(label).alias("_label"), F.max(label).alias("_most")
    )
    clear = clear.where(F.col("_label") == F.col("_most")).select("_key", "_label")
    if usable is not None:
        clear = clear.withColumnRenamed("_key", key).where(usable).withColumnRenamed(key, "_key")
    chosen = clear.withColumn("_digest", hash_hex(["_key"], SEED)).orderBy("_digest").limit(rows)
    texts = docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    # At most ``rows`` keys of a few bytes; of rows with one key, a single text.
    sample = texts.join(F.broadcast(chosen), "_key").groupBy("_key", "_digest", "_label")
    sample = materialize(sample.agg(F.min("_text").alias("_text")), "sample")
    table = neighbour_sums(texts.select("_text"), n_buckets)
    model = QualityModel(table, fit_network(np.zeros((0, 3 * DIM + KINDS + 2)), np.zeros(0), np.zeros(0, bool)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _unit(shared.value.table)
        for batch in batches:
            x = features(table, batch.column(2))
            lists = pa.ListArray.from_arrays(
                np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists], names=["digest", "label", "x"]
            )

    columns = sample.select("_digest", F.col("_label").cast("int"), "_text")
    found = columns.mapInArrow(pooled, "digest string, label int, x array<double>").toArrow()
    found = found.sort_by("digest")
    if found.num_rows:
        x = np.array(found["x"].to_pylist())
        digests = found["digest"].to_pylist()
        held = np.array([int(d[-8:], 16) % 5 == 0 for d in digests])
        model.network = fit_network(x, found["label"].to_numpy(), held)
    return model


def score_quality(
    docs: DataFrame, model: QualityModel, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(key, score) for each row of ``docs``: texts are read whole, a null one counts as empty.

    Nothing but the text decides the score, so repeated rows score alike; an empty text has the
    score of no words at all, and an empty table gives an empty result.
    """
    rows = identified(docs).select(F.col("row")[key].alias(key), F.col("row")[text].alias("_text"))
    return model.score(rows, "_text")


def keep_quality(docs: DataFrame, model: QualityModel, least: float, text: str = "text") -> DataFrame:
    """``docs`` whose score is ``least`` or more: scored as by ``score_quality``, row by row.

    Repeated rows stay or go together; column names of ``docs`` may be any.
    """
    rows = identified(docs).select("row", F.col("row")[text].alias("_text"))
    return model.score(rows, "_text").where(F.col("score") >= least).select("row.*")
