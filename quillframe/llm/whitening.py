"""Whitening of embeddings from a covariance weighted by how often a vector comes.

Vectors are turned into integers, so that equal ones can be told exactly. Equal vectors are
grouped; the fit counts each distinct one once, or as often as it comes. Sums of the integers are
exact; each task multiplies the centred vectors it holds by their transpose, and the products are
added by place. The eigenvectors of that matrix, whose size is that of a vector, are found on the
driver. Every distinct vector is whitened once and joined back to the rows that hold it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.sources.artifacts import materialize

SCALE = 64
SHIFT = 1_000_000
LARGEST = 1 << 40  # of a scaled component; larger ones are held to it
COMPONENTS = 16


def integer_vectors(
    vectors: DataFrame, key: str, vector: str, scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """(key, x array<long>): ``floor(scale * c) + shift`` of each component c, as double.

    Rows whose vector is null or holds a null or a component that is not finite are left out.
    """
    value = F.col(vector)
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    held = lambda c: F.greatest(F.least(c, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
    whole = lambda c: F.floor(held(c.cast("double") * scale)) + F.lit(shift).cast("long")
    return vectors.where(value.isNotNull() & F.forall(value, finite)).select(
        F.col(key).alias("key"), F.transform(value, whole).alias("x")
    )


def _matrices(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each width among the lists, those without components left out."""
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    widths = np.diff(offsets)
    for width in np.unique(widths[widths > 0]).tolist():
        rows = np.flatnonzero(widths == width)
        yield rows, values[offsets[rows][:, None] + np.arange(width)]


def _exact(matrix: np.ndarray, bound: int) -> np.ndarray:
    """The matrix in 64-bit integers if no result is above ``bound``, else in Python's."""
    return matrix.astype(np.int64 if bound < 1 << 62 else object)


@dataclass
class Fit:
    """What is known of the vectors of one width; ``n`` counts the fit list."""

    n: int
    sums: list[int]
    values: np.ndarray | None = None  # eigenvalues, falling
    axes: np.ndarray | None = None  # unit eigenvectors, one a column
    trace: float = 0.0

    def residuals(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exactly."""
        most = max(int(np.abs(x).max(initial=0)), 1) * self.n + max(map(abs, self.sums))
        return _exact(x, most) * self.n - np.array(self.sums, dtype=np.int64 if most < 1 << 62 else object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.residuals(x) / self.n).astype(np.float64)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of squared residuals of each row; None where 64 bits can't hold it."""
        apart = self.residuals(x)
        most = int(np.abs(apart).max(initial=0))
        apart = _exact(apart, most * most * apart.shape[1])
        return [v if v < 1 << 63 else None for v in (apart * apart).sum(axis=1).tolist()]

    def whitening(self, components: int) -> np.ndarray:
        """Columns that project a centred vector on unit variance; NaN for axes without variance."""
        least = max(self.values[0], 0.0) * len(self.values) * np.finfo(float).eps
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.values > least, 1 / np.sqrt(self.values), np.nan)
        return self.axes[:, :components] * scale[:components]


def _sums(distinct: DataFrame) -> dict[int, Fit]:
    """The size of the fit list and its sums by dimension, for each width of vectors."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column(1).to_numpy(zero_copy_only=False)
            for rows, x in _matrices(batch.column(0)):
                d, w = x.shape[1], weights[rows]
                most = int(np.abs(x).max(initial=0)) * int(w.sum())
                part = (_exact(x, most) * _exact(w, most)[:, None]).sum(axis=0)
                count[d] = count.get(d, 0) + int(w.sum())
                sums[d] = sums.get(d, 0) + part.astype(object)
        out = [(d, i, count[d], str(v)) for d in sums for i, v in enumerate(sums[d])]
        names = ["d", "i", "n", "sum"]
        columns = [list(c) for c in zip(*out)] or [[], [], [], []]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), names=names)

    parts = distinct.select("x", "weight").mapInArrow(summed, "d int, i int, n long, sum string")
    total = F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")
    fits: dict[int, Fit] = {}
    # One row for each dimension.
    for row in parts.groupBy("d", "i").agg(F.sum("n").alias("n"), total).orderBy("d", "i").collect():
        fits.setdefault(row["d"], Fit(int(row["n"]), [])).sums.append(int(row["sum"]))
    return fits


def _covariances(parts: DataFrame, column: str, centre, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """For each width d the covariance of ``column`` over the fit list, divisor ``sizes[d]``.

    ``centre(d, matrix)`` centres rows before they are multiplied. Each task adds up what it holds.
    """

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            of = batch.column(2).to_numpy(zero_copy_only=False)
            for rows, matrix in _matrices(batch.column(0)):
                for d in np.unique(of[rows]).tolist():
                    mine = of[rows] == d
                    c = centre(d, matrix[mine])
                    held[d] = held.get(d, 0.0) + (c * weights[rows][mine][:, None]).T @ c
        for d, gram in held.items():
            i, j = np.triu_indices(len(gram))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), d, np.int32)), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 pa.array(gram[i, j])],
                names=["d", "i", "j", "product"],
            )

    products = parts.select(column, "weight", F.col("d").cast("int").alias("d")).mapInArrow(
        multiplied, "d int, i int, j int, product double"
    )
    out: dict[int, np.ndarray] = {}
    # A row for each pair of dimensions.
    for d, i, j, product in products.groupBy("d", "i", "j").agg(F.sum("product")).collect():
        gram = out.setdefault(d, np.zeros((0, 0)))
        if len(gram) <= j:
            gram = np.pad(gram, (0, j + 1 - len(gram)))
        gram[i, j] = gram[j, i] = product / sizes[d]
        out[d] = gram
    return out


def whiten(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    counted: bool = False,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """(key, copies, n, deviation, whitened, explained, identity_error) for each usable row.

    ``whitened`` and ``explained`` are arrays over the first ``components`` eigenvectors of the
    covariance, by falling eigenvalue: the vector less the mean, projected and over the root of the
    eigenvalue; and the eigenvalue's share of the trace. The fit list holds each distinct vector
    once, or, ``counted``, as often as it comes; ``n`` is its size, ``copies`` how often this vector
    comes. ``deviation`` is the sum over dimensions of ``(n * x - sum)^2``, null if 64 bits can't
    hold it. ``identity_error`` is the largest absolute entry of the whitened fit list's covariance
    less the identity.

    Rows whose vector is null, or holds a null or a component that is not finite, are left out, and
    so are empty vectors, which have no component. Scaled components beyond ``LARGEST`` count as
    that. Vectors of each length are a fit of their own. Repeated rows give repeated results, a null
    key stays one. An axis without variance has null whitened values and no part in
    ``identity_error`` (0 if no axis has any), and of a trace of zero the share is 0. An empty table
    gives an empty result.
    """
    rows = integer_vectors(vectors, key, vector, scale, shift).where(F.size("x") > 0)
    groups = rows.groupBy("x").agg(F.count("*").alias("copies"))
    weight = F.col("copies") if counted else F.lit(1).cast("long")
    distinct = materialize(
        groups.select("x", "copies", weight.alias("weight"), F.size("x").alias("d")), "distinct"
    )
    fits = _sums(distinct)
    sizes = {d: fit.n for d, fit in fits.items()}
    plain = dict(fits)
    spread = _covariances(distinct, "x", lambda d, x: plain[d].centred(x), sizes)
    for d, matrix in spread.items():
        values, axes = np.linalg.eigh(matrix)
        fits[d] = Fit(sizes[d], fits[d].sums, values[::-1], axes[:, ::-1], float(np.trace(matrix)))
    shapes = {d: fit.whitening(min(components, d)) for d, fit in fits.items()}

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _matrices(batch.column(0)):
                taken = batch.take(pa.array(at))
                fit, shape = fits[x.shape[1]], shapes[x.shape[1]]
                white = fit.centred(x) @ shape
                flat = pa.array(white.ravel(), mask=np.isnan(white.ravel()))
                ends = np.arange(len(x) + 1, dtype=np.int32) * shape.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(fit.deviation(x), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), flat)],
                    names=[*taken.schema.names, "deviation", "whitened"],
                )

    white = materialize(
        distinct.mapInArrow(
            projected, "x array<long>, copies long, weight long, d int, deviation long, whitened array<double>"
        ),
        "whitened",
    )
    errors = _identity_errors(white, shapes, sizes)
    facts = [
        (
            d,
            sizes[d],
            [float(v / fit.trace) if fit.trace > 0 else 0.0 for v in fit.values[: shapes[d].shape[1]]],
            errors[d],
        )
        for d, fit in fits.items()
    ]
    known = vectors.sparkSession.createDataFrame(
        facts, "_d int, n long, explained array<double>, identity_error double"
    )
    found = white.select(F.col("x").alias("_x"), "copies", "d", "deviation", "whitened").join(
        known, F.col("d") == F.col("_d")
    )
    # The copies of one vector are the hot side, which the adaptive join splits.
    return rows.join(found, F.col("x") == F.col("_x")).select(
        "key", "copies", "n", "deviation", "whitened", "explained", "identity_error"
    )


def _identity_errors(
    white: DataFrame, shapes: dict[int, np.ndarray], sizes: dict[int, int]
) -> dict[int, float]:
    """How far the covariance of whitened vectors is from the identity, by width of the vectors."""
    alive = {d: ~np.isnan(shape).any(axis=0) for d, shape in shapes.items()}
    filled = white.select(
        F.transform("whitened", lambda v: F.coalesce(v, F.lit(0.0))).alias("whitened"), "weight", "d"
    )
    means: dict[int, np.ndarray] = {d: np.zeros(len(a)) for d, a in alive.items()}
    at = filled.select("d", "weight", F.posexplode("whitened").alias("i", "v"))
    for d, i, total in at.groupBy("d", "i").agg(F.sum(F.col("v") * F.col("weight"))).collect():
        means[d][i] = total / sizes[d]
    found = _covariances(filled, "whitened", lambda d, w: w - means[d], sizes)
    out = {}
    for d, cov in found.items():
        apart = np.abs(cov - np.eye(len(cov)))[np.ix_(alive[d], alive[d])]
        out[d] = float(apart.max(initial=0.0))
    return out


def whitened_components(whitened: DataFrame) -> DataFrame:
    """A row for each component of each row of ``whiten``, numbered from 1."""
    at = F.posexplode("whitened").alias("_i", "_value")
    spread = whitened.select("key", "copies", "n", "deviation", "explained", "identity_error", at)
    return spread.select(
        "key",
        (F.col("_i") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("_value").alias("whitened"),
        F.get("explained", F.col("_i")).alias("explained"),
        "identity_error",
    )
