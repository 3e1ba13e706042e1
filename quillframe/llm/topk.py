"""Exact top-k inner products over a bit-sliced index.

Components become integers; the index holds their high bits as slices, one bitmap over the rows of
a block for each attribute and bit. A query is a sum of signed powers of two, so its approximate
scores are sums of shifted slices, added with carry-save bitmap arithmetic into a bit-sliced total.
From its most significant slice downward the k best rows are selected; every row that the dropped
bits could lift among them is then scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillframe.sources.artifacts import materialize

BLOCK_ROWS = 8192
ROW_BLOCKS = 1  # mean blocks of rows in a group
QUERY_BLOCKS = 16  # mean blocks of queries that meet them: an index block is sent once for so many
QUERY_ROWS = 512
MOST_TASKS = 100_000  # that groups are spread over
SLICES = 7  # bits kept of a row's component
QUERY_BITS = 6  # bits kept of a query's component, besides its sign
LARGEST = 1 << 24  # of a component of a sliced vector, so that scores are exact in 64 bits
WHOLE = float(1 << 52)  # doubles beyond are whole numbers


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, ints): components times 256, rounded down, as doubles, which hold them exactly; rows
    with unusable vectors left out."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    value = F.col(vector)
    return vectors.where(value.isNotNull() & F.forall(value, finite)).select(
        F.col(key).alias("key"),
        F.transform(value, lambda x: _floor(x.cast("double") * 256)).alias("ints"),
    )


def _floor(value: Column) -> Column:
    return F.when(F.abs(value) < WHOLE, F.floor(value).cast("double")).otherwise(value)


def _alike(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, bool], pa.RecordBatch]]:
    """Rows by (number of components, whether one is too large to be sliced)."""
    lists = batch.column(1)
    widths = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(lists)), widths)
    large = np.zeros(len(lists), bool)
    np.logical_or.at(large, row, np.abs(lists.flatten().to_numpy(zero_copy_only=False)) >= LARGEST)
    for width, big in sorted(set(zip(widths.tolist(), large.tolist()))):
        yield (width, big), batch.take(pa.array(np.flatnonzero((widths == width) & (large == big))))


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """(block, width, large, keys, ints) with at most ``most`` rows each, alike in width and size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        held: dict[tuple[int, bool], list[pa.RecordBatch]] = {}

        def block(kind: tuple[int, bool], table: pa.Table) -> pa.RecordBatch:
            nonlocal made
            made += 1
            width, large = kind
            ints = table["ints"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            stored = ints if large else ints.astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([made - 1]),
                    pa.array([width], pa.int32()),
                    pa.array([large]),
                    pa.array([table["key"].to_numpy().astype(np.int64).tobytes()], pa.binary()),
                    pa.array([stored.tobytes()], pa.binary()),
                ],
                names=["block", "width", "large", "keys", "ints"],
            )

        for batch in batches:
            for kind, some in _alike(batch):
                parts = held.setdefault(kind, [])
                parts.append(some)
                while sum(b.num_rows for b in parts) >= most:
                    table = pa.Table.from_batches(parts)
                    yield block(kind, table.slice(0, most))
                    parts[:] = table.slice(most).to_batches()
        for kind, parts in held.items():
            if any(b.num_rows for b in parts):
                yield block(kind, pa.Table.from_batches(parts))

    return rows.mapInArrow(run, f"{BLOCK}, keys binary, ints binary")


BLOCK = "block long, width int, large boolean"


def _numbers(block: dict) -> np.ndarray:
    """The matrix of a block: 64-bit integers, or Python's where components are large."""
    if block["large"]:
        values = np.array([int(v) for v in np.frombuffer(block["ints"], np.float64)], object)
    else:
        values = np.frombuffer(block["ints"], np.int32)
    return values.reshape(len(block["keys"]) // 8, block["width"])


def slices_of(ints: np.ndarray) -> tuple[np.ndarray, int]:
    """Bitmaps (attribute, bit, words) of the high bits of each column, and the bits dropped.

    Values are shifted to start at 0: the top bit is that of two's complement, turned over.
    """
    rows, width = ints.shape
    # Bits of a two's complement number: those of its size, and one for the sign.
    size = int(max(int(ints.max(initial=0)), -1 - int(ints.min(initial=0)))).bit_length() + 1
    drop = max(0, size - SLICES)
    offset = ((ints >> drop) + (1 << (SLICES - 1))).astype(np.uint8)
    words = -(-rows // 64)
    padded = np.zeros((words * 64, width), np.uint8)
    padded[:rows] = offset
    maps = np.empty((width, SLICES, words), np.uint64)
    for bit in range(SLICES):
        packed = np.packbits((padded >> bit) & 1, axis=0, bitorder="little")
        maps[:, bit, :] = np.ascontiguousarray(packed.T).view("<u8")
    return maps, drop


def build_index(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Write the bit-sliced index of all usable rows: (block, width, large, keys, ints, maps, drop).

    Vectors of one length share blocks; those with a component of ``LARGEST`` or more are kept
    apart and not sliced.
    """

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, block in enumerate(batch.to_pylist()):
                maps, drop = (b"", 0) if block["large"] else slices_of(_numbers(block))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(i, 1).columns,
                        pa.array([bytes(maps)], pa.binary()),
                        pa.array([drop], pa.int32()),
                    ],
                    names=[*batch.schema.names, "maps", "drop"],
                )

    blocks = _blocks(usable(vectors, key, vector), BLOCK_ROWS)
    schema = f"{BLOCK}, keys binary, ints binary, maps binary, drop int"
    return materialize(blocks.mapInArrow(sliced, schema), "slices")


def _digits(value: int) -> list[tuple[int, int]]:
    """(power of two, sign) of a number with no two neighbouring powers."""
    out, bit = [], 0
    while value:
        if value & 1:
            sign = 2 - (value & 3)
            out.append((bit, sign))
            value -= sign
        value >>= 1
        bit += 1
    return out


def add_slices(maps: np.ndarray, query: np.ndarray) -> list[np.ndarray]:
    """Bit-sliced sum of ``query`` times the attributes, up to a constant: bitmaps, least first.

    Slices of a negative digit are turned over, which adds the same to every row, as does the
    attributes' offset. Three bitmaps of one weight become one of that weight and one of the next
    (a full adder), until one of each is left.
    """
    levels: list[list[np.ndarray]] = []
    for d in np.flatnonzero(query):
        for bit, sign in _digits(int(query[d])):
            for j in range(SLICES):
                while len(levels) <= bit + j:
                    levels.append([])
                levels[bit + j].append(maps[d, j] if sign > 0 else ~maps[d, j])
    total = []
    at = 0
    while at < len(levels):
        here = levels[at]
        if len(here) > 1 and at + 1 == len(levels):
            levels.append([])
        while len(here) > 2:
            a, b, c = here.pop(), here.pop(), here.pop()
            x = a ^ b
            levels[at + 1].append((a & b) | (c & x))
            x ^= c
            here.append(x)
        if len(here) == 2:
            a, b = here
            levels[at + 1].append(a & b)
            here = [a ^ b]
        total.append(here[0] if here else np.zeros(maps.shape[2], np.uint64))
        at += 1
    return total


def at_least(total: list[np.ndarray], bound: int, among: np.ndarray) -> np.ndarray:
    """Bitmap of the rows ``among`` whose total is ``bound`` or more."""
    if bound <= 0:
        return among
    if bound >> len(total):
        return np.zeros_like(among)
    more, same = np.zeros_like(among), among
    for bit in range(len(total) - 1, -1, -1):
        if bound >> bit & 1:
            same = same & total[bit]
        else:
            more = more | (same & total[bit])
            same = same & ~total[bit]
    return more | same


def kth_largest(total: list[np.ndarray], k: int, among: np.ndarray) -> int | None:
    """The k-th largest total of the rows ``among``; None if there are fewer."""
    if int(np.bitwise_count(among).sum()) < k:
        return None
    found, same = 0, among
    for bit in range(len(total) - 1, -1, -1):
        ones = same & total[bit]
        n = int(np.bitwise_count(ones).sum())
        if n >= k:
            same, found = ones, found | 1 << bit
        else:
            same, k = same & ~total[bit], k - n
    return found


def block_top_k(
    keys: np.ndarray,
    ints: np.ndarray,
    maps: np.ndarray,
    drop: int,
    norm: float,
    own: int,
    query: np.ndarray,
    k: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(keys, scores) of the k best rows of a block for one query, leaving out rows of its key.

    ``norm`` is the greatest length of a row's kept bits. With u the kept bits of a row, r its
    dropped ones, and the query its coarse part times 2^shift plus a rest, the score is the total
    times 2^(shift + drop), plus query times r (bounded by its signs), plus rest times u times
    2^drop (bounded by their lengths). Rows that these bounds could lift to the k-th are scored.
    """
    size = int(np.abs(query).max(initial=0)).bit_length()
    shift = max(0, size - QUERY_BITS)
    coarse = (query + (1 << shift >> 1)) >> shift
    rest = query - (coarse << shift)
    bits = np.zeros(maps.shape[2] * 64, np.uint8)
    bits[: len(keys)] = keys != own
    among = np.packbits(bits, bitorder="little").view("<u8")
    total = add_slices(maps, coarse)
    kth = kth_largest(total, k, among) if total else None
    if kth is not None:
        dropped = int(np.abs(query).sum()) * ((1 << drop) - 1)
        length = math.ceil(math.sqrt(float((rest * rest).sum())) * norm) + 1 if rest.any() else 0
        slack = -(-(dropped + (2 * length << drop)) // (1 << shift + drop))
        among = at_least(total, kth - slack, among)
    rows = np.flatnonzero(np.unpackbits(among.view(np.uint8), bitorder="little"))
    scores = ints[rows].astype(np.int64) @ query
    best = np.lexsort((keys[rows], -scores))[:k]
    return keys[rows][best], scores[best]


def plain_top_k(
    keys: np.ndarray, ints: np.ndarray, own: int, query: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """``block_top_k`` by scoring every row, where components are too large for slices."""
    scores = ints.astype(object).dot(query.astype(object))
    scores = np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in scores], np.int64)
    rows = np.flatnonzero(keys != own)
    best = rows[sorted(range(len(rows)), key=lambda i: (-int(scores[rows[i]]), keys[rows[i]]))[:k]]
    return keys[best], scores[best]


def top_k(
    vectors: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, key, score): the k best rows of each query, ties to the smaller key.

    ``queries`` is a condition on ``vectors``; its rows are held against all rows, block by block:
    both sides are dealt into groups of a few blocks, and each group of rows meets each of queries.
    Vectors that are null or hold a null or non-finite component take no part, on either side, and
    neither do rows without a key. Only vectors of one length meet; empty ones score 0 with each
    other. Components of any size are scored exactly; a score beyond 64 bits counts as the nearest
    that they hold. Keys are integers. Rows with a query's key are its own and no
    candidates of it; of repeated query rows the one of least vector asks. Fewer than k candidates
    are all returned; no rows give none.
    """
    vectors = vectors.where(F.col(key).isNotNull())
    index = build_index(vectors, key, vector)
    asked = vectors.where(queries).select(F.col(key).alias(key), F.col(vector).alias(vector))
    single = usable(asked, key, vector).groupBy("key").agg(F.min("ints").alias("ints"))
    asked = materialize(_blocks(single, QUERY_ROWS), "queries")
    n, m = max(1, -(-index.count() // ROW_BLOCKS)), max(1, -(-asked.count() // QUERY_BLOCKS))
    # Of one type, as both sides are dealt out by the digest of their numbers.
    dealt = lambda among: F.pmod(F.xxhash64("block"), F.lit(among)).cast("int")
    every = lambda among: F.explode(F.sequence(F.lit(0), F.lit(among - 1)).cast("array<int>"))
    # The work of a group is far more than its bytes say, so each may have a task of its own.
    apart = lambda side: side.repartition(min(n * m, MOST_TASKS), "rows", "asked")
    left = apart(index.withColumns({"rows": dealt(n), "asked": every(m)}))
    right = apart(asked.withColumns({"asked": dealt(m), "rows": every(n)}))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "key": [], "score": []}
        asking = [(np.frombuffer(a["keys"], np.int64), _numbers(a), a) for a in right.to_pylist()]
        for row in left.to_pylist():
            keys, ints = np.frombuffer(row["keys"], np.int64), _numbers(row)
            if not row["large"]:
                maps = np.frombuffer(row["maps"], np.uint64).reshape(row["width"], SLICES, -(-len(keys) // 64))
                kept = (ints >> row["drop"]).astype(np.float64)
                norm = math.sqrt(float((kept * kept).sum(axis=1).max(initial=0.0)))
            for own, queries, ask in asking:
                if ask["width"] != row["width"]:
                    continue
                for mine, query in zip(own, queries):
                    if row["large"] or ask["large"]:
                        found, scores = plain_top_k(keys, ints, mine, query, k)
                    else:
                        found, scores = block_top_k(
                            keys, ints, maps, row["drop"], norm, mine, query.astype(np.int64), k
                        )
                    out["query_id"].append(np.full(len(found), mine))
                    out["key"].append(found)
                    out["score"].append(scores)
        return pa.table({c: np.concatenate([np.zeros(0, np.int64), *v]) for c, v in out.items()})

    pairs = left.groupBy("rows", "asked").cogroup(right.groupBy("rows", "asked"))
    found = pairs.applyInArrow(search, "query_id long, key long, score long")
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "key"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("key").alias(key), "score"
    )
