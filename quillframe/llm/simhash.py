"""Near-duplicate documents by SimHash and anchor-point covering.

A covering code over a block of bits has a codeword (an anchor) within its covering radius of every
value. Of two fingerprints that differ in at most ``t`` bits, one of ``m`` blocks differs in at most
``t // m``. In that block the home anchor of the one, which lies within the covering radius of it,
lies within covering radius plus ``t // m`` of the other. So each fingerprint is sent to its home
anchor and to every anchor within that larger distance, and comparing homes with all that came to
an anchor finds every link.

The code is the Hamming code of 15 bits with the block's other bits left free (covering radius 1).
With three blocks of 21 or 22 bits there are some 2^18 anchors a block and 16 copies a fingerprint
and block. Two blocks give more anchors and more copies, for far more fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.llm.graph import components, forest
from quillframe.llm.rows import identified, numbered, without
from quillframe.sources.artifacts import materialize

SEED = 42
CODE_BITS = 15  # length of the Hamming code
RADIUS = 1  # its covering radius
SALTS = 4  # an anchor's members are dealt over so many tasks
WORDS_AT_ONCE = 1 << 16
PAIRS_AT_ONCE = 1 << 22


def simhash(text: bytes, shingle: int = 4) -> int:
    """Unsigned 64-bit fingerprint of a text: bits set in over half the shingles' hashes.

    A-Z count as lower case and words end at ASCII white space. Fewer words than a shingle holds
    make one shingle; no words give 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, WORDS_AT_ONCE):
        part = words[at : at + WORDS_AT_ONCE + shingle - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(shingle))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(uid, key, fp long) for each row; a null text counts as empty."""
    return _fingerprints(identified(docs), shingle, text, key)


def _fingerprints(rows: DataFrame, shingle: int, text: str, key: str) -> DataFrame:
    """``fingerprints`` of rows (uid, row)."""
    rows = rows.select("uid", F.col("row")[key].alias("key"), F.col("row")[text].alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(2).cast(pa.binary()), b"")
            found = np.fromiter((simhash(x.as_py(), shingle) for x in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                names=["uid", "key", "fp"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    number = rows.schema["uid"].dataType.simpleString()
    return rows.mapInArrow(hashed, f"uid {number}, key {kind}, fp long")


def _blocks(m: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of ``m`` blocks of 64 bits."""
    if not 2 <= m <= 64 // CODE_BITS:
        raise ValueError(f"2 to {64 // CODE_BITS} blocks hold a code of {CODE_BITS} bits")
    cuts = [64 * i // m for i in range(m + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def _syndrome(values: np.ndarray) -> np.ndarray:
    """Which of the 15 code bits to turn for the nearest codeword (1-15), or 0."""
    out = np.zeros(len(values), np.uint64)
    for bit in range(CODE_BITS):
        out ^= ((values >> np.uint64(bit)) & np.uint64(1)) * np.uint64(bit + 1)
    return out


def _turns(width: int, distance: int) -> list[np.ndarray]:
    """For each syndrome the masks of at most ``distance`` bits that lead to a codeword."""
    masks = np.array(
        [
            sum(1 << b for b in bits)
            for n in range(distance + 1)
            for bits in combinations(range(width), n)
        ],
        np.uint64,
    )
    led = _syndrome(masks)
    return [masks[led == s] for s in range(CODE_BITS + 1)]


def _cells(fps: np.ndarray, bits: int, blocks: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(cell, fp, home) of every copy of the fingerprints."""
    salt = (fps ^ (fps >> np.uint64(31))) % np.uint64(SALTS)
    for k, (low, width) in enumerate(_blocks(blocks)):
        value = (fps >> np.uint64(low)) & np.uint64((1 << width) - 1)
        syndrome = _syndrome(value)
        turns = _turns(width, RADIUS + bits // blocks)
        numbered = (lambda top: lambda anchor: (top | anchor) * np.uint64(SALTS))(np.uint64(k << 40))
        home = value ^ np.where(
            syndrome > 0, np.uint64(1) << (np.maximum(syndrome, 1) - np.uint64(1)), np.uint64(0)
        )
        for s in range(SALTS):
            yield numbered(home) + np.uint64(s), fps, np.ones(len(fps), bool)
        for s in range(CODE_BITS + 1):
            own = np.flatnonzero(syndrome == s)
            near = (value[own][:, None] ^ turns[s][None, :]).ravel()
            times = len(turns[s])
            yield (
                numbered(near) + np.repeat(salt[own], times),
                np.repeat(fps[own], times),
                np.zeros(len(near), bool),
            )


def _links_in(cell: np.ndarray, fp: np.ndarray, home: np.ndarray, bits: int) -> tuple:
    """A forest of the links between homes and members of each cell; rows sorted by cell."""
    members, homes = np.flatnonzero(~home), np.flatnonzero(home)
    first = np.searchsorted(cell[members], cell[homes], "left")
    count = np.searchsorted(cell[members], cell[homes], "right") - first
    a, b = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    total = np.cumsum(count)
    at = 0
    while at < len(homes):
        done = total[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(total, done + PAIRS_AT_ONCE, "right")))
        n = count[at:upto]
        one = np.repeat(fp[homes[at:upto]], n)
        steps = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        other = fp[members[np.repeat(first[at:upto], n) + steps]]
        apart = np.bitwise_count(one ^ other)
        near = (apart <= bits) & (apart > 0)
        if near.any():
            a, b = forest(np.concatenate([a, one[near]]), np.concatenate([b, other[near]]))
        at = upto
    return a, b


def links(distinct: DataFrame, bits: int, blocks: int) -> DataFrame:
    """(a, b) between fingerprints at most ``bits`` apart: enough of them to connect what is linked.

    ``distinct`` has one row per fingerprint (fp). Links inside an anchor are thinned to a forest
    where they are found, so a large group gives no more links than members.
    """

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 4096):
                for cell, fp, home in _cells(fps[at : at + 4096], bits, blocks):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(home)],
                        names=["cell", "fp", "home"],
                    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def link(parts):
            a, b = _links_in(*map(np.concatenate, zip(*parts)), bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

        for batch in batches:
            cell, fp, home = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(cell):
                continue
            fp = fp.view(np.uint64)
            start = int(np.searchsorted(cell, cell[-1], "left"))  # of the last cell, still open
            if start or (held and held[-1][0][-1] != cell[0]):
                held.append((cell[:start], fp[:start], home[:start]))
                yield link(held)
                held = []
            held.append((cell[start:], fp[start:], home[start:]))
        if held:
            yield link(held)

    spread = distinct.select("fp").mapInArrow(copied, "cell long, fp long, home boolean")
    together = spread.repartition("cell").sortWithinPartitions("cell")
    return together.mapInArrow(compared, "a long, b long")


def near_groups(
    docs: DataFrame,
    shingle: int = 4,
    bits: int = 4,
    blocks: int = 3,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """(uid, key, fp, component, first): the group of each row of ``docs``.

    Rows whose fingerprints differ in at most ``bits`` bits are linked, and so are rows reachable
    over such links. ``component`` is the least key of the group (null if all its keys are null),
    ``first`` the uid of the row of that key (the least of equal ones). A null or empty text has
    fingerprint 0, linked like any other; an empty table gives an empty one.
    """
    return _groups(identified(docs), shingle, bits, blocks, text, key)


def _groups(
    rows: DataFrame, shingle: int = 4, bits: int = 4, blocks: int = 3, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``near_groups`` for rows (uid, row)."""
    prints = materialize(_fingerprints(rows, shingle, text, key), "fingerprints")
    lowest = F.min(F.struct(F.col("key").isNull(), "key", "uid"))
    distinct = materialize(prints.groupBy("fp").agg(lowest.alias("low")), "distinct")
    roots = components(links(distinct, bits, blocks))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "low"
    )
    rooted = materialize(rooted, "rooted")
    groups = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("low").alias("_low"))
    # Written, so that the join has nothing but exchanges below it and splits a hot group.
    groups = materialize(groups, "groups")
    named = rooted.join(groups, F.col("root") == F.col("_root")).select(
        F.col("fp").alias("_fp"),
        F.col("_low.key").alias("component"),
        F.col("_low.uid").alias("first"),
    )
    return prints.join(named, F.col("fp") == F.col("_fp")).drop("_fp")


def fingerprint_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, at_rest: bool = False, **options) -> DataFrame:
    """``docs`` with one row of each group of ``near_groups``: that of the least key.

    Null and empty texts are one group, linked like any other; of rows with equal keys one stays. An
    empty table gives an empty one; column names of ``docs`` may be any. Rows are written once with
    their numbers, so that the second reading drops the rows that the first chose; not if they are
    ``at_rest`` (``rows.numbered``).
    """
    rows = numbered(docs, at_rest=at_rest)
    groups = _groups(rows, **options)
    return without(rows, groups.where(F.col("uid") != F.col("first"))).select("row.*")
