"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

A genome is a packing: a list of bins of items. Crossover injects whole well-filled bins of one
parent into another, removes the bins of the other that hold the same items, and places what they
held besides by best fit. Items are dealt into shards of a bounded size; each shard is evolved by a
few islands of small populations, whose elites move to the next island after every epoch. The bins
of a shard that are far from full are opened again and packed in a later level, where items of many
shards meet, until all that is left fits one shard. A shard has many sequences' worth of items, so
that every level closes most of what it packs, however short the items are.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.rows import identified
from quillframe.llm.token_files import crc32s, with_end
from quillframe.llm.tokens import encode_batch
from quillframe.sources.artifacts import materialize

ITEMS = 2_000  # mean items of a shard, more where they fill fewer than SEQUENCES
SEQUENCES = 32  # least mean total length of a shard, in sequences
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 4
POPULATION = 4
REOPENED = 0.03  # share of a shard's bins that a later level packs again


def best_fit(bins: list[list[int]], items: list[int], size: np.ndarray, room: int) -> list[list[int]]:
    """Add items, largest first, each to the fullest bin that still holds it."""
    bins = [list(b) for b in bins]
    free = sorted((room - int(size[b].sum()), i) for i, b in enumerate(bins))
    for item in sorted(items, key=lambda x: (-size[x], x)):
        need = int(size[item])
        at = bisect_left(free, (need, -1))
        if at == len(free):
            left, place = room, len(bins)
            bins.append([])
        else:
            left, place = free.pop(at)
        bins[place].append(item)
        insort(free, (left - need, place))
    return bins


def fitness(bins: list[list[int]], size: np.ndarray, room: int) -> tuple[int, float]:
    """Fewer bins first; of equally many, those whose fill is more uneven."""
    return -len(bins), float(sum((size[b].sum() / room) ** 2 for b in bins))


def crossover(
    one: list[list[int]], other: list[list[int]], size: np.ndarray, room: int, rng: np.random.Generator
) -> list[list[int]]:
    """Whole well-filled bins of ``other`` in ``one``, displaced items placed by best fit."""
    fill = np.array([size[b].sum() for b in other])
    full = np.argsort(-fill, kind="stable")[: max(1, len(other) // 2)]
    chosen = full[rng.random(len(full)) < 0.5]
    injected = [other[i] for i in chosen]
    taken = {x for b in injected for x in b}
    kept, displaced = [], []
    for b in one:
        if taken.isdisjoint(b):
            kept.append(b)
        else:
            displaced += [x for x in b if x not in taken]
    return best_fit(injected + kept, displaced, size, room)


def mutate(
    bins: list[list[int]], size: np.ndarray, room: int, rng: np.random.Generator
) -> list[list[int]]:
    """Open some of the emptiest bins and a few others, and place their items by best fit."""
    fill = np.array([size[b].sum() for b in bins])
    n = max(2, len(bins) // 20)
    opened = {*np.argsort(fill, kind="stable")[:n].tolist(), *rng.integers(len(bins), size=n).tolist()}
    loose = [x for i in sorted(opened) for x in bins[i]]
    return best_fit([b for i, b in enumerate(bins) if i not in opened], loose, size, room)


def evolve(
    size: np.ndarray, room: int, migrants: list[list[list[int]]], seed: list[int]
) -> list[list[int]]:
    """The best packing of an island after an epoch.

    The first genome is best fit of items by falling size, others of items in random order, and
    ``migrants`` join them. It ends early at the least number of bins there can be.
    """
    rng = np.random.default_rng(seed)
    least = -(-int(size.sum()) // room)
    score = lambda bins: fitness(bins, size, room)
    everyone = [*migrants, best_fit([], list(range(len(size))), size, room)]
    while len(everyone) < POPULATION:
        everyone.append(mutate(everyone[-1], size, room, rng))
    everyone.sort(key=score, reverse=True)
    for _ in range(GENERATIONS):
        if len(everyone[0]) <= least:
            break
        parents = everyone[: max(2, POPULATION // 2)]
        children = []
        for _ in range(POPULATION):
            one, other = rng.choice(len(parents), 2, replace=False)
            child = crossover(parents[one], parents[other], size, room, rng)
            children.append(mutate(child, size, room, rng))
        everyone = sorted(parents + children, key=score, reverse=True)[:POPULATION]
    return everyone[0]


def _bins(genome: bytes) -> list[list[int]]:
    """A packing from the bin number of each item."""
    number = np.frombuffer(genome, "<i4")
    order = np.argsort(number, kind="stable")
    cuts = np.flatnonzero(np.diff(number[order])) + 1
    return [part.tolist() for part in np.split(order, cuts)] if len(order) else []


def _genome(bins: list[list[int]], n: int) -> bytes:
    number = np.zeros(n, "<i4")
    for i, b in enumerate(bins):
        number[b] = i
    return number.tobytes()


def _evolved(state: DataFrame, room: int, epoch: int) -> DataFrame:
    """Each island's elite after one more epoch; (shard, island, items, sizes, elite, migrant)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            elites = []
            for row in batch.itertuples():
                size = np.frombuffer(row.sizes, "<i4").astype(np.int64)
                found = [_bins(g) for g in (row.elite, row.migrant) if g is not None]
                best = evolve(size, room, found, [epoch, int(row.shard), int(row.island)])
                elites.append(_genome(best, len(size)))
            yield batch.assign(elite=elites, migrant=None)

    return state.mapInPandas(run, state.schema)


def shards_of(n: int, total: int, room: int) -> int:
    """Shards for ``n`` items of ``total`` length: of ``ITEMS`` items, but ``SEQUENCES`` at least."""
    return max(1, min(math.ceil(n / ITEMS), total // (SEQUENCES * room)))


def _level(items: DataFrame, shards: int, room: int, level: int, path: str) -> DataFrame:
    """Pack one level: (item, length, bin, offset), with a null bin for what is to be packed again.

    A single shard closes all its bins. Of several, each opens its emptiest bins again: at most half
    of its length if it has two bins or more, and at most one sequence if it has one. So no more
    than 1 / 2 + 1 / ``SEQUENCES`` of the length is left, and levels stay far below 63.
    """
    last = shards == 1
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(shards)))

    def gather(group: pa.Table) -> pa.Table:
        group = group.sort_by("item")
        size = group["length"].to_numpy().astype("<i4")
        return pa.table(
            {
                "shard": pa.array([group["shard"][0].as_py()] * ISLANDS, pa.int64()),
                "island": pa.array(range(ISLANDS), pa.int64()),
                "items": pa.array([group["item"].to_numpy().tobytes()] * ISLANDS, pa.binary()),
                "sizes": pa.array([size.tobytes()] * ISLANDS, pa.binary()),
                "elite": pa.array([None] * ISLANDS, pa.binary()),
                "migrant": pa.array([None] * ISLANDS, pa.binary()),
            }
        )

    schema = "shard long, island long, items binary, sizes binary, elite binary, migrant binary"
    state = dealt.groupBy("shard").applyInArrow(gather, schema).repartition("shard", "island")
    for epoch in range(EPOCHS):
        state = materialize(_evolved(state, room, epoch), f"epoch{epoch}")
        if epoch + 1 < EPOCHS:
            leaving = state.select(
                F.col("shard").alias("_shard"),
                ((F.col("island") + 1) % ISLANDS).alias("_island"),
                F.col("elite").alias("_elite"),
            )
            here = (F.col("shard") == F.col("_shard")) & (F.col("island") == F.col("_island"))
            state = state.join(leaving, here).select(
                "shard", "island", "items", "sizes", "elite", F.col("_elite").alias("migrant")
            )

    def settle(group: pa.Table) -> pa.Table:
        group = group.sort_by("island")
        size = np.frombuffer(group["sizes"][0].as_py(), "<i4").astype(np.int64)
        item = np.frombuffer(group["items"][0].as_py(), np.int64)
        packings = [_bins(g.as_py()) for g in group["elite"]]
        best = max(packings, key=lambda bins: fitness(bins, size, room))
        best.sort(key=lambda b: -int(size[b].sum()))
        closed = len(best) if last else len(best) - max(1, math.ceil(len(best) * REOPENED))
        bins = np.full(len(size), -1, np.int64)
        offset = np.zeros(len(size), np.int64)
        shard = group["shard"][0].as_py()
        for i, b in enumerate(best[:closed]):
            bins[b] = ((shard << 20) + i << 6) + level + 1
            offset[b] = np.cumsum(size[b]) - size[b]
        return pa.table(
            {
                "item": item,
                "length": size,
                "bin": pa.array(bins, mask=bins < 0),
                "offset": offset,
            }
        )

    done = state.groupBy("shard").applyInArrow(settle, "item long, length long, bin long, offset long")
    return materialize(done, path)


def pack(items: DataFrame, room: int) -> DataFrame:
    """(item, bin, offset) for each (item long, length long): few bins of at most ``room``.

    Items are unique and no longer than ``room``. Bin numbers are any longs. Items of a full
    length, and empty ones, have no choice: each of the full has a bin of its own.
    """
    whole = items.where(F.col("length") >= room).select(
        "item", (F.col("item") * 64).alias("bin"), F.lit(0).cast("long").alias("offset")
    )
    left = materialize(items.where(F.col("length") < room).select("item", "length"), "items")
    packed = whole
    level = 0
    while (sizes := left.agg(F.count("*"), F.sum("length")).first())[0]:
        done = _level(left, shards_of(*sizes, room), room, level, f"level{level}")
        packed = packed.unionByName(done.where("bin is not null").select("item", "bin", "offset"))
        left = done.where("bin is null").select("item", "length")
        level += 1
    return packed


def pieces(
    docs: DataFrame, tokenizer: str, room: int, end_id: int, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(item, key, piece, start, length, ids_crc32): documents, the long ones cut at ``room``."""
    rows = identified(docs).select(F.col("row")[key].alias("key"), F.col("row")[text].alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ids = with_end(*encode_batch(tokenizer, batch.column(1)), end_id)
            times = -(-lengths // room)
            row = np.repeat(np.arange(len(lengths)), times)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            length = np.minimum(lengths[row] - piece * room, room)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(piece * room),
                    pa.array(length),
                    pa.array(crc32s(length, ids)),
                ],
                names=["key", "piece", "start", "length", "ids_crc32"],
            )

    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long"
    # Numbers are written with the pieces: another scan could be split in another way.
    numbered = rows.mapInArrow(cut, schema).select(F.monotonically_increasing_id().alias("item"), "*")
    return materialize(numbered, "pieces")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    room: int = 2048,
    end_id: int = 0,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) of every piece of ``docs``.

    A document is its ids and ``end_id``; one longer than ``room`` is cut into pieces of ``room``
    ids, the last of which may be shorter. Pieces of a sequence follow each other without gaps. A
    null or empty text is ``end_id`` alone; repeated rows are packed as often as they come.
    """
    cut = pieces(docs, tokenizer, room, end_id, text, key)
    placed = pack(cut.select("item", "length"), room).withColumnRenamed("item", "_item")
    return cut.join(placed, F.col("item") == F.col("_item")).select(
        "key", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset"
    )
