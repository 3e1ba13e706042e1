"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Words and pairs of neighbouring words are counted over all training texts. The count of a pair is kept
as its quantised logarithm q: the pair is put into a Bloom filter with each of the numbers 1 to q. To
read it, one probes 1, 2, ... until a probe fails; a false positive makes a count too large by a step,
with a small known chance. The filter is cut into segments by the pair's hash, so its parts are built
in parallel; it grows with the corpus, some 18 bits for each step of each distinct pair. Words are
counted exactly beside it.

A word's probability after another is a mixture of two parts. The pair's share is the least count of
its step over what follows the word before: that word's exact count, and room for the false positives
that all words of the vocabulary may give together. The other part is the word's own share with one
added to each count. So the probabilities of all words after one word, an unknown one among them, add
up to 1 at most, but for two rare cases: more false positives than there is room for, and a frequent
pair whose count the filter gives a step too high (one in some 4,000 pairs), where the least counts of
the other pairs leave less free than that step adds.

Workers probe the whole filter by broadcast as long as it is below a stated size. A larger one stays
in segments, and the n-grams of the texts are brought to them by shuffle: the same probes, the same
answers. Texts are packed in pieces for that. A piece asks for each of its n-grams once, the answers
come back in the order asked, without the n-grams, and meet the piece's text; only a part of the pieces
is on the way at a time.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, SparkContext, TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillframe.llm.rows import balanced, cut_at_space, flat, identified, words_of
from quillframe.sources.artifacts import brief_shuffles, materialize, shared_path

PROBES = 12
BITS_PER_ENTRY = 18  # above PROBES / ln 2: under half the bits are set, one false answer in 4,096
SEGMENT_BYTES = 8 << 20  # of training text for each segment
SLICE_BYTES = 2 << 20
PROBED_AT_ONCE = 1 << 18
HELD_GRAMS = 1 << 20  # pairs a task counts before it sends them on
BROADCAST_BYTES = 256 << 20
PART_BYTES = 16 << 20  # of a broadcast
PIECE_BYTES = 8 << 20  # of text that asks for its n-grams together
TURNS = 8  # in which pieces are scored by shuffle, and the text that a turn has at least
TURN_BYTES = 256 << 20
MIX = 0.7  # weight of the pair's share in a probability, the rest is the word's own

_END = np.uint64(xxhash.xxh64_intdigest(b"\n", 1))  # no word holds white space
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys."""
    x = x ^ (x >> np.uint64(31))
    x = x * _ODD
    return x ^ (x >> np.uint64(29))


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(first * np.uint64(3) + _mixed(second))


def word_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, key) of every token in order; each text ends with one end token.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; their key is a 64-bit digest.
    """
    rows, codes, words = words_of(pc.ascii_lower(texts))
    digests = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(texts)
    count = np.bincount(rows, minlength=n)
    ends = np.cumsum(count + 1) - 1
    keys = np.empty(len(rows) + n, np.uint64)
    inside = np.ones(len(keys), bool)
    inside[ends] = False
    keys[ends] = _END
    keys[inside] = digests[codes]
    return np.repeat(np.arange(n), count + 1), keys


def token_runs(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, key, key before) of the tokens of whole texts, a slice at a time.

    A text begins after an end. The parts of a text longer than a slice follow on each other: only
    the last of them ends.
    """
    waiting = None
    last = (-1, _END)
    for item in [*balanced(texts, SLICE_BYTES, cut_at_space), None]:
        if waiting is not None:
            numbers, part = waiting
            rows, keys = word_keys(part)
            before = np.concatenate([[_END], keys[:-1]]).astype(np.uint64)
            before[np.concatenate([[True], rows[1:] != rows[:-1]])] = _END
            if numbers[0] == last[0]:
                before[0] = last[1]
            if item is not None and item[0][0] == numbers[-1]:
                rows, keys, before, final = rows[:-1], keys[:-1], before[:-1], before[-1]
                last = (numbers[-1], final)
            yield numbers[rows], keys, before
        waiting = item


def quantised(counts: np.ndarray) -> np.ndarray:
    """1 for a count of 1, 2 for 2 and 3, 3 for 4 to 7, and so on."""
    return np.frexp(counts.astype(np.float64))[1]


def restored(q: np.ndarray) -> np.ndarray:
    """The least of the counts that share a quantised one; 0 stays 0."""
    return np.where(q > 0, 2.0 ** (q.astype(np.float64) - 1), 0.0)


def room(distinct: int) -> float:
    """What false positives may add to the counts of all pairs that begin with one word.

    Each word of the vocabulary gives one with a chance of ``2 ** -PROBES`` at most; their number is
    near a Poisson one, so five deviations and one more leave about one word in a million beyond.
    """
    mean = distinct / 2**PROBES
    return mean + 5 * math.sqrt(mean) + 1


def _seeds(keys: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of (key, level), from which its places follow."""
    one = _mixed(_mixed(keys + level.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)))
    return one, _mixed(one + _ODD) | np.uint64(1)


def _place(one: np.ndarray, two: np.ndarray, i: int, bits: np.ndarray) -> np.ndarray:
    """The ``i``-th probed bit in filters of ``bits`` bits each; the cube keeps places apart."""
    return (one + np.uint64(i) * two + np.uint64((i**3 - i) // 6)) % bits


def build_segment(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, int]:
    """The filter of one segment's n-grams, and its size in bits."""
    q = quantised(counts)
    bits = max(64, int(q.sum()) * BITS_PER_ENTRY)
    flags = np.zeros(-(-bits // 8) * 8, bool)
    for level in range(1, int(q.max(initial=0)) + 1):
        some = keys[q >= level]
        size = np.full(len(some), bits, np.uint64)
        one, two = _seeds(some, np.full(len(some), level))
        for i in range(PROBES):
            flags[_place(one, two, i, size).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes(), bits


class Filter:
    """Some or all segments of the filter, side by side; memory is that of the segments given."""

    def __init__(self, segments: int, parts: dict[int, tuple[bytes, int]]) -> None:
        self.segments = np.uint64(segments)
        held = sorted(parts.items())
        # The last place stands for segments without n-grams: its bits are all zeros.
        self.ids = np.array([segment for segment, _ in held], np.int64)
        self.bits = np.array([*(bits for _, (_, bits) in held), 64], np.uint64)
        sizes = [len(data) for _, (data, _) in held]
        self.start = np.cumsum([0, *sizes], dtype=np.int64)
        self.raw = np.frombuffer(b"".join([*(data for _, (data, _) in held), bytes(8)]), np.uint8)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        segment = (keys % self.segments).astype(np.int64)
        at = np.searchsorted(self.ids, segment)
        found = np.append(self.ids, -1)[at] == segment
        return np.where(found, at, len(self.ids))

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """Quantised count of each key, 0 if it is not there."""
        parts = range(0, len(keys), PROBED_AT_ONCE)
        found = [self._probe(keys[at : at + PROBED_AT_ONCE]) for at in parts]
        return np.concatenate([np.zeros(0, np.int8), *found])

    def _probe(self, keys: np.ndarray) -> np.ndarray:
        home = self._home(keys)
        out = np.zeros(len(keys), np.int8)
        left = np.arange(len(keys))
        level = 1
        while len(left):
            bits, start = self.bits[home[left]], self.start[home[left]]
            one, two = _seeds(keys[left], np.full(len(left), level))
            for i in range(PROBES):
                place = _place(one, two, i, bits)
                byte = self.raw[start + (place >> np.uint64(3)).astype(np.int64)]
                hit = (byte >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                if not hit.all():  # most absent keys leave at the first probes
                    one, two, bits, start, left = (x[hit] for x in (one, two, bits, start, left))
            out[left] = level
            level += 1
        return out


@dataclass
class LanguageModel:
    """Exact word counts and the filter's segments, as tables, with what scoring needs to know.

    ``tables`` holds (segment, keys, counts, filter, bits), one row for each segment that holds any:
    its words with their counts, and its part of the filter of pairs; ``total`` counts training tokens,
    ``distinct`` the different ones.
    """

    tables: DataFrame
    segments: int
    total: int
    distinct: int
    bytes: int


def _dealt(
    sets: list[np.ndarray], segments: int
) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The segments that hold any key of some sets, few of a large corpus's, and for each set its
    order by segment and where the next segments begin in it."""
    homes = [(keys % np.uint64(segments)).astype(np.int64) for keys in sets]
    filled = np.unique(np.concatenate(homes))
    orders = [np.argsort(home, kind="stable") for home in homes]
    cuts = [np.searchsorted(home[order], filled[1:]) for home, order in zip(homes, orders)]
    return filled, list(zip(orders, cuts))


def _counted(texts: DataFrame, segments: int) -> DataFrame:
    """(segment, words, word_counts, pairs, pair_counts): what each task has counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], []]

        def sent() -> pa.RecordBatch:
            counted = [np.unique(np.concatenate(p), return_counts=True) for p in held]
            filled, dealt = _dealt([keys for keys, _ in counted], segments)
            columns = [pa.array(filled.astype(np.int32))]
            for (keys, counts), (order, cuts) in zip(counted, dealt, strict=True):
                for values in (keys.astype("<u8"), counts.astype("<u4")):
                    split = np.split(values[order], cuts)
                    columns.append(pa.array([x.tobytes() for x in split], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for _, keys, before in token_runs(batch.column(0)):
                held[0].append(keys)
                held[1].append(pair_keys(before, keys))
                if sum(map(len, held[0])) >= HELD_GRAMS:
                    yield sent()
                    held = [[], []]
        if held[0]:
            yield sent()

    names = ["segment", "words", "word_counts", "pairs", "pair_counts"]
    schema = "segment int, words binary, word_counts binary, pairs binary, pair_counts binary"
    return texts.mapInArrow(run, schema)


def _merged(keys: pa.ChunkedArray, counts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    key = np.concatenate([np.frombuffer(x.as_py(), "<u8") for x in keys])
    count = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in counts])
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order].astype(np.int64)
    if not len(key):
        return key, count
    starts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
    return key[starts], np.add.reduceat(count, starts)


def train(texts: DataFrame, text: str = "text") -> LanguageModel:
    """Count the words and pairs of all ``texts`` and build the filter; null texts count as empty.

    What a task has counted goes to the segments as packed arrays, already one entry for each of its
    n-grams, so a word that is in every text is one entry per task. The tables are written to the
    shared folder, and the driver sees their sums only.
    """
    plain = texts.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    segments = max(1, -(-size // SEGMENT_BYTES))

    def build(group: pa.Table) -> pa.Table:
        words, word_counts = _merged(group["words"], group["word_counts"])
        pairs, pair_counts = _merged(group["pairs"], group["pair_counts"])
        data, bits = build_segment(pairs, pair_counts)
        return pa.table(
            {
                "segment": group["segment"][:1],
                "keys": pa.array([words.tobytes()], pa.binary()),
                "counts": pa.array([word_counts.tobytes()], pa.binary()),
                "filter": pa.array([data], pa.binary()),
                "bits": pa.array([bits], pa.int64()),
                "total": pa.array([int(word_counts.sum())], pa.int64()),
                "distinct": pa.array([len(words)], pa.int64()),
            }
        )

    schema = (
        "segment int, keys binary, counts binary, filter binary, bits long, total long, distinct long"
    )
    counted = _counted(plain, segments)
    with brief_shuffles(texts.sparkSession):
        built = materialize(counted.groupBy("segment").applyInArrow(build, schema), "model")
    sums = built.agg(
        F.sum("total"),
        F.sum("distinct"),
        F.sum(F.octet_length("keys") + F.octet_length("counts") + F.octet_length("filter")),
    ).first()
    return LanguageModel(
        built.select("segment", "keys", "counts", "filter", "bits"),
        segments,
        sums[0] or 0,
        sums[1] or 0,
        sums[2] or 0,
    )


class WordCounts:
    """Exact counts of some or all words."""

    def __init__(self, parts: list[tuple[bytes, bytes]]) -> None:
        keys = np.frombuffer(b"".join(k for k, _ in parts), "<u8")
        counts = np.frombuffer(b"".join(c for _, c in parts), "<i8")
        order = np.argsort(keys)
        narrow = np.uint32 if counts.max(initial=0) < 2**32 else np.int64
        self.keys, self.counts = keys[order], counts.astype(narrow)[order]

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0).astype(np.int64)


def probabilities(
    own: np.ndarray, before: np.ndarray, pair: np.ndarray, total: int, distinct: int
) -> np.ndarray:
    """Each token's probability after the token before it.

    ``own`` and ``before`` are the exact counts of both, ``pair`` the filter's quantised count of
    the two together. A pair comes no oftener than either word, which bounds a false answer. After
    an unknown word the word's own share is all.
    """
    alone = (own + 1) / (total + distinct + 1)
    seen = np.minimum(restored(pair), np.minimum(own, before))
    mixed = MIX * seen / (before + room(distinct)) + (1 - MIX) * alone
    return np.where(before > 0, mixed, alone)


def _scores(
    rows: np.ndarray, n: int, own: np.ndarray, before: np.ndarray, pair: np.ndarray, total: int, distinct: int
) -> list[np.ndarray]:
    """(n_tokens, n_known, base_score, score) of ``n`` texts from what was found for each token."""
    alone = (own + 1) / (total + distinct + 1)
    return [
        np.bincount(rows, minlength=n),
        np.bincount(rows, own > 0, n).astype(np.int64),
        np.bincount(rows, np.log10(alone), n),
        np.bincount(rows, np.log10(probabilities(own, before, pair, total, distinct)), n),
    ]


RESULT = "n_tokens long, n_known long, base_score double, score double"


class Shared:
    """The whole model on a worker: broadcasts of (counts, filter), each of some whole segments."""

    def __init__(self, segments: int) -> None:
        self.segments = np.uint64(segments)
        self.home = np.full(segments, -1, np.int32)  # which broadcast holds a segment
        self.parts: list[Broadcast] = []

    def add(self, context: SparkContext, rows: list[Row]) -> None:
        counts = WordCounts([(row["keys"], row["counts"]) for row in rows])
        parts = {row["segment"]: (row["filter"], row["bits"]) for row in rows}
        self.home[list(parts)] = len(self.parts)
        self.parts.append(context.broadcast((counts, Filter(int(self.segments), parts))))

    def _asked(self, keys: np.ndarray, which: int) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        home = self.home[(keys % self.segments).astype(np.int64)]
        for i, part in enumerate(self.parts):
            at = np.flatnonzero(home == i)
            held = part.value[which]
            out[at] = held.probe(keys[at]) if which else held.of(keys[at])
        return out

    def counts(self, keys: np.ndarray) -> np.ndarray:
        return self._asked(keys, 0)

    def probe(self, keys: np.ndarray) -> np.ndarray:
        return self._asked(keys, 1)


_last: WeakKeyDictionary[SparkContext, list[Broadcast]] = WeakKeyDictionary()


def _shared(model: LanguageModel) -> Shared:
    """Broadcast a model that was measured to be small, ``PART_BYTES`` at a time.

    Neither the driver nor an executor then holds a second copy of all of it on the way. Executors
    let go of the model of the call before; a frame that still needs it has it sent again.
    """
    context = model.tables.sparkSession.sparkContext
    for old in _last.pop(context, []):
        old.unpersist(blocking=True)
    shared = Shared(model.segments)
    waiting, size = [], 0
    for row in model.tables.toLocalIterator():
        waiting.append(row)
        size += sum(len(row[name]) for name in ("keys", "counts", "filter"))
        if size >= PART_BYTES:
            shared.add(context, waiting)
            waiting, size = [], 0
    if waiting:
        shared.add(context, waiting)
    _last[context] = shared.parts
    return shared


def _score_by_broadcast(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """(key, ...) for rows (key, text): every worker probes the whole filter."""
    shared = _shared(model)
    total, distinct = model.total, model.distinct
    key = rows.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.collect()  # a worker's last call leaves its function, and with it a model, in a cycle
        for batch in batches:
            n = batch.num_rows
            sums = [np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)]
            for row, keys, before in token_runs(batch.column(1)):
                known, back = np.unique(np.concatenate([keys, before]), return_inverse=True)
                count = shared.counts(known)[back]
                own, ahead = count[: len(keys)], count[len(keys) :]
                asked, back = np.unique(pair_keys(before, keys), return_inverse=True)
                pair = shared.probe(asked)[back]
                found = _scores(row, n, own, ahead, pair, total, distinct)
                for kept, value in zip(sums, found):
                    kept += value
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, sums)], names=[key, *names]
            )

    names = ["n_tokens", "n_known", "base_score", "score"]
    return rows.mapInArrow(run, f"{_field(rows)}, {RESULT}")


def _field(rows: DataFrame) -> str:
    return f"`{rows.columns[0]}` {rows.schema[0].dataType.simpleString()}"


def _pieces(rows: DataFrame) -> DataFrame:
    """Rows (uid, key, text) packed and written once: (piece, uids, keys, texts, start, ends, size, turn).

    A text longer than a piece is cut into several, which are alone in theirs. ``start`` is the key
    before the first token, and ``ends`` says whether the last text does.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            items = [*balanced(batch.column(2), PIECE_BYTES, cut_at_space)]
            start = _END
            for i, (numbers, texts) in enumerate(items):
                ends = i + 1 == len(items) or items[i + 1][0][0] != numbers[-1]
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([(task << 33) + made], pa.int64()),
                        *[one(batch.column(c).slice(numbers[0], len(numbers))) for c in (0, 1)],
                        one(texts),
                        pa.array(np.array([start], np.uint64).view(np.int64)),
                        pa.array([ends]),
                        pa.array([texts.nbytes], pa.int64()),
                        pa.array([(task + made) % TURNS], pa.int32()),
                    ],
                    names=schema.names,
                )
                made += 1
                words = [_END] if ends else word_keys(texts)[1][:-1]
                start = words[-1] if len(words) else start

    schema = T.StructType(
        [
            T.StructField("piece", T.LongType()),
            T.StructField("uids", T.ArrayType(rows.schema[0].dataType)),
            T.StructField("keys", T.ArrayType(rows.schema[1].dataType)),
            T.StructField("texts", T.ArrayType(T.StringType())),
            T.StructField("start", T.LongType()),
            T.StructField("ends", T.BooleanType()),
            T.StructField("size", T.LongType()),
            T.StructField("turn", T.IntegerType()),
        ]
    )
    path = shared_path(rows.sparkSession, "pieces")
    # A row is large, so that groups of rows are looked at after each.
    options = {
        "compression": "zstd",
        "parquet.block.size": 2 * PIECE_BYTES,
        "parquet.block.size.row.check.min": 1,
        "parquet.page.size.row.check.min": 1,
    }
    rows.mapInArrow(packed, schema).write.partitionBy("turn").options(**options).parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path)


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For each piece its place, and (text number, key, key before) of its tokens."""
    ends, texts = flat(batch.column("texts"))
    for i, (start, whole) in enumerate(zip(batch["start"].to_pylist(), batch["ends"].to_pylist())):
        runs = [*token_runs(texts.slice(ends[i], ends[i + 1] - ends[i]))]
        row, keys, before = (np.concatenate(x) for x in zip(*runs, strict=True))
        before[0] = np.int64(start).view(np.uint64)
        upto = len(keys) if whole else len(keys) - 1
        yield i, [row[:upto], keys[:upto], before[:upto]]


def _score_by_shuffle(rows: DataFrame, key: str, model: LanguageModel) -> DataFrame:
    """(``key``, ...) for rows (uid, key, text): n-grams are brought to the segments that hold them."""
    segments, total, distinct = model.segments, model.total, model.distinct

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (_, keys, before) in _opened(batch):
                sets = [np.unique(np.concatenate([keys, before])), np.unique(pair_keys(before, keys))]
                filled, dealt = _dealt(sets, segments)
                if not len(filled):
                    continue
                columns = [
                    pa.array(filled.astype(np.int32)),
                    pa.array(np.full(len(filled), batch["piece"][i].as_py())),
                ]
                for grams, (order, cuts) in zip(sets, dealt, strict=True):
                    split = np.split(grams.astype("<u8")[order], cuts)
                    columns.append(pa.array([x.tobytes() for x in split], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["segment", "piece", "words", "pairs"])

    def answered(left: pa.Table, right: pa.Table) -> pa.Table:
        held = right.to_pylist()
        grams = Filter(segments, {r["segment"]: (r["filter"], r["bits"]) for r in held})
        counts = WordCounts([(r["keys"], r["counts"]) for r in held])

        def told(column: str, of: Callable[[np.ndarray], np.ndarray], kind: str) -> pa.Array:
            parts = [np.frombuffer(x, "<u8") for x in left[column].to_pylist()]
            if not parts:
                return pa.array([], pa.binary())
            known, back = np.unique(np.concatenate(parts), return_inverse=True)
            found = of(known).astype(kind)[back]
            split = np.split(found, np.cumsum([len(x) for x in parts[:-1]]))
            return pa.array([x.tobytes() for x in split], pa.binary())

        return pa.table(
            {
                "piece": left["piece"],
                "segment": left["segment"],
                "n": told("words", counts.of, "<i8"),
                "q": told("pairs", grams.probe, "i1"),
            }
        )

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("segment")
        parts = []
        for batch in right.to_batches():
            for i, (row, keys, before) in _opened(batch):
                words, word = np.unique(np.concatenate([keys, before]), return_inverse=True)
                pairs, pair = np.unique(pair_keys(before, keys), return_inverse=True)
                _, dealt = _dealt([words, pairs], segments)
                found = []
                for column, kind, (order, _) in zip("nq", ("<i8", "i1"), dealt, strict=True):
                    values = np.empty(len(order), kind)
                    values[order] = np.frombuffer(b"".join(left[column].to_pylist()), kind)
                    found.append(values)
                count, q = found[0][word], found[1][pair]
                own, ahead = count[: len(keys)], count[len(keys) :]
                uids, names = (batch[c].slice(i, 1).flatten() for c in ("uids", "keys"))
                sums = _scores(row, len(uids), own, ahead, q, total, distinct)
                parts.append(pa.Table.from_arrays([uids, names, *map(pa.array, sums)], shown.names))
        return pa.concat_tables(parts)

    pieces = _pieces(rows)
    size = pieces.agg(F.sum("size")).first()[0] or 0
    turns = max(1, min(TURNS, size // TURN_BYTES))
    shown = T.StructType(
        [
            T.StructField("uid", rows.schema[0].dataType),
            T.StructField("key", rows.schema[1].dataType),
            *T._parse_datatype_string(RESULT).fields,
        ]
    )
    done = []
    for turn in range(turns):
        part = pieces.where(F.col("turn") % turns == turn).drop("size", "turn")
        wanted = part.select("piece", "texts", "start", "ends").mapInArrow(
            asked, "segment int, piece long, words binary, pairs binary"
        )
        answers = (
            wanted.groupBy("segment")
            .cogroup(model.tables.groupBy("segment"))
            .applyInArrow(answered, "piece long, segment int, n binary, q binary")
        )
        sums = answers.groupBy("piece").cogroup(part.groupBy("piece")).applyInArrow(scored, shown)
        with brief_shuffles(rows.sparkSession):
            done.append(materialize(sums, "scores"))
    whole = reduce(DataFrame.unionAll, done).groupBy("uid")  # a cut text has a row for each piece
    return whole.agg(
        F.first("key").alias(key),
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")],
    ).drop("uid")


def score(
    docs: DataFrame,
    model: LanguageModel,
    text: str = "text",
    key: str = "doc_id",
    most: int = BROADCAST_BYTES,
) -> DataFrame:
    """(key, n_tokens, n_known, base_score, score) for each row of ``docs``.

    ``base_score`` is exact: log10 probabilities of single words with one added to each count.
    ``score`` is the log10 of the smoothed model's probability of the text. Whole texts are scored; null and empty ones are one end
    token. A model trained on nothing gives every word the same probability. The tables are
    broadcast if they have at most ``most`` bytes together; otherwise texts are scored by shuffle.
    """
    row = F.col("row")
    rows = identified(docs).select(
        "uid", row[key].alias("key"), F.coalesce(row[text], F.lit("")).alias("_text")
    )
    if model.bytes > most:
        return _score_by_shuffle(rows, key, model)
    return _score_by_broadcast(rows.select(F.col("key").alias(key), "_text"), model)
