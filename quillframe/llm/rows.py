"""Helpers the operators share: row identity, running sums, and batches of a bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillframe.sources.artifacts import materialize

DROPPED_ROWS = 1_000_000  # row numbers that are broadcast at most: 8 MB


def identified(docs: DataFrame, name: str = "uid") -> DataFrame:
    """``docs`` as (``name``, row): a number for each row, and its columns packed in a struct.

    Packing keeps column names of the caller apart from those the operators add. The numbers hold
    for one reading of ``docs``; what is to meet them in a later job is written with them.
    """
    return docs.select(F.monotonically_increasing_id().alias(name), F.struct(F.col("*")).alias("row"))


def numbered(docs: DataFrame, name: str = "uid", at_rest: bool = False) -> DataFrame:
    """``identified`` rows that each reading finds under the same number: they are written once.

    ``at_rest`` says that ``docs`` is a scan of parquet files which stay as they are, so that nothing
    has to be written: a row is known by its file, as 64 bits of a digest of the path (a million
    files share one with a chance below one in ten million), and its place in the file, whatever
    splits the files are read in. Frames that no file's rows are seen in are written all the same.
    """
    if at_rest:
        try:
            place = docs.metadataColumn("_metadata")
            known = F.struct(
                F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("place")
            )
            return docs.select(known.alias(name), F.struct(F.col("*")).alias("row"))
        except AnalysisException:
            pass
    return materialize(identified(docs, name), "numbered")


def without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """``rows`` (uid, ...) whose uid is not among those of ``dropped``.

    Up to ``DROPPED_ROWS`` uids, counted before, are broadcast, so that texts stay where they are;
    beyond that rows and uids meet by shuffle, with the same result.
    """
    dropped = materialize(dropped.select(F.col("uid").alias("_dropped")), "dropped")
    if dropped.count() <= DROPPED_ROWS:
        dropped = F.broadcast(dropped)
    return rows.join(dropped, F.col("uid") == F.col("_dropped"), "left_anti")


def hash_below_mod(key: Column, mod: int) -> Column:
    """``crc32(key as text) mod m``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % mod


def running_sums(df: DataFrame, order: Sequence[str], value: str, by: str | None = None) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the earlier rows, in each group of ``by``.

    Rows are range-sorted, so a group of any size spreads over partitions. Each task sums its own
    stretch in one pass over the batches; what earlier partitions hold of the group is added from
    one total per partition and group.
    """
    keys = [by] if by else []
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField("_part", T.IntegerType()),
            T.StructField("_inside", T.LongType()),
        ]
    )
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        group, held = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = pc.fill_null(batch.column(batch.schema.get_field_index(value)), 0)
            sums = np.concatenate([[0], np.cumsum(values.to_numpy(zero_copy_only=False))])
            starts = np.zeros(1, np.int64)
            if by:
                names = batch.column(batch.schema.get_field_index(by))
                codes = names.dictionary_encode(null_encoding="encode").indices.to_numpy(False)
                starts = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1])
                first, last = names[0].as_py(), names[-1].as_py()
            else:
                first = last = 0
            if group != (first,):
                held = 0
            lengths = np.diff(np.append(starts, batch.num_rows))
            base = np.repeat(sums[starts], lengths)
            out = sums[:-1] - base
            out[: lengths[0]] += held
            held = int(sums[-1] - sums[starts[-1]]) + (held if len(starts) == 1 else 0)
            group = (last,)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.full(batch.num_rows, part, np.int32)),
                    pa.array(out.astype(np.int64)),
                ],
                names=[*batch.schema.names, "_part", "_inside"],
            )

    placed = materialize(ranged.mapInArrow(inside, schema), "running")
    totals = placed.groupBy(*keys, "_part").agg(F.sum(value).alias("_sum"))
    # One row for each partition and group that meet.
    across = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(k).alias(f"_on_{k}") for k in keys],
        F.col("_part").alias("_on_part"),
        F.coalesce(F.sum("_sum").over(across), F.lit(0)).cast("long").alias("_start"),
    )
    match = F.col("_part") == F.col("_on_part")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_on_{k}"))
    return placed.join(starts, match, "left").select(
        *df.columns, (F.col("_inside") + F.col("_start")).alias("before")
    )


def balanced(
    texts: pa.Array, max_bytes: int, cut: Callable[[str, int], Iterator[str]]
) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Slices of ``texts`` of at most ``max_bytes``: (row numbers, texts); null counts as empty.

    A longer text comes alone, in the parts that ``cut`` makes of it.
    """
    texts = pc.fill_null(texts, "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        if sizes[at] > max_bytes:
            for part in cut(texts[at].as_py(), max_bytes):
                yield np.array([at]), pa.array([part], pa.string())
            at += 1
            continue
        upto = int(np.searchsorted(ends, ends[at] - sizes[at] + max_bytes, "right"))
        yield np.arange(at, upto), texts.slice(at, upto - at)
        at = upto


def cut_at_space(text: str, size: int) -> Iterator[str]:
    """Parts of about ``size`` characters, each but the first beginning with a space."""
    at = 0
    while len(text) - at > size and (end := text.find(" ", at + size)) >= 0:
        yield text[at:end]
        at = end
    yield text[at:]


def flat(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Offsets from 0, and the values of the lists one after the other."""
    offsets = lists.offsets.to_numpy()
    return offsets - offsets[0], lists.values.slice(offsets[0], offsets[-1] - offsets[0])


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words of ``texts`` split at ``[\\x20\\x09-\\x0D]``: row of each word, its code, and the words."""
    offsets, words = flat(pc.ascii_split_whitespace(texts))
    rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    known = coded.dictionary.to_pylist()
    if "" in known:  # what stands beside white space at either end
        full = codes != known.index("")
        rows, codes = rows[full], codes[full]
    return rows, codes, known
