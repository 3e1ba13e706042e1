"""Token ids as Parquet list columns that readers can pick from.

Rows are range-sorted by key, tokenised in that order, and written one file per range: the ids as a
list column (dictionary- or delta-encoded), beside them the key, the number of ids, and the place
of the first id in its file. A manifest holds what earlier files hold, so a document's place in the
whole is a sum of two numbers, and no pass over the ids is needed to know it. Small pages with page
indexes, and row groups of a set size, let a reader skip to some keys, or read no ids at all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillframe.llm.rows import identified
from quillframe.llm.tokens import encode_batch
from quillframe.sources.artifacts import shared_path


def with_end(lengths: np.ndarray, ids: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to each of the lists of ``lengths`` that ``ids`` holds in order."""
    places = np.cumsum(lengths)
    return lengths + 1, np.insert(ids, places, end_id)


def crc32s(lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of each list, as little-endian unsigned 32-bit integers."""
    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    ends = np.cumsum(lengths) * 4
    starts = ends - lengths * 4
    found = (zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
    return np.fromiter(found, np.int64, len(lengths))


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    encoding: str = "dictionary",
    row_group_mb: int = 32,
    page_kb: int = 256,
    text: str = "text",
    key: str = "doc_id",
) -> None:
    """Write ``path``/tokens and ``path``/manifest in ascending order of ``key``, nulls first.

    Equal keys follow in the order of the input and spread over files like any others. A null text
    counts as empty and holds ``end_id`` alone. An empty table gives empty files.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is dictionary or delta")
    rows = identified(docs).select(
        F.col("row")[key].alias("key"), "uid", F.col("row")[text].alias("text")
    )
    ranged = rows.repartitionByRange("key", "uid").sortWithinPartitions("key", "uid")
    kind = ranged.schema["key"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), 0
        for batch in batches:
            lengths, ids = with_end(*encode_batch(tokenizer, batch.column(2)), end_id)
            ends = held + np.cumsum(lengths)
            for at in range(0, len(lengths), 1000):
                some = slice(at, at + 1000)
                first = int(lengths[:at].sum())
                n = lengths[some]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, 1000),
                        pa.array(np.full(len(n), part, np.int32)),
                        pa.array(ends[some] - n),
                        pa.array(n),
                        pa.ListArray.from_arrays(
                            np.concatenate([[0], np.cumsum(n)]).astype(np.int32),
                            pa.array(ids[first : first + int(n.sum())].view(np.int32)),
                        ),
                    ],
                    names=["key", "file", "place", "n_tokens", "ids"],
                )
            held = int(ends[-1]) if len(ends) else held

    schema = f"key {kind}, file int, place long, n_tokens long, ids array<int>"
    writer = ranged.mapInArrow(encoded, schema).write.mode("overwrite")
    options = {
        "compression": "zstd",
        "parquet.block.size": row_group_mb << 20,
        "parquet.page.size": page_kb << 10,
        "parquet.page.row.count.limit": 1000,
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
        "parquet.writer.version": "v2" if encoding == "delta" else "v1",
    }
    writer.options(**options).parquet(f"{path}/tokens")
    spark = docs.sparkSession
    sizes = spark.read.parquet(f"{path}/tokens").groupBy("file").agg(F.sum("n_tokens").alias("n"))
    # One row per file.
    earlier = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    manifest = sizes.select(
        "file", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("long").alias("before")
    )
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")


@dataclass
class TokenFiles:
    """What ``write_token_files`` wrote: read only what is asked for."""

    spark: SparkSession
    path: str

    def metadata(self) -> DataFrame:
        """(key, start, n_tokens) of every document, without reading ids."""
        return self._placed("key", "n_tokens")

    def tokens(self, where: Column | None = None) -> DataFrame:
        """(key, start, n_tokens, ids); a condition on ``key`` reaches the files' page indexes."""
        return self._placed("key", "n_tokens", "ids", where=where)

    def _placed(self, *columns: str, where: Column | None = None) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.path}/tokens")
        stored = stored if where is None else stored.where(where)
        return self._located(stored.select("file", "place", *columns), columns)

    def _located(self, stored: DataFrame, columns) -> DataFrame:
        before = self.spark.read.parquet(f"{self.path}/manifest").select(
            F.col("file").alias("_file"), "before"
        )
        joined = stored.join(before, F.col("file") == F.col("_file"))
        return joined.select((F.col("place") + F.col("before")).alias("start"), *columns)

    def checksums(self) -> DataFrame:
        """(key, start, n_tokens, ids_crc32) from the ids as the files hold them."""
        stored = self.spark.read.parquet(f"{self.path}/tokens").select("key", "file", "place", "ids")
        kind = stored.schema["key"].dataType.simpleString()

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column(3)
                offsets = lists.offsets.to_numpy()
                ids = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
                n = np.diff(offsets).astype(np.int64)
                crc = crc32s(n, ids.view("<u4"))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array(n), pa.array(crc)],
                    names=["key", "file", "place", "n_tokens", "ids_crc32"],
                )

        schema = f"key {kind}, file int, place long, n_tokens long, ids_crc32 long"
        return self._located(stored.mapInArrow(summed, schema), ["key", "n_tokens", "ids_crc32"])


def token_digests(
    docs: DataFrame, tokenizer: str, end_id: int, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Write ``docs`` to token files in the shared folder, and read back their checksums."""
    path = shared_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, tokenizer, end_id, text=text, key=key)
    return TokenFiles(docs.sparkSession, path).checksums()
