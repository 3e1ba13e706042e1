"""Exact duplicates by a persistent index of text digests.

The index is a table of digests, bucketed and sorted by digest. A batch is cut down to one row per
digest before it is shuffled, so a group of copies of any size is one row per task; those rows meet
the index in a sort-merge anti-join, and the new ones are appended to it. DataFrame operations only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillframe.llm.rows import identified, numbered, without
from quillframe.sources.artifacts import materialize, shared_path

# Fixed value: the characters that do not count, ASCII white space.
IGNORED = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for character in IGNORED:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


@dataclass
class DigestIndex:
    """Digests kept under ``path``, with the key of the document that holds each.

    Opening a folder again, in any session, finds what was appended before. ``buckets`` has to stay
    what it was when the folder was made.
    """

    spark: SparkSession
    path: str
    buckets: int = 0
    key_type: str = "bigint"

    def __post_init__(self) -> None:
        self.buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = f"digests_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {self.key_type})"
            f" USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"
            f" LOCATION '{self.path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, digests: DataFrame) -> None:
        """Add new digests, one file per bucket."""
        digests.repartition(self.buckets, "digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def close(self) -> None:
        """Forget the table's name; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def _digests(rows: DataFrame, text: str, key: str) -> DataFrame:
    row = F.col("row")
    return rows.select(
        "uid",
        row[key].alias("key"),
        F.unhex(F.sha2(normalised(row[text]).cast("binary"), 256)).alias("digest"),
        F.coalesce(F.length(row[text]), F.lit(0)).alias("points"),
    )


def deduplicate(
    docs: DataFrame, index: DigestIndex, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Hold a batch against the index and append what is new.

    Returns (uid, key, digest, keep_id, first, group_size, kept) for every row. Texts are equal when
    they are the same without ASCII white space; null and empty texts are equal. Of the batch's
    equal texts the one with most code points is kept, then of least key (null keys last), then the
    least row number; ``first`` is its uid. If the index holds the digest already, no row is kept,
    ``keep_id`` is the key the index has, and ``first`` is null. ``group_size`` counts the batch.
    An empty batch gives an empty result and appends nothing.
    """
    return _deduplicate(identified(docs), index, text, key)


def _deduplicate(rows: DataFrame, index: DigestIndex, text: str, key: str) -> DataFrame:
    """``deduplicate`` for rows (uid, row)."""
    rows = materialize(_digests(rows, text, key), "digests")
    best = F.min(F.struct((-F.col("points")).alias("points"), F.col("key").isNull(), "key", "uid"))
    batch = materialize(
        rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size")), "batch"
    ).select("digest", F.col("best.key").alias("own"), F.col("best.uid").alias("uid"), "group_size")
    new = batch.select("digest", "own").hint("merge").join(index.rows(), "digest", "left_anti")
    new = materialize(new.select("digest", F.col("own").alias("keep_id")), "new")
    known = batch.select("digest").hint("merge").join(index.rows().hint("merge"), "digest")
    known = materialize(known.select("digest", F.col("keep_id").alias("held"), F.lit(True).alias("old")), "known")
    index.append(new)
    groups = batch.join(known, "digest", "left").select(
        F.col("digest").alias("_digest"),
        F.when(F.col("old"), F.col("held")).otherwise(F.col("own")).alias("keep_id"),
        F.when(F.col("old").isNull(), F.col("uid")).alias("first"),
        "group_size",
    )
    # The copies of one text are the hot side, which the adaptive join splits.
    joined = rows.join(groups, F.col("digest") == F.col("_digest"))
    return joined.select(
        "uid",
        "key",
        "digest",
        "keep_id",
        "first",
        "group_size",
        F.coalesce(F.col("uid") == F.col("first"), F.lit(False)).alias("kept"),
    )


def new_index(docs: DataFrame, key: str = "doc_id") -> DigestIndex:
    """An empty index in the shared folder."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType
    kind = "bigint" if isinstance(kind, T.NullType) else kind.simpleString()
    return DigestIndex(spark, shared_path(spark, "index"), key_type=kind)


def _groups(rows: DataFrame, docs: DataFrame, text: str, key: str) -> DataFrame:
    index = new_index(docs, key)
    found = _deduplicate(rows, index, text, key)
    index.close()
    return found


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``deduplicate`` against an index of its own: the groups of equal texts in ``docs``."""
    return _groups(identified(docs), docs, text, key)


def drop_exact_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", at_rest: bool = False
) -> DataFrame:
    """``docs`` with the kept row of each group of equal texts, as ``deduplicate`` chooses it.

    Null and empty texts are one group. Rows are written once with their numbers, so that the second
    reading drops the rows that the first chose, whatever ``docs`` is read from; not if they are
    ``at_rest`` (``rows.numbered``). An empty table gives an empty one; column names of ``docs`` may
    be any.
    """
    rows = numbered(docs, at_rest=at_rest)
    return without(rows, _groups(rows, docs, text, key).where("NOT kept")).select("row.*")
