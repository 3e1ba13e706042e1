"""Writing results and models, and the shared folder intermediate tables go to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the folder the session names for checkpoints.

    Everything one application writes lies under its own id, so it can be dropped together.
    Only a local session without such a folder gets a temporary one; on a cluster a folder that
    one machine alone can see would lose data with that machine, so it is refused.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="quillframe-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/quillframe/{context.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage at a table that outlives any executor, and later readers prune its columns.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs inside go when it ends, and not first when the driver happens
    to collect its garbage. For queries whose result is written and whose frames are not used again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def discard(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; frames that read them end with it."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base:
        path = context._jvm.org.apache.hadoop.fs.Path(
            f"{base.rstrip('/')}/quillframe/{context.applicationId}"
        )
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def save_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a result table as parquet."""
    df.write.mode(mode).parquet(path)


def save_run_metadata(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a one-row table of settings and metrics as JSON."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Write a fitted pipeline to a folder."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Read a fitted pipeline back."""
    return PipelineModel.load(path)
