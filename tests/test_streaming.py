from __future__ import annotations

import datetime
import random

import pytest
from conftest import rows_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quillframe.operators.fairness import group_metrics
from quillframe.streaming import monitor

SCHEMA = "ts timestamp, g string, y int, p int"
START = datetime.datetime(2024, 5, 1, tzinfo=datetime.UTC)


def made(seed, days, n=300, spread=2):
    """Events around the given days, some up to ``spread`` days early."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        at = START + datetime.timedelta(days=rng.choice(days) - rng.random() * spread)
        y = rng.randint(0, 1)
        p = y if rng.random() < 0.8 else 1 - y
        rows.append((at, rng.choice(["a", "b", None]), y, p))
    return [*rows, (None, "a", 1, 1), (START, "a", None, 1), (START, "b", 0, None)]


@pytest.fixture
def feed(spark, tmp_path):
    folder = str(tmp_path / "events")

    def add(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def stream(delay="5 days"):
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
        return monitor.windowed_counts(source, "ts", "g", "y", "p", "1 day", delay)

    def batch():
        return monitor.windowed_counts(spark.read.schema(SCHEMA).parquet(folder), "ts", "g", "y", "p", "1 day")

    return add, stream, batch, str(tmp_path / "out"), str(tmp_path / "offsets")


def test_stream_equals_batch_over_restarts_and_late_rows(spark, feed):
    add, stream, batch, out, offsets = feed
    add(made(1, [3, 4]))
    add(made(2, [5]))
    monitor.watch(stream(), out, offsets).awaitTermination()
    assert rows_of(monitor.watched(spark, out, "g")) == rows_of(batch())
    add(made(3, [7]))
    add(made(4, [4, 6]))  # late, for windows that have been written before
    monitor.watch(stream(), out, offsets).awaitTermination()
    whole = rows_of(monitor.watched(spark, out, "g"))
    assert whole == rows_of(batch()) and len(whole) > 12
    monitor.watch(stream(), out, offsets).awaitTermination()  # nothing new
    assert rows_of(monitor.watched(spark, out, "g")) == whole
    metrics = monitor.metrics_over_time(monitor.watched(spark, out, "g"), "g").collect()
    day = F.col("ts").between(F.lit(START + datetime.timedelta(days=3)), F.lit(START + datetime.timedelta(days=4)))
    table = spark.read.schema(SCHEMA).parquet(out.replace("/out", "/events"))
    plain = group_metrics(table.where(day & F.col("y").isNotNull() & F.col("p").isNotNull()), "g", "y", "p")
    want = {r.g: (r.n, r.accuracy, r.f1, r.selection_rate) for r in plain.collect()}
    at = (START + datetime.timedelta(days=3)).replace(tzinfo=None)
    found = {r.g: (r.n, r.accuracy, r.f1, r.selection_rate) for r in metrics if r.window_start == at}
    assert found == pytest.approx(want) if None not in want else found.keys() == want.keys()
    assert all(found[g] == pytest.approx(want[g]) for g in want)


def test_failure_within_a_batch_counts_nothing_twice(spark, feed, monkeypatch):
    add, stream, batch, out, offsets = feed
    add(made(1, [3, 4]))
    add(made(2, [5]))
    from pyspark.sql import DataFrameWriter

    write, calls = DataFrameWriter.parquet, []

    def breaking(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        if "batch=1" in path and not calls:
            calls.append(path)
            raise OSError("lost after it was written")

    monkeypatch.setattr(DataFrameWriter, "parquet", breaking)
    with pytest.raises(StreamingQueryException):
        monitor.watch(stream(), out, offsets).awaitTermination()
    assert calls
    monitor.watch(stream(), out, offsets).awaitTermination()
    assert rows_of(monitor.watched(spark, out, "g")) == rows_of(batch())


def test_rows_behind_the_watermark_are_left_out(spark, feed):
    add, stream, batch, out, offsets = feed
    add(made(1, [20], spread=0.5))
    monitor.watch(stream("1 day"), out, offsets).awaitTermination()
    before = rows_of(monitor.watched(spark, out, "g"))
    add(made(2, [2], spread=0.5))
    monitor.watch(stream("1 day"), out, offsets).awaitTermination()
    assert rows_of(monitor.watched(spark, out, "g")) == before


def test_no_events(spark, feed):
    add, stream, _, out, offsets = feed
    add([])
    monitor.watch(stream(), out, offsets).awaitTermination()
    assert monitor.watched(spark, out, "g").collect() == []


def test_drift_is_told(spark):
    rows = [(START + datetime.timedelta(days=d), g, 100, 0.9 if d < 8 or g == "a" else 0.6, 0.5, 0.1, 0.2, r)
            for d in range(10) for g, r in (("a", 0.5), ("b", 0.45 if d < 9 else 0.2))]
    rows.append((START + datetime.timedelta(days=8), "few", 5, 0.1, 0.5, 0.1, 0.2, 0.5))
    frame = spark.createDataFrame(
        rows,
        "window_start timestamp, g string, n long, accuracy double, precision double, recall double,"
        " f1 double, selection_rate double",
    )
    found = monitor.drift_alerts(frame, "g", history=7).collect()
    day = lambda r: (r.window_start - START.replace(tzinfo=None)).days
    assert {(r.g, day(r)) for r in found if r.drifted} == {("b", 8), ("b", 9)}
    assert {day(r) for r in found if r.unequal} == {9}
    assert all((r.expected is None) == (day(r) < 7 or r.g == "few") for r in found)
