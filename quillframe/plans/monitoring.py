"""Results over time: a stream of scored events beside a batch query over the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillframe.functions.hashing import hash_unit
from quillframe.plans.evaluating import rates_sql
from quillframe.plans.registry import query
from quillframe.plans.standins import MEDIAN_VALUE, SEED, unit_sql
from quillframe.sources.artifacts import shared_path
from quillframe.sources.tables import SCHEMAS
from quillframe.streaming import monitor

BROKEN_FROM = "2024-01-20"  # from here on clicks are scored without their signal
DELAY = "31 days"  # files of the table may be read in any order
METRICS = ["accuracy", "precision", "recall", "f1", "selection_rate"]


def scored_events(events):
    """Events with a true class and a rule's class: the day's clicks go wrong at some point."""
    y = (F.col("value") > MEDIAN_VALUE).cast("int")
    broken = (F.col("event_type") == "click") & (F.col("ts") >= F.lit(BROKEN_FROM).cast("timestamp_ntz"))
    signal = F.when(broken, 0.0).otherwise(0.6 * y)
    said = (hash_unit(["event_id"], SEED, "score") + signal) / 1.6 >= 0.5
    return events.select("ts", "event_type", y.alias("y"), said.cast("int").alias("pred"))


_SCORED_EVENTS = f"""scored AS (
  SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, (value > {MEDIAN_VALUE})::INT AS y,
         ((CASE WHEN event_type = 'click' AND ts >= TIMESTAMP '{BROKEN_FROM}' THEN 0::DOUBLE
                ELSE 0.6::DOUBLE * (value > {MEDIAN_VALUE})::INT END
           + {unit_sql('score', 'event_id')}) / 1.6::DOUBLE >= 0.5::DOUBLE)::INT AS pred
  FROM events),
{rates_sql('scored', 'window_start, event_type')}"""


def _over_time(spark, sf_dir):
    stream = spark.readStream.schema(SCHEMAS["events"]).parquet(f"{sf_dir}/events.parquet*")
    counts = monitor.windowed_counts(
        scored_events(stream), "ts", "event_type", "y", "pred", "1 day", DELAY
    )
    path = shared_path(spark, "watched")
    monitor.watch(counts, path, shared_path(spark, "offsets")).awaitTermination()
    table = monitor.metrics_over_time(monitor.watched(spark, path, "event_type"), "event_type")
    return table.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "metrics_over_time",
    f"WITH {_SCORED_EVENTS} SELECT window_start, event_type, n, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in METRICS)
    + " FROM m",
)
def metrics_over_time(spark, sf_dir):
    return _over_time(spark, sf_dir).withColumns({c: F.round(c, 6) for c in METRICS})


@query(
    "drift_alerts",
    f"""WITH {_SCORED_EVENTS},
a AS (SELECT window_start, event_type, n, accuracy, selection_rate,
        CASE WHEN count(*) OVER before = 7
             THEN sum(accuracy * n) OVER before / sum(n) OVER before END AS expected,
        min(selection_rate) OVER day / nullif(max(selection_rate) OVER day, 0) AS ratio
      FROM m WINDOW
        before AS (PARTITION BY event_type ORDER BY window_start ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
        day AS (PARTITION BY window_start))
SELECT window_start, event_type, n, round(accuracy, 6) AS accuracy, round(expected, 6) AS expected,
       coalesce(n >= 30 AND accuracy < expected - 0.1::DOUBLE, false) AS drifted,
       round(selection_rate, 6) AS selection_rate, round(ratio, 6) AS ratio, ratio < 0.8::DOUBLE AS unequal
FROM a""",
)
def drift_alerts(spark, sf_dir):
    alerts = monitor.drift_alerts(_over_time(spark, sf_dir), "event_type")
    return alerts.withColumns(
        {c: F.round(c, 6) for c in ("accuracy", "expected", "selection_rate", "ratio")}
    )
