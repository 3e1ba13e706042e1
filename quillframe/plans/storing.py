"""Reading tables, and writing results to read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillframe.operators.metrics import regression_report
from quillframe.plans.registry import query
from quillframe.plans.standins import FEATURES_SQL, KEYS_SQL, PRICED_SQL, lines, priced_lines
from quillframe.sources import artifacts
from quillframe.sources.tables import load_table


@query(
    "load_table",
    f"SELECT {KEYS_SQL}, {FEATURES_SQL}, l_returnflag, l_linestatus,"
    " strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM lineitem",
)
def load(spark, sf_dir):
    """All columns; the time as text, which every engine prints alike."""
    shown = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    return load_table(spark, sf_dir, "lineitem").withColumn("l_shipdate", shown)


@query(
    "save_table",
    "SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS mean_quantity"
    " FROM lineitem GROUP BY 1",
)
def save_table(spark, sf_dir):
    path = artifacts.shared_path(spark, "result")
    means = lines(spark, sf_dir, "l_returnflag").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean_quantity")
    )
    artifacts.save_table(means, path)
    return spark.read.parquet(path)


@query(
    "save_run_metadata",
    f"WITH {PRICED_SQL} SELECT 'rule' AS model_name, 42::BIGINT AS seed, count(*) AS n,"
    " round(avg(abs(net - guess)), 4) AS mae FROM priced",
)
def save_run_metadata(spark, sf_dir):
    path = artifacts.shared_path(spark, "metadata")
    report = regression_report(priced_lines(spark, sf_dir), "net", "guess")
    row = report.select(
        F.lit("rule").alias("model_name"),
        F.lit(42).cast("long").alias("seed"),
        "n",
        F.round("mae", 4).alias("mae"),
    )
    artifacts.save_run_metadata(row, path)
    return spark.read.schema(row.schema).json(path)
