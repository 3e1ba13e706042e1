"""Time the headline queries: one JSON line on stdout."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillframe.plans import QUERIES  # noqa: E402
from quillframe.sources import discard  # noqa: E402

HEADLINE = [
    "load_table",
    "inject_duplicates",
    "drop_duplicates",
    "impute_median",
    "clean",
    "add_row_index",
    "value_counts",
    "describe",
    "describe_grouped",
    "histogram",
    "box_stats",
    "moving_average",
    "running_ratio",
    "epoch_summary",
    "top_k",
    "sample_n",
    "split",
    "split_exact",
    "stratified_split",
    "stratified_kfold",
    "apply_scaler",
    "fit_linear",
    "regression_report",
    "fit_logistic",
    "cross_validate",
    "binary_metrics",
    "classification_report",
    "roc_auc",
    "roc_curve",
    "tokenize",
    "build_vocab",
    "encode",
    "fit_text_classifier",
    "linear_shapley",
    "shapley_ranking",
    "sampled_shapley",
    "local_surrogate",
    "group_metrics",
    "disparate_impact",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED") or tempfile.mkdtemp())
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    discard(spark)  # intermediate tables of this run
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
