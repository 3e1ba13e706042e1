"""Run queries beside their SQL and compare: python tools/check_queries.py [sf] [name ...]."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillframe.plans import ORACLES, QUERIES  # noqa: E402
from quillframe.sources.tables import SCHEMAS  # noqa: E402


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp())
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows_of(table) -> list[tuple]:
    """Rows as sorted tuples, columns in the order of their names."""
    columns = [table.column(c).to_pylist() for c in sorted(table.column_names)]
    rows = [tuple(plain(v) for v in row) for row in zip(*columns, strict=True)]
    return sorted(rows, key=repr)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark = session()
    duck = duckdb.connect()
    for table in SCHEMAS:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    bad = 0
    for name in names:
        started = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toArrow()
            spent = time.time() - started
            if name not in ORACLES:
                print(f"rows  {name} {got.num_rows} {spent:.1f}s", flush=True)
                continue
            want = duck.sql(ORACLES[name]).to_arrow_table()
            a, b = rows_of(got), rows_of(want)
            same_columns = sorted(got.column_names) == sorted(want.column_names)
            types = {
                c: (got.schema.field(c).type, want.schema.field(c).type)
                for c in got.column_names
                if c in want.column_names
                and str(got.schema.field(c).type) != str(want.schema.field(c).type)
            }
            if same_columns and a == b:
                print(f"ok    {name} {len(a)} {spent:.1f}s {types or ''}", flush=True)
                continue
            bad += 1
            differing = [(x, y) for x, y in zip(a, b, strict=False) if x != y]
            print(f"DIFF  {name} rows {len(a)} {len(b)} differing {len(differing)}")
            print(f"      {sorted(got.column_names)} {sorted(want.column_names)}")
            print(f"      {differing[:2]}", flush=True)
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {name} {type(error).__name__} {str(error)[:1500]}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
