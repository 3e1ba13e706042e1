"""Reading the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared so that no job has to open file footers to infer a schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column, so that aggregates skip it."""
    floating = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.select(
        *[
            F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)).alias(c)
            if c in floating
            else F.col(c)
            for c in df.columns
        ]
    )


def load_table(
    spark: SparkSession,
    directory: str,
    name: str,
    schema: str | T.StructType | None = None,
    nan_as_null: bool = True,
) -> DataFrame:
    """Read ``<directory>/<name>.parquet`` with a declared schema.

    A filter on a floating column cannot reach the parquet scan through the NaN rewrite; pass
    ``nan_as_null=False`` for a table known to hold no NaN when such a filter matters.
    """
    declared = schema or SCHEMAS.get(name)
    reader = spark.read.schema(declared) if declared else spark.read
    df = reader.parquet(f"{directory}/{name}.parquet")
    return nan_to_null(df) if nan_as_null else df
