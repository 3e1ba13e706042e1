"""Cleaning, projections, set operations and lookups."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quillframe.operators import cleaning as ops
from quillframe.operators.ordered import add_row_index
from quillframe.operators.scaling import assemble
from quillframe.plans.registry import query
from quillframe.plans.standins import (
    DIRTY_SQL,
    FEATURES,
    FEATURES_SQL,
    KEYS_SQL,
    LINE_KEY,
    LINES_SQL,
    N_DUPLICATES,
    NULL_SHARES,
    SEED,
    dirty_lines,
    lines,
)
from quillframe.sources.artifacts import materialize
from quillframe.sources.tables import load_table


def _rounded(df):
    return df.withColumn("net", F.round("net", 6))


def _distinct(spark, sf_dir):
    """Distinct dirty rows, written out because the medians read them more than once."""
    return materialize(ops.drop_duplicates(dirty_lines(spark, sf_dir)), "distinct")


_ROW = f"{KEYS_SQL}, {FEATURES_SQL}, round(net, 6) AS net"


@query("inject_nulls", f"WITH {DIRTY_SQL} SELECT {_ROW} FROM spoiled")
def inject_nulls(spark, sf_dir):
    return _rounded(ops.inject_nulls(lines(spark, sf_dir), NULL_SHARES, LINE_KEY, SEED))


@query("inject_duplicates", f"WITH {DIRTY_SQL} SELECT {_ROW} FROM dirty")
def inject_duplicates(spark, sf_dir):
    spoiled = ops.inject_nulls(lines(spark, sf_dir), NULL_SHARES, LINE_KEY, SEED)
    return _rounded(ops.inject_duplicates(spoiled, N_DUPLICATES, LINE_KEY, SEED))


_MEDIANS = ", ".join(f"median({c}) AS {c}" for c in FEATURES)
_FILLED = ", ".join(f"coalesce(u.{c}, m.{c}) AS {c}" for c in FEATURES)
_KEYS_U = ", ".join(f"u.{c}" for c in LINE_KEY)


@query(
    "impute_median",
    f"WITH {DIRTY_SQL}, m AS (SELECT {_MEDIANS} FROM uniq)"
    f" SELECT {_KEYS_U}, {_FILLED}, round(u.net, 6) AS net FROM uniq u CROSS JOIN m",
)
def impute_median(spark, sf_dir):
    return _rounded(ops.impute_median(_distinct(spark, sf_dir), FEATURES))


@query(
    "impute_report",
    f"WITH {DIRTY_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS n_missing,"
        f" median({c}) AS median FROM uniq"
        for c in FEATURES
    ),
)
def impute_report(spark, sf_dir):
    return ops.impute_report(_distinct(spark, sf_dir), FEATURES)


@query(
    "cast_columns",
    f"WITH {LINES_SQL} SELECT {KEYS_SQL}, trunc(l_extendedprice)::INT AS l_extendedprice,"
    " trunc(l_quantity)::INT AS l_quantity FROM lines",
)
def cast_columns(spark, sf_dir):
    table = lines(spark, sf_dir).select(*LINE_KEY, "l_extendedprice", "l_quantity")
    return ops.cast_columns(table, {"l_extendedprice": "int", "l_quantity": "int"})


@query(
    "rename",
    "SELECT c_custkey AS customer_id, c_name, c_nationkey, c_acctbal,"
    " c_mktsegment AS segment FROM customer",
)
def rename(spark, sf_dir):
    names = {"c_custkey": "customer_id", "c_mktsegment": "segment"}
    return ops.rename(load_table(spark, sf_dir, "customer"), names)


@query(
    "add_row_index",
    f"WITH {LINES_SQL} SELECT {KEYS_SQL}, l_quantity,"
    f" row_number() OVER (ORDER BY {KEYS_SQL}, l_quantity) - 1 AS row_index FROM lines",
)
def add_row_index_(spark, sf_dir):
    table = lines(spark, sf_dir).select(*LINE_KEY, "l_quantity")
    return add_row_index(table, [*LINE_KEY, "l_quantity"])


@query("select_features", f"SELECT {KEYS_SQL}, {FEATURES_SQL} FROM lineitem")
def select_features(spark, sf_dir):
    return ops.select_features(lines(spark, sf_dir), "net")


@query(
    "map_labels",
    f"SELECT {KEYS_SQL}, l_returnflag, CASE l_returnflag WHEN 'R' THEN 'Returned'"
    " WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'None' END AS flag_name FROM lineitem",
)
def map_labels(spark, sf_dir):
    table = load_table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_returnflag")
    names = {"R": "Returned", "A": "Accepted", "N": "None"}
    return ops.map_labels(table, "l_returnflag", names, "flag_name")


@query(
    "map_labels_table",
    "SELECT c_custkey, c_nationkey, n_name AS nation"
    " FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def map_labels_table(spark, sf_dir):
    names = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    table = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return ops.map_labels(table, "c_nationkey", names, "nation")


@query("filter_eq", f"SELECT {KEYS_SQL}, l_returnflag, l_quantity FROM lineitem WHERE l_returnflag = 'A'")
def filter_eq(spark, sf_dir):
    table = load_table(spark, sf_dir, "lineitem")
    return ops.filter_eq(table, "l_returnflag", "A").select(*LINE_KEY, "l_returnflag", "l_quantity")


@query(
    "assemble",
    f"SELECT {KEYS_SQL}, "
    + ", ".join(f"{c} AS x{i}" for i, c in enumerate(FEATURES))
    + ", 4::BIGINT AS n_features FROM lineitem",
)
def assemble_(spark, sf_dir):
    array = vector_to_array("features")
    return assemble(lines(spark, sf_dir), FEATURES).select(
        *LINE_KEY,
        *[array[i].alias(f"x{i}") for i in range(len(FEATURES))],
        F.size(array).cast("long").alias("n_features"),
    )


_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_missing FROM dirty"
    for c in [*LINE_KEY, *FEATURES, "net"]
)


@query(
    "expect_no_nulls",
    f"WITH {DIRTY_SQL}, m AS ({_MISSING}) SELECT * FROM m WHERE n_missing > 0",
)
def expect_no_nulls(spark, sf_dir):
    return ops.expect_no_nulls(dirty_lines(spark, sf_dir))


@query(
    "null_counts",
    f"WITH {DIRTY_SQL}, m AS ({_MISSING}) SELECT * FROM m"
    ' UNION ALL SELECT \'TOTAL\' AS "column", sum(n_missing)::BIGINT AS n_missing FROM m',
)
def null_counts(spark, sf_dir):
    return ops.null_counts(dirty_lines(spark, sf_dir))


_CLEAN_KEY = ", ".join([*(f"u.{c}" for c in LINE_KEY), "u.net"])


@query(
    "clean",
    f"WITH {DIRTY_SQL}, m AS (SELECT {_MEDIANS} FROM uniq)"
    f" SELECT {_KEYS_U}, trunc(coalesce(u.l_quantity, m.l_quantity))::INT AS l_quantity, "
    + ", ".join(f"coalesce(u.{c}, m.{c}) AS {c}" for c in FEATURES[1:])
    + f", round(u.net, 6) AS net, row_number() OVER (ORDER BY {_CLEAN_KEY}) - 1 AS row_index"
    " FROM uniq u CROSS JOIN m",
)
def clean(spark, sf_dir):
    table, _ = ops.clean(
        dirty_lines(spark, sf_dir), FEATURES, {"l_quantity": "int"}, [*LINE_KEY, "net"]
    )
    return _rounded(table)


_EMPTY_CELLS = " + ".join(f"({c} IS NULL)::INT" for c in FEATURES)


@query(
    "clean_report",
    f"WITH {DIRTY_SQL} SELECT (SELECT count(*) FROM dirty) AS rows_before,"
    " (SELECT count(*) FROM uniq) AS rows_after,"
    " (SELECT count(*) FROM dirty) - (SELECT count(*) FROM uniq) AS rows_removed,"
    f" (SELECT sum({_EMPTY_CELLS})::BIGINT FROM dirty) AS missing_before,"
    " 0::BIGINT AS missing_after",
)
def clean_report(spark, sf_dir):
    _, report = ops.clean(
        dirty_lines(spark, sf_dir), FEATURES, {"l_quantity": "int"}, [*LINE_KEY, "net"]
    )
    return report


@query(
    "union_all",
    "SELECT c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer"
    " UNION ALL SELECT s_nationkey, s_acctbal FROM supplier",
)
def union_all(spark, sf_dir):
    customers = load_table(spark, sf_dir, "customer")
    suppliers = load_table(spark, sf_dir, "supplier")
    return ops.union_all(
        customers.select(F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal")),
        suppliers.select(F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey")),
    )


@query("drop_duplicates", f"WITH {DIRTY_SQL} SELECT {_ROW} FROM uniq")
def drop_duplicates(spark, sf_dir):
    return _rounded(ops.drop_duplicates(dirty_lines(spark, sf_dir)))


@query(
    "duplicate_count",
    f"WITH {DIRTY_SQL} SELECT (SELECT count(*) FROM dirty) - (SELECT count(*) FROM uniq)"
    " AS n_duplicates",
)
def duplicate_count(spark, sf_dir):
    return ops.duplicate_count(dirty_lines(spark, sf_dir))


@query("distinct_values", "SELECT DISTINCT lang FROM documents")
def distinct_values(spark, sf_dir):
    return ops.distinct_values(load_table(spark, sf_dir, "documents"), "lang")
