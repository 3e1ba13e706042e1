"""Shapes, counts, summaries and plot tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillframe.operators import profiling as ops
from quillframe.plans.registry import query
from quillframe.plans.standins import FEATURES, LINES_SQL, lines
from quillframe.sources.tables import SCHEMAS, load_table


@query("shape", """SELECT count(*) AS n_rows,
  (SELECT count(*) FROM (DESCRIBE SELECT * FROM lineitem)) AS n_columns FROM lineitem""")
def shape(spark, sf_dir):
    """Columns as the files have them."""
    return ops.shape(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


_COLUMNS = [c.split()[0] for c in SCHEMAS["lineitem"].split(", ")]
_KNOWN_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS name, count({c}) AS n_known FROM lineitem" for c in _COLUMNS
)


@query(
    "schema_table",
    f"""WITH known AS ({_KNOWN_SQL})
SELECT (row_number() OVER () - 1)::INT AS position, column_name AS "column",
  CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
       WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
       WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type,
  (SELECT n_known FROM known WHERE name = column_name) AS n_known
FROM (DESCRIBE SELECT * FROM lineitem)""",
)
def schema_table(spark, sf_dir):
    """What the files hold, whatever is declared."""
    return ops.schema_table(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def _value_counts_sql(table: str, col: str) -> str:
    return (
        f"SELECT {col} AS value, count(*) AS n,"
        f" round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM {table}), 6) AS percent"
        f" FROM {table} GROUP BY {col}"
    )


@query("value_counts", _value_counts_sql("lineitem", "l_returnflag"))
def value_counts(spark, sf_dir):
    counts = ops.value_counts(load_table(spark, sf_dir, "lineitem"), "l_returnflag")
    return counts.withColumn("percent", F.round("percent", 6))


@query("value_counts_sources", _value_counts_sql("documents", "source"))
def value_counts_sources(spark, sf_dir):
    counts = ops.value_counts(load_table(spark, sf_dir, "documents"), "source")
    return counts.withColumn("percent", F.round("percent", 6))


def _describe_sql(c: str, by: str = "", digits: int = 4) -> str:
    parts = {
        "mean": f"avg({c})",
        "std": f"stddev_samp({c})",
        "min": f"min({c})",
        "q25": f"quantile_cont({c}, 0.25)",
        "q50": f"quantile_cont({c}, 0.5)",
        "q75": f"quantile_cont({c}, 0.75)",
        "max": f"max({c})",
    }
    shown = ", ".join(f"round({e}, {digits}) AS {n}" for n, e in parts.items())
    group = f" GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"SELECT {lead}'{c}' AS feature, count({c}) AS count, {shown} FROM lines{group}"


@query(
    "describe",
    f"WITH {LINES_SQL} " + " UNION ALL ".join(_describe_sql(c) for c in [*FEATURES, "net"]),
)
def describe(spark, sf_dir):
    return ops.describe(lines(spark, sf_dir), [*FEATURES, "net"], 4)


@query(
    "describe_grouped",
    f"WITH {LINES_SQL} "
    + " UNION ALL ".join(_describe_sql(c, "l_returnflag") for c in ("l_extendedprice", "net")),
)
def describe_grouped(spark, sf_dir):
    table = lines(spark, sf_dir, "l_returnflag")
    return ops.describe(table, ["l_extendedprice", "net"], 4, ["l_returnflag"])


@query("describe_approximate")
def describe_approximate(spark, sf_dir):
    return ops.describe(lines(spark, sf_dir), [*FEATURES, "net"], 4, exact=False)


@query(
    "group_mean",
    """WITH m AS (SELECT c_mktsegment, avg(c_acctbal) AS mean FROM customer GROUP BY 1)
SELECT c_mktsegment, round(mean, 4) AS mean,
       round((SELECT max(mean) * 1.2::DOUBLE FROM m), 4) AS axis_top FROM m""",
)
def group_mean(spark, sf_dir):
    means = ops.group_mean(load_table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal")
    return means.select("c_mktsegment", *[F.round(c, 4).alias(c) for c in ("mean", "axis_top")])


@query(
    "histogram",
    """WITH r AS (SELECT c_mktsegment, min(c_acctbal) AS lo, max(c_acctbal) AS hi
           FROM customer GROUP BY 1),
c AS (SELECT c_mktsegment, least(floor(15::DOUBLE * (c_acctbal - lo) / (hi - lo)) + 1, 15)::INT
             AS bin, count(*) AS n
      FROM customer JOIN r USING (c_mktsegment) GROUP BY 1, 2),
g AS (SELECT c_mktsegment, lo, hi, unnest(range(1, 16))::INT AS bin FROM r)
SELECT c_mktsegment, bin, round(lo + (bin - 1) * ((hi - lo) / 15), 4) AS "left",
       round(lo + bin * ((hi - lo) / 15), 4) AS "right", coalesce(n, 0) AS n
FROM g LEFT JOIN c USING (c_mktsegment, bin)""",
)
def histogram(spark, sf_dir):
    bins = ops.histogram(load_table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal")
    return bins.withColumns({c: F.round(c, 4) for c in ("left", "right")})


@query(
    "box_stats",
    f"""WITH {LINES_SQL},
q AS (SELECT l_returnflag, quantile_cont(net, 0.25) AS q1, quantile_cont(net, 0.5) AS median,
             quantile_cont(net, 0.75) AS q3 FROM lines GROUP BY 1),
j AS (SELECT *, net BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)
             AS inside FROM lines JOIN q USING (l_returnflag))
SELECT l_returnflag, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median,
       round(any_value(q3), 4) AS q3,
       round(least(min(net) FILTER (inside), any_value(q1)), 4) AS whisker_low,
       round(greatest(max(net) FILTER (inside), any_value(q3)), 4) AS whisker_high,
       count(*) FILTER (NOT inside) AS n_outliers
FROM j GROUP BY 1""",
)
def box_stats(spark, sf_dir):
    box = ops.box_stats(lines(spark, sf_dir, "l_returnflag"), "l_returnflag", "net")
    numbers = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return box.withColumns({c: F.round(c, 4) for c in numbers})


@query(
    "scatter_points",
    "SELECT l_quantity, l_extendedprice, l_returnflag FROM lineitem",
)
def scatter_points(spark, sf_dir):
    table = load_table(spark, sf_dir, "lineitem")
    return ops.scatter_points(table, "l_quantity", "l_extendedprice", "l_returnflag")
