"""Spoiling, checking and cleaning tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillframe.functions.hashing import hash_below
from quillframe.functions.scalars import map_codes
from quillframe.operators.joins import MAX_BROADCAST_ROWS, join_small
from quillframe.operators.ordered import add_row_index
from quillframe.operators.quantiles import quantiles
from quillframe.operators.sampling import sample_n
from quillframe.sources.artifacts import materialize


def is_missing(df: DataFrame, col: str) -> Column:
    """NULL, or NaN in a floating column."""
    missing = F.col(col).isNull()
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(col)
    return missing


def inject_nulls(
    df: DataFrame, fractions: Mapping[str, float], key: Sequence[str], seed: int = 42
) -> DataFrame:
    """Blank a seeded share of the named columns."""
    blanked = {
        c: F.when(~hash_below(key, share, seed, f"null/{c}"), F.col(c))
        for c, share in fractions.items()
    }
    return df.select(*[blanked.get(c, F.col(c)).alias(c) for c in df.columns])


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both, copies kept, columns matched by name."""
    return a.unionByName(b)


def inject_duplicates(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Append ``n`` sampled rows again."""
    return union_all(df, sample_n(df, n, key, seed))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Distinct whole rows; NULL equals NULL and NaN equals NaN."""
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """How many rows repeat another one."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("n_duplicates"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def impute_report(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """(feature, n_missing, median) of each column."""
    medians = quantiles(df, cols, [0.5], exact=exact).select("feature", F.col("value").alias("median"))
    counted = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in cols])
    long = counted.unpivot([], list(cols), "feature", "n_missing")
    return join_small(long, medians, ["feature"], "left")


def impute_median(
    df: DataFrame,
    cols: Sequence[str],
    medians: Mapping[str, float] | None = None,
    exact: bool = True,
) -> DataFrame:
    """Fill missing cells with the column's median: one number per column, put in as a constant."""
    if medians is None:
        table = quantiles(df, cols, [0.5], exact=exact)
        medians = {r["feature"]: r["value"] for r in table.toLocalIterator()}
    filled = {
        c: F.when(is_missing(df, c), F.lit(medians[c])).otherwise(F.col(c))
        for c in cols
        if c in medians
    }
    return df.select(*[filled.get(c, F.col(c)).alias(c) for c in df.columns])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Change column types; double to int cuts toward zero."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def select_features(df: DataFrame, target: str | Sequence[str]) -> DataFrame:
    """All columns but the target."""
    return df.drop(*([target] if isinstance(target, str) else target))


def map_labels(
    df: DataFrame,
    col: str,
    names: Mapping[Any, Any] | DataFrame,
    output: str,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Name a code, from a dictionary or from a two-column table (code, name).

    A table is broadcast when it is counted to be small and joined by shuffle otherwise.
    """
    if isinstance(names, DataFrame):
        code, name = names.columns
        pairs = names.select(F.col(code).alias(col), F.col(name).alias(output))
        return join_small(df, pairs, [col], "left", max_rows)
    return df.withColumn(output, map_codes(F.col(col), names))


def filter_eq(df: DataFrame, col: str, value: Any) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def null_counts(df: DataFrame, total: str = "TOTAL") -> DataFrame:
    """Missing cells per column and, as the row ``total``, in all, from one pass."""
    counts = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in df.columns])
    every = sum((F.col(c) for c in df.columns), F.lit(0).cast("long"))
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in df.columns]
    rows.append(F.struct(F.lit(total).alias("column"), every.alias("n_missing")))
    return counts.select(F.inline(F.array(*rows)))


def expect_no_nulls(df: DataFrame, strict: bool = False) -> DataFrame:
    """Columns that hold missing cells, with how many; none when the table is clean.

    With ``strict`` the query fails instead when it runs and finds any.
    """
    counts = null_counts(df).where(F.col("column") != "TOTAL")
    found = counts.where(F.col("n_missing") > 0)
    if strict:
        message = F.concat(F.lit("missing values in "), F.col("column"))
        clean = F.assert_true(F.col("n_missing") == 0, message)
        found = counts.where(clean.isNotNull())
    return found


def clean(
    df: DataFrame,
    impute: Sequence[str],
    types: Mapping[str, str],
    key: Sequence[str],
    exact: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """De-duplicate, fill missing cells, cast, and number the rows.

    Returns the clean table and its report: rows before, after and removed, missing cells before
    and after. Distinct rows cost a shuffle of the whole table, so they are written out once; the
    medians then read their own columns only.
    """
    distinct = materialize(drop_duplicates(df), "distinct")
    filled = cast_columns(impute_median(distinct, impute, exact=exact), types)
    result = add_row_index(filled, key)

    def facts(frame: DataFrame, name: str) -> DataFrame:
        missing = sum((is_missing(frame, c).cast("long") for c in frame.columns), F.lit(0))
        return frame.agg(
            F.lit(name).alias("stage"),
            F.count("*").alias("rows"),
            F.coalesce(F.sum(missing), F.lit(0)).alias("missing"),
        )

    stages = union_all(facts(df, "before"), facts(result.drop("row_index"), "after"))
    at = lambda stage, col: F.max(F.when(F.col("stage") == stage, F.col(col)))
    report = stages.agg(
        at("before", "rows").alias("rows_before"),
        at("after", "rows").alias("rows_after"),
        (at("before", "rows") - at("after", "rows")).alias("rows_removed"),
        at("before", "missing").alias("missing_before"),
        at("after", "missing").alias("missing_after"),
    )
    return result, report
