from __future__ import annotations

import math

import pytest
from conftest import SF_SMALL, rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quillframe.operators import cleaning as ops
from quillframe.functions.hashing import hash_hex
from quillframe.operators import sampling
from quillframe.operators.ordered import add_row_index
from quillframe.plans.standins import LINE_KEY, lines
from quillframe.sources.tables import load_table, nan_to_null

NAN = float("nan")


@pytest.fixture
def nan_null(table):
    return table([(1, 1.0), (2, 2.0), (3, NAN), (4, None), (5, 10.0)], "id int, x double")


def test_nan_becomes_null(nan_null):
    loaded = nan_to_null(nan_null)
    assert loaded.where("x is null").count() == 2
    assert loaded.agg(F.median("x")).first()[0] == 2.0


def test_median_fill_skips_nan_and_null(nan_null):
    filled = ops.impute_median(nan_null, ["x"])
    assert rows_of(filled) == [(1, 1.0), (2, 2.0), (3, 2.0), (4, 2.0), (5, 10.0)]
    report = ops.impute_report(nan_null, ["x"]).first()
    assert (report.feature, report.n_missing, report["median"]) == ("x", 2, 2.0)


def test_even_median_interpolates(table):
    df = table([(float(i),) for i in range(1, 5)] + [(None,)], "x double")
    assert ops.impute_median(df, ["x"]).where("x = 2.5").count() == 1


def test_all_missing_column_stays_missing(table):
    df = table([(None,), (NAN,)], "x double")
    assert ops.impute_median(df, ["x"]).count() == 2
    assert ops.null_counts(df).where("column = 'x'").first().n_missing == 2


def test_duplicates_treat_nan_and_null_as_equal(nan_null):
    values = nan_null.select("x")
    twice = ops.union_all(values, values)
    assert ops.drop_duplicates(twice).count() == 5
    assert ops.duplicate_count(twice).first().n_duplicates == 5


def test_duplicate_count_of_empty_table(table):
    assert ops.duplicate_count(table([], "x int")).first().n_duplicates == 0


def test_null_checks(nan_null):
    counts = {r["column"]: r.n_missing for r in ops.null_counts(nan_null).collect()}
    assert counts == {"id": 0, "x": 2, "TOTAL": 2}
    assert rows_of(ops.expect_no_nulls(nan_null)) == [("x", 2)]
    assert ops.expect_no_nulls(nan_null.select("id")).count() == 0
    assert ops.expect_no_nulls(nan_null.select("id"), strict=True).count() == 0
    with pytest.raises(PySparkException):
        ops.expect_no_nulls(nan_null, strict=True).collect()


def test_cast_cuts_toward_zero(table):
    df = table([(2.9,), (-2.9,)], "x double")
    assert rows_of(ops.cast_columns(df, {"x": "int"})) == [(-2,), (2,)]


def test_label_lookup_by_dictionary_and_table(table):
    df = table([(0,), (1,), (7,), (None,)], "code int")
    expected = {0: "no", 1: "yes", 7: None, None: None}
    for names in ({0: "no", 1: "yes"}, table([(0, "no"), (1, "yes")], "c int, n string")):
        named = ops.map_labels(df, "code", names, "name")
        assert {r.code: r.name for r in named.collect()} == expected
    by_shuffle = ops.map_labels(df, "code", names, "name", max_rows=1)
    assert {r.code: r.name for r in by_shuffle.collect()} == expected


def test_spoiling_is_repeatable_and_near_its_share(spark):
    df = lines(spark, SF_SMALL)
    share = {"l_tax": 0.05, "l_discount": 0.0, "l_quantity": 1.0}
    one = ops.inject_nulls(df, share, LINE_KEY)
    other = ops.inject_nulls(df.repartition(8), share, LINE_KEY)
    assert one.exceptAll(other).isEmpty()
    n = df.count()
    counts = {r["column"]: r.n_missing for r in ops.null_counts(one).collect()}
    assert abs(counts["l_tax"] / n - 0.05) < 0.015
    assert counts["l_discount"] == 0 and counts["l_quantity"] == n


def test_clean_removes_what_was_spoiled(spark):
    df = lines(spark, SF_SMALL)
    spoiled = ops.inject_duplicates(ops.inject_nulls(df, {"l_tax": 0.1}, LINE_KEY), 50, LINE_KEY)
    result, report = ops.clean(spoiled, ["l_tax"], {"l_quantity": "int"}, [*LINE_KEY, "net"])
    facts = report.first()
    assert facts.rows_before == df.count() + 50
    assert facts.rows_after == df.count() and facts.rows_removed == 50
    assert facts.missing_before > 0 and facts.missing_after == 0
    index = result.agg(F.min("row_index"), F.max("row_index"), F.countDistinct("row_index")).first()
    assert tuple(index) == (0, facts.rows_after - 1, facts.rows_after)
    assert dict(result.dtypes)["l_quantity"] == "int"


def test_row_index_spreads_equal_keys(spark):
    # Every row has the same key: the number still runs through, over several partitions.
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id"))
    indexed = add_row_index(df.repartition(4), ["k"])
    got = indexed.agg(F.min("row_index"), F.max("row_index"), F.countDistinct("row_index")).first()
    assert tuple(got) == (0, 19_999, 20_000)


def test_row_index_follows_key_for_any_layout(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    for partitions in (1, 8):
        indexed = add_row_index(df.repartition(partitions), ["k"])
        assert indexed.where("row_index <> k").isEmpty()


def test_filters_reach_the_scan(spark):
    plan = (
        load_table(spark, SF_SMALL, "lineitem")
        .where("l_returnflag = 'A'")
        .select("l_quantity")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "EqualTo(l_returnflag,A)" in plan
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan


def test_median_value_is_finite(spark):
    report = ops.impute_report(lines(spark, SF_SMALL), ["net"]).first()
    assert report.n_missing == 0 and math.isfinite(report["median"])


def test_a_sample_looks_at_whole_rows_near_its_edge_only(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def costly(i):
        made.add(1)
        return i * 2

    rows = spark.range(3000).select("id", costly("id").alias("v"))
    found = {r.id: r.v for r in sampling.sample_n(rows, 5, ["id"]).collect()}
    assert len(found) == 5 and all(v == 2 * i for i, v in found.items())
    assert made.value < 300
    digests = spark.range(3000).select("id", hash_hex(["id"], 42, "sample").alias("h")).orderBy("h").limit(5)
    assert found.keys() == {r.id for r in digests.collect()}
