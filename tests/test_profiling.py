from __future__ import annotations

import numpy as np
import pytest
from conftest import SF_SMALL, rows_of
from pyspark.sql import functions as F

from quillframe.operators import profiling as ops
from quillframe.operators.quantiles import quantiles
from quillframe.plans.standins import lines


@pytest.fixture
def even4(table):
    return table([("a", float(i)) for i in range(1, 5)], "g string, x double")


def test_describe_interpolates_quartiles(even4):
    row = ops.describe(even4, ["x"]).first()
    assert (row["count"], row["mean"], row["min"], row["max"]) == (4, 2.5, 1.0, 4.0)
    assert (row.q25, row.q50, row.q75) == (1.75, 2.5, 3.25)
    assert row["std"] == pytest.approx(np.std([1, 2, 3, 4], ddof=1))


def test_describe_counts_only_known_values(table):
    df = table([(1.0,), (2.0,), (float("nan"),), (None,), (10.0,)], "x double")
    row = ops.describe(df, ["x"], 3).first()
    assert (row["count"], row.q50, row["max"]) == (3, 2.0, 10.0)


@pytest.mark.parametrize("limits", [{}, {"accuracy": 50}, {"accuracy": 100, "max_bracket": 20}])
def test_quantiles_are_exact_for_any_bracket(spark, limits):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.hash("id") / 1e6).alias("x"),
        (F.col("id") % 2).alias("g"),
    )
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 1.0]
    got = quantiles(df, ["x"], probs, ["g"], **limits).collect()
    values = df.toPandas()
    assert len(got) == 12
    for row in got:
        expected = np.quantile(values.x[values.g == row.g], row.prob)
        assert row.value == pytest.approx(expected, rel=1e-12)


@pytest.mark.parametrize("side", ["lo", "hi"])
def test_a_bracket_that_misses_is_opened(spark, monkeypatch, side):
    from quillframe.operators import quantiles as module

    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    sketch = module._sketch
    # Brackets wholly above, or wholly below, the wanted rank.
    off = {"lo": (998.0, 999.0), "hi": (-5.0, -1.0)}[side]
    monkeypatch.setattr(
        module,
        "_sketch",
        lambda *args: sketch(*args).withColumns({"lo": F.lit(off[0]), "hi": F.lit(off[1])}),
    )
    got = {r.prob: r.value for r in quantiles(df, ["x"], [0.25, 0.5]).collect()}
    assert got == {0.25: 249.75, 0.5: 499.5}


def test_quantiles_of_null_group(table):
    df = table([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None)], "g string, x double")
    got = {r.g: r.value for r in quantiles(df, ["x"], [0.5], ["g"]).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_many_groups_take_the_shuffle_join(spark, monkeypatch):
    from quillframe.operators import joins

    monkeypatch.setattr(joins.settle, "__defaults__", (10,))
    monkeypatch.setattr(joins.join_small, "__defaults__", ("inner", 10))
    df = spark.range(2000).select((F.col("id") % 100).alias("g"), F.col("id").cast("double").alias("x"))
    got = {r.g: r.value for r in quantiles(df, ["x"], [0.5], ["g"]).collect()}
    assert got == {g: 950.0 + g for g in range(100)}


def test_approximate_quantiles_are_near(spark):
    df = lines(spark, SF_SMALL)
    exact = {(r.feature, r.prob): r.value for r in quantiles(df, ["net"], [0.1, 0.9]).collect()}
    rough = quantiles(df, ["net"], [0.1, 0.9], exact=False).collect()
    for r in rough:
        assert r.value == pytest.approx(exact[r.feature, r.prob], rel=0.02)


def test_histogram_closes_the_last_bin(table):
    df = table([("a", float(i)) for i in range(16)], "g string, x double")
    counts = {r.bin: r.n for r in ops.histogram(df, "g", "x", 15).collect()}
    assert counts == {**dict.fromkeys(range(1, 15), 1), 15: 2}


def test_histogram_keeps_empty_bins_and_single_values(table):
    df = table([("a", 0.0), ("a", 15.0), ("b", 3.0)], "g string, x double")
    bins = ops.histogram(df, "g", "x", 15)
    assert bins.count() == 30
    assert {r.g: r.n for r in bins.groupBy("g").agg(F.sum("n").alias("n")).collect()} == {"a": 2, "b": 1}


def test_box_stats_whiskers_and_outliers(table):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    row = ops.box_stats(table([("a", v) for v in values], "g string, x double"), "g", "x").first()
    assert (row.q1, row["median"], row.q3) == (2.25, 3.5, 4.75)
    assert (row.whisker_low, row.whisker_high, row.n_outliers) == (1.0, 5.0, 1)


def test_value_counts_and_shape(table):
    df = table([("a",), ("a",), ("b",), (None,)], "v string")
    assert [tuple(r) for r in ops.value_counts(df, "v").collect()] == [
        ("a", 2, 50.0),
        (None, 1, 25.0),
        ("b", 1, 25.0),
    ]
    assert tuple(ops.shape(df).first()) == (4, 1)
    assert rows_of(ops.schema_table(df)) == [(0, "v", "string", 3)]


def test_group_mean_order_and_headroom(table):
    df = table([("a", 4.0), ("b", 1.0), ("b", 3.0)], "g string, x double")
    assert [tuple(r) for r in ops.group_mean(df, "g", "x").collect()] == [
        ("b", 2.0, pytest.approx(4.8)),
        ("a", 4.0, pytest.approx(4.8)),
    ]


def test_scatter_points_are_repeatable(spark):
    df = lines(spark, SF_SMALL, "l_returnflag")
    args = ("l_quantity", "net", "l_returnflag", 100, ["l_orderkey", "l_partkey", "net"])
    one = ops.scatter_points(df, *args)
    other = ops.scatter_points(df.repartition(7), *args)
    assert one.count() == 100 and rows_of(one) == rows_of(other)


def test_nan_is_missing_everywhere(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", float("nan")), ("a", None), ("a", 10.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(3)
    plain = df.where("x is not null and not isnan(x)")
    from quillframe.operators import metrics, scaling

    for f in (
        lambda t: ops.histogram(t, "g", "x", 4),
        lambda t: ops.box_stats(t, "g", "x"),
        lambda t: ops.group_mean(t, "g", "x"),
        lambda t: scaling.fit_scaler(t, ["x"]),
        lambda t: metrics.regression_report(t.withColumn("y", F.lit(1.0)), "y", "x"),
    ):
        assert f(df).collect() == f(plain).collect()
    schema = {r.column: (r.type, r.n_known) for r in ops.schema_table(df).collect()}
    assert schema == {"g": ("string", 5), "x": ("double", 3)}


def test_missing_classes_are_left_out(spark):
    from quillframe.operators import metrics

    df = spark.createDataFrame([(1, 1), (0, 1), (None, 1), (1, None)], "y int, p int")
    plain = df.where("y is not null and p is not null")
    report = lambda t: sorted(map(str, metrics.classification_report(t, "y", "p").collect()))
    assert report(df) == report(plain)
    matrix = metrics.confusion_matrix(df, "y", "p")
    assert sorted(map(tuple, matrix.collect())) == [(0, 0, 0), (0, 1, 1), (1, 0, 0), (1, 1, 1)]
