"""Train/test splits and cross-validation folds, repeatable for a key and a seed.

Rows with the same key fall on the same side, so copies cannot leak from train to test. A split of
exact size, by class or not, divides the one key at its border by the digest of the row, so that only
identical rows can make it inexact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillframe.functions.hashing import hash_below, hash_hex
from quillframe.operators.joins import join_small, settle
from quillframe.operators.models import training_rows
from quillframe.operators.sampling import hash_cutoffs, row_digest
from quillframe.operators.scaling import scale_and_assemble


def _side(is_test: Column) -> Column:
    return F.when(is_test, F.lit("test")).otherwise(F.lit("train"))


def split(
    df: DataFrame, test_size: float, key: Sequence[str], seed: int = 42, exact: bool = False
) -> DataFrame:
    """Add ``split`` = ``train`` / ``test``.

    By default one comparison per row, with the share right on average. ``exact=True`` puts
    ``ceil(n * test_size)`` rows in test, for one more pass: of the rows that share the key at the
    border, those of lower row digest go to test, so only identical rows can make it inexact.
    """
    if not exact:
        return df.withColumn("split", _side(hash_below(key, test_size, seed, "split")))
    hashed = df.withColumn("_h", row_digest(df, key, seed, "split"))
    targets = lambda sizes: sizes.select(
        F.lit(0).alias("slot"), F.ceil(F.col("n") * F.lit(test_size)).alias("target")
    )
    own = hash_hex(key, seed, "split")
    cutoff = hash_cutoffs(hashed, targets, key_digest=own).first()["cutoff"]
    return hashed.withColumn("split", _side(F.col("_h") <= cutoff)).drop("_h")


def allocate_test_rows(classes: DataFrame, label: str, test_size: float) -> DataFrame:
    """Test rows per class from (label, n): shares rounded down, what is left over going to the
    largest remainders, so that the total is ``ceil(n * test_size)``."""
    total = classes.agg(F.sum("n").alias("n"))
    wanted = total.select(F.ceil(F.col("n") * F.lit(test_size))).scalar()
    share = F.col("n") * wanted / total.scalar()
    floors = classes.select(
        label, "n", F.floor(share).alias("base"), (share - F.floor(share)).alias("_rest")
    )
    left = wanted - floors.agg(F.sum("base")).scalar()
    ranked = floors.withColumn(
        "_order", F.row_number().over(W.orderBy(F.desc(F.round("_rest", 9)), label))
    )
    return ranked.select(
        label, "n", (F.col("base") + (F.col("_order") <= left).cast("long")).alias("target")
    )


def stratified_split(
    df: DataFrame, test_size: float, label: str, key: Sequence[str], seed: int = 42
) -> DataFrame:
    """Add ``split`` with the class shares of the whole table on both sides.

    Of the rows that share the key at a class's border, those of lower row digest go to test.
    """
    hashed = df.withColumn("_h", row_digest(df, key, seed, "split"))
    targets = lambda classes: allocate_test_rows(settle(classes), label, test_size).select(
        label, F.lit(0).alias("slot"), "target"
    )
    own = hash_hex(key, seed, "split")
    cutoffs = hash_cutoffs(hashed, targets, [label], key_digest=own).select(label, "cutoff")
    joined = join_small(hashed, cutoffs, [label], "left")
    return joined.withColumn("split", _side(F.col("_h") <= F.col("cutoff"))).drop("_h", "cutoff")


def stratified_kfold(
    df: DataFrame, k: int, label: str, key: Sequence[str], seed: int = 42
) -> DataFrame:
    """Add ``fold`` 0..k-1. A class of n rows gives fold i the random-order ranks from
    ``i*n // k`` up to ``(i+1)*n // k``, so its fold sizes differ by at most one row. Rows that share a key at a border
    are told apart by the digest of the row."""
    hashed = df.withColumn("_h", row_digest(df, key, seed, "fold"))
    slots = F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("slot")
    targets = lambda classes: classes.select(label, "n", slots).select(
        label, "slot", F.floor(F.col("slot") * F.col("n") / k).alias("target")
    )
    cutoffs = hash_cutoffs(hashed, targets, [label], key_digest=hash_hex(key, seed, "fold"))
    # k - 1 cutoffs per class, in one array.
    per_class = cutoffs.groupBy(label).agg(F.collect_list("cutoff").alias("_cutoffs"))
    joined = join_small(hashed, per_class, [label], "left")
    passed = F.size(F.filter("_cutoffs", lambda c: F.col("_h") > c))
    return joined.withColumn("fold", passed.cast("int")).drop("_h", "_cutoffs")


def split_validation(
    df: DataFrame, test_size: float, validation_size: float, key: Sequence[str], seed: int = 42
) -> DataFrame:
    """Add ``split`` = ``train`` / ``validation`` / ``test``: the test side is that of ``split``, and
    the validation side a share of the rest, chosen by a digest of its own."""
    test = hash_below(key, test_size, seed, "split")
    held = hash_below(key, validation_size / (1 - test_size), seed, "validation")
    side = F.when(test, "test").when(held, "validation").otherwise("train")
    return df.withColumn("split", side)


def split_audit(df: DataFrame, label: str) -> DataFrame:
    """Rows per side and class."""
    return df.groupBy("split", label).agg(F.count("*").alias("n"))


def grid_search(
    df: DataFrame,
    estimator: Callable[..., Estimator],
    grid: Mapping[str, Sequence[Any]],
    k: int,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    seed: int = 42,
    prepare: Callable | None = None,
    at_once: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """Accuracy of every setting of ``grid`` on every fold, and the settings from best to worst.

    ``estimator(n_train, **setting)`` makes what is fitted. Folds and ``prepare`` are those of
    :func:`cross_validate`; a fold is readied and cached once, and ``at_once`` settings are fitted on
    it at a time. The first table has (setting, its values, fold, n, accuracy); the second
    (rank, setting, its values, cv_mean, cv_std), the highest mean first, then the lowest spread
    over folds, then the setting listed first.
    """
    prepare = prepare or scale_and_assemble
    names = list(grid)
    settings = [dict(zip(names, values)) for values in product(*grid.values())]
    columns = dict.fromkeys([*key, *features, label])
    rows = []
    folds = stratified_kfold(df.select(*columns), k, label, key, seed)
    with training_rows(folds.select(*dict.fromkeys([*features, label, "fold"]))) as (folded, _):
        sizes = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
        for fold in range(k):
            n_train = sum(n for f, n in sizes.items() if f != fold)
            ready = prepare(folded.where(F.col("fold") != fold), features)
            whole = ready(folded).withColumnRenamed(label, "label")
            whole = whole.select("fold", "label", "features").persist()
            train, held = whole.where(F.col("fold") != fold), whole.where(F.col("fold") == fold)

            def right(setting: dict[str, Any]) -> tuple[int, float]:
                model = estimator(n_train, **setting).fit(train)
                hit = (F.col("prediction") == F.col("label")).cast("double")
                return tuple(model.transform(held).agg(F.count("*"), F.avg(hit)).first())

            try:
                with ThreadPool(min(at_once, len(settings))) as pool:
                    for i, found in enumerate(pool.map(right, settings)):
                        rows.append((i, *settings[i].values(), fold, *found))
            finally:
                whole.unpersist()
    kinds = {float: "double", int: "long", str: "string", bool: "boolean"}
    own = "".join(f"`{n}` {kinds[type(grid[n][0])]}, " for n in names)
    folds = df.sparkSession.createDataFrame(rows, f"setting int, {own}fold int, n long, accuracy double")
    summary = folds.groupBy("setting", *names).agg(
        F.avg("accuracy").alias("cv_mean"), F.stddev_pop("accuracy").alias("cv_std")
    )
    # One row for each setting.
    best = W.orderBy(F.desc(F.round("cv_mean", 12)), F.round("cv_std", 12), "setting")
    ranked = summary.select(F.row_number().over(best).alias("rank"), "setting", *names, "cv_mean", "cv_std")
    return folds, ranked


def cross_validate(
    df: DataFrame,
    estimator: Estimator | Callable[[int], Estimator],
    k: int,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    seed: int = 42,
    prepare: Callable | None = None,
    at_once: int = 5,
) -> tuple[DataFrame, DataFrame]:
    """Accuracy per fold, and its mean with population deviation.

    ``estimator`` may be a function of the number of training rows, for settings that depend on it.
    ``prepare(train, features)`` returns a function that readies any frame for the estimator; it
    sees the training folds only, so nothing leaks from the held-out fold. By default it scales
    and assembles. ``at_once`` folds are fitted at a time; a model is dropped when its fold is scored.
    """
    prepare = prepare or scale_and_assemble
    columns = dict.fromkeys([*key, *features, label])
    folds = stratified_kfold(df.select(*columns), k, label, key, seed)
    # Keys tell folds apart and are not kept in memory after that.
    with training_rows(folds.select(*dict.fromkeys([*features, label, "fold"]))) as (folded, _):
        sizes = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}

        def right(fold: int) -> tuple[int, int, float]:
            train = folded.where(F.col("fold") != fold)
            n_train = sum(n for f, n in sizes.items() if f != fold)
            whole = prepare(train, features)(folded).withColumnRenamed(label, "label")
            fitter = estimator if isinstance(estimator, Estimator) else estimator(n_train)
            model = fitter.fit(whole.where(F.col("fold") != fold))
            hit = (F.col("prediction") == F.col("label")).cast("double")
            scored = model.transform(whole.where(F.col("fold") == fold))
            return (fold, *scored.agg(F.count("*"), F.avg(hit)).first())

        with ThreadPool(min(at_once, k)) as pool:
            found = [row for row in pool.map(right, range(k), 1) if row[1]]
    folds = df.sparkSession.createDataFrame(found, "fold int, n long, accuracy double")
    summary = folds.agg(
        F.avg("accuracy").alias("cv_mean"), F.stddev_pop("accuracy").alias("cv_std")
    )
    return folds, summary
