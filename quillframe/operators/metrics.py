"""Measuring predictions. Every function reads a scored table; none needs the model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.functions.scalars import known, zero_if_undefined
from quillframe.operators.joins import join_small, settle
from quillframe.operators.models import predict
from quillframe.operators.ordered import running_totals
from quillframe.sources.artifacts import materialize

# --- numbers ---------------------------------------------------------------------------------


def _error_sums(scored: DataFrame, y: str, pred: str) -> DataFrame:
    error = F.col(y) - F.col(pred)
    sums = scored.where(known(error).isNotNull()).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(y).alias("_spread"),
    )
    # 1 - SSE/SST; a constant target scores 1 when hit exactly and 0 otherwise.
    r2 = F.when(F.col("_spread") > 0, 1 - F.try_divide(F.col("mse"), F.col("_spread"))).when(
        F.col("_spread") == 0, (F.col("mse") == 0).cast("double")
    )
    return sums.select("n", "mae", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"))


def mae(scored: DataFrame, y: str, pred: str) -> DataFrame:
    return _error_sums(scored, y, pred).select("mae")


def mse(scored: DataFrame, y: str, pred: str) -> DataFrame:
    return _error_sums(scored, y, pred).select("mse")


def rmse(scored: DataFrame, y: str, pred: str) -> DataFrame:
    return _error_sums(scored, y, pred).select("rmse")


def r2(scored: DataFrame, y: str, pred: str) -> DataFrame:
    return _error_sums(scored, y, pred).select("r2")


def regression_report(
    scored: DataFrame, y: str, pred: str, unit: float = 100_000.0, good_r2: float = 0.5
) -> DataFrame:
    """All regression metrics in one pass, the error in money (``mae × unit``), and a fit flag."""
    return _error_sums(scored, y, pred).select(
        "*", (F.col("mae") * unit).alias("mae_money"), (F.col("r2") > good_r2).alias("good_fit")
    )


def actual_vs_predicted(scored: DataFrame, y: str, pred: str) -> DataFrame:
    """Points of the plot with the ends of its identity line beside each."""
    ends = scored.agg(
        F.least(F.min(y), F.min(pred)).alias("lo"), F.greatest(F.max(y), F.max(pred)).alias("hi")
    )
    return scored.select(
        F.col(y).alias("actual"),
        F.col(pred).alias("predicted"),
        ends.select("lo").scalar().alias("line_lo"),
        ends.select("hi").scalar().alias("line_hi"),
    )


# --- classes ---------------------------------------------------------------------------------


def _pairs(scored: DataFrame, y: str, pred: str) -> DataFrame:
    """(y_true, y_pred, n): all the class metrics need; rows without either class are left out."""
    rows = scored.where(F.col(y).isNotNull() & F.col(pred).isNotNull())
    return rows.groupBy(F.col(y).alias("y_true"), F.col(pred).alias("y_pred")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(
    scored: DataFrame, y: str, pred: str, labels: Sequence[Any] | None = None
) -> DataFrame:
    """Counts by (true, predicted) class, zeros included.

    Without ``labels`` the classes are those seen; the list is the side of the matrix returned, so
    it is always smaller than the result.
    """
    counts = settle(_pairs(scored, y, pred))
    kind = counts.schema["y_true"].dataType
    seen = counts.select(
        F.explode(F.array("y_true", F.col("y_pred").cast(kind))).alias("label")
    ).distinct()
    if labels is None:
        classes = seen.agg(F.sort_array(F.collect_list("label"))).scalar()
        grid = seen.select(F.col("label").alias("y_true"), F.explode(classes).alias("y_pred"))
    else:
        rows = [(a, b) for a in labels for b in labels]
        grid = scored.sparkSession.createDataFrame(
            rows, f"y_true {kind.simpleString()}, y_pred {kind.simpleString()}"
        )
    counts = counts.withColumn("y_pred", F.col("y_pred").cast(kind))
    return join_small(grid, counts, ["y_true", "y_pred"], "left").select(
        "y_true", "y_pred", F.coalesce("n", F.lit(0)).alias("n")
    )


def class_counts(y: str, pred: str, pos_label: Any = 1) -> dict[str, Column]:
    """Aggregates tp, fp, fn, tn for one positive class, to use in any ``agg``."""
    is_pos, said_pos = F.col(y) == F.lit(pos_label), F.col(pred) == F.lit(pos_label)
    return {
        "tp": F.count_if(is_pos & said_pos),
        "fp": F.count_if(~is_pos & said_pos),
        "fn": F.count_if(is_pos & ~said_pos),
        "tn": F.count_if(~is_pos & ~said_pos),
    }


def rates() -> list[Column]:
    """accuracy, precision, recall and f1 from columns tp, fp, fn, tn; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return [
        zero_if_undefined(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        zero_if_undefined(tp, tp + fp).alias("precision"),
        zero_if_undefined(tp, tp + fn).alias("recall"),
        zero_if_undefined(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def binary_metrics(scored: DataFrame, y: str, pred: str, pos_label: Any = 1) -> DataFrame:
    """accuracy, precision, recall and F1 for one class called positive, in one pass."""
    counts = class_counts(y, pred, pos_label)
    return scored.agg(*[c.alias(n) for n, c in counts.items()]).select(*rates())


def classification_report(scored: DataFrame, y: str, pred: str) -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and weighted averages.

    One pass makes the (true, predicted) counts; everything else works on that small table.
    """
    pairs = settle(_pairs(scored, y, pred))
    right = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    kind = pairs.schema["y_true"].dataType

    def side(label: Column, tp: Column, support: Column, said: Column) -> Column:
        return F.struct(
            label.cast(kind).cast("string").alias("label"),
            tp.alias("tp"),
            support.alias("support"),
            said.alias("said"),
        )

    sides = pairs.select(
        F.inline(
            F.array(
                side(F.col("y_true"), right, F.col("n"), none),
                side(F.col("y_pred"), none, none, F.col("n")),
            )
        )
    )
    tp, said, support = F.sum("tp"), F.sum("said"), F.sum("support")
    classes = sides.groupBy("label").agg(
        zero_if_undefined(tp, said).alias("precision"),
        zero_if_undefined(tp, support).alias("recall"),
        zero_if_undefined(2 * tp, said + support).alias("f1"),
        support.alias("support"),
    )
    total = F.sum("support")
    weighted = lambda c: zero_if_undefined(F.sum(F.col(c) * F.col("support")), total).alias(c)
    parts = ["precision", "recall", "f1"]
    macro = classes.agg(
        F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in parts], total.alias("support")
    )
    by_support = classes.agg(
        F.lit("weighted avg").alias("label"), *[weighted(c) for c in parts], total.alias("support")
    )
    # Recall weighted by support is the share of rows predicted right.
    accuracy = by_support.select(
        F.lit("accuracy").alias("label"),
        *[F.col("recall").alias(c) for c in parts],
        "support",
    )
    return classes.unionByName(accuracy).unionByName(macro).unionByName(by_support)


# --- scores ----------------------------------------------------------------------------------


def _by_score(
    scored: DataFrame, y: str, prob: str, pos_label: Any, digits: int | None
) -> DataFrame:
    score = F.col(prob) if digits is None else F.round(prob, digits)
    rows = scored.where(F.col(y).isNotNull() & known(prob).isNotNull())
    return rows.groupBy(score.alias("score")).agg(
        F.count_if(F.col(y) == F.lit(pos_label)).alias("pos"),
        F.count_if(F.col(y) != F.lit(pos_label)).alias("neg"),
    )


def roc_auc(
    scored: DataFrame, y: str, prob: str, pos_label: Any = 1, digits: int | None = None
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL when a class is missing.

    Rows are counted per distinct score first, then ordered by range partitions, so no task sees
    all scores. ``digits`` rounds scores for a cheaper, approximate answer.
    """
    counts = _by_score(scored, y, prob, pos_label, digits)
    running = running_totals(counts, ["score"], {"_neg_upto": "neg"})
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    won = pos * (F.col("_neg_upto").cast("double") - neg / 2)
    pairs = F.sum(pos) * F.sum(neg)
    return running.agg(F.try_divide(F.sum(won), pairs).alias("roc_auc"))


def roc_curve(
    scored: DataFrame, y: str, prob: str, pos_label: Any = 1, digits: int | None = None
) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, after the (0, 0) point at infinity."""
    counts = _by_score(scored, y, prob, pos_label, digits)
    running = running_totals(
        counts.withColumn("_down", -F.col("score")), ["_down"], {"_tp": "pos", "_fp": "neg"}
    )
    sizes = running.agg(F.max("_tp").alias("pos"), F.max("_fp").alias("neg"))
    share = lambda upto, whole: F.try_divide(
        F.col(upto).cast("double"), sizes.select(F.col(whole).cast("double")).scalar()
    )
    points = running.select(
        F.col("score").alias("threshold"),
        share("_fp", "neg").alias("fpr"),
        share("_tp", "pos").alias("tpr"),
    )
    start = scored.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def evaluate_scored(
    scored: DataFrame, name: str, y: str, pred: str, prob: str, pos_label: Any = 1
) -> DataFrame:
    """One row of all headline metrics for a named model."""
    area = roc_auc(scored, y, prob, pos_label).scalar()
    metrics = binary_metrics(scored, y, pred, pos_label)
    return metrics.select(F.lit(name).alias("model"), "*", area.alias("roc_auc"))


class Evaluation(Mapping):
    """Parts of an evaluation by name; each is computed when it is asked for, and once."""

    def __init__(self, parts: dict[str, Callable[[], DataFrame]]) -> None:
        self._parts = parts
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._parts[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._parts)

    def __len__(self) -> int:
        return len(self._parts)


def evaluate(
    model: Model, df: DataFrame, name: str, label: str = "label", pos_label: Any = 1
) -> Evaluation:
    """Score a table; its metrics, class report, confusion matrix and ROC curve on request.

    The three columns these read are written out first, so the model runs once.
    """
    scored = materialize(predict(model, df).select(label, "prediction", "prob"), "scored")
    return Evaluation(
        {
            "metrics": lambda: evaluate_scored(scored, name, label, "prediction", "prob", pos_label),
            "report": lambda: classification_report(scored, label, "prediction"),
            "confusion": lambda: confusion_matrix(scored, label, "prediction"),
            "roc": lambda: roc_curve(scored, label, "prob", pos_label),
        }
    )
