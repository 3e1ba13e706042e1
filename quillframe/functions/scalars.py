"""Column expressions; all stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def known(col: str | Column) -> Column:
    """The value, with NaN as NULL: every operator takes both for missing."""
    value = F.col(col) if isinstance(col, str) else col
    return F.when(~F.isnan(value), value)


def preview(text: Column, n: int) -> Column:
    """The first ``n`` characters, with ``...`` only when something was cut."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(
        text
    )


def round_to(col: Column, digits: int) -> Column:
    return F.round(col, digits)


def softmax(logits: Column) -> Column:
    """Probabilities of an array of logits, shifted by the largest so that none overflows."""
    powers = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(powers, lambda x: x / total)


def softmax_argmax(logits: Column) -> Column:
    """Struct of class probabilities, the winning class (0-based, first on ties), its share."""
    probabilities = softmax(logits)
    return F.struct(
        probabilities.alias("probabilities"),
        (F.array_position(logits, F.array_max(logits)) - 1).cast("int").alias("prediction"),
        F.array_max(probabilities).alias("confidence"),
    )


def confidence_bar(share: Column, width: int = 20) -> Column:
    """A text bar: ``int(share * width)`` filled cells out of ``width``."""
    filled = (share * width).cast("int")
    return F.concat(F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(width) - filled))


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is 0."""
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def signed_direction(weight: Column) -> Column:
    """``up`` for a positive weight, else ``down``."""
    return F.when(weight > 0, F.lit("up")).otherwise(F.lit("down"))


def zero_if_undefined(part: Column, whole: Column) -> Column:
    """``part / whole`` with 0 for a zero divisor, the usual rule for undefined ratios."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def map_codes(col: Column, names: Mapping[Any, Any]) -> Column:
    """Look a code up in a small fixed dictionary; unknown codes give NULL."""
    pairs = [F.lit(v) for item in names.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), col)
