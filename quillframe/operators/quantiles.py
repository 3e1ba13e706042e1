"""Exact quantiles of columns of any size.

The built-in ``percentile`` keeps every distinct value of a group in one task. Here a sketch
brackets each wanted rank, a second pass counts what lies below the bracket and the distinct
values inside it, and the exact value is read off those counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillframe.operators.joins import join_small, settle
from quillframe.sources.artifacts import materialize


def _known(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The columns as doubles with NaN as NULL."""
    doubles = {c: F.col(c).cast("double") for c in cols}
    return df.select(*by, *[F.when(~F.isnan(d), d).alias(c) for c, d in doubles.items()])


def _cell(values: Column, index: Column) -> Column:
    return F.get(values, index.cast("int"))


def _rows(structs: Sequence[Column]) -> Column:
    """One row per struct: what each column or bracket of a wide aggregate holds."""
    return F.inline(F.array(*structs))


def _sketch(
    rows: DataFrame, cols: Sequence[str], by: list[str], probs: Sequence[float], accuracy: int
) -> DataFrame:
    """One bracket [lo, hi] per (group, feature, prob), with the two ranks it has to hold."""
    slack = 3.0 / accuracy
    edges = [min(max(p + side, 0.0), 1.0) for p in probs for side in (-slack, slack)]
    facts = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count(c).alias("n"),
            F.min(c).alias("_min"),
            F.max(c).alias("_max"),
            F.percentile_approx(c, edges, accuracy).alias("_edges"),
        ).alias(f"_c{j}")
        for j, c in enumerate(cols)
    ]
    sketched = rows.groupBy(*by).agg(*facts)
    sketched = sketched.select(*by, _rows([F.col(f"_c{j}") for j in range(len(cols))]))
    exploded = sketched.where(F.col("n") > 0).select(
        "*", F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_i", "prob")
    )
    place = (F.col("n") - 1) * F.col("prob")
    # A small group is its own bracket.
    few = F.col("n") <= accuracy
    return exploded.select(
        *by,
        "feature",
        "_i",
        "prob",
        "n",
        place.alias("place"),
        F.floor(place).alias("rank_lo"),
        F.ceil(place).alias("rank_hi"),
        F.when((F.col("prob") <= slack) | few, F.col("_min"))
        .otherwise(_cell(F.col("_edges"), F.col("_i") * 2))
        .alias("lo"),
        F.when((F.col("prob") >= 1 - slack) | few, F.col("_max"))
        .otherwise(_cell(F.col("_edges"), F.col("_i") * 2 + 1))
        .alias("hi"),
    )


class _Brackets:
    """Rows beside the brackets of their group: constants without groups, else one join per row."""

    def __init__(
        self, rows: DataFrame, cols: Sequence[str], brackets: DataFrame, by: list[str], k: int
    ):
        self.cols, self.k = list(cols), k
        pick = lambda c, i, side: F.max(
            F.when((F.col("feature") == c) & (F.col("_i") == i), F.col(side))
        )
        wide = brackets.groupBy(*by).agg(
            *[
                pick(c, i, side).alias(f"_{side}{j}_{i}")
                for j, c in enumerate(cols)
                for i in range(k)
                for side in ("lo", "hi")
            ]
        )
        if by:
            self.rows = join_small(rows, wide, by)
            self.edge = F.col
        else:
            known = wide.first().asDict()
            self.rows = rows
            self.edge = lambda name: F.lit(known[name]).cast("double")

    def below(self, j: int, i: int) -> Column:
        return F.col(self.cols[j]) < self.edge(f"_lo{j}_{i}")

    def inside(self, j: int, i: int) -> Column:
        return F.col(self.cols[j]).between(self.edge(f"_lo{j}_{i}"), self.edge(f"_hi{j}_{i}"))


def _narrow(
    rows: DataFrame,
    cols: Sequence[str],
    brackets: DataFrame,
    by: list[str],
    k: int,
    accuracy: int,
) -> DataFrame:
    """Shrink brackets by sketching only the values inside them."""
    cells = 100
    grid = [i / cells for i in range(cells + 1)]
    held = _Brackets(rows, cols, brackets, by, k)
    places = [(j, i) for j in range(len(cols)) for i in range(k)]
    counted = held.rows.groupBy(*by).agg(
        *[
            F.struct(
                F.lit(cols[j]).alias("feature"),
                F.lit(i).alias("_i"),
                F.count_if(held.below(j, i)).alias("_below"),
                F.count_if(held.inside(j, i)).alias("_inside"),
                F.percentile_approx(
                    F.when(held.inside(j, i), F.col(cols[j])), grid, accuracy
                ).alias("_grid"),
            ).alias(f"_c{j}_{i}")
            for j, i in places
        ]
    )
    facts = counted.select(*by, _rows([F.col(f"_c{j}_{i}") for j, i in places]))
    both = join_small(brackets, facts, [*by, "feature", "_i"])
    share = lambda rank: F.try_divide(rank - F.col("_below"), F.col("_inside")) * cells
    first = F.floor(share(F.col("rank_lo"))) - 1
    last = F.ceil(share(F.col("rank_hi") + 1)) + 1
    at = lambda i: _cell(F.col("_grid"), F.least(F.greatest(i, F.lit(0)), F.lit(cells)))
    return both.select(
        *[c for c in brackets.columns if c not in ("lo", "hi")],
        F.when(first <= 0, F.col("lo")).otherwise(at(first)).alias("lo"),
        F.when(last >= cells, F.col("hi")).otherwise(at(last)).alias("hi"),
    )


def _select(
    rows: DataFrame, cols: Sequence[str], brackets: DataFrame, by: list[str], k: int
) -> DataFrame:
    """Exact values from counts below and inside each bracket; NULL where a bracket missed.

    Values outside all brackets of a column share one row, so a cell of the table costs one update
    of the map-side counts however many quantiles are asked for.
    """
    group = [*by, "feature"]
    keys = [*group, "_i"]
    held = _Brackets(rows, cols, brackets, by, k)
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.when(reduce(lambda a, b: a | b, [held.inside(j, i) for i in range(k)]), F.col(c)).alias(
                "_value"
            ),
            *[held.below(j, i).alias(f"_below{i}") for i in range(k)],
        )
        for j, c in enumerate(cols)
    ]
    counts = materialize(
        held.rows.select(*by, _rows(cells))
        .groupBy(*group, "_value")
        .agg(
            F.count("*").alias("_count"),
            *[F.count_if(f"_below{i}").alias(f"_below{i}") for i in range(k)],
        ),
        "counts",
    )
    below = counts.groupBy(*group).agg(
        *[
            F.struct(F.lit(i).alias("_i"), F.sum(f"_below{i}").alias("_below")).alias(f"_b{i}")
            for i in range(k)
        ]
    )
    below = below.select(*group, _rows([F.col(f"_b{i}") for i in range(k)]))
    wanted = join_small(brackets, below, keys)
    candidates = join_small(
        counts.where(F.col("_value").isNotNull()).select(*group, "_value", "_count"), wanted, group
    ).where(F.col("_value").between(F.col("lo"), F.col("hi")))
    upto = F.sum("_count").over(
        W.partitionBy(*keys).orderBy("_value").rowsBetween(W.unboundedPreceding, 0)
    )
    placed = candidates.withColumn("_upto", F.col("_below") + upto)
    reached = lambda rank: F.min(F.when(F.col("_upto") > F.col(rank), F.col("_value")))
    found = placed.groupBy(*keys, "place", "rank_lo", "_below").agg(
        reached("rank_lo").alias("_v0"), reached("rank_hi").alias("_v1")
    )
    # Linear interpolation between the two neighbouring ranks.
    value = F.col("_v0") + (F.col("place") - F.col("rank_lo")) * (F.col("_v1") - F.col("_v0"))
    exact = found.select(*keys, F.when(F.col("_below") <= F.col("rank_lo"), value).alias("value"))
    return join_small(brackets.select(*keys, "prob"), exact, keys, "left")


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    exact: bool = True,
    accuracy: int = 10_000,
    max_bracket: int = 1_000_000,
) -> DataFrame:
    """Interpolated quantiles as a table (by..., feature, prob, value); NULL and NaN are skipped.

    ``exact=False`` returns the sketch's answer after one pass. The exact mode reads the columns
    twice, and once more for each factor of some thousands by which a group exceeds
    ``max_bracket * accuracy / 8`` rows.
    """
    by, k = list(by), len(probs)
    rows = _known(df, cols, by)
    shown = [*by, "feature", "prob", "value"]
    if not exact:
        sketches = [F.percentile_approx(c, [float(p) for p in probs], accuracy) for c in cols]
        sketched = rows.groupBy(*by).agg(*[q.alias(f"_q{j}") for j, q in enumerate(sketches)])
        return sketched.select(
            *by,
            _rows(
                [
                    F.struct(
                        F.lit(c).alias("feature"),
                        F.lit(float(p)).alias("prob"),
                        F.get(f"_q{j}", F.lit(i)).alias("value"),
                    )
                    for j, c in enumerate(cols)
                    for i, p in enumerate(probs)
                ]
            ),
        ).where(F.col("value").isNotNull())

    brackets = settle(_sketch(rows, cols, by, probs, accuracy))
    widest = brackets.agg(F.max("n")).first()[0]
    if widest is None:
        return brackets.select(*by, "feature", "prob", F.col("lo").alias("value"))
    expected = widest * 8 / accuracy
    while expected > max_bracket:
        brackets = settle(_narrow(rows, cols, brackets, by, k, accuracy))
        expected *= 5 / 100
    result = settle(_select(rows, cols, brackets, by, k))
    missed = result.where(F.col("value").isNull()).drop("value", "prob")
    if missed.isEmpty():
        return result.select(*shown)
    # A bracket that missed is opened to the whole column, which cannot miss.
    whole = join_small(brackets, missed, [*by, "feature", "_i"]).withColumns(
        {"lo": F.lit(float("-inf")), "hi": F.lit(float("inf"))}
    )
    redone = settle(_select(rows, cols, settle(whole), by, k))
    return result.where(F.col("value").isNotNull()).unionByName(redone).select(*shown)


def quantile_columns(
    df: DataFrame,
    col: str,
    names: dict[str, float],
    by: Sequence[str] = (),
    exact: bool = True,
) -> DataFrame:
    """Quantiles of one column as one row per group with a named column for each."""
    table = quantiles(df, [col], list(names.values()), by, exact)
    return table.groupBy(*by).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in names.items()]
    )
