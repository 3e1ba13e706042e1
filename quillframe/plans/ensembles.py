"""Boosted trees and principal components."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillframe.operators import metrics, models, reduction
from quillframe.operators.scaling import assemble, scale_and_assemble
from quillframe.operators.splitting import split_validation
from quillframe.plans.registry import query
from quillframe.plans.standins import (
    CLASSED_SQL,
    FEATURES,
    KEYS_SQL,
    LINE_KEY,
    LINES_SQL,
    SEED,
    classed_lines,
    hash_sql,
    lines,
)

FEW_VALUED = ["l_quantity", "l_discount", "l_tax"]


def _stump_sql(tree: int, rows: str) -> str:
    """CTEs ending in ``stump<tree>``: the best split of the residuals ``r`` of a CTE, by the spread
    it leaves, between two neighbouring values of a column."""
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n, sum(r) AS s FROM {rows} GROUP BY {c}"
        for c in FEW_VALUED
    )
    return f"""values{tree} AS ({values}),
cuts{tree} AS (SELECT feature, (value + lead(value) OVER w) / 2 AS threshold,
    sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY feature) AS n,
    sum(s) OVER (PARTITION BY feature) AS s
  FROM values{tree} WINDOW w AS (PARTITION BY feature ORDER BY value)),
stump{tree} AS (SELECT feature, threshold, sl / nl AS low, (s - sl) / (n - nl) AS high
  FROM cuts{tree} WHERE threshold IS NOT NULL
  ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)"""


_SIDE = " ".join(f"WHEN '{c}' THEN {c}" for c in FEW_VALUED)
_STUMPS_SQL = f"""{CLASSED_SQL},
rows0 AS (SELECT {', '.join(FEW_VALUED)}, 2::DOUBLE * label - 1 AS y, 2::DOUBLE * label - 1 AS r FROM classed),
{_stump_sql(0, 'rows0')},
rows1 AS (SELECT {', '.join(FEW_VALUED)}, y, 4 * y / (1 + exp(2 * y * f)) AS r
          FROM (SELECT rows0.*, CASE WHEN CASE feature {_SIDE} END <= threshold THEN low ELSE high END AS f
                FROM rows0 CROSS JOIN stump0)),
{_stump_sql(1, 'rows1')}"""


def _leaves_sql(tree: int, weight: str) -> str:
    return (
        f"SELECT {tree} AS tree, {weight}::DOUBLE AS weight, feature, op, round(threshold, 6) AS threshold,"
        f" round(CASE op WHEN '<=' THEN low ELSE high END, 6) AS prediction"
        f" FROM stump{tree} CROSS JOIN (VALUES ('<='), ('>')) o(op)"
    )


@query(
    "boosted_stumps", f"WITH {_STUMPS_SQL} {_leaves_sql(0, '1')} UNION ALL {_leaves_sql(1, '0.1')}"
)
def boosted_stumps(spark, sf_dir):
    """Two rounds of trees of one split, over columns of few values."""
    rows = assemble(classed_lines(spark, sf_dir), FEW_VALUED)
    model = models.fit_boosted(rows, rounds=2, max_depth=1)
    leaves = models.tree_rules(spark, model, FEW_VALUED)
    return leaves.select(
        "tree", "weight", F.inline("conditions"), F.round("prediction", 6).alias("prediction")
    ).withColumn("threshold", F.round("threshold", 6))


@query(
    "split_validation",
    f"""SELECT {KEYS_SQL}, CASE WHEN substr({hash_sql('split')}, 1, 8) < '33333334' THEN 'test'
  WHEN substr({hash_sql('validation')}, 1, 8) < '40000000' THEN 'validation' ELSE 'train' END AS split
FROM lineitem""",
)
def three_way_split(spark, sf_dir):
    return split_validation(lines(spark, sf_dir), 0.2, 0.2, LINE_KEY, SEED).select(*LINE_KEY, "split")


@query("fit_boosted")
def fit_boosted(spark, sf_dir):
    """Boosted trees that stop when the validation side gains no more, measured on the test side."""
    parted = assemble(split_validation(classed_lines(spark, sf_dir), 0.2, 0.2, LINE_KEY, SEED), FEATURES)
    seen = parted.where("split <> 'test'").withColumn("held", F.col("split") == "validation")
    model = models.fit_boosted(seen, rounds=20, validation="held")
    row = metrics.evaluate(model, parted.where("split = 'test'"), "boosted")["metrics"]
    return row.withColumn("trees", F.lit(model.getNumTrees))


PRICES = ["l_quantity", "l_extendedprice", "net"]
_CENTRED = ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS x{i}" for i, c in enumerate(PRICES)
)
_GRAM = ", ".join(f"avg(x{i} * x{j}) AS a{i}{j}" for i in range(3) for j in range(i, 3))


def _entry(i: int, j: int) -> str:
    return f"a{min(i, j)}{max(i, j)}"


def _product(i: int, j: int, first: str, second: str) -> str:
    """Entry of (A - first)(A - second)."""
    less = lambda a, b, e: f"({_entry(a, b)}{f' - {e}' if a == b else ''})"
    return "(" + " + ".join(f"{less(i, k, first)} * {less(k, j, second)}" for k in range(3)) + ")"


def _directions(component: int, first: str, second: str) -> str:
    """Columns of a product that all lie along one eigenvector."""
    return " UNION ALL ".join(
        f"SELECT {component} AS component, e{component} AS variance, "
        + ", ".join(f"{_product(i, j, first, second)} AS v{i}" for i in range(3))
        + " FROM roots"
        for j in range(3)
    )


# Eigenvalues of a symmetric 3 x 3 matrix have a closed form; so have its eigenvectors.
_COMPONENTS_SQL = f"""{LINES_SQL},
x AS (SELECT {_CENTRED} FROM lines),
gram AS (SELECT {_GRAM} FROM x),
q AS (SELECT *, (a00 + a11 + a22) / 3 AS q FROM gram),
p AS (SELECT *, sqrt(((a00 - q) * (a00 - q) + (a11 - q) * (a11 - q) + (a22 - q) * (a22 - q)
                      + 2 * (a01 * a01 + a02 * a02 + a12 * a12)) / 6) AS p FROM q),
r AS (SELECT *, ((a00 - q) * ((a11 - q) * (a22 - q) - a12 * a12) - a01 * (a01 * (a22 - q) - a12 * a02)
                 + a02 * (a01 * a12 - (a11 - q) * a02)) / (2 * p * p * p) AS r FROM p),
phi AS (SELECT *, acos(greatest(-1, least(1, r))) / 3 AS phi FROM r),
ends AS (SELECT *, q + 2 * p * cos(phi) AS e1, q + 2 * p * cos(phi + 2 * pi() / 3) AS e3 FROM phi),
roots AS (SELECT *, 3 * q - e1 - e3 AS e2 FROM ends),
found AS ({_directions(1, 'e2', 'e3')} UNION ALL {_directions(2, 'e1', 'e3')}),
long AS (SELECT *, sqrt(v0 * v0 + v1 * v1 + v2 * v2) AS length FROM found),
best AS (SELECT * FROM long QUALIFY row_number() OVER (PARTITION BY component ORDER BY length DESC) = 1),
signed AS (SELECT *, CASE WHEN abs(v0) >= abs(v1) AND abs(v0) >= abs(v2) THEN sign(v0)
                          WHEN abs(v1) >= abs(v2) THEN sign(v1) ELSE sign(v2) END / length AS scale FROM best)"""


def _components(spark, sf_dir):
    rows = lines(spark, sf_dir)
    ready = scale_and_assemble(rows, PRICES)(rows)
    return ready, reduction.fit_components(ready, 2)


@query(
    "principal_components",
    f"WITH {_COMPONENTS_SQL} "
    + " UNION ALL ".join(
        f"SELECT component, '{c}' AS feature, round(v{i} * scale, 5) + 0 AS weight,"
        f" round(variance, 6) AS variance, round(variance / 3, 6) AS share FROM signed"
        for i, c in enumerate(PRICES)
    ),
)
def principal_components(spark, sf_dir):
    _, found = _components(spark, sf_dir)
    table = reduction.component_table(spark, found, PRICES)
    weight = (F.round("weight", 5) + 0).alias("weight")
    return table.select(
        "component", "feature", weight, F.round("variance", 6).alias("variance"), F.round("share", 6).alias("share")
    )


@query(
    "reconstruction_error",
    f"WITH {_COMPONENTS_SQL} SELECT (SELECT count(*) FROM x) AS n, round(e3, 8) AS error FROM roots",
)
def reconstruction_error(spark, sf_dir):
    ready, found = _components(spark, sf_dir)
    return reduction.reconstruction_error(ready, found).withColumn("error", F.round("error", 8))
