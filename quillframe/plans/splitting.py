"""Samples, splits, folds and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillframe.operators import scaling
from quillframe.operators import splitting as ops
from quillframe.operators.sampling import sample_n
from quillframe.plans.registry import query
from quillframe.plans.standins import (
    FEATURES,
    FEATURES_SQL,
    KEYS_SQL,
    LINE_KEY,
    LINES_SQL,
    REVIEWS_SQL,
    SEED,
    hash_sql,
    lines,
    reviews,
    stratified_sql,
)
from quillframe.sources.tables import load_table

_SAMPLE_SQL = (
    f"SELECT {KEYS_SQL}, l_quantity FROM lineitem"
    f" ORDER BY {hash_sql('sample')}, {KEYS_SQL} LIMIT 5000"
)


@query("sample_n", _SAMPLE_SQL)
def sample(spark, sf_dir):
    table = load_table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_quantity")
    return sample_n(table, 5000, LINE_KEY, SEED)


@query("sample_n_cutoff", _SAMPLE_SQL)
def sample_cutoff(spark, sf_dir):
    table = load_table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_quantity")
    return sample_n(table, 5000, LINE_KEY, SEED)


@query(
    "split",
    f"SELECT {KEYS_SQL}, CASE WHEN substr({hash_sql('split')}, 1, 8) < '33333334' THEN 'test'"
    " ELSE 'train' END AS split FROM lineitem",
)
def split(spark, sf_dir):
    table = load_table(spark, sf_dir, "lineitem").select(*LINE_KEY)
    return ops.split(table, 0.2, LINE_KEY, SEED)


@query(
    "split_exact",
    f"""WITH r AS (SELECT {KEYS_SQL}, row_number() OVER (ORDER BY {hash_sql('split')}) AS place,
                   count(*) OVER () AS n FROM lineitem)
SELECT {KEYS_SQL}, CASE WHEN place <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split
FROM r""",
)
def split_exact(spark, sf_dir):
    table = load_table(spark, sf_dir, "lineitem").select(*LINE_KEY)
    return ops.split(table, 0.2, LINE_KEY, SEED, exact=True)


@query(
    "stratified_split",
    f"WITH {stratified_sql('lineitem', 'l_returnflag', KEYS_SQL)}"
    f" SELECT {KEYS_SQL}, l_returnflag, split FROM parted",
)
def stratified_split(spark, sf_dir):
    table = load_table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_returnflag")
    return ops.stratified_split(table, 0.2, "l_returnflag", LINE_KEY, SEED)


@query(
    "stratified_split_reviews",
    f"WITH {REVIEWS_SQL}, {stratified_sql('reviews', 'label', 'doc_id')}"
    " SELECT doc_id, label, split FROM parted",
)
def stratified_split_reviews(spark, sf_dir):
    table = reviews(spark, sf_dir).select("doc_id", "label")
    return ops.stratified_split(table, 0.2, "label", ["doc_id"], SEED)


@query(
    "stratified_kfold",
    f"""WITH r AS (
  SELECT {KEYS_SQL}, l_returnflag, count(*) OVER (PARTITION BY l_returnflag) AS n,
         row_number() OVER (PARTITION BY l_returnflag ORDER BY {hash_sql('fold')}) AS place
  FROM lineitem)
SELECT {KEYS_SQL}, l_returnflag,
       ((place > n * 1 // 5)::INT + (place > n * 2 // 5)::INT + (place > n * 3 // 5)::INT
        + (place > n * 4 // 5)::INT)::INT AS fold
FROM r""",
)
def stratified_kfold(spark, sf_dir):
    table = load_table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_returnflag")
    return ops.stratified_kfold(table, 5, "l_returnflag", LINE_KEY, SEED)


@query(
    "split_audit",
    f"WITH {stratified_sql('lineitem', 'l_returnflag', KEYS_SQL)}"
    " SELECT split, l_returnflag, count(*) AS n FROM parted GROUP BY 1, 2",
)
def split_audit(spark, sf_dir):
    table = load_table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_returnflag")
    parted = ops.stratified_split(table, 0.2, "l_returnflag", LINE_KEY, SEED)
    return ops.split_audit(parted, "l_returnflag")


_TRAIN = f"""{LINES_SQL},
train AS (SELECT * FROM lines WHERE substr({hash_sql('split')}, 1, 8) >= '33333334')"""
_SCALER = ", ".join(
    f"avg({c}) AS mean_{i}, stddev_pop({c}) AS std_{i}" for i, c in enumerate(FEATURES)
)
_SCALED = ", ".join(
    f"({c} - mean_{i}) / std_{i} AS {c}" for i, c in enumerate(FEATURES)
)


def _train(spark, sf_dir):
    return ops.split(lines(spark, sf_dir), 0.2, LINE_KEY, SEED).where("split = 'train'")


@query(
    "fit_scaler",
    f"WITH {_TRAIN} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std"
        " FROM train"
        for c in FEATURES
    ),
)
def fit_scaler(spark, sf_dir):
    scaler = scaling.fit_scaler(_train(spark, sf_dir), FEATURES)
    return scaler.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query(
    "apply_scaler",
    f"WITH {_TRAIN}, s AS (SELECT {_SCALER} FROM train),"
    f" z AS (SELECT {KEYS_SQL}, {_SCALED} FROM lines CROSS JOIN s)"
    f" SELECT {KEYS_SQL}, " + ", ".join(f"round({c}, 4) AS {c}" for c in FEATURES) + " FROM z",
)
def apply_scaler(spark, sf_dir):
    scaler = scaling.fit_scaler(_train(spark, sf_dir), FEATURES)
    scaled = scaling.apply_scaler(lines(spark, sf_dir), scaler)
    return scaled.select(*LINE_KEY, *[F.round(c, 4).alias(c) for c in FEATURES])


@query(
    "scaling_check",
    f"WITH {_TRAIN}, s AS (SELECT {_SCALER} FROM train),"
    f" z AS (SELECT {_SCALED} FROM lines CROSS JOIN s),"
    f" u AS (SELECT unnest([{FEATURES_SQL}]) AS x FROM z)"
    " SELECT round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM u",
)
def scaling_check(spark, sf_dir):
    scaler = scaling.fit_scaler(_train(spark, sf_dir), FEATURES)
    check = scaling.scaling_check(scaling.apply_scaler(lines(spark, sf_dir), scaler), FEATURES)
    return check.select(*[F.round(c, 6).alias(c) for c in ("mean", "std")])
