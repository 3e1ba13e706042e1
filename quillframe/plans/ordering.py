"""Training-log windows, rankings and column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillframe.functions import (
    confidence_bar,
    percent,
    preview,
    round_to,
    signed_direction,
    softmax_argmax,
)
from quillframe.operators import ordered as ops
from quillframe.plans.registry import query
from quillframe.plans.standins import (
    KEYS_SQL,
    LINE_KEY,
    LOG_SQL,
    SCORED_SQL,
    scored_lines,
    train_log,
)
from quillframe.sources.tables import load_table

_STEPS = f"""{LOG_SQL},
steps AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY ts, event_id) - 1 AS step,
                 count(*) OVER (PARTITION BY run) AS n FROM log)"""


@query(
    "moving_average",
    f"""WITH {_STEPS},
w AS (SELECT run, step, least(50, n // 5) AS "window",
             avg(loss) OVER (PARTITION BY run ORDER BY step
                             ROWS BETWEEN least(50, n // 5) - 1 PRECEDING AND CURRENT ROW) AS a
      FROM steps)
SELECT run, step, "window", round(a, 6) AS moving_avg FROM w WHERE step >= "window" - 1""",
)
def moving_average(spark, sf_dir):
    averaged = ops.moving_average(train_log(spark, sf_dir), ["run"], ["ts", "event_id"], "loss")
    return averaged.withColumn("moving_avg", F.round("moving_avg", 6))


@query(
    "moving_average_fixed",
    f"""WITH {_STEPS},
w AS (SELECT run, step, 10::BIGINT AS "window",
             avg(loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN 9 PRECEDING AND
                             CURRENT ROW) AS a FROM steps)
SELECT run, step, "window", round(a, 6) AS moving_avg FROM w WHERE step >= 9""",
)
def moving_average_fixed(spark, sf_dir):
    averaged = ops.moving_average(
        train_log(spark, sf_dir), ["run"], ["ts", "event_id"], "loss", window=10
    )
    return averaged.withColumn("moving_avg", F.round("moving_avg", 6))


@query(
    "running_ratio",
    f"""WITH {LOG_SQL},
r AS (SELECT run, epoch, row_number() OVER w AS step, sum(correct) OVER w AS c,
             sum(total) OVER w AS t
      FROM log WINDOW w AS (PARTITION BY run, epoch ORDER BY ts, event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT run, epoch, step, c::BIGINT AS running_correct, t::BIGINT AS running_total,
       round(c::DOUBLE / t::DOUBLE, 6) AS running_accuracy
FROM r WHERE step = 1 OR step % 50 = 0""",
)
def running_ratio(spark, sf_dir):
    ratio = ops.running_ratio(train_log(spark, sf_dir), ["run", "epoch"], ["ts", "event_id"])
    return ratio.withColumn("running_accuracy", F.round("running_accuracy", 6))


@query(
    "epoch_summary",
    f"""WITH {LOG_SQL}
SELECT run, epoch, count(*) AS steps, round(avg(loss), 6) AS avg_loss,
       round(sum(correct)::DOUBLE / sum(total)::DOUBLE, 6) AS accuracy,
       round((epoch_us(max(ts)) - epoch_us(min(ts)))::DOUBLE / 1e6::DOUBLE, 6) AS seconds
FROM log GROUP BY 1, 2""",
)
def epoch_summary(spark, sf_dir):
    summary = ops.epoch_summary(train_log(spark, sf_dir), ["run", "epoch"], "ts")
    return summary.withColumns({c: F.round(c, 6) for c in ("avg_loss", "accuracy", "seconds")})


@query(
    "epoch_boundaries",
    f"""WITH {LOG_SQL},
l AS (SELECT run, epoch, row_number() OVER w - 1 AS step, lag(epoch) OVER w AS prev,
             max(loss) OVER (PARTITION BY run) AS peak
      FROM log WINDOW w AS (PARTITION BY run ORDER BY ts, event_id))
SELECT run, epoch, step AS boundary_step, round(peak * 0.95::DOUBLE, 6) AS label_height,
       (row_number() OVER (PARTITION BY run ORDER BY step) + 1)::INT AS epoch_number
FROM l WHERE prev IS NOT NULL AND epoch <> prev""",
)
def epoch_boundaries(spark, sf_dir):
    marks = ops.epoch_boundaries(train_log(spark, sf_dir), ["run"], "epoch")
    return marks.withColumn("label_height", F.round("label_height", 6))


@query(
    "head",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
)
def head(spark, sf_dir):
    table = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ops.head(table, 5, ["o_orderkey"])


@query(
    "top_k",
    "SELECT (row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey))::INT AS rank,"
    " o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15",
)
def top_k(spark, sf_dir):
    table = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ops.top_k(table, "o_totalprice", 15, ["o_orderkey"])


@query(
    "preview",
    "SELECT doc_id, CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '...'"
    " ELSE text END AS preview FROM documents",
)
def preview_(spark, sf_dir):
    table = load_table(spark, sf_dir, "documents")
    return table.select("doc_id", preview(F.col("text"), 200).alias("preview"))


@query("round_to", "SELECT o_orderkey, round(o_totalprice / 7::DOUBLE, 3) AS share FROM orders")
def round_to_(spark, sf_dir):
    table = load_table(spark, sf_dir, "orders")
    return table.select("o_orderkey", round_to(F.col("o_totalprice") / 7, 3).alias("share"))


@query(
    "softmax_argmax",
    """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
m AS (SELECT vec_id, v, list_max(v) AS top FROM e),
p AS (SELECT vec_id, v, top, list_transform(v, lambda x: exp(x - top)) AS powers FROM m)
SELECT vec_id, (list_position(v, top) - 1)::INT AS prediction,
       round(1::DOUBLE / list_sum(powers), 6) AS confidence,
       round(powers[1] / list_sum(powers), 6) AS first_probability
FROM p""",
)
def softmax_argmax_(spark, sf_dir):
    table = load_table(spark, sf_dir, "embeddings")
    logits = table.select("vec_id", F.col("embedding").cast("array<double>").alias("logits"))
    scored = logits.select("vec_id", softmax_argmax(F.col("logits")).alias("s"))
    return scored.select(
        "vec_id",
        "s.prediction",
        F.round("s.confidence", 6).alias("confidence"),
        F.round(F.col("s.probabilities")[0], 6).alias("first_probability"),
    )


@query(
    "confidence_bar",
    f"WITH {SCORED_SQL} SELECT {KEYS_SQL}, repeat('█', floor(prob * 20)::INT) ||"
    " repeat('░', 20 - floor(prob * 20)::INT) AS bar FROM scored",
)
def confidence_bar_(spark, sf_dir):
    scored = scored_lines(spark, sf_dir)
    return scored.select(*LINE_KEY, confidence_bar(F.col("prob")).alias("bar"))


@query(
    "percent",
    "SELECT l_linestatus, round(count(*) FILTER (l_returnflag = 'R') * 100.0::DOUBLE / count(*), 6)"
    " AS percent_returned FROM lineitem GROUP BY 1",
)
def percent_(spark, sf_dir):
    returned = F.count_if(F.col("l_returnflag") == "R")
    return (
        load_table(spark, sf_dir, "lineitem")
        .groupBy("l_linestatus")
        .agg(F.round(percent(returned, F.count("*")), 6).alias("percent_returned"))
    )


@query(
    "signed_direction",
    "SELECT c_custkey, CASE WHEN c_acctbal - 4500 > 0 THEN 'up' ELSE 'down' END AS direction"
    " FROM customer",
)
def signed_direction_(spark, sf_dir):
    table = load_table(spark, sf_dir, "customer")
    return table.select(
        "c_custkey", signed_direction(F.col("c_acctbal") - 4500).alias("direction")
    )
