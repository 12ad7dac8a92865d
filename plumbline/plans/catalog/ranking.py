"""Ranks, tiles, running totals and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import columns as C
from plumbline.operators import evaluation as EV
from plumbline.operators.ranking import score_ntile, score_rank
from plumbline.plans.catalog import frames
from plumbline.plans.catalog.registry import query

KEYS = ", ".join(frames.LINE_KEYS)
EVEN_TIES = frames.tie_sql("o_orderkey")


@query(
    "score_rank",
    f"""WITH {frames.SCORED} SELECT {KEYS}, score, row_number() OVER (ORDER BY score DESC, tie) AS rownum FROM scored""",
)
def _(spark, folder):
    rows = frames.returns_scored(spark, folder).select(*frames.LINE_KEYS, "score")
    return score_rank(rows, "score", frames.LINE_KEYS)


@query(
    "score_ntile",
    f"""WITH {frames.SCORED}
SELECT {KEYS}, score, ntile(10) OVER (ORDER BY score DESC, tie)::INTEGER AS deciles FROM scored""",
)
def _(spark, folder):
    rows = frames.returns_scored(spark, folder).select(*frames.LINE_KEYS, "score")
    return score_ntile(rows, "score", frames.LINE_KEYS)


@query(
    "cumulative_sum",
    f"""WITH {frames.RETURNS}, monthly AS (
  SELECT l_linenumber, sum(y)::BIGINT AS target, sum(1 - y)::BIGINT AS non_target FROM returns GROUP BY l_linenumber)
SELECT *, sum(target) OVER (ORDER BY l_linenumber)::BIGINT AS cum_target,
  sum(non_target) OVER (ORDER BY l_linenumber)::BIGINT AS cum_non_target FROM monthly""",
)
def _(spark, folder):
    rows = EV.non_target_flag(frames.returns(spark, folder), "y", "n")
    counts = rows.groupBy("l_linenumber").agg(F.sum("y").alias("target"), F.sum("n").alias("non_target"))
    return EV.cumulative_sum(counts, ["target", "non_target"], "l_linenumber")


@query(
    "distributed_rank_ntile",
    f"""SELECT o_orderkey, o_orderstatus, row_number() OVER w AS rownum, ntile(10) OVER w::INTEGER AS deciles
FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, {EVEN_TIES})""",
)
def _(spark, folder):
    rows = frames.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    ranked = score_rank(rows, "o_totalprice", frames.ORDER_KEYS, ["o_orderstatus"])
    tiled = score_ntile(ranked, "o_totalprice", frames.ORDER_KEYS, by=["o_orderstatus"])
    return tiled.drop("o_totalprice")


@query("sort_rows", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority ORDER BY n DESC")
def _(spark, folder):
    counts = frames.table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return C.sort_rows(counts, "n", ascending=False)


@query(
    "top_one",
    """SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey
ORDER BY n DESC, c_nationkey LIMIT 1""",
)
def _(spark, folder):
    counts = frames.table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return C.top_one(counts, "n", "c_nationkey")
