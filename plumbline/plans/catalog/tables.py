"""Sources, sinks, column selection, reshaping, joins and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import null_default, percent_of_total, sign_colour
from plumbline.operators import columns as C
from plumbline.operators import evaluation as EV
from plumbline.operators import explain as X
from plumbline.operators import joins as J
from plumbline.operators.profile import data_stats, value_counts
from plumbline.operators.ranking import score_ntile
from plumbline.plans.catalog import frames
from plumbline.plans.catalog.evaluation import GAINS_SQL, fixed_leaderboard
from plumbline.plans.catalog.profiling import stats_sql
from plumbline.plans.catalog.registry import query, rounded
from plumbline.session import scratch_path, stored
from plumbline.sources import tables as S

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query("read_delimited", f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders")
def _(spark, folder):
    rows = frames.table(spark, folder, "orders").select(*ORDER_COLUMNS)
    path = scratch_path(spark, "orders-csv")
    rows.write.option("header", True).option("sep", "|").csv(path)
    return S.read_delimited(spark, path, schema=rows.schema, sep="|")


@query("read_delimited_inferred", "SELECT p_partkey::INTEGER AS p_partkey, p_brand, p_size, p_retailprice FROM part")
def _(spark, folder):
    rows = frames.table(spark, folder, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    path = scratch_path(spark, "part-csv")
    rows.write.option("header", True).csv(path)
    return S.read_delimited(spark, path)


@query(
    "register_view",
    "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment",
)
def _(spark, folder):
    S.register_view(frames.table(spark, folder, "customer"), "plumbline_customer")
    return spark.sql("SELECT c_mktsegment, count(*) AS customers FROM plumbline_customer GROUP BY c_mktsegment")


@query("read_table", "SELECT * FROM supplier")
def _(spark, folder):
    S.register_view(frames.table(spark, folder, "supplier"), "plumbline_supplier")
    return S.read_table(spark, "plumbline_supplier")


@query("save_table", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def _(spark, folder):
    rows = frames.table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    path = scratch_path(spark, "part-table")
    return S.save_table(rows, "plumbline_" + path.rsplit("-", 1)[1], path)


@query(
    "write_report",
    f"""WITH {frames.SCORED}, {stats_sql("scored", ["l_linestatus"], ["l_discount", "l_tax", "y"])},
tiles AS ({GAINS_SQL})
SELECT 'Summary_Stats' AS report, "Variable" AS entry, "Non_Missing" AS rows FROM stats
UNION ALL SELECT 'KS', deciles::VARCHAR, count FROM tiles
UNION ALL SELECT 'Top_Vars', x, n FROM (
  SELECT 'l_discount' AS x, (SELECT count(*) FROM scored) AS n UNION ALL SELECT 'l_tax', (SELECT count(*) FROM scored))
UNION ALL SELECT 'Performance_metrics', a, 1 FROM (VALUES ('Logistic'), ('MultiLayerPerceptron'),
  ('RandomForest'), ('GradientBoosting')) t(a)""",
)
def _(spark, folder):
    rows = frames.returns_scored(spark, folder)
    long = C.wide_to_long(rows, ["l_discount", "l_tax"])
    target = scratch_path(spark, "report")
    S.write_report(
        {
            "Summary_Stats": data_stats(rows.select("l_linestatus", "l_discount", "l_tax", "y")),
            "Top_Vars": long.groupBy("Variable").agg(F.count("*").alias("rows")),
            "Performance_metrics": fixed_leaderboard(spark, folder),
            "KS": EV.gains_table(rows, "y", "score", frames.LINE_KEYS),
        },
        target,
    )
    entries = {
        "Summary_Stats": ("Variable", F.col("Non_Missing")),
        "Top_Vars": ("Variable", F.col("rows")),
        "Performance_metrics": ("Algorithms", F.lit(1).cast("bigint")),
        "KS": ("deciles", F.col("count")),
    }
    parts = {
        name: S.read_report(spark, target, name).select(F.col(key).cast("string").alias("entry"), n.alias("rows"))
        for name, (key, n) in entries.items()
    }
    return J.union_results(parts, "report").select("report", "entry", "rows")


@query(
    "cached_scope",
    f"""WITH {frames.RETURNS} SELECT l_linestatus, count(*) AS rows, sum(y)::BIGINT AS target,
  (SELECT count(*) FROM returns) AS total_rows FROM returns GROUP BY l_linestatus""",
)
def _(spark, folder):
    rows = frames.returns(spark, folder).select("l_linestatus", "y")
    with S.cached_scope(rows):
        total = rows.count()
        grouped = stored(rows.groupBy("l_linestatus").agg(F.count("*").alias("rows"), F.sum("y").alias("target")), "grouped")
    return grouped.withColumn("total_rows", F.lit(total).cast("bigint"))


@query("exclude_by_pattern", "SELECT o_orderstatus, o_totalprice FROM orders")
def _(spark, folder):
    return C.exclude_by_pattern(frames.table(spark, folder, "orders"), ["KEY$", "date", "Prior"])


@query("exclude_by_name", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def _(spark, folder):
    return C.exclude_by_name(frames.table(spark, folder, "customer"), ["C_Name", "C_MKTSEGMENT"])


_LINE_ROLES = {
    "l_orderkey": "numeric",
    "l_partkey": "numeric",
    "l_suppkey": "numeric",
    "l_linenumber": "numeric",
    "l_quantity": "numeric",
    "l_extendedprice": "numeric",
    "l_discount": "numeric",
    "l_tax": "numeric",
    "l_returnflag": "categorical",
    "l_linestatus": "categorical",
    "l_shipdate": "temporal",
}


@query(
    "column_roles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"Variable\", '{r}' AS role, count({c}) AS \"Non_Missing\" FROM lineitem"
        for c, r in _LINE_ROLES.items()
    ),
)
def _(spark, folder):
    return C.column_roles(frames.table(spark, folder, "lineitem"))


@query(
    "column_census",
    """SELECT (SELECT count(*) FROM orders) AS rows, count(*) AS columns,
  count(*) FILTER (data_type = 'VARCHAR') AS categorical,
  count(*) FILTER (data_type IN ('BIGINT', 'INTEGER', 'DOUBLE')) AS numeric,
  count(*) FILTER (data_type IN ('VARCHAR', 'BIGINT', 'INTEGER', 'DOUBLE') AND column_name NOT LIKE '%key') AS kept,
  count(*) FILTER (data_type = 'VARCHAR' AND column_name NOT LIKE '%key') AS kept_categorical,
  count(*) FILTER (data_type IN ('BIGINT', 'INTEGER', 'DOUBLE') AND column_name NOT LIKE '%key') AS kept_numeric
FROM (SELECT column_name, column_type AS data_type FROM (DESCRIBE SELECT * FROM orders))""",
)
def _(spark, folder):
    rows = frames.table(spark, folder, "orders")
    return C.column_census(rows, C.drop_unusable(C.exclude_by_pattern(rows, ["key"])))


@query(
    "drop_high_cardinality",
    f"WITH {frames.ORDER_STATUS} SELECT o_orderkey, o_totalprice, o_orderpriority, c_mktsegment FROM order_status",
)
def _(spark, folder):
    rows = frames.order_status(spark, folder).select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "c_mktsegment", "n_name"
    )
    return C.drop_high_cardinality(rows, data_stats(rows), 20)


@query(
    "non_target_flag",
    f"WITH {frames.RETURNS} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, y, 1 - y AS non_target FROM returns",
)
def _(spark, folder):
    return EV.non_target_flag(frames.returns(spark, folder).select(*frames.LINE_KEYS, "y"), "y")


@query(
    "cast_columns",
    """SELECT l_orderkey, l_linenumber::DOUBLE AS l_linenumber, l_quantity::INTEGER AS l_quantity
FROM lineitem""",
)
def _(spark, folder):
    rows = frames.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return C.cast_columns(rows, {"l_linenumber": "double", "l_quantity": "int"})


@query(
    "filter_rows",
    f"""WITH {frames.NULLS} SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_linestatus FROM nulls
WHERE l_linestatus = 'F' AND l_discount IS NOT NULL AND l_quantity >= 20""",
)
def _(spark, folder):
    rows = frames.returns_nulls(spark, folder)
    kept = C.filter_rows(
        rows, F.col("l_linestatus") == "F", F.col("l_discount").isNotNull(), F.col("l_quantity") >= 20
    )
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_linestatus")


@query(
    "wide_to_long",
    """SELECT p_partkey, 'p_retailprice' AS "Variable", p_retailprice AS value FROM part
UNION ALL SELECT p_partkey, 'p_size', p_size::DOUBLE FROM part""",
)
def _(spark, folder):
    rows = C.cast_columns(frames.table(spark, folder, "part"), {"p_size": "double"})
    return C.wide_to_long(rows, ["p_retailprice", "p_size"], ["p_partkey"])


@query("rename_columns", "SELECT c_custkey AS id, c_acctbal AS balance FROM customer")
def _(spark, folder):
    rows = frames.table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return C.rename_columns(rows, {"c_custkey": "id", "c_acctbal": "balance"})


@query(
    "split_features_target",
    f"""WITH {frames.DOC_QUALITY} SELECT doc_id, lang, source, n_chars,
  (SELECT sum(quality) FROM doc_quality)::BIGINT AS target_sum FROM doc_quality""",
)
def _(spark, folder):
    features, target = C.split_features_target(frames.doc_quality(spark, folder), "quality")
    total = target.agg(F.sum("quality")).first()[0]
    return features.withColumn("target_sum", F.lit(total).cast("bigint"))


@query(
    "left_join_stats",
    """SELECT "Variable", total, distinct_values FROM (
  SELECT 'o_orderstatus' AS "Variable", count(*) AS total, count(DISTINCT o_orderstatus) AS distinct_values FROM orders
  UNION ALL SELECT 'o_orderpriority', count(*), count(DISTINCT o_orderpriority) FROM orders
  UNION ALL SELECT 'o_totalprice', count(*), NULL FROM orders)""",
)
def _(spark, folder):
    rows = frames.table(spark, folder, "orders")
    base = C.column_roles(rows.select("o_orderstatus", "o_orderpriority", "o_totalprice"))
    counts = value_counts(rows, ["o_orderstatus", "o_orderpriority"])
    levels = counts.groupBy("Variable").agg(F.count("value").alias("distinct_values"))
    joined = J.left_join_stats(base, levels)
    return joined.select("Variable", F.col("Non_Missing").alias("total"), "distinct_values")


@query(
    "inner_join_deciles",
    f"""WITH {frames.SCORED}, tiled AS (
  SELECT y, ntile(10) OVER (ORDER BY score DESC, tie)::INTEGER AS deciles FROM scored)
SELECT deciles, count(*) AS count, sum(y)::BIGINT AS target, sum(1 - y)::BIGINT AS non_target FROM tiled GROUP BY deciles""",
)
def _(spark, folder):
    tiled = score_ntile(frames.returns_scored(spark, folder), "score", frames.LINE_KEYS)
    # Three aggregations read the tiled rows.
    tiled = stored(EV.non_target_flag(tiled, "y").select("deciles", "y", "non_target"), "tiled")
    return J.inner_join_deciles(
        tiled.groupBy("deciles").agg(F.count("*").alias("count")),
        tiled.groupBy("deciles").agg(F.sum("y").alias("target")),
        tiled.groupBy("deciles").agg(F.sum("non_target").alias("non_target")),
    )


@query(
    "inner_join_importance",
    f"""WITH {frames.ATTRIBUTIONS} SELECT "Variable", round(avg(abs(shap_value)), 8) AS mean_abs,
  round(CASE WHEN min(feature_value) < max(feature_value) THEN corr(feature_value, shap_value) END, 8) AS corr
FROM attributions GROUP BY "Variable" """,
)
def _(spark, folder):
    rows = frames.attributions(spark, folder)
    return rounded(J.inner_join_importance(X.mean_abs(rows), X.corr_pair(rows)), "mean_abs", "corr", digits=8)


@query(
    "column_bind",
    """SELECT o_orderkey, o_totalprice, o_orderpriority, round(o_totalprice / 1000, 6) AS thousands FROM orders""",
)
def _(spark, folder):
    rows = frames.table(spark, folder, "orders")
    left = rows.select("o_orderkey", "o_totalprice", "o_orderpriority")
    right = rows.select("o_orderkey", F.round(F.col("o_totalprice") / 1000, 6).alias("thousands"))
    return J.column_bind(left, right, ["o_orderkey"])


@query(
    "union_results",
    """SELECT 'customers' AS type_of_model, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY c_nationkey
UNION ALL SELECT 'suppliers', s_nationkey, count(*) FROM supplier GROUP BY s_nationkey""",
)
def _(spark, folder):
    customers = frames.table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("nation"))
    suppliers = frames.table(spark, folder, "supplier").groupBy(F.col("s_nationkey").alias("nation"))
    counts = {"customers": customers, "suppliers": suppliers}
    return J.union_results({k: g.agg(F.count("*").alias("n")) for k, g in counts.items()})


@query("lower", "SELECT o_orderkey, lower(o_orderpriority) AS priority FROM orders")
def _(spark, folder):
    return frames.table(spark, folder, "orders").select("o_orderkey", F.lower("o_orderpriority").alias("priority"))


@query("regex_match", "SELECT p_partkey, regexp_matches(p_type, '(?i)steel|^promo') AS matched FROM part")
def _(spark, folder):
    matched = F.col("p_type").rlike("(?i)steel|^promo")
    return frames.table(spark, folder, "part").select("p_partkey", matched.alias("matched"))


@query("abs_round", "SELECT c_custkey, abs(c_acctbal) AS size, round(c_acctbal / 7, 2) AS share FROM customer")
def _(spark, folder):
    balance = F.col("c_acctbal")
    return frames.table(spark, folder, "customer").select(
        "c_custkey", F.abs(balance).alias("size"), F.round(balance / 7, 2).alias("share")
    )


@query("conditional", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'red' ELSE 'blue' END AS colour FROM customer")
def _(spark, folder):
    rows = frames.table(spark, folder, "customer")
    return rows.select("c_custkey", sign_colour(F.col("c_acctbal")).alias("colour"))


@query(
    "null_default",
    f"WITH {frames.NULLS} SELECT l_orderkey, l_linenumber, coalesce(l_discount, 0) AS l_discount FROM nulls",
)
def _(spark, folder):
    rows = frames.returns_nulls(spark, folder)
    return rows.select("l_orderkey", "l_linenumber", null_default(F.col("l_discount")).alias("l_discount"))


@query(
    "percent_of_total",
    """SELECT o_orderpriority, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 6) AS share
FROM orders GROUP BY o_orderpriority""",
)
def _(spark, folder):
    counts = frames.table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0]
    return counts.withColumn("share", F.round(percent_of_total(F.col("n"), F.lit(total)), 6))
