"""Model frames derived from the given tables, each as DataFrame and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.scalars import TIE_FIELDS

LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LINE_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
ORDER_KEYS = ("o_orderkey",)
DOC_KEYS = ("doc_id",)
#: Rows of a joined table up to which it may be broadcast; a larger one is joined by shuffles.
BROADCAST_ROWS = 20_000


def digest_sql(digits: int, seed: int, *keys: str) -> str:
    """The md5 number of keys and seed in SQL."""
    marked = [f"CASE WHEN {k} IS NULL THEN '-' ELSE length({k}::VARCHAR) || ':' || {k}::VARCHAR END" for k in keys]
    return f"('0x' || substr(md5({' || '.join(marked)} || '|{seed}'), 1, {digits}))::BIGINT"


def tie_sql(*keys: str) -> str:
    """The tie number in SQL: two modular folds over the keys."""
    halves = []
    for prime, factor in TIE_FIELDS:
        h = "1::BIGINT"
        for key in keys:
            h = f"(({h} * {factor} + {key}::BIGINT % {prime}) % {prime})"
        halves.append(f"({h} * {factor} % {prime})")
    return f"({halves[0]} * 2147483648 + {halves[1]})"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def joined_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table to join with, which passes through the driver only up to ``BROADCAST_ROWS`` rows."""
    rows = table(spark, folder, name)
    return rows if rows.count() <= BROADCAST_ROWS else rows.hint("merge")


def returns(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with target ``y``: was the item returned?"""
    return table(spark, folder, "lineitem").select(
        *LINE_KEYS, *LINE_NUMERIC, "l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("y")
    )


RETURNS = """returns AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
         l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y
  FROM lineitem)"""


def returns_scored(spark: SparkSession, folder: str) -> DataFrame:
    """``returns`` with a fixed score of few distinct values and a prediction."""
    score = F.round(F.col("l_discount") + F.col("l_quantity") / 100, 2)
    rows = returns(spark, folder).withColumn("score", score)
    return rows.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


SCORED = (
    RETURNS
    + """, scored AS (
  SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction,
         """
    + tie_sql(*LINE_KEYS)
    + """ AS tie
  FROM (SELECT *, round(l_discount + l_quantity / 100, 2) AS score FROM returns))"""
)


def returns_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """``returns`` with missing values; null is the most frequent line status."""
    order = F.col("l_orderkey")
    return returns(spark, folder).withColumns(
        {
            "l_discount": F.when(order % 11 != 0, F.col("l_discount")),
            "l_linestatus": F.when(order % 3 == 0, F.col("l_linestatus")),
        }
    )


NULLS = (
    RETURNS
    + """, nulls AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 11 <> 0 THEN l_discount END AS l_discount,
                    CASE WHEN l_orderkey % 3 = 0 THEN l_linestatus END AS l_linestatus)
  FROM returns)"""
)


def order_status(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with customer and nation columns; the status is the target."""
    orders = table(spark, folder, "orders")
    customer = joined_table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        "o_orderpriority",
        "c_acctbal",
        "c_mktsegment",
        "n_name",
    )


ORDER_STATUS = """order_status AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, c_acctbal, c_mktsegment, n_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def doc_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents; the quality flag is the target."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return labels.join(documents, "doc_id")


DOC_QUALITY = """doc_quality AS (
  SELECT doc_id, quality, lang, source, n_chars FROM labels JOIN documents USING (doc_id))"""


def attributions(spark: SparkSession, folder: str) -> DataFrame:
    """A closed-form attribution per line item and feature, with a constant feature."""
    rows = returns(spark, folder)
    means = rows.agg(*[F.round(F.avg(c), 2).alias(c) for c in LINE_NUMERIC]).first()
    factors = dict(zip(LINE_NUMERIC, (0.1, -0.1, 2.0, -3.0)))
    entries = [
        F.struct(
            F.lit(c).alias("Variable"),
            F.col(c).alias("feature_value"),
            (F.lit(factors[c]) * (F.col(c) - F.lit(means[c]))).alias("shap_value"),
        )
        for c in LINE_NUMERIC
    ]
    constant = F.struct(
        F.lit("constant").alias("Variable"), F.lit(1.0).alias("feature_value"), F.lit(0.25).alias("shap_value")
    )
    return rows.select(*LINE_KEYS, F.inline(F.array(*entries, constant)))


ATTRIBUTIONS = (
    RETURNS
    + """, means AS (
  SELECT round(avg(l_quantity), 2) AS q, round(avg(l_extendedprice), 2) AS e, round(avg(l_discount), 2) AS d,
    round(avg(l_tax), 2) AS t FROM returns),
attributions AS (
  SELECT 'l_quantity' AS "Variable", l_quantity AS feature_value, 0.1::DOUBLE * (l_quantity - q) AS shap_value FROM returns, means
  UNION ALL SELECT 'l_extendedprice', l_extendedprice, -0.1::DOUBLE * (l_extendedprice - e) FROM returns, means
  UNION ALL SELECT 'l_discount', l_discount, 2.0::DOUBLE * (l_discount - d) FROM returns, means
  UNION ALL SELECT 'l_tax', l_tax, -3.0::DOUBLE * (l_tax - t) FROM returns, means
  UNION ALL SELECT 'constant', 1.0::DOUBLE, 0.25::DOUBLE FROM returns)"""
)
