"""Encoders, feature vectors and splits."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plumbline.operators import encode as EN
from plumbline.operators.split import random_split, stratified_split
from plumbline.plans.catalog import frames
from plumbline.plans.catalog.registry import query, rounded

# Orders whose priority is missing for every seventh order key.
GAPPED = """gapped AS (SELECT o_orderkey, o_totalprice,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders),
levels AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS code
  FROM gapped WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority),
indexed AS (SELECT o_orderkey, o_totalprice, g.o_orderpriority,
  coalesce(code, (SELECT count(*) FROM levels))::DOUBLE AS o_orderpriority_index
  FROM gapped g LEFT JOIN levels l ON g.o_orderpriority = l.o_orderpriority)"""
PRIORITIES = 5


def _gapped(spark, folder):
    priority = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("o_orderpriority")
    return frames.table(spark, folder, "orders").select("o_orderkey", "o_totalprice", priority)


def _slots(column: str, prefix: str, size: int) -> list:
    values = vector_to_array(F.col(column))
    return [values[k].alias(f"{prefix}{k}") for k in range(size)]


def _indicator(k: int) -> str:
    return f"CASE WHEN o_orderpriority_index = {k} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


INDICATORS = ", ".join(f"{_indicator(k)} AS d{k}" for k in range(PRIORITIES))


@query(
    "label_index",
    f"""WITH {frames.DOC_QUALITY}, codes AS (
  SELECT quality, (row_number() OVER (ORDER BY count(*) DESC, quality::VARCHAR) - 1)::DOUBLE AS label
  FROM doc_quality GROUP BY quality)
SELECT doc_id, quality, label FROM doc_quality JOIN codes USING (quality)""",
)
def _(spark, folder):
    rows = frames.doc_quality(spark, folder).select("doc_id", "quality")
    return EN.label_index(rows, "quality").transform(rows)


@query(
    "target_label",
    f"""WITH {frames.ORDER_STATUS} SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM order_status""",
)
def _(spark, folder):
    label = EN.target_label("o_orderstatus", "F").alias("label")
    return frames.order_status(spark, folder).select("o_orderkey", label)


@query("string_index", f"WITH {GAPPED} SELECT o_orderkey, o_orderpriority, o_orderpriority_index FROM indexed")
def _(spark, folder):
    rows = _gapped(spark, folder).drop("o_totalprice")
    return EN.fit_string_index(rows, ["o_orderpriority"]).transform(rows)


@query("string_index_join", f"WITH {GAPPED} SELECT o_orderkey, o_orderpriority, o_orderpriority_index FROM indexed")
def _(spark, folder):
    """The same numbers by joins: two levels count as frequent here, the others are joined by hash."""
    return EN.string_index(_gapped(spark, folder).drop("o_totalprice"), ["o_orderpriority"], heavy=2)


@query(
    "string_index_wide",
    """WITH levels AS (SELECT c_name, row_number() OVER (ORDER BY count(*) DESC, c_name) - 1 AS code
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name)
SELECT o_orderkey, c_name, code::DOUBLE AS c_name_index
FROM orders JOIN customer ON o_custkey = c_custkey JOIN levels USING (c_name)""",
)
def _(spark, folder):
    """A level per customer: more than are broadcast."""
    customer = frames.table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    rows = frames.table(spark, folder, "orders").select("o_orderkey", "o_custkey").join(customer, "o_custkey")
    return EN.string_index(rows.drop("o_custkey"), ["c_name"], heavy=50)


@query("one_hot", f"WITH {GAPPED} SELECT o_orderkey, {INDICATORS} FROM indexed")
def _(spark, folder):
    rows = _gapped(spark, folder)
    stages = [EN.string_indexer(["o_orderpriority"]), EN.one_hot_encoder(["o_orderpriority"])]
    coded = EN.compose_stages(rows, stages).transform(rows)
    return coded.select("o_orderkey", *_slots("o_orderpriority_cat", "d", PRIORITIES))


@query(
    "assemble_onehot",
    f"WITH {GAPPED} SELECT o_orderkey, {INDICATORS}, o_totalprice AS d{PRIORITIES} FROM indexed",
)
def _(spark, folder):
    rows = _gapped(spark, folder)
    stages = [
        EN.string_indexer(["o_orderpriority"]),
        EN.one_hot_encoder(["o_orderpriority"]),
        EN.onehot_assembler(["o_orderpriority"], ["o_totalprice"]),
    ]
    coded = EN.compose_stages(rows, stages).transform(rows)
    return coded.select("o_orderkey", *_slots("features", "d", PRIORITIES + 1))


@query(
    "assemble_tree",
    f"WITH {GAPPED} SELECT o_orderkey, o_orderpriority_index AS f0, o_totalprice AS f1 FROM indexed",
)
def _(spark, folder):
    rows = _gapped(spark, folder)
    stages = [EN.string_indexer(["o_orderpriority"]), EN.tree_assembler(["o_orderpriority"], ["o_totalprice"])]
    coded = EN.compose_stages(rows, stages).transform(rows)
    return coded.select("o_orderkey", *_slots("features", "f", 2))


@query(
    "standard_scale",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round(l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) AS s0,
  round(l_extendedprice / (SELECT stddev_samp(l_extendedprice) FROM lineitem), 6) AS s1,
  round(l_discount / (SELECT stddev_samp(l_discount) FROM lineitem), 6) AS s2,
  round(l_tax / (SELECT stddev_samp(l_tax) FROM lineitem), 6) AS s3 FROM lineitem""",
)
def _(spark, folder):
    rows = EN.tree_assembler([], frames.LINE_NUMERIC).transform(frames.returns(spark, folder))
    scaled = EN.standard_scaler().fit(rows).transform(rows)
    slots = scaled.select(*frames.LINE_KEYS, *_slots("scaled_features", "s", 4))
    return rounded(slots, "s0", "s1", "s2", "s3")


SCALED_SLOTS = ", ".join(
    f"round(d{k} / (SELECT stddev_samp(d{k}) FROM wide), 6) AS s{k}" for k in range(PRIORITIES + 1)
)


@query(
    "compose_stages",
    f"""WITH {GAPPED}, wide AS (SELECT o_orderkey, {INDICATORS}, o_totalprice AS d{PRIORITIES} FROM indexed)
SELECT o_orderkey, {SCALED_SLOTS} FROM wide""",
)
def _(spark, folder):
    rows = _gapped(spark, folder)
    stages = [
        EN.string_indexer(["o_orderpriority"]),
        EN.one_hot_encoder(["o_orderpriority"]),
        EN.onehot_assembler(["o_orderpriority"], ["o_totalprice"]),
        EN.standard_scaler(),
    ]
    coded = EN.compose_stages(rows, stages).transform(rows)
    slots = coded.select("o_orderkey", *_slots("scaled_features", "s", PRIORITIES + 1))
    return rounded(slots, *[f"s{k}" for k in range(PRIORITIES + 1)])


LINE_BUCKET = f"{frames.digest_sql(8, 42, *frames.LINE_KEYS)} % 10000"


@query(
    "random_split",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN {LINE_BUCKET} < 7000 THEN 'train' ELSE 'test' END AS split FROM lineitem""",
)
def _(spark, folder):
    rows = frames.table(spark, folder, "lineitem").select(*frames.LINE_KEYS)
    return random_split(rows, frames.LINE_KEYS, 0.7, 42)


@query(
    "stratified_split",
    f"""WITH {frames.RETURNS}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY y ORDER BY tie) AS place, count(*) OVER (PARTITION BY y) AS size FROM (
    SELECT *, {frames.digest_sql(15, 2020, *frames.LINE_KEYS)} AS tie
    FROM returns)),
limits AS (SELECT *, round(0.1 * size) AS test_rows FROM placed)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, y,
  CASE WHEN place <= test_rows THEN 'test'
       WHEN place <= test_rows + round(0.1 * (size - test_rows)) THEN 'cv' ELSE 'train' END AS split
FROM limits""",
)
def _(spark, folder):
    rows = frames.returns(spark, folder).select(*frames.LINE_KEYS, "y")
    return stratified_split(rows, "y", frames.LINE_KEYS)


@query(
    "label_encode",
    f"""WITH {frames.ORDER_STATUS} SELECT o_orderkey,
  (dense_rank() OVER (ORDER BY n_name) - 1)::BIGINT AS n_name,
  (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::BIGINT AS c_mktsegment FROM order_status""",
)
def _(spark, folder):
    rows = frames.order_status(spark, folder).select("o_orderkey", "n_name", "c_mktsegment")
    return EN.label_encode(rows, ["n_name", "c_mktsegment"])


@query(
    "encoding_map",
    f"""WITH {frames.ORDER_STATUS} SELECT 'n_name' AS "Variable", value,
  (row_number() OVER (ORDER BY value) - 1)::INTEGER AS code FROM (SELECT DISTINCT n_name AS value FROM order_status)
UNION ALL SELECT 'c_mktsegment', value, (row_number() OVER (ORDER BY value) - 1)::INTEGER
FROM (SELECT DISTINCT c_mktsegment AS value FROM order_status)""",
)
def _(spark, folder):
    rows = frames.order_status(spark, folder)
    return EN.encoding_map(rows, EN.label_encoder(["n_name", "c_mktsegment"]).fit(rows))


@query(
    "label_encode_wide",
    """SELECT doc_id, (dense_rank() OVER (ORDER BY text) - 1)::BIGINT AS text,
  (dense_rank() OVER (ORDER BY lang) - 1)::BIGINT AS lang FROM documents""",
)
def _(spark, folder):
    rows = frames.table(spark, folder, "documents").select("doc_id", "text", "lang")
    return EN.label_encode(rows, ["text", "lang"], limit=100)


@query(
    "level_codes",
    """SELECT 'lang' AS "Variable", value, (row_number() OVER (ORDER BY value) - 1)::BIGINT AS code
FROM (SELECT DISTINCT lang AS value FROM documents)
UNION ALL SELECT 'text', value, (row_number() OVER (ORDER BY value) - 1)::BIGINT
FROM (SELECT DISTINCT text AS value FROM documents)""",
)
def _(spark, folder):
    return EN.level_codes(frames.table(spark, folder, "documents"), ["lang", "text"])


NULL_LEVELS_SQL = """WITH rows AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS level FROM orders),
codes AS (SELECT level, row_number() OVER (ORDER BY level) - 1 AS code FROM (SELECT DISTINCT level FROM rows WHERE level IS NOT NULL))
SELECT o_orderkey, code::BIGINT AS level FROM rows LEFT JOIN codes USING (level)"""


def _null_levels(spark, folder, limit):
    level = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("level")
    rows = frames.table(spark, folder, "orders").select("o_orderkey", level)
    return EN.label_encode(rows, ["level"], limit=limit)


@query("label_encode_nulls", NULL_LEVELS_SQL)
def _(spark, folder):
    return _null_levels(spark, folder, 100)


@query("label_encode_nulls_wide", NULL_LEVELS_SQL)
def _(spark, folder):
    return _null_levels(spark, folder, 1)


NULL_KEY_SQL = f"""WITH keyed AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS a,
  CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS b FROM orders)
SELECT o_orderkey, a, b, CASE WHEN {frames.digest_sql(8, 42, "a", "b", "o_orderkey")} % 10000 < 7000
  THEN 'train' ELSE 'test' END AS split FROM keyed"""


@query("random_split_null_keys", NULL_KEY_SQL)
def _(spark, folder):
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    rows = frames.table(spark, folder, "orders").select(
        "o_orderkey", F.when(key % 3 == 0, status).alias("a"), F.when(key % 3 == 1, status).alias("b")
    )
    return random_split(rows, ["a", "b", "o_orderkey"], 0.7, 42)
