"""Fitted models: rows depend on the learner, so these queries have no SQL twin."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plumbline.functions import positive_probability
from plumbline.operators import columns as C
from plumbline.operators import encode as EN
from plumbline.operators import model_expressions as MX
from plumbline.operators import models as M
from plumbline.plans.catalog import frames
from plumbline.plans.catalog.registry import query
from plumbline.plans.explanation import Explained, explain
from plumbline.plans.model_bench import SPLIT, TARGET, BenchResult, Prepared, model_bench, prepare
from plumbline.spec import ModelSpec

ORDERS = ModelSpec(target="o_orderstatus", positive_label="F", keys=frames.ORDER_KEYS)
DOCUMENTS = ModelSpec(target="quality", keys=frames.DOC_KEYS, max_levels=21)
_KEPT: dict[tuple, object] = {}


INPUTS = ("orders", "customer", "nation", "documents", "labels")


def _stamp(spark, folder) -> tuple:
    """Paths, times and sizes of the input files: other files mean other models."""
    paths = [f"{folder}/{name}.parquet" for name in INPUTS]
    files = spark.read.format("binaryFile").load(paths).select("path", "modificationTime", "length")
    return tuple(sorted(map(tuple, files.collect())))  # one row per file


def _once(spark, folder, name, make):
    """Models of one session and state of the inputs are fitted once and shared by the queries."""
    key = (spark.sparkContext.applicationId, _stamp(spark, folder), name)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def prepared_orders(spark, folder) -> Prepared:
    return _once(spark, folder, "prepared", lambda: prepare(frames.order_status(spark, folder), ORDERS))


def _train(spark, folder):
    return prepared_orders(spark, folder).rows.filter(F.col(SPLIT) == "train")


def _inputs(spark, folder) -> list[str]:
    prepared = prepared_orders(spark, folder)
    return EN.tree_inputs(prepared.categorical, prepared.numeric)


def logistic(spark, folder):
    return _once(spark, folder, "logistic", lambda: M.fit_logistic(_train(spark, folder), "scaled_onehot"))


def forest(spark, folder):
    return _once(spark, folder, "forest", lambda: M.fit_forest(_train(spark, folder)))


def explained_documents(spark, folder) -> Explained:
    return _once(spark, folder, "explained", lambda: explain(frames.doc_quality(spark, folder), DOCUMENTS))


def bench_orders(spark, folder) -> BenchResult:
    return _once(spark, folder, "bench", lambda: model_bench(frames.order_status(spark, folder), ORDERS))


def _scored(model, spark, folder):
    rows = M.score_rows(model, prepared_orders(spark, folder).rows, ["o_orderkey", TARGET, SPLIT])
    return rows.select("o_orderkey", TARGET, SPLIT, "model_probability", "prediction")


@query("fit_logistic")
def _(spark, folder):
    return _scored(logistic(spark, folder), spark, folder)


@query("fit_mlp")
def _(spark, folder):
    return _scored(M.fit_mlp(_train(spark, folder), len(_inputs(spark, folder))), spark, folder)


@query("fit_forest")
def _(spark, folder):
    return _scored(forest(spark, folder), spark, folder)


@query("fit_gbt")
def _(spark, folder):
    return _scored(M.fit_gbt(_train(spark, folder)), spark, folder)


@query("fit_gbm_baseline")
def _(spark, folder):
    explained = explained_documents(spark, folder)
    return explained.scored(explained.rows).select("doc_id", TARGET, SPLIT, "score", "prediction")


@query("top_variables")
def _(spark, folder):
    rows = prepared_orders(spark, folder).rows
    return M.top_variables(rows, forest(spark, folder), _inputs(spark, folder))


@query("gbm_importance")
def _(spark, folder):
    explained = explained_documents(spark, folder)
    return M.gbm_importance(explained.rows, explained.model, explained.features)


@query("score_frames")
def _(spark, folder):
    rows = prepared_orders(spark, folder).rows
    parts = [rows.filter(F.col(SPLIT) == s) for s in ("train", "test")]
    scored = M.score_frames(logistic(spark, folder), *parts, keep=["o_orderkey", TARGET, SPLIT])
    return scored[0].unionByName(scored[1]).drop("rawPrediction")


@query("predict_labels")
def _(spark, folder):
    explained = explained_documents(spark, folder)
    return M.predict_labels(explained.model, explained.assembled(explained.cv), ["doc_id", TARGET])


@query("model_bench")
def _(spark, folder):
    return bench_orders(spark, folder).leaderboard


@query("model_bench_gains")
def _(spark, folder):
    return bench_orders(spark, folder).gains


@query("select_prediction_columns")
def _(spark, folder):
    scored = logistic(spark, folder).transform(prepared_orders(spark, folder).rows)
    scored = scored.withColumn("model_probability", positive_probability())
    return C.select_prediction_columns(scored, "o_orderkey").drop("rawPrediction")


@query("positive_probability")
def _(spark, folder):
    scored = forest(spark, folder).transform(prepared_orders(spark, folder).rows)
    return scored.select("o_orderkey", positive_probability().alias("model_probability"))


ORDER_SPLIT = f"""WITH {frames.ORDER_STATUS}, split AS (
  SELECT o_orderkey, CASE WHEN {frames.digest_sql(8, 42, "o_orderkey")} % 10000 < 7000 THEN 'train' ELSE 'test' END AS split
  FROM order_status)"""


@query(
    "score_invariants",
    f"""{ORDER_SPLIT} SELECT algorithm, split, count(*) AS rows, count(*) AS valid
FROM split, (SELECT unnest(['Logistic', 'MultiLayerPerceptron', 'RandomForest', 'GradientBoosting']) AS algorithm)
GROUP BY algorithm, split""",
)
def _(spark, folder):
    """Every model scores every row: a probability in [0, 1] and the prediction that goes with it."""
    score, label = F.col("model_probability"), F.col("prediction")
    fits = F.when(score > 0.5, label == 1.0).when(score < 0.5, label == 0.0).otherwise(label.isin(0.0, 1.0))
    valid = F.count(F.when((score >= 0) & (score <= 1) & fits, 1))
    rows = bench_orders(spark, folder).predictions
    return rows.groupBy("algorithm", SPLIT).agg(F.count("*").alias("rows"), valid.alias("valid"))


@query("top_variables_total", "SELECT 4::BIGINT AS inputs, 1.0::DOUBLE AS total")
def _(spark, folder):
    """Importances name every input once and add up to one."""
    rows = prepared_orders(spark, folder).rows
    found = M.top_variables(rows, forest(spark, folder), _inputs(spark, folder))
    return found.agg(F.countDistinct("Variable").alias("inputs"), F.round(F.sum("Variable_Importance"), 6).alias("total"))


@query(
    "predicted_keys",
    f"{ORDER_SPLIT} SELECT o_orderkey, split, TRUE AS scored FROM split",
)
def _(spark, folder):
    scored = _scored(logistic(spark, folder), spark, folder)
    return scored.select("o_orderkey", SPLIT, F.col("model_probability").between(0, 1).alias("scored"))


ORDER_GAP = f"WITH {frames.ORDER_STATUS} SELECT o_orderkey, 0.0::DOUBLE AS gap FROM order_status"


@query("logistic_expression", ORDER_GAP)
def _(spark, folder):
    """The compiled regression scores every row as the model does."""
    model = logistic(spark, folder)
    scored = model.transform(prepared_orders(spark, folder).rows)
    compiled = MX.logistic_probability(model, vector_to_array("scaled_onehot"))
    return scored.select("o_orderkey", MX.gap(compiled, positive_probability()).alias("gap"))


@query("positive_probability_expression", ORDER_GAP)
def _(spark, folder):
    """The extracted probability is the one that the forest's node table gives."""
    model, rows = forest(spark, folder), prepared_orders(spark, folder).rows
    compiled = MX.forest_probability(rows, model, vector_to_array(M.FEATURES))
    return model.transform(rows).select("o_orderkey", MX.gap(compiled, positive_probability()).alias("gap"))


@query("fit_gbm_baseline_expression", f"WITH {frames.DOC_QUALITY} SELECT doc_id, 0.0::DOUBLE AS gap FROM doc_quality")
def _(spark, folder):
    """The node table of the boosted model scores every row as the model does."""
    explained = explained_documents(spark, folder)
    scored = explained.scored(explained.rows)
    compiled = MX.boosted_probability(explained.rows, explained.model, vector_to_array(M.FEATURES))
    return scored.select("doc_id", MX.gap(compiled, F.col("score")).alias("gap"))


@query(
    "select_prediction_columns_expression",
    f"WITH {frames.ORDER_STATUS} SELECT o_orderkey, 0.0::DOUBLE AS gap, TRUE AS same_label FROM order_status",
)
def _(spark, folder):
    """The selected columns hold what the compiled model says: score, probabilities and label."""
    model = logistic(spark, folder)
    compiled = MX.logistic_probability(model, vector_to_array("scaled_onehot"))
    scored = model.transform(prepared_orders(spark, folder).rows).withColumn("model_probability", positive_probability())
    selected = C.select_prediction_columns(scored.withColumn("compiled", compiled), "o_orderkey", "compiled")
    label = F.when(F.col("compiled") > 0.5, 1.0).otherwise(0.0)
    same = (F.col("prediction") == label) | (F.abs(F.col("compiled") - 0.5) < 1e-9)
    return selected.select("o_orderkey", MX.gap(F.col("compiled"), F.col("model_probability")).alias("gap"), same.alias("same_label"))


def _importance_gap(found, nodes):
    both = found.join(nodes.withColumnRenamed("Variable_Importance", "other"), "Variable", "full")
    return both.select("Variable", MX.gap(F.col("Variable_Importance"), F.col("other")).alias("gap"))


@query(
    "gbm_importance_nodes",
    """SELECT column_name AS "Variable", 0.0::DOUBLE AS gap FROM (DESCRIBE documents) WHERE column_name IN ('lang', 'source', 'n_chars')""",
)
def _(spark, folder):
    """Importances recomputed from the gains of the node table."""
    explained = explained_documents(spark, folder)
    nodes = MX.node_importances(explained.rows, explained.model, explained.features, per_tree=False)
    return _importance_gap(explained.importances(), nodes)


@query(
    "top_variables_nodes",
    """SELECT column_name || CASE WHEN column_type = 'VARCHAR' THEN '_index' ELSE '' END AS "Variable", 0.0::DOUBLE AS gap
FROM (SELECT * FROM (DESCRIBE orders) UNION ALL SELECT * FROM (DESCRIBE customer))
WHERE column_name IN ('o_orderpriority', 'c_mktsegment', 'o_totalprice', 'c_acctbal')""",
)
def _(spark, folder):
    rows = prepared_orders(spark, folder).rows
    found = M.top_variables(rows, forest(spark, folder), _inputs(spark, folder))
    return _importance_gap(found, MX.node_importances(rows, forest(spark, folder), _inputs(spark, folder), per_tree=True))
