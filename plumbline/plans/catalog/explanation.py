"""Plot data, partial dependence and attributions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plumbline.operators import explain as X
from plumbline.operators.attribution import expected_margin, model_leaves, tree_shap_wide
from plumbline.operators.models import predict_labels
from plumbline.plans.catalog import frames
from plumbline.plans.catalog.modelling import explained_documents
from plumbline.plans.catalog.registry import query, rounded

FEATURES = list(frames.LINE_NUMERIC)
STEPS = "[" + ", ".join(f"{k} / 9.0::DOUBLE" for k in range(10)) + "]"


def _grid_sql(source: str, features: list[str]) -> str:
    """CTEs ``grids`` (edges or levels per feature) and ``bucketed`` (long rows with bucket number)."""
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS \"Variable\", {f}::DOUBLE AS x, y, score FROM {source}" for f in features
    )
    return f"""long AS MATERIALIZED ({long}),
levels AS MATERIALIZED (
  SELECT "Variable", list(x ORDER BY x) AS grid FROM (SELECT DISTINCT "Variable", x FROM long WHERE x IS NOT NULL)
  GROUP BY "Variable" HAVING count(*) < 10),
cuts AS MATERIALIZED (
  SELECT "Variable", list_sort(list_distinct(quantile_cont(x, {STEPS}))) AS grid FROM long GROUP BY "Variable"),
grids AS MATERIALIZED (
  SELECT "Variable", levels.grid IS NOT NULL AS is_levels, coalesce(levels.grid, cuts.grid) AS grid
  FROM cuts LEFT JOIN levels USING ("Variable")),
bucketed AS (
  SELECT "Variable", x, y, score, grid, is_levels,
    len(list_filter(CASE WHEN is_levels THEN grid[2:] ELSE grid[2:-2] END, lambda e: e <= x))::INTEGER AS bucket
  FROM long JOIN grids USING ("Variable"))"""


EDGES = """round(any_value(grid[bucket + 1]), 6) AS low,
  round(any_value(CASE WHEN is_levels THEN grid[bucket + 1] ELSE grid[bucket + 2] END), 6) AS high"""
QUARTILES = """round(quantile_cont(score, 0.25), 6) AS q1, round(quantile_cont(score, 0.5), 6) AS median,
  round(quantile_cont(score, 0.75), 6) AS q3"""


@query(
    "target_plot_data",
    f"""WITH {frames.SCORED}, {_grid_sql("scored", FEATURES)}
SELECT "Variable", bucket, {EDGES}, count(*) AS count, round(avg(y), 6) AS mean_target
FROM bucketed GROUP BY "Variable", bucket""",
)
def _(spark, folder):
    plot = X.target_plot_data(frames.returns_scored(spark, folder), FEATURES, "y")
    return rounded(plot, "low", "high", "mean_target")


@query(
    "actual_plot_data",
    f"""WITH {frames.SCORED}, {_grid_sql("scored", FEATURES)}
SELECT "Variable", bucket, {EDGES}, count(*) AS count, {QUARTILES}
FROM bucketed GROUP BY "Variable", bucket""",
)
def _(spark, folder):
    plot = X.actual_plot_data(frames.returns_scored(spark, folder), FEATURES, "score")
    return rounded(plot, "low", "high", "q1", "median", "q3")


def _inner_edges(feature: str) -> str:
    return f"(SELECT list_sort(list_distinct(quantile_cont({feature}, {STEPS})))[2:-2] FROM scored)"


@query(
    "actual_interact_data",
    f"""WITH {frames.SCORED}, cells AS (
  SELECT score, len(list_filter({_inner_edges("l_extendedprice")}, lambda e: e <= l_extendedprice))::INTEGER AS bucket_1,
    len(list_filter({_inner_edges("l_quantity")}, lambda e: e <= l_quantity))::INTEGER AS bucket_2 FROM scored)
SELECT bucket_1, bucket_2, count(*) AS count, {QUARTILES} FROM cells GROUP BY bucket_1, bucket_2""",
)
def _(spark, folder):
    plot = X.actual_interact_data(
        frames.returns_scored(spark, folder), ["l_extendedprice", "l_quantity"], "score"
    )
    return rounded(plot, "q1", "median", "q3")


# A closed-form model in the place of a fitted one.
CLOSED_FORM = """1 / (1 + exp(-(0.04 * l_quantity - 6 * l_discount + l_extendedprice / 100000 * l_tax * 20 - 1)))"""


def closed_form(df):
    return df.withColumn("score", F.expr(CLOSED_FORM))


def _pdp_part(feature: str) -> str:
    """SQL of the one-way dependence on a feature, over its grid."""
    replaced = CLOSED_FORM.replace(feature, "g")
    return f"""SELECT '{feature}' AS "Variable", round(g, 6) AS grid_value, count(*) AS count,
  round(avg({replaced}), 6) AS partial_dependence
FROM returns, (SELECT unnest(CASE WHEN count(DISTINCT {feature}) < 10 THEN list_distinct(list({feature}))
  ELSE list_distinct(quantile_cont({feature}, {STEPS})) END) AS g FROM returns) GROUP BY g"""


@query(
    "partial_dependence",
    f"WITH {frames.RETURNS} " + " UNION ALL ".join(_pdp_part(f) for f in ("l_quantity", "l_discount", "l_tax")),
)
def _(spark, folder):
    rows = frames.returns(spark, folder).select(*FEATURES)
    grids = X.grid_values(rows, ["l_quantity", "l_discount", "l_tax"])
    return rounded(X.partial_dependence(rows, grids, closed_form), "grid_value", "partial_dependence")


_GRID = (
    "(SELECT {a}, (row_number() OVER (ORDER BY {a}) - 1) / greatest(1, count(*) OVER () - 1)::DOUBLE AS place_{a} FROM "
    "(SELECT unnest(list_distinct(quantile_cont({f}, " + STEPS + "))) AS {a} FROM returns))"
)


@query(
    "partial_dependence_2way",
    f"""WITH {frames.RETURNS} SELECT round(a, 6) AS grid_1, round(b, 6) AS grid_2, round(place_a, 6) AS position_1,
  round(place_b, 6) AS position_2, count(*) AS count,
  round(avg({CLOSED_FORM.replace("l_quantity", "a").replace("l_extendedprice", "b")}), 6) AS partial_dependence
FROM returns, {_GRID.format(f="l_quantity", a="a")}, {_GRID.format(f="l_extendedprice", a="b")} GROUP BY ALL""",
)
def _(spark, folder):
    rows = frames.returns(spark, folder).select(*FEATURES)
    pair = ["l_quantity", "l_extendedprice"]
    plot = X.partial_dependence_2way(rows, pair, X.grid_values(rows, pair), closed_form)
    return rounded(plot, "grid_1", "grid_2", "position_1", "position_2", "partial_dependence")


INTEGER_FORM = "l_linenumber * 0.3 + l_linenumber * l_linenumber * 0.01 + l_quantity * 0.001"


def _integer_rows(spark, folder):
    """Line numbers are integers; a grid may lie between them."""
    rows = frames.table(spark, folder, "lineitem").select("l_linenumber", "l_quantity")
    return rows, {"l_linenumber": [1.0, 1.5, 2.25, 6.9], "l_quantity": [10.5, 20.0]}


@query(
    "partial_dependence_integer",
    f"""SELECT 'l_linenumber' AS "Variable", g AS grid_value, count(*) AS count,
  round(avg({INTEGER_FORM.replace("l_linenumber", "g")}), 6) AS partial_dependence
FROM lineitem, (SELECT unnest([1.0::DOUBLE, 1.5, 2.25, 6.9]) AS g) GROUP BY g""",
)
def _(spark, folder):
    rows, grids = _integer_rows(spark, folder)
    scored = X.partial_dependence(
        rows, {"l_linenumber": grids["l_linenumber"]}, lambda df: df.withColumn("score", F.expr(INTEGER_FORM))
    )
    return rounded(scored, "partial_dependence")


@query(
    "partial_dependence_2way_integer",
    f"""SELECT g AS grid_1, h AS grid_2, round(p, 6) AS position_1, q AS position_2, count(*) AS count,
  round(avg({INTEGER_FORM.replace("l_linenumber", "g").replace("l_quantity", "h")}), 6) AS partial_dependence
FROM lineitem, (VALUES (1.0::DOUBLE, 0.0::DOUBLE), (1.5, 1 / 3.0), (2.25, 2 / 3.0), (6.9, 1.0)) a(g, p),
  (VALUES (10.5::DOUBLE, 0.0::DOUBLE), (20.0, 1.0)) b(h, q)
GROUP BY ALL""",
)
def _(spark, folder):
    rows, grids = _integer_rows(spark, folder)
    pair = ["l_linenumber", "l_quantity"]
    scored = X.partial_dependence_2way(rows, pair, grids, lambda df: df.withColumn("score", F.expr(INTEGER_FORM)))
    return rounded(scored, "position_1", "partial_dependence")


@query("partial_dependence_model")
def _(spark, folder):
    explained = explained_documents(spark, folder)
    grids = X.grid_values(explained.rows, explained.features)
    return X.partial_dependence(explained.rows.select(*explained.features), grids, explained.scored, cuts=explained.cuts())


@query("actual_plot_model")
def _(spark, folder):
    explained = explained_documents(spark, folder)
    return X.actual_plot_data(explained.scored_once(), explained.features, "score")


@query("tree_shap")
def _(spark, folder):
    return explained_documents(spark, folder).attributions(["doc_id"])


TRAIN_DOCUMENTS = f"""placed AS (
  SELECT doc_id, row_number() OVER (PARTITION BY quality ORDER BY {frames.digest_sql(15, 2020, "doc_id")}) AS place,
    count(*) OVER (PARTITION BY quality) AS size FROM labels JOIN documents USING (doc_id)),
limits AS (SELECT *, round(0.1 * size) AS test_rows FROM placed),
split AS (SELECT doc_id, CASE WHEN place <= test_rows THEN 'test'
  WHEN place <= test_rows + round(0.1 * (size - test_rows)) THEN 'cv' ELSE 'train' END AS split FROM limits)"""


@query("tree_shap_additive", f"WITH {TRAIN_DOCUMENTS} SELECT doc_id, 0.0::DOUBLE AS gap FROM split WHERE split = 'train'")
def _(spark, folder):
    """Expected margin plus all attributions of a row is the margin of the row."""
    explained = explained_documents(spark, folder)
    base = 2 * expected_margin(model_leaves(explained.rows, explained.model))
    scored = explained.scored(explained.train)
    wide = tree_shap_wide(scored, explained.model, keep=["doc_id", "rawPrediction"], scale=2.0)
    total = F.aggregate("shap_values", F.lit(base), lambda a, x: a + x)
    margin = 2 * vector_to_array(F.col("rawPrediction"))[1]
    return wide.select("doc_id", (F.round(F.abs(total - margin), 6) + 0.0).alias("gap"))


@query("predict_labels_rows", f"WITH {TRAIN_DOCUMENTS} SELECT doc_id, TRUE AS is_label FROM split WHERE split = 'cv'")
def _(spark, folder):
    explained = explained_documents(spark, folder)
    rows = predict_labels(explained.model, explained.assembled(explained.cv), ["doc_id"])
    return rows.select("doc_id", F.col("prediction").isin(0.0, 1.0).alias("is_label"))


@query("tree_shap_ranking")
def _(spark, folder):
    return X.abs_shap(explained_documents(spark, folder).attributions())


@query(
    "shap_summary",
    f"""WITH {frames.ATTRIBUTIONS} SELECT "Variable", count(*) AS count, round(avg(abs(shap_value)), 8) AS mean_abs,
  round(min(shap_value), 8) AS min_shap, round(max(shap_value), 8) AS max_shap, min(feature_value) AS min_value,
  max(feature_value) AS max_value, round(quantile_cont(shap_value, 0.25), 8) AS q1,
  round(quantile_cont(shap_value, 0.5), 8) AS median, round(quantile_cont(shap_value, 0.75), 8) AS q3
FROM attributions GROUP BY "Variable" """,
)
def _(spark, folder):
    summary = X.shap_summary(frames.attributions(spark, folder))
    return rounded(summary, "mean_abs", "min_shap", "max_shap", "q1", "median", "q3", digits=8)


@query(
    "abs_shap",
    f"""WITH {frames.ATTRIBUTIONS}, linked AS (
  SELECT "Variable", avg(abs(shap_value)) AS a,
    coalesce(CASE WHEN min(feature_value) < max(feature_value) THEN corr(feature_value, shap_value) END, 0) AS c
  FROM attributions GROUP BY "Variable")
SELECT "Variable", round(a, 8) AS "SHAP_abs", round(c, 8) AS "Corr", CASE WHEN c > 0 THEN 'red' ELSE 'blue' END AS "Sign"
FROM linked""",
)
def _(spark, folder):
    return rounded(X.abs_shap(frames.attributions(spark, folder)), "SHAP_abs", "Corr", digits=8)


def _step_sql(column: str) -> str:
    share = f"coalesce(({column} - low_{column}) / nullif(high_{column} - low_{column}, 0), 0)"
    return f"least(floor({share} * 20), 19)::INTEGER"


@query(
    "shap_density",
    f"""WITH {frames.ATTRIBUTIONS}, edges AS (
  SELECT "Variable", min(feature_value) AS low_feature_value, max(feature_value) AS high_feature_value,
    min(shap_value) AS low_shap_value, max(shap_value) AS high_shap_value FROM attributions GROUP BY "Variable")
SELECT "Variable", {_step_sql("feature_value")} AS value_step, {_step_sql("shap_value")} AS shap_step, count(*) AS count
FROM attributions JOIN edges USING ("Variable") GROUP BY ALL""",
)
def _(spark, folder):
    return X.shap_density(frames.attributions(spark, folder))
