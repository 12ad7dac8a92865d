"""Gains, KS, confusion, ROC, reports and leaderboard on fixed scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import evaluation as EV
from plumbline.operators.split import random_split
from plumbline.plans.catalog import frames
from plumbline.plans.catalog.registry import query, rounded
from plumbline.session import stored

SHARES = ("Pct_target", "%Dist_Target", "%Dist_non_Target", "spread")
GAINS_SQL = """SELECT deciles, count, target, non_target, round(target * 100.0 / count, 6) AS "Pct_target",
  cum_target, cum_non_target, round(cum_target * 100.0 / total_target, 6) AS "%Dist_Target",
  round(cum_non_target * 100.0 / total_non_target, 6) AS "%Dist_non_Target",
  round(abs(cum_target * 100.0 / total_target - cum_non_target * 100.0 / total_non_target), 6) AS spread
FROM (SELECT *, sum(target) OVER w::BIGINT AS cum_target, sum(non_target) OVER w::BIGINT AS cum_non_target,
        sum(target) OVER () AS total_target, sum(non_target) OVER () AS total_non_target
      FROM (SELECT deciles, count(*) AS count, sum(y)::BIGINT AS target, sum(1 - y)::BIGINT AS non_target
            FROM (SELECT y, ntile(10) OVER (ORDER BY score DESC, tie)::INTEGER AS deciles FROM scored)
            GROUP BY deciles)
      WINDOW w AS (ORDER BY deciles))"""


@query("gains_table", f"WITH {frames.SCORED} {GAINS_SQL}")
def gains_query(spark, folder):
    rows = frames.returns_scored(spark, folder)
    return rounded(EV.gains_table(rows, "y", "score", frames.LINE_KEYS), *SHARES)


@query(
    "gains_table_continuous",
    f"""WITH {frames.RETURNS}, scored AS (SELECT y, l_extendedprice AS score,
  {frames.tie_sql(*frames.LINE_KEYS)} AS tie
  FROM returns) {GAINS_SQL}""",
)
def _(spark, folder):
    rows = frames.returns(spark, folder)
    return rounded(EV.gains_table(rows, "y", "l_extendedprice", frames.LINE_KEYS), *SHARES)


@query("ks_statistic", f"WITH {frames.SCORED}, gains AS ({GAINS_SQL}) SELECT round(max(spread), 2) AS ks FROM gains")
def _(spark, folder):
    rows = frames.returns_scored(spark, folder)
    return EV.ks_statistic(EV.gains_table(rows, "y", "score", frames.LINE_KEYS))


CONFUSION = """confusion AS (SELECT count(*) FILTER (y = 1 AND prediction = 1) AS "TP",
  count(*) FILTER (y = 0 AND prediction = 1) AS "FP", count(*) FILTER (y = 0 AND prediction = 0) AS "TN",
  count(*) FILTER (y = 1 AND prediction = 0) AS "FN" FROM scored)"""


@query("confusion_matrix", f"WITH {frames.SCORED}, {CONFUSION} SELECT * FROM confusion")
def _(spark, folder):
    return EV.confusion_matrix(frames.returns_scored(spark, folder), "y", "prediction")


@query(
    "binary_metrics",
    f"""WITH {frames.SCORED}, {CONFUSION} SELECT round("TP" / ("TP" + "FP"), 6) AS "Precision",
  round("TP" / ("TP" + "FN"), 6) AS "Recall", round(2 * "TP" / (2 * "TP" + "FP" + "FN"), 6) AS "F1",
  round(("TP" + "TN") / ("TP" + "FP" + "TN" + "FN"), 6) AS "Accuracy" FROM confusion""",
)
def _(spark, folder):
    confusion = EV.confusion_matrix(frames.returns_scored(spark, folder), "y", "prediction")
    return rounded(EV.binary_metrics(confusion), "Precision", "Recall", "F1", "Accuracy")


AUC = """round(sum(neg * (above + pos / 2.0)) / (sum(pos) * sum(neg)), 6)"""


@query(
    "roc_auc",
    f"""WITH {frames.SCORED}, per_score AS (
  SELECT score, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM scored GROUP BY score),
ranked AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) - pos AS above FROM per_score)
SELECT {AUC} AS roc_auc FROM ranked""",
)
def _(spark, folder):
    return rounded(EV.roc_auc(frames.returns_scored(spark, folder), "y", "score"), "roc_auc")


@query(
    "roc_auc_continuous",
    f"""WITH {frames.RETURNS}, per_score AS (
  SELECT l_extendedprice AS score, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM returns GROUP BY score),
ranked AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) - pos AS above FROM per_score)
SELECT {AUC} AS roc_auc FROM ranked""",
)
def _(spark, folder):
    return rounded(EV.roc_auc(frames.returns(spark, folder), "y", "l_extendedprice"), "roc_auc")


@query(
    "roc_auc_binned",
    f"""WITH {frames.SCORED}, per_bin AS (
  SELECT least(floor(score * 20), 19) AS bin, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM scored GROUP BY bin),
ranked AS (SELECT *, sum(pos) OVER (ORDER BY bin DESC) - pos AS above FROM per_bin)
SELECT {AUC} AS roc_auc FROM ranked""",
)
def _(spark, folder):
    return rounded(EV.roc_auc_binned(frames.returns_scored(spark, folder), "y", "score", 20), "roc_auc")


@query(
    "accuracy_score",
    f"WITH {frames.SCORED} SELECT round(avg(CASE WHEN y = prediction THEN 1 ELSE 0 END), 3) AS accuracy FROM scored",
)
def _(spark, folder):
    return EV.accuracy_score(frames.returns_scored(spark, folder), "y", "prediction")


@query(
    "classification_report",
    f"""WITH {frames.SCORED}, per_class AS (
  SELECT label::VARCHAR AS label, hit / pred AS precision, hit / truth AS recall, 2 * hit / (pred + truth) AS f1_score,
         truth::BIGINT AS support
  FROM (SELECT label, count(*) FILTER (y = label AND prediction = label)::DOUBLE AS hit,
               count(*) FILTER (y = label)::DOUBLE AS truth, count(*) FILTER (prediction = label)::DOUBLE AS pred
        FROM scored, (VALUES (0), (1)) t(label) GROUP BY label)),
everything AS (
  SELECT * FROM per_class
  UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT avg(CASE WHEN y = prediction THEN 1.0 ELSE 0.0 END) FROM scored),
    (SELECT count(*) FROM scored)
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support)::BIGINT FROM per_class
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1_score * support) / sum(support), sum(support)::BIGINT FROM per_class)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, support
FROM everything""",
)
def _(spark, folder):
    report = EV.classification_report(frames.returns_scored(spark, folder), "y", "prediction")
    return rounded(report, "precision", "recall", "f1_score")


FIXED_SCORES = {
    "Logistic": "l_quantity / 50",
    "MultiLayerPerceptron": "l_tax * 10",
    "RandomForest": "l_extendedprice / 110000",
    "GradientBoosting": "l_discount * 9",
}


def fixed_predictions(spark, folder):
    """Four fixed scores in the role of four models, on the usual split."""
    rows = random_split(frames.returns(spark, folder), frames.LINE_KEYS, 0.7, 42)
    entries = [
        F.struct(F.lit(name).alias("algorithm"), F.expr(score).alias("model_probability"))
        for name, score in FIXED_SCORES.items()
    ]
    long = rows.select(*frames.LINE_KEYS, "y", "split", F.inline(F.array(*entries)))
    return long.withColumn("prediction", (F.col("model_probability") >= 0.5).cast("double"))


def fixed_leaderboard(spark, folder):
    by = ["algorithm", "split"]
    rows = stored(fixed_predictions(spark, folder), "predictions")
    gains = EV.gains_table(rows, "y", "model_probability", frames.LINE_KEYS, by)
    metrics = EV.metric_rows(rows, gains, "y", "model_probability", "prediction", by)
    return EV.leaderboard(metrics)


FIXED_SQL = f"""{frames.RETURNS}, hashed AS (
  SELECT *, CASE WHEN {frames.digest_sql(8, 42, *frames.LINE_KEYS)} % 10000 < 7000 THEN 'Train' ELSE 'Test' END AS split,
         {frames.tie_sql(*frames.LINE_KEYS)} AS tie
  FROM returns),
long AS ({" UNION ALL ".join(f"SELECT '{n}' AS algorithm, split, y, tie, {s} AS p FROM hashed" for n, s in FIXED_SCORES.items())}),
tiles AS (
  SELECT algorithm, split, deciles, count(*) AS count, sum(y)::BIGINT AS target, sum(1 - y)::BIGINT AS non_target
  FROM (SELECT *, ntile(10) OVER (PARTITION BY algorithm, split ORDER BY p DESC, tie)::INTEGER AS deciles FROM long)
  GROUP BY algorithm, split, deciles),
gains AS (
  SELECT *, sum(target) OVER w::BIGINT AS cum_target, sum(non_target) OVER w::BIGINT AS cum_non_target,
    abs(sum(target) OVER w * 100.0 / sum(target) OVER a - sum(non_target) OVER w * 100.0 / sum(non_target) OVER a) AS spread
  FROM tiles WINDOW w AS (PARTITION BY algorithm, split ORDER BY deciles), a AS (PARTITION BY algorithm, split)),
ks AS (SELECT algorithm, split, round(max(spread), 2) AS ks FROM gains GROUP BY algorithm, split)"""


@query(
    "gains_table_grouped",
    f"""WITH {FIXED_SQL} SELECT algorithm, lower(split) AS split, deciles, count, target, non_target, cum_target,
  cum_non_target, round(spread, 6) AS spread FROM gains""",
)
def _(spark, folder):
    rows = stored(fixed_predictions(spark, folder), "predictions")
    gains = EV.gains_table(rows, "y", "model_probability", frames.LINE_KEYS, ["algorithm", "split"])
    columns = ["algorithm", "split", "deciles", "count", "target", "non_target", "cum_target", "cum_non_target"]
    return rounded(gains.select(*columns, "spread"), "spread")


LEADER_METRICS = [f"{s}_{m}" for m in EV.LEADERBOARD_METRICS for s in ("Train", "Test")]
_METRIC_SQL = {
    "Precision": "round(tp / nullif(tp + fp, 0), 6)",
    "Recall": "round(tp / nullif(tp + fn, 0), 6)",
    "F1": "round(2 * tp / nullif(2 * tp + fp + fn, 0), 6)",
    "Accuracy": "round((tp + tn) / (tp + fp + tn + fn), 6)",
    "ROC": "auc",
    "KS": "ks",
}
_LEADER_COLUMNS = ", ".join(
    f"max(CASE WHEN split = '{s}' THEN {_METRIC_SQL[m]} END) AS \"{s}_{m}\""
    for m in EV.LEADERBOARD_METRICS
    for s in ("Train", "Test")
)


@query(
    "leaderboard",
    f"""WITH {FIXED_SQL}, cells AS (
  SELECT algorithm, split, count(*) FILTER (y = 1 AND p >= 0.5)::DOUBLE AS tp,
    count(*) FILTER (y = 0 AND p >= 0.5)::DOUBLE AS fp, count(*) FILTER (y = 0 AND p < 0.5)::DOUBLE AS tn,
    count(*) FILTER (y = 1 AND p < 0.5)::DOUBLE AS fn FROM long GROUP BY algorithm, split),
per_score AS (SELECT algorithm, split, p, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM long GROUP BY ALL),
areas AS (SELECT algorithm, split, {AUC} AS auc FROM (
  SELECT *, sum(pos) OVER (PARTITION BY algorithm, split ORDER BY p DESC) - pos AS above FROM per_score)
  GROUP BY algorithm, split)
SELECT algorithm AS "Algorithms", {_LEADER_COLUMNS}
FROM cells JOIN areas USING (algorithm, split) JOIN ks USING (algorithm, split) GROUP BY algorithm""",
)
def _(spark, folder):
    return rounded(fixed_leaderboard(spark, folder), *LEADER_METRICS)
