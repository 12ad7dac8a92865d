"""Judging scores against a binary target: gains, KS, confusion, ROC, leaderboard.

Every operator takes ``by`` columns (model, split, ...), so all models of a bench
are judged in one set of jobs. ``by`` must have few groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.functions.scalars import percent_of_total, sortable_score
from plumbline.operators.ranking import deal_copies, has_split, tile_edges, with_tile
from plumbline.session import stored

GAINS_COLUMNS = (
    "deciles",
    "count",
    "target",
    "non_target",
    "Pct_target",
    "cum_target",
    "cum_non_target",
    "%Dist_Target",
    "%Dist_non_Target",
    "spread",
)
LEADERBOARD_METRICS = ("Precision", "Recall", "F1", "Accuracy", "ROC", "KS")


def non_target_flag(df: DataFrame, target: str, output: str = "non_target") -> DataFrame:
    return df.withColumn(output, F.lit(1) - F.col(target))


def group_sum_count(df: DataFrame, group: str | Sequence[str], target: str, non_target: str) -> DataFrame:
    """Sums of target and non-target and the row count per group, in one aggregation."""
    names = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*names).agg(
        F.count("*").alias("count"),
        F.sum(target).alias("target"),
        F.sum(non_target).alias("non_target"),
    )


def cumulative_sum(
    df: DataFrame, columns: Sequence[str], order: str, by: Sequence[str] = (), prefix: str = "cum_"
) -> DataFrame:
    """Running totals along ``order``. Meant for result tables (a row per tile), not for raw rows."""
    window = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumns({prefix + c: F.sum(c).over(window) for c in columns})


def column_totals(df: DataFrame, sums: Sequence[str] = (), maxima: Sequence[str] = ()) -> DataFrame:
    return df.agg(
        *[F.sum(c).alias(f"total_{c}") for c in sums], *[F.max(c).alias(f"max_{c}") for c in maxima]
    )


def gains_table(
    df: DataFrame,
    target: str,
    score: str,
    keys: Sequence[str],
    by: Sequence[str] = (),
    tiles: int = 10,
    seed: int = 0,
) -> DataFrame:
    """Decile table of a score: counts, rates, cumulated shares and their spread.

    After the tile edges are known this is one scan with a map-side combined
    aggregation into ``tiles`` rows per group. ``df`` is read about four times: write
    it first where its score is costly.
    """
    by = list(by)
    df = df.select(*dict.fromkeys([*by, *keys, target, score]))
    edges = tile_edges(df, score, keys, tiles, by, seed, [target])
    rows = df.withColumn("_y", F.col(target).cast("bigint"))
    numbered = with_tile(rows, edges, score, keys, by, "deciles", seed, [target])
    flags = non_target_flag(numbered, "_y", "_ny")
    if not has_split(edges):
        return complete_gains(group_sum_count(flags, [*by, "deciles"], "_y", "_ny"), by)
    # Copies of one row on both sides of an edge: count them once, then deal the counts out.
    counted = group_sum_count(flags.filter("NOT _split"), [*by, "deciles"], "_y", "_ny")
    copies = flags.filter("_split").groupBy(*by, "_s", "_t", "_y", "_ny").agg(F.count("*").alias("_n"))
    dealt = deal_copies(copies, edges, [F.desc("_y")], by, "deciles").groupBy(*by, "deciles").agg(
        F.sum("_take").alias("count"),
        F.sum(F.col("_y") * F.col("_take")).alias("target"),
        F.sum(F.col("_ny") * F.col("_take")).alias("non_target"),
    )
    sums = [F.sum(c).alias(c) for c in ("count", "target", "non_target")]
    counted = counted.unionByName(dealt).groupBy(*by, "deciles").agg(*sums)
    return complete_gains(counted, by)


def complete_gains(counted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adds rates, running totals, shares and spread to tile counts (a few rows per group)."""
    everything = W.partitionBy(*by)
    table = cumulative_sum(counted, ["target", "non_target"], "deciles", by)
    return table.select(
        *by,
        "deciles",
        "count",
        "target",
        "non_target",
        percent_of_total(F.col("target"), F.col("count")).alias("Pct_target"),
        "cum_target",
        "cum_non_target",
        percent_of_total(F.col("cum_target"), F.sum("target").over(everything)).alias("%Dist_Target"),
        percent_of_total(F.col("cum_non_target"), F.sum("non_target").over(everything)).alias("%Dist_non_Target"),
    ).withColumn("spread", F.abs(F.col("%Dist_Target") - F.col("%Dist_non_Target")))


def ks_statistic(gains: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Largest spread of a gains table, rounded to two digits."""
    return gains.groupBy(*by).agg(F.round(F.max("spread"), 2).alias("ks"))


def crosstab_counts(df: DataFrame, target: str, prediction: str, values: Sequence = (0, 1)) -> DataFrame:
    """Contingency table with a column per predicted value, present or not."""
    table = df.groupBy(target).agg(
        *[F.count_if(F.col(prediction) == v).alias(f"predicted_{v}") for v in values]
    )
    return table


def confusion_matrix(df: DataFrame, target: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """The four cells by conditional counting; a class that is never predicted gives zeros."""
    hit, flagged = F.col(target) == 1, F.col(prediction) == 1
    return df.groupBy(*by).agg(
        F.count_if(hit & flagged).alias("TP"),
        F.count_if(~hit & flagged).alias("FP"),
        F.count_if(~hit & ~flagged).alias("TN"),
        F.count_if(hit & ~flagged).alias("FN"),
    )


def binary_metrics(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and accuracy; null where a denominator is zero."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("TP", "FP", "TN", "FN"))
    precision, recall = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    return confusion.select(
        *by,
        precision.alias("Precision"),
        recall.alias("Recall"),
        F.try_divide(2 * precision * recall, precision + recall).alias("F1"),
        F.try_divide(tp + tn, tp + fp + tn + fn).alias("Accuracy"),
    )


#: Distinct scores that one window may order.
CELL_SCORES = 500_000


def roc_auc(
    df: DataFrame, target: str, score: str, by: Sequence[str] = (), cell_scores: int = CELL_SCORES
) -> DataFrame:
    """Exact area under the ROC curve; equal scores count half.

    Rows are first counted per score. The scores are dealt into ranges of about
    ``cell_scores``; positives above a score are a running sum inside its range plus
    the totals of the ranges before it, so no window grows with the table.
    """
    by = list(by)
    rows = df.select(*by, sortable_score(score).alias("_s"), F.col(target).cast("bigint").alias("_y"))
    per_score = rows.groupBy(*by, "_s").agg(
        F.sum("_y").cast("double").alias("_pos"), F.sum(1 - F.col("_y")).cast("double").alias("_neg")
    )
    per_score = stored(per_score, "scores")
    ranges = -(-per_score.count() // cell_scores)
    if ranges > 1:
        dealt = per_score.repartitionByRange(ranges, *by, F.desc("_s")).withColumn("_cell", F.spark_partition_id())
    else:
        dealt = per_score.withColumn("_cell", F.lit(0))
    above = W.partitionBy(*by, "_cell").orderBy(F.desc("_s")).rowsBetween(W.unboundedPreceding, -1)
    per_cell = (
        dealt.withColumn("_above", F.coalesce(F.sum("_pos").over(above), F.lit(0.0)))
        .groupBy(*by, "_cell")
        .agg(
            F.sum("_pos").alias("_pos"),
            F.sum("_neg").alias("_neg"),
            F.sum(F.col("_neg") * (F.col("_above") + F.col("_pos") / 2)).alias("_pairs"),
        )
    )
    higher = W.partitionBy(*by).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    ranked = per_cell.withColumn("_higher", F.coalesce(F.sum("_pos").over(higher), F.lit(0.0)))
    won = F.sum(F.col("_pairs") + F.col("_neg") * F.col("_higher"))
    return ranked.groupBy(*by).agg(
        F.try_divide(won, F.sum("_pos") * F.sum("_neg")).alias("roc_auc")
    )


def roc_auc_binned(df: DataFrame, target: str, score: str, bins: int = 1_000, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve of scores in [0, 1] told apart in ``bins`` equal steps.

    One pass with a map-side combined count per bin; scores of one bin count as equal.
    Missing scores come last, scores outside the range join the outer bins.
    """
    by = list(by)
    place = F.floor(F.least(F.greatest(sortable_score(score), F.lit(0.0)), F.lit(1.0)) * bins)
    missing = F.col(score).isNull() | F.isnan(F.col(score).cast("double"))
    label = F.col(target).cast("bigint")
    counted = df.groupBy(*by, F.when(missing, -1).otherwise(F.least(place, F.lit(bins - 1))).alias("_bin")).agg(
        F.sum(label).cast("double").alias("_pos"), F.sum(1 - label).cast("double").alias("_neg")
    )
    higher = W.partitionBy(*by).orderBy(F.desc("_bin")).rowsBetween(W.unboundedPreceding, -1)
    ranked = counted.withColumn("_higher", F.coalesce(F.sum("_pos").over(higher), F.lit(0.0)))
    won = F.sum(F.col("_neg") * (F.col("_higher") + F.col("_pos") / 2))
    return ranked.groupBy(*by).agg(F.try_divide(won, F.sum("_pos") * F.sum("_neg")).alias("roc_auc"))


def accuracy_score(
    df: DataFrame, target: str, prediction: str, by: Sequence[str] = (), digits: int = 3
) -> DataFrame:
    correct = (F.col(target).cast("double") == F.col(prediction).cast("double")).cast("int")
    return df.groupBy(*by).agg(F.round(F.avg(correct), digits).alias("accuracy"))


def classification_report(
    df: DataFrame, target: str, prediction: str, classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """Precision, recall, f1 and support per class, then accuracy, macro and weighted averages.

    Undefined ratios count as 0, as in the usual printed report.
    """
    truth, guess = F.col(target), F.col(prediction)
    counts = df.agg(
        *[F.count_if((truth == c) & (guess == c)).alias(f"hit_{c}") for c in classes],
        *[F.count_if(truth == c).alias(f"true_{c}") for c in classes],
        *[F.count_if(guess == c).alias(f"pred_{c}") for c in classes],
        F.count("*").alias("rows"),
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    def entry(name: str, p: Column, r: Column, f: Column, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            p.cast("double").alias("precision"),
            r.cast("double").alias("recall"),
            f.cast("double").alias("f1_score"),
            n.cast("bigint").alias("support"),
        )

    per_class = {}
    for c in classes:
        hit, true, pred = F.col(f"hit_{c}"), F.col(f"true_{c}"), F.col(f"pred_{c}")
        per_class[c] = (ratio(hit, pred), ratio(hit, true), ratio(2 * hit, pred + true), true)
    rows = F.col("rows")
    hits = sum((F.col(f"hit_{c}") for c in classes), F.lit(0))
    accuracy = ratio(hits, rows)
    nothing = F.lit(None)
    entries = [entry(str(c), *per_class[c]) for c in classes]
    entries.append(entry("accuracy", nothing, nothing, accuracy, rows))
    for name, weight in (
        ("macro avg", {c: F.lit(1.0 / len(classes)) for c in classes}),
        ("weighted avg", {c: ratio(F.col(f"true_{c}"), rows) for c in classes}),
    ):
        averages = [sum((per_class[c][m] * weight[c] for c in classes), F.lit(0.0)) for m in range(3)]
        entries.append(entry(name, *averages, rows))
    return counts.select(F.inline(F.array(*entries)))


def metric_rows(
    predictions: DataFrame,
    gains: DataFrame,
    target: str,
    score: str,
    prediction: str,
    by: Sequence[str] = ("algorithm", "split"),
) -> DataFrame:
    """All metrics of every model and split in long form (by..., metric, value)."""
    by = list(by)
    basic = binary_metrics(confusion_matrix(predictions, target, prediction, by), by)
    area = roc_auc(predictions, target, score, by).withColumnRenamed("roc_auc", "ROC")
    spread = ks_statistic(gains, by).withColumnRenamed("ks", "KS")
    frames = [
        basic.unpivot(by, ["Precision", "Recall", "F1", "Accuracy"], "metric", "value"),
        area.unpivot(by, ["ROC"], "metric", "value"),
        spread.unpivot(by, ["KS"], "metric", "value"),
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def leaderboard(metrics: DataFrame, algorithm: str = "algorithm", split: str = "split") -> DataFrame:
    """One row per algorithm, metrics of both splits side by side in a fixed column order."""
    columns = [
        F.max(F.when((F.col(split) == s.lower()) & (F.col("metric") == m), F.col("value"))).alias(f"{s}_{m}")
        for m in LEADERBOARD_METRICS
        for s in ("Train", "Test")
    ]
    return metrics.groupBy(F.col(algorithm).alias("Algorithms")).agg(*columns)
