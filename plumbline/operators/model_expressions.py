"""Fitted models as column expressions: coefficients and node tables as arrays, walked in the JVM.

A compiled model scores rows without the learner, in any query, and checks it: the
expression and the model must agree for every row. Its size follows the model only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.operators.attribution import node_table


def _array(values: Sequence, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def logistic_probability(model: Model, features: Column) -> Column:
    """Probability of the positive class from an array of features."""
    weights = _array([float(c) for c in model.coefficients.toArray()], "double")
    margin = F.aggregate(F.zip_with(features, weights, lambda x, w: x * w), F.lit(float(model.intercept)), lambda a, x: a + x)
    return 1 / (1 + F.exp(-margin))


def _leaf_values(rows: list, value: str, features: Column) -> tuple[Column, int]:
    """Array of the value that each tree's leaf gives a row, and the number of trees."""
    rows = sorted(rows, key=lambda r: (r["tree"], r["id"]))
    place = {(r["tree"], r["id"]): k for k, r in enumerate(rows)}
    roots = [place[r["tree"], r["id"]] for r in rows if r["id"] == 0]
    depth, levels = 0, [(k, 0) for k in roots]
    for k, level in levels:
        depth = max(depth, level)
        if rows[k]["left"] >= 0:
            levels += [(place[rows[k]["tree"], rows[k][side]], level + 1) for side in ("left", "right")]

    def child(row, side: str) -> int:
        return place[row["tree"], row[side]] if row["left"] >= 0 else -1

    plain = [r["left"] >= 0 and r["levels"] < 0 for r in rows]
    left, right = (_array([child(r, side) for r in rows], "int") for side in ("left", "right"))
    feature = _array([max(0, r["feature"]) for r in rows], "int")
    limit = _array([r["limits"][0] if p else None for r, p in zip(rows, plain)], "double")
    values = _array([float(r[value]) for r in rows], "double")
    has_sets = any(r["left"] >= 0 and r["levels"] >= 0 for r in rows)
    sets = [r["limits"] if r["left"] >= 0 and r["levels"] >= 0 else [] for r in rows]
    sets = F.array(*[_array(s, "double") for s in sets]) if has_sets else None

    def step(node: Column, _: Column) -> Column:
        x = F.get(features, F.get(feature, node))
        goes_left = x <= F.get(limit, node)
        if sets is not None:
            goes_left = F.coalesce(goes_left, F.array_contains(F.get(sets, node), x))
        down = F.when(goes_left, F.get(left, node)).otherwise(F.get(right, node))
        return F.when(F.get(left, node) < 0, node).otherwise(down)

    steps = _array(list(range(depth)), "int")
    found = F.transform(_array(roots, "int"), lambda root: F.get(values, F.aggregate(steps, root, step)))
    return found, len(roots)


def boosted_probability(df: DataFrame, model: Model, features: Column) -> Column:
    """Probability of the positive class of a boosted classifier; the log-odds are twice the margin."""
    found, _ = _leaf_values(node_table(df, model).collect(), "prediction", features)
    weighted = F.zip_with(found, _array([float(w) for w in model.treeWeights], "double"), lambda v, w: v * w)
    return 1 / (1 + F.exp(-2 * F.aggregate(weighted, F.lit(0.0), lambda a, v: a + v)))


def forest_probability(df: DataFrame, model: Model, features: Column) -> Column:
    """Probability of the positive class of a binary forest: mean share over the trees."""
    found, trees = _leaf_values(node_table(df, model).collect(), "positive", features)
    return F.aggregate(found, F.lit(0.0), lambda a, v: a + v) / trees


def node_importances(df: DataFrame, model: Model, names: Sequence[str], per_tree: bool) -> DataFrame:
    """(Variable, Variable_Importance) from the node table: gain times rows of a feature's splits.

    ``per_tree``: every tree counts alike, as in a forest; else by its gains, as in boosting.
    """
    splits = node_table(df, model).filter("left >= 0")
    gains = splits.groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("g"))
    if per_tree:
        gains = gains.withColumn("g", F.try_divide("g", F.sum("g").over(W.partitionBy("tree"))))
    known = df.sparkSession.createDataFrame(list(enumerate(names)), "feature int, Variable string")
    # One row per feature: its window is the model's width.
    summed = known.join(gains, "feature", "left").groupBy("Variable").agg(F.coalesce(F.sum("g"), F.lit(0.0)).alias("g"))
    share = F.coalesce(F.try_divide("g", F.sum("g").over(W.partitionBy())), F.lit(0.0))
    return summed.select("Variable", share.alias("Variable_Importance"))


def gap(left: Column, right: Column, digits: int = 6) -> Column:
    """Rounded distance of two numbers; infinite where one is missing."""
    return F.coalesce(F.round(F.abs(left - right), digits) + 0.0, F.lit(math.inf))
