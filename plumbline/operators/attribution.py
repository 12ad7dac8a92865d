"""Exact path-dependent Shapley attributions of boosted trees, per row and feature.

The model is cut into leaves. A leaf pays its value when a row passes all tests on
its path; for a feature on the path the tests either hold for the row or, averaged
over training rows, hold with the share of rows that went that way (Lundberg et al.
2018 define the game). The Shapley weight of a set of s among d features is the
integral of t**s (1 - t)**(d - 1 - s) over [0, 1], so the sum over all sets is the
integral of a product over the features, a polynomial of degree d - 1. Gauss-Legendre
quadrature with d / 2 points gives it exactly: work grows with leaves x depth**2 and
there is no limit on the features of a path.

Leaves travel with the task; their size depends on the model only. Rows are handled in
Arrow batches inside ``mapInArrow``: no shuffle, and each task sees only its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.session import scratch_path

#: Rows handled at once, to bound the memory of deep paths.
ROWS_AT_ONCE = 2_048


@dataclass(frozen=True)
class Test:
    """One side of a split: ``feature`` at most / above ``limit``, or in / not in ``categories``."""

    feature: int
    limit: float | None
    categories: tuple[float, ...] | None
    left: bool
    share: float


@dataclass(frozen=True)
class Leaf:
    value: float  # tree weight times leaf prediction
    cover: float  # share of training rows in this leaf
    tests: tuple[Test, ...]


def node_table(df: DataFrame, model: Model) -> DataFrame:
    """Rows (tree, id, prediction, rows, gain, weight, positive, left, right, feature, limits, levels) of a
    fitted tree model, read from its saved form. A leaf has no children (-1)."""
    path = scratch_path(df.sparkSession, "trees")
    model.write().save(path)
    nodes = df.sparkSession.read.parquet(f"{path}/data")
    data = F.col("nodeData")
    stats = data["impurityStats"]
    # Regression trees keep (weight, sum, sum of squares), classification trees a weight per class.
    regression = F.lit(not hasattr(model, "trees") or "Regression" in type(model.trees[0]).__name__)
    classes = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    return nodes.select(
        F.col("treeID").alias("tree") if "treeID" in nodes.columns else F.lit(0).alias("tree"),
        data["id"].alias("id"),
        data["prediction"].alias("prediction"),
        data["rawCount"].alias("rows"),
        data["gain"].alias("gain"),
        F.when(regression, stats[0]).otherwise(classes).alias("weight"),
        F.when(~regression, F.try_divide(F.get(stats, F.lit(1)), classes)).alias("positive"),
        data["leftChild"].alias("left"),
        data["rightChild"].alias("right"),
        data["split"]["featureIndex"].alias("feature"),
        data["split"]["leftCategoriesOrThreshold"].alias("limits"),
        data["split"]["numCategories"].alias("levels"),
    )


def split_points(df: DataFrame, model: Model, names: Sequence[str]) -> dict[str, list[float]]:
    """Every test limit of a tree model per feature, ascending; only for models without categorical tests."""
    tests = node_table(df, model).filter("left >= 0")
    if tests.filter("levels >= 0").count():
        raise ValueError("categorical tests have no limits")
    limits = tests.groupBy("feature").agg(F.sort_array(F.collect_set(F.col("limits")[0])).alias("limits"))
    found = {r["feature"]: list(r["limits"]) for r in limits.collect()}  # bounded by the size of the model
    return {name: found.get(k, []) for k, name in enumerate(names)}


def model_leaves(df: DataFrame, model: Model) -> list[Leaf]:
    """Leaves of a fitted boosted or single regression tree model, read from its saved node table."""
    rows = node_table(df, model).collect()  # bounded by the size of the model
    trees: dict[int, dict[int, object]] = {}
    for row in rows:
        trees.setdefault(row["tree"], {})[row["id"]] = row
    leaves: list[Leaf] = []
    for tree, weight in enumerate(model.treeWeights):
        table = trees[tree]
        pending = [(0, ())]
        while pending:
            number, tests = pending.pop()
            node = table[number]
            if node["left"] < 0:
                leaves.append(Leaf(weight * node["prediction"], node["rows"] / table[0]["rows"], tests))
                continue
            categorical = node["levels"] >= 0
            for side, is_left in ((node["left"], True), (node["right"], False)):
                test = Test(
                    node["feature"],
                    None if categorical else node["limits"][0],
                    tuple(node["limits"]) if categorical else None,
                    is_left,
                    table[side]["rows"] / node["rows"],
                )
                pending.append((side, (*tests, test)))
    return leaves


def expected_margin(leaves: Sequence[Leaf]) -> float:
    """Mean margin over the training rows; attributions of a row add up to its margin minus this."""
    return sum(leaf.value * leaf.cover for leaf in leaves)


def leaf_shares(leaf: Leaf) -> dict[int, float]:
    """Per feature on the path the share of training rows that pass its tests."""
    shares: dict[int, float] = {}
    for test in leaf.tests:
        shares[test.feature] = shares.get(test.feature, 1.0) * test.share
    return shares


def leaf_attributions(held: np.ndarray, away: np.ndarray, value: float) -> np.ndarray:
    """Attribution of each path feature (columns) for rows of held tests (0 or 1)."""
    size = len(away)
    nodes, weights = np.polynomial.legendre.leggauss((size + 1) // 2)
    total = np.zeros(held.shape)
    for t, weight in zip((nodes + 1) / 2, weights / 2):
        factors = held * t + away * (1 - t)
        # Products of all factors but one, from both ends.
        below, above = np.ones(held.shape), np.ones(held.shape)
        below[:, 1:] = np.cumprod(factors, axis=1)[:, :-1]
        above[:, :-1] = np.cumprod(factors[:, ::-1], axis=1)[:, ::-1][:, 1:]
        total += weight * below * above
    return value * total * (held - away)


def _by_pattern(held: np.ndarray, away: np.ndarray, value: float) -> np.ndarray:
    """:func:`leaf_attributions`, once per different pattern of held tests.

    A path of d features has at most 2**d patterns, mostly far fewer than rows.
    """
    packed = np.packbits(held.astype(bool), axis=1)
    codes = packed[:, 0] if packed.shape[1] == 1 else packed.view(np.dtype((np.void, packed.shape[1])))[:, 0]
    _, first, place = np.unique(codes, return_index=True, return_inverse=True)
    return leaf_attributions(held[first], away, value)[place]


def tree_shap_wide(
    df: DataFrame, model: Model, features: str = "features", keep: Sequence[str] = (), scale: float = 1.0
) -> DataFrame:
    """Adds ``shap_values`` (array, one entry per feature) to the kept columns and the feature values.

    ``scale`` 2 turns margins into log-odds.
    """
    leaves = model_leaves(df, model)
    width = model.numFeatures
    plan = []
    for leaf in leaves:
        if leaf.tests:
            shares = leaf_shares(leaf)
            tests = [[(t.limit, t.categories, t.left) for t in leaf.tests if t.feature == f] for f in shares]
            plan.append((list(shares), tests, np.array(list(shares.values())), leaf.value * scale))

    def add_leaves(values: np.ndarray, result: np.ndarray) -> None:
        for names, tests, away, value in plan:
            held = np.ones((len(values), len(names)))
            for k, (feature, group) in enumerate(zip(names, tests)):
                for limit, categories, left in group:
                    x = values[:, feature]
                    goes_left = x <= limit if categories is None else np.isin(x, categories)
                    held[:, k] *= goes_left if left else ~goes_left
            result[:, names] += _by_pattern(held, away, value)

    def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("feature_values"))
            values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            result = np.zeros(values.shape)
            for start in range(0, len(values), ROWS_AT_ONCE):
                add_leaves(values[start : start + ROWS_AT_ONCE], result[start : start + ROWS_AT_ONCE])
            offsets = np.arange(0, result.size + 1, width, dtype=np.int32)
            shap = pa.ListArray.from_arrays(pa.array(offsets), pa.array(result.ravel()))
            names_out = [*batch.schema.names, "shap_values"]
            yield pa.RecordBatch.from_arrays([*batch.columns, shap], names=names_out)

    rows = df.select(*keep, vector_to_array(F.col(features)).alias("feature_values"))
    schema = T.StructType([*rows.schema.fields, T.StructField("shap_values", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(attribute, schema)


def tree_shap(
    df: DataFrame,
    model: Model,
    names: Sequence[str],
    features: str = "features",
    keep: Sequence[str] = (),
    scale: float = 1.0,
) -> DataFrame:
    """Long form: a (kept columns, Variable, feature_value, shap_value) row per row and feature."""
    wide = tree_shap_wide(df, model, features, keep, scale)
    entries = [
        F.struct(
            F.lit(name).alias("Variable"),
            F.col("feature_values")[k].alias("feature_value"),
            F.col("shap_values")[k].alias("shap_value"),
        )
        for k, name in enumerate(names)
    ]
    return wide.select(*keep, F.inline(F.array(*entries)))
