"""The data behind target, prediction, partial-dependence and attribution plots.

Plots cover every row. Bucket edges and quartiles are exact and come from
``order_stats``; all features share one scan, as (Variable, bucket) rows that are
combined on the map side.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.scalars import null_default, sign_colour
from plumbline.operators.columns import wide_to_long
from plumbline.operators.order_stats import LARGEST, quantiles, sorted_place

GRID_POINTS = 10
SURELY_MANY = 5
QUARTILES = (0.25, 0.5, 0.75)


@dataclass(frozen=True)
class Buckets:
    """Value buckets of a feature.

    ``levels``: every value is a bucket. Otherwise bucket k spans
    [grid[k], grid[k + 1]), and the last one includes its upper edge.
    """

    grid: tuple[float, ...]
    levels: bool

    @property
    def count(self) -> int:
        return len(self.grid) if self.levels else max(1, len(self.grid) - 1)

    def number(self, value: Column) -> Column:
        inner = self.grid[1:] if self.levels else self.grid[1:-1]
        return sum(((value >= F.lit(edge)).cast("int") for edge in inner), F.lit(0))

    def low(self, k: int) -> float:
        return self.grid[k]

    def high(self, k: int) -> float:
        return self.grid[k] if self.levels else self.grid[min(k + 1, len(self.grid) - 1)]


def _as_double(df: DataFrame, features: Sequence[str], *keep: str | Column) -> DataFrame:
    return df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features])


def feature_buckets(df: DataFrame, features: Sequence[str], points: int = GRID_POINTS) -> dict[str, Buckets]:
    """Buckets per feature: levels when there are few values, else between ``points`` percentiles.

    The percentiles run from 0 to 100 in equal steps; equal ones count once.
    """
    values = _as_double(df, features)
    # A sketch rules out features with many values; only the others are counted exactly.
    sketch = values.agg(*[F.approx_count_distinct(f).alias(f"d{k}") for k, f in enumerate(features)]).first()
    maybe_few = [f for k, f in enumerate(features) if sketch[f"d{k}"] <= SURELY_MANY * points]
    levels: dict[str, list[float]] = {}
    if maybe_few:
        long = wide_to_long(values, maybe_few).filter(F.col("value").isNotNull())
        found = long.groupBy("Variable", "value").agg(F.count("*").alias("n"))
        few = found.groupBy("Variable").agg(F.sort_array(F.collect_list("value")).alias("values"))
        levels = {r["Variable"]: r["values"] for r in few.collect() if len(r["values"]) < points}
    result = {f: Buckets(tuple(v), True) for f, v in levels.items()}
    many = [f for f in features if f not in levels]
    if many:
        steps = [k / (points - 1) for k in range(points)]
        edges = quantiles(wide_to_long(values, many), "value", steps, ["Variable"])
        for feature in many:
            grid = sorted(set(edges.get((feature,), [])))
            result[feature] = Buckets(tuple(grid), False)
    return {f: result[f] for f in features if result[f].grid}


def bucketed(df: DataFrame, buckets: Mapping[str, Buckets], keep: Sequence[str]) -> DataFrame:
    """(kept columns, Variable, bucket) rows of all features; null values have no bucket."""
    entries = [
        F.when(
            F.col(f).isNotNull(),
            F.struct(F.lit(f).alias("Variable"), b.number(F.col(f).cast("double")).alias("bucket")),
        )
        for f, b in buckets.items()
    ]
    rows = df.select(*keep, F.explode(F.array(*entries)).alias("_b")).filter(F.col("_b").isNotNull())
    return rows.select(*keep, "_b.Variable", "_b.bucket")


def _bucket_table(df: DataFrame, buckets: Mapping[str, Buckets]) -> DataFrame:
    rows = [(f, k, b.low(k), b.high(k)) for f, b in buckets.items() for k in range(b.count)]
    return df.sparkSession.createDataFrame(rows, "Variable string, bucket int, low double, high double")


def target_plot_data(
    df: DataFrame, features: Sequence[str], target: str, points: int = GRID_POINTS
) -> DataFrame:
    """Rows and mean target per feature bucket."""
    buckets = feature_buckets(df, features, points)
    counted = (
        bucketed(df.withColumn("_y", F.col(target).cast("double")), buckets, ["_y"])
        .groupBy("Variable", "bucket")
        .agg(F.count("*").alias("count"), F.avg("_y").alias("mean_target"))
    )
    table = F.broadcast(_bucket_table(df, buckets))
    return counted.join(table, ["Variable", "bucket"]).select(
        "Variable", "bucket", "low", "high", "count", "mean_target"
    )


def _quartile_frame(rows: DataFrame, score: str, by: Sequence[str]) -> DataFrame:
    """(by..., count, q1, median, q3); one small row per bucket leaves the driver."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    values = quantiles(rows, score, QUARTILES, by)
    schema = T.StructType([T.StructField(b, kinds[b]) for b in by])
    for name in ("q1", "median", "q3"):
        schema = schema.add(name, "double")
    table = rows.sparkSession.createDataFrame([(*g, *v) for g, v in values.items()], schema)
    counts = rows.groupBy(*by).agg(F.count("*").alias("count"))
    return counts.join(F.broadcast(table), list(by))


def actual_plot_data(
    scored: DataFrame, features: Sequence[str], score: str, points: int = GRID_POINTS
) -> DataFrame:
    """Rows and quartiles of the prediction per feature bucket. Cache ``scored`` if it is costly."""
    buckets = feature_buckets(scored, features, points)
    rows = bucketed(scored, buckets, [score])
    table = F.broadcast(_bucket_table(scored, buckets))
    return _quartile_frame(rows, score, ["Variable", "bucket"]).join(table, ["Variable", "bucket"]).select(
        "Variable", "bucket", "low", "high", "count", "q1", "median", "q3"
    )


def actual_interact_data(
    scored: DataFrame, pair: Sequence[str], score: str, points: int = GRID_POINTS
) -> DataFrame:
    """Rows and quartiles of the prediction on the bucket grid of two features."""
    first, second = pair
    buckets = feature_buckets(scored, pair, points)
    rows = _as_double(scored, pair, score).dropna(subset=list(pair))
    rows = rows.select(
        score,
        buckets[first].number(F.col(first)).alias("bucket_1"),
        buckets[second].number(F.col(second)).alias("bucket_2"),
    )
    return _quartile_frame(rows, score, ["bucket_1", "bucket_2"]).select(
        "bucket_1", "bucket_2", "count", "q1", "median", "q3"
    )


def grid_values(df: DataFrame, features: Sequence[str], points: int = GRID_POINTS) -> dict[str, list[float]]:
    """Grid per feature: its values when there are few, else percentiles 0..100."""
    return {f: list(b.grid) for f, b in feature_buckets(df, features, points).items()}


def model_cells(df: DataFrame, cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """Features replaced by the value that stands for their cell between two cuts.

    A cell of cut c holds the values above the cut before and up to c, as a tree's tests
    ``value <= c`` tell them apart; c itself stands for it, the largest double for the last one.
    Scores of a model whose tests all lie in ``cuts`` do not change. Null and NaN stay.
    """
    placed = {}
    for feature, limits in cuts.items():
        value, limits = F.col(feature).cast("double"), sorted(set(map(float, limits)))
        if limits:
            ends = F.array(*[F.lit(c) for c in [*limits, LARGEST]])
            cell = F.get(ends, sorted_place(ends, len(limits), lambda end: end < value))
            placed[feature] = F.when(value.isNull() | F.isnan(value), value).otherwise(cell)
        else:
            placed[feature] = F.when(value.isNull() | F.isnan(value), value).otherwise(F.lit(0.0))
    return df.withColumns(placed)


def _weighted(rows: DataFrame, sides: Mapping[object, Sequence[str]]) -> dict[object, DataFrame]:
    """For each side: its columns of every row, with ``_n``, the rows that it stands for.

    Where a sketch finds at most half as many different rows as rows, equal ones are counted
    (combined on the map side); else each stands for itself. The result is the same.
    """
    names = list(sides)
    wide = {name: F.xxhash64(*sides[name]) if sides[name] else F.lit(0) for name in names}
    sketch = rows.agg(F.count("*").alias("n"), *[F.approx_count_distinct(wide[name]).alias(f"d{k}") for k, name in enumerate(names)]).first()
    result = {}
    for k, name in enumerate(names):
        if 2 * sketch[f"d{k}"] <= sketch["n"]:
            result[name] = rows.groupBy(*sides[name]).agg(F.count("*").alias("_n"))
        else:
            result[name] = rows.select(*sides[name], F.lit(1).cast("bigint").alias("_n"))
    return result


def _weighted_mean(score: str) -> list[Column]:
    """Rows behind the weighted scores, and their mean as ``avg`` would give it."""
    known = F.when(F.col(score).isNotNull(), F.col("_n"))
    mean = F.try_divide(F.sum(F.col(score) * F.col("_n")), F.sum(known))
    return [F.sum("_n").alias("count"), mean.alias("partial_dependence")]


def partial_dependence(
    df: DataFrame,
    grids: Mapping[str, Sequence[float]],
    scorer: Callable[[DataFrame], DataFrame],
    score: str = "score",
    cuts: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """Mean prediction over all rows with one feature set to each grid value.

    ``scorer`` adds the ``score`` column, a function of the row alone; it gets the features
    of the grid as doubles. Rows that agree in everything but the feature are scored once
    and weighted; ``cuts`` (all test limits of a tree model per feature) makes rows of
    one cell agree. A row is repeated once per grid value, a number fixed by the grid; only
    one partial sum per grid value is shuffled.
    """
    # In double: a grid value between two integers must reach the scorer as it is.
    rows = df.withColumns({f: F.col(f).cast("double") for f in grids})
    rows = model_cells(rows, cuts or {})
    parts = []
    sides = {f: [c for c in df.columns if c != f] for f in grids}
    for feature, held in _weighted(rows, sides).items():
        points = F.array(*[F.lit(float(v)) for v in grids[feature]])
        spread = held.select("*", F.explode(points).alias(feature)).withColumn("Variable", F.lit(feature))
        parts.append(spread.select("Variable", F.col(feature).alias("grid_value"), "_n", *df.columns))
    copies = parts[0]
    for part in parts[1:]:
        copies = copies.unionByName(part)
    return scorer(copies).groupBy("Variable", "grid_value").agg(*_weighted_mean(score))


def partial_dependence_2way(
    df: DataFrame,
    pair: Sequence[str],
    grids: Mapping[str, Sequence[float]],
    scorer: Callable[[DataFrame], DataFrame],
    score: str = "score",
    cuts: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """Mean prediction over all rows on the grid of two features, as :func:`partial_dependence`.

    ``position_1`` and ``position_2`` place a grid value among its feature's, from 0 to 1: the
    quantile axis of the plot.
    """
    pair = tuple(pair)
    first, second = pair
    places = {(f, v): p for f, v, p in grid_positions({f: grids[f] for f in dict.fromkeys(pair)})}
    points = [
        F.struct(
            F.lit(float(a)).alias("grid_1"),
            F.lit(float(b)).alias("grid_2"),
            F.lit(places[first, float(a)]).alias("position_1"),
            F.lit(places[second, float(b)]).alias("position_2"),
        )
        for a in grids[first]
        for b in grids[second]
    ]
    others = [c for c in df.columns if c not in pair]
    held = _weighted(model_cells(df, {f: c for f, c in (cuts or {}).items() if f not in pair}), {pair: others})[pair]
    rows = held.select("*", F.inline(F.array(*points)))
    rows = rows.withColumns({first: F.col("grid_1"), second: F.col("grid_2")})
    return scorer(rows).groupBy("grid_1", "grid_2", "position_1", "position_2").agg(*_weighted_mean(score))


def mean_abs(attributions: DataFrame, value: str = "shap_value", by: str = "Variable") -> DataFrame:
    return attributions.groupBy(by).agg(F.avg(F.abs(value)).alias("mean_abs"))


def corr_pair(
    attributions: DataFrame, left: str = "feature_value", right: str = "shap_value", by: str = "Variable"
) -> DataFrame:
    """Pearson correlation per group; null when a side is constant."""
    return attributions.groupBy(by).agg(_correlation(left, right).alias("corr"))


def _correlation(left: str, right: str) -> Column:
    # A constant side can leave rounding noise instead of an exact zero variance.
    varies = (F.min(left) < F.max(left)) & (F.min(right) < F.max(right))
    spread = F.stddev_pop(left) * F.stddev_pop(right)
    return F.when(varies, F.try_divide(F.covar_pop(left, right), spread))


def shap_summary(attributions: DataFrame) -> DataFrame:
    """Distribution of the attribution per feature: mean size, extremes and quartiles."""
    spread = attributions.groupBy("Variable").agg(
        F.count("*").alias("count"),
        F.avg(F.abs("shap_value")).alias("mean_abs"),
        F.min("shap_value").alias("min_shap"),
        F.max("shap_value").alias("max_shap"),
        F.min("feature_value").alias("min_value"),
        F.max("feature_value").alias("max_value"),
    )
    middle = quantiles(attributions, "shap_value", QUARTILES, ["Variable"])
    table = attributions.sparkSession.createDataFrame(
        [(*g, *v) for g, v in middle.items()], "Variable string, q1 double, median double, q3 double"
    )
    return spread.join(F.broadcast(table), "Variable", "left")


def shap_density(attributions: DataFrame, value_steps: int = 20, shap_steps: int = 20) -> DataFrame:
    """Rows per cell of feature value and attribution, both in equal steps between their extremes.

    The data of an attribution summary plot over all rows: nothing is sampled.
    """
    sides = ("feature_value", value_steps, "value_step"), ("shap_value", shap_steps, "shap_step")
    edges = attributions.groupBy("Variable").agg(
        *[f(c).alias(f"_{n}_{c}") for c, _, _ in sides for n, f in (("low", F.min), ("high", F.max))]
    )

    def step(column: str, steps: int) -> Column:
        low, high = F.col(f"_low_{column}"), F.col(f"_high_{column}")
        share = F.coalesce(F.try_divide(F.col(column) - low, high - low), F.lit(0.0))
        return F.least(F.floor(share * steps), F.lit(steps - 1)).cast("int")

    placed = attributions.join(F.broadcast(edges), "Variable")  # one row per feature
    return placed.groupBy("Variable", *[step(c, n).alias(name) for c, n, name in sides]).agg(F.count("*").alias("count"))


def grid_positions(grids: Mapping[str, Sequence[float]]) -> list[tuple[str, float, float]]:
    """(Variable, grid_value, position): the place of a grid value among its feature's, from 0 to 1."""
    return [
        (f, float(v), k / max(1, len(values) - 1)) for f, values in grids.items() for k, v in enumerate(sorted(values))
    ]


def abs_shap(attributions: DataFrame) -> DataFrame:
    """Mean attribution size per feature and the sign of its correlation with the feature value."""
    corr = null_default(F.col("corr"))
    return (
        attributions.groupBy("Variable")
        .agg(
            F.avg(F.abs("shap_value")).alias("SHAP_abs"),
            _correlation("feature_value", "shap_value").alias("corr"),
        )
        .select("Variable", "SHAP_abs", corr.alias("Corr"), sign_colour(corr).alias("Sign"))
        .orderBy("SHAP_abs", "Variable")
    )
