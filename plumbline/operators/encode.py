"""Turning columns into model features. All stages are Spark ML transformers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.operators.profile import value_counts
from plumbline.session import stored

INDEX, DUMMY, CODE = "_index", "_cat", "_code"
# Level lists of encoders live on the driver; columns with more levels are handled by joins.
DRIVER_LEVELS = 10_000


def target_label(target: str, positive_label: object) -> Column:
    """1.0 for the positive value, 0.0 for any other."""
    return F.col(target).eqNullSafe(F.lit(positive_label)).cast("double")


def label_index(df: DataFrame, target: str, output: str = "label") -> StringIndexerModel:
    """Numbers target values by falling frequency (equal counts alphabetically)."""
    return StringIndexer(inputCol=target, outputCol=output, stringOrderType="frequencyDesc").fit(df)


def string_indexer(columns: Sequence[str]) -> StringIndexer:
    """Numbers levels by falling frequency; unseen and missing ones share an extra number.

    The level lists end up on the driver: drop high-cardinality columns before.
    """
    return StringIndexer(
        inputCols=list(columns), outputCols=[c + INDEX for c in columns], handleInvalid="keep"
    )


def one_hot_encoder(columns: Sequence[str]) -> OneHotEncoder:
    """Indicator vectors of indexed columns. The slot left out is that of unseen levels."""
    return OneHotEncoder(
        inputCols=[c + INDEX for c in columns], outputCols=[c + DUMMY for c in columns], dropLast=True
    )


def onehot_assembler(categorical: Sequence[str], numeric: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=[c + DUMMY for c in categorical] + list(numeric), outputCol=output)


def tree_inputs(categorical: Sequence[str], numeric: Sequence[str]) -> list[str]:
    return [c + INDEX for c in categorical] + list(numeric)


def tree_assembler(categorical: Sequence[str], numeric: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=tree_inputs(categorical, numeric), outputCol=output)


def standard_scaler(features: str = "features", output: str = "scaled_features") -> StandardScaler:
    """Divides by the sample standard deviation; no centring, so sparse vectors stay sparse."""
    return StandardScaler(inputCol=features, outputCol=output, withMean=False, withStd=True)


def compose_stages(df: DataFrame, stages: Sequence) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(df)


def few_levels(df: DataFrame, columns: Sequence[str], limit: int = DRIVER_LEVELS) -> list[str]:
    """The columns with at most about ``limit`` levels, by one sketch pass."""
    if not columns:
        return []
    counts = df.agg(*[F.approx_count_distinct(c).alias(f"d{k}") for k, c in enumerate(columns)]).first()
    return [c for k, c in enumerate(columns) if counts[f"d{k}"] <= limit]


def fit_string_index(df: DataFrame, columns: Sequence[str], limit: int = DRIVER_LEVELS) -> StringIndexerModel:
    """Fits :func:`string_indexer` for a learner after checking that the level lists fit the driver.

    :func:`string_index` gives the same numbers for any number of levels.
    """
    wide = set(columns) - set(few_levels(df, columns, limit))
    if wide:
        raise ValueError(f"more than {limit} levels, drop or index by join: {sorted(wide)}")
    return string_indexer(columns).fit(df)


def frequency_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(Variable, value, code): levels by falling frequency (equal counts alphabetically), for any number of levels."""
    levels = value_counts(df, columns).filter(F.col("value").isNotNull())
    return _numbered(levels, [F.desc("n"), F.asc("value")])


def string_index(
    df: DataFrame, columns: Sequence[str], codes: DataFrame | None = None, heavy: int = DRIVER_LEVELS
) -> DataFrame:
    """Adds the index (double) of string columns as :func:`string_indexer` does, without a level list on the driver.

    ``codes``: from :func:`frequency_codes` of the fitting rows (default: ``df`` itself). The
    ``heavy`` most frequent levels of a column are broadcast, at most that many rows of a level
    name each; a level beyond them has at most a ``heavy``-th of the rows and is joined by hash.
    Null and unknown levels get the number of levels, and null takes part in no join.
    """
    codes = codes if codes is not None else stored(frequency_codes(df, columns), "codes")
    sizes = {r["Variable"]: r["n"] for r in codes.groupBy("Variable").agg(F.count("*").alias("n")).collect()}
    for column in columns:
        size = sizes.get(column, 0)
        index = F.coalesce(F.col("_code").cast("double"), F.lit(float(size))).alias(column + INDEX)
        own = codes.filter(F.col("Variable") == column).select(F.col("value").alias(column), F.col("code").alias("_code"))
        frequent = F.broadcast(own.filter(F.col("_code") < heavy))
        if size <= heavy:
            df = df.join(frequent, column, "left").select(*df.columns, index)
            continue
        known = df.filter(F.col(column).isNotNull())
        met = known.join(frequent, column).select(*df.columns, index)
        rest = known.join(frequent, column, "left_anti").join(own.filter(F.col("_code") >= heavy), column, "left")
        missing = df.filter(F.col(column).isNull()).select("*", F.lit(float(size)).alias(column + INDEX))
        df = met.unionByName(rest.select(*df.columns, index)).unionByName(missing)
    return df


def label_encoder(columns: Sequence[str]) -> StringIndexer:
    """Numbers levels in sorted order; an unseen level is an error."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[c + CODE for c in columns],
        stringOrderType="alphabetAsc",
        handleInvalid="error",
    )


def level_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(Variable, value, code): the place of every level in sorted order, for any number of levels."""
    levels = value_counts(df, columns).filter(F.col("value").isNotNull()).select("Variable", "value")
    return _numbered(levels, [F.asc("value")])


def _numbered(levels: DataFrame, order: Sequence[Column]) -> DataFrame:
    """(Variable, value, code): the place of every level in the order.

    Levels are dealt into sorted ranges of about equal size and written with the number
    of their range; a window numbers each range and the sizes of the ranges before it,
    one row per range, are added.
    """
    placed = stored(levels.repartitionByRange("Variable", *order).withColumn("_range", F.spark_partition_id()), "levels")
    sizes = placed.groupBy("Variable", "_range").agg(F.count("*").alias("_size"))
    before = W.partitionBy("Variable").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "Variable", "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.row_number().over(W.partitionBy("Variable", "_range").orderBy(*order))
    coded = placed.withColumn("_inside", inside).join(offsets, ["Variable", "_range"])
    return coded.select("Variable", "value", (F.col("_offset") + F.col("_inside") - 1).cast("bigint").alias("code"))


def label_encode(
    df: DataFrame,
    columns: Sequence[str],
    model: StringIndexerModel | None = None,
    limit: int = DRIVER_LEVELS,
) -> DataFrame:
    """Replaces string columns by their codes (bigint) in sorted order.

    Columns of few levels go through a fitted encoder, a projection. The others are
    coded by a join with their level table, which stays distributed; adaptive
    execution splits the partition of a frequent level. On both ways a null value and
    a level that was not fitted get a null code.
    """
    narrow = list(model.getInputCols()) if model else few_levels(df, columns, limit)
    coded = df
    if narrow:
        encoder = (model or label_encoder(narrow).fit(df)).copy().setHandleInvalid("keep")
        coded = encoder.transform(coded)
        sizes = dict(zip(narrow, map(len, encoder.labelsArray)))
        known = {c: F.when(F.col(c + CODE) < sizes[c], F.col(c + CODE).cast("bigint")) for c in narrow}
        coded = coded.withColumns(known).drop(*[c + CODE for c in narrow])
    for column in [c for c in columns if c not in narrow]:
        codes = level_codes(df, [column]).select(F.col("value").alias(column), F.col("code").alias("_code"))
        coded = coded.join(codes, column, "left").withColumn(column, F.col("_code")).drop("_code")
    return coded.select(*df.columns)


def encoding_map(df: DataFrame, model: StringIndexerModel) -> DataFrame:
    """(Variable, value, code) of a fitted encoder."""
    rows = [
        (column, value, code)
        for column, labels in zip(model.getInputCols(), model.labelsArray)
        for code, value in enumerate(labels)
    ]
    return df.sparkSession.createDataFrame(rows, "Variable string, value string, code int")
