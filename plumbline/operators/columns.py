"""Choosing, dropping, renaming and reshaping columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATEGORICAL, NUMERIC, TEMPORAL, OTHER = "categorical", "numeric", "temporal", "other"
PREDICTION_COLUMNS = ("model_probability", "prediction", "rawPrediction", "label")


def role_of(kind: T.DataType) -> str:
    """Role of a column by its type. Booleans count as numeric (0/1)."""
    if isinstance(kind, T.StringType):
        return CATEGORICAL
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return NUMERIC
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.DatetimeType)):
        return TEMPORAL
    return OTHER


def roles(df: DataFrame) -> dict[str, str]:
    return {f.name: role_of(f.dataType) for f in df.schema.fields}


def names_with_role(df: DataFrame, role: str) -> list[str]:
    return [name for name, r in roles(df).items() if r == role]


def exclude_by_pattern(df: DataFrame, patterns: Sequence[str], active: bool = True) -> DataFrame:
    """Drops columns whose name contains a match of any pattern, in any case."""
    if not active or not patterns:
        return df
    tests = [re.compile(p, re.IGNORECASE) for p in patterns]
    return df.select(*[c for c in df.columns if not any(t.search(c) for t in tests)])


def exclude_by_name(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drops the named columns, in any case."""
    unwanted = {n.lower() for n in names}
    return df.select(*[c for c in df.columns if c.lower() not in unwanted])


def drop_unusable(df: DataFrame) -> DataFrame:
    """Keeps string and numeric columns; booleans become 0/1."""
    kept = []
    for field in df.schema.fields:
        if role_of(field.dataType) in (CATEGORICAL, NUMERIC):
            column = F.col(field.name)
            boolean = isinstance(field.dataType, T.BooleanType)
            kept.append(column.cast("int").alias(field.name) if boolean else column)
    return df.select(*kept)


def column_roles(df: DataFrame) -> DataFrame:
    """One row per column: its role and how many rows fill it."""
    entries = [
        F.struct(
            F.lit(name).alias("Variable"), F.lit(role).alias("role"), F.col(f"n{k}").alias("Non_Missing")
        )
        for k, (name, role) in enumerate(roles(df).items())
    ]
    counts = df.agg(*[F.count(c).alias(f"n{k}") for k, c in enumerate(df.columns)])
    return counts.select(F.inline(F.array(*entries)))


def column_census(df: DataFrame, kept: DataFrame) -> DataFrame:
    """How many columns of each role there are and remain, beside the row count."""
    before, after = roles(df), roles(kept)

    def number(roles_: dict[str, str], wanted: Sequence[str]) -> Column:
        return F.lit(sum(r in wanted for r in roles_.values())).cast("bigint")

    usable = (CATEGORICAL, NUMERIC)
    return df.agg(F.count("*").alias("rows")).select(
        "rows",
        F.lit(len(before)).cast("bigint").alias("columns"),
        number(before, (CATEGORICAL,)).alias("categorical"),
        number(before, (NUMERIC,)).alias("numeric"),
        number(after, usable).alias("kept"),
        number(after, (CATEGORICAL,)).alias("kept_categorical"),
        number(after, (NUMERIC,)).alias("kept_numeric"),
    )


def drop_high_cardinality(df: DataFrame, stats: DataFrame, max_levels: int = 20) -> DataFrame:
    """Drops string columns whose ``distinct_values`` reach ``max_levels``."""
    wide = stats.filter(F.col("distinct_values") >= max_levels).select("Variable")
    return df.drop(*[r["Variable"] for r in wide.collect()])


def cast_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})


def filter_rows(df: DataFrame, *conditions: Column) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, conditions, F.lit(True)))


def wide_to_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """A (Variable, value) row per column; the columns need a common type."""
    return df.unpivot(list(keep), list(columns), "Variable", "value")


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def split_features_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    return df.drop(target), df.select(target)


def select_prediction_columns(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(*extra, *[c for c in PREDICTION_COLUMNS if c in df.columns])


def sort_rows(df: DataFrame, column: str, ascending: bool = True) -> DataFrame:
    """Total order over result tables; range-partitioned by Spark for larger ones."""
    return df.orderBy(F.asc(column) if ascending else F.desc(column))


def top_one(df: DataFrame, by: str, tie: str) -> DataFrame:
    """Row with the largest ``by``; the smaller ``tie`` wins among equals."""
    return df.orderBy(F.desc(by), F.asc_nulls_last(tie)).limit(1)
