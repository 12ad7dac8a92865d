"""Joins and unions of result frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_stats(base: DataFrame, *others: DataFrame, on: str = "Variable") -> DataFrame:
    """Joins per-variable frames. They hold a row per column, so Spark may broadcast them."""
    return reduce(lambda left, right: left.join(right, on, "left"), others, base)


def inner_join_deciles(*frames: DataFrame, on: str = "deciles") -> DataFrame:
    return reduce(lambda left, right: left.join(right, on, "inner"), frames)


def inner_join_importance(importance: DataFrame, correlation: DataFrame) -> DataFrame:
    return importance.join(correlation, "Variable", "inner")


def column_bind(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Puts two frames side by side, row for row. Rows meet by key, not by position."""
    return left.join(right, list(keys), "inner")


def union_results(frames: Mapping[str, DataFrame], tag: str = "type_of_model") -> DataFrame:
    """Stacks result tables and tags each row with the name of its table."""
    tagged = [frame.withColumn(tag, F.lit(name)) for name, frame in frames.items()]
    return reduce(DataFrame.unionByName, tagged)
