"""Column profiles.

Two jobs profile a table of any width: one aggregation without a shuffle of rows
(counts and means of all columns), and one count of the distinct values of all
string columns together, combined on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import percent_of_total
from plumbline.operators.columns import CATEGORICAL, NUMERIC, names_with_role
from plumbline.operators.joins import left_join_stats
from plumbline.session import stored


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def describe_columns(df: DataFrame) -> DataFrame:
    """count, mean, stddev, min and max of every usable column in one pass.

    Numeric extremes are doubles in ``min``/``max``; those of strings are in
    ``min_text``/``max_text``.
    """
    aggregates, entries = [], []
    for k, name in enumerate(df.columns):
        if name in names_with_role(df, NUMERIC):
            value = F.col(name).cast("double")
            fields = {
                "mean": F.avg(value),
                "stddev": F.stddev_samp(value),
                "min": F.min(value),
                "max": F.max(value),
            }
        elif name in names_with_role(df, CATEGORICAL):
            fields = {"min_text": F.min(name), "max_text": F.max(name)}
        else:
            continue
        aggregates.append(F.count(name).alias(f"count{k}"))
        aggregates.extend(column.alias(f"{field}{k}") for field, column in fields.items())
        kinds = {"mean": "double", "stddev": "double", "min": "double", "max": "double"}
        kinds |= {"min_text": "string", "max_text": "string"}
        entries.append(
            F.struct(
                F.lit(name).alias("Variable"),
                F.col(f"count{k}").alias("count"),
                *[
                    (F.col(f"{f}{k}") if f in fields else F.lit(None)).cast(kind).alias(f)
                    for f, kind in kinds.items()
                ],
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def _column_summary(df: DataFrame) -> DataFrame:
    """(Variable, dtype_vars, Non_Missing, total_rows, Mean) from a single aggregation."""
    numeric = set(names_with_role(df, NUMERIC))
    aggregates = [F.count("*").alias("rows")]
    entries = []
    for k, (name, dtype) in enumerate(df.dtypes):
        aggregates.append(F.count(name).alias(f"count{k}"))
        mean = F.lit(None).cast("double")
        if name in numeric:
            aggregates.append(F.avg(F.col(name).cast("double")).alias(f"mean{k}"))
            mean = F.col(f"mean{k}")
        entries.append(
            F.struct(
                F.lit(name).alias("Variable"),
                F.lit(dtype).alias("dtype_vars"),
                F.col(f"count{k}").alias("Non_Missing"),
                F.col("rows").alias("total_rows"),
                mean.alias("Mean"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def missing_profile(df: DataFrame) -> DataFrame:
    return _with_missing(_column_summary(df)).drop("dtype_vars", "Mean")


def _with_missing(summary: DataFrame) -> DataFrame:
    missing = F.col("total_rows") - F.col("Non_Missing")
    return summary.withColumns(
        {"Missing": missing, "missing_percent": percent_of_total(missing, F.col("total_rows"))}
    )


def mean_profile(df: DataFrame) -> DataFrame:
    """Mean per column; null for strings."""
    return _column_summary(df).select("Variable", "Mean")


def dtype_profile(df: DataFrame) -> DataFrame:
    return _column_summary(df).select("Variable", "dtype_vars", "total_rows")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(Variable, value, n) of all string columns with one shuffle of pre-counted values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("Variable"), F.col(c).alias("value")) for c in columns])
    return df.select(F.inline(pairs)).groupBy("Variable", "value").agg(F.count("*").alias("n"))


def _digests(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(Variable, a, b, n): rows per value, told apart by two 64-bit hashes; null has none.

    Whole strings are hashed where they are read and do not travel.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("Variable"), F.col(c).alias("value")) for c in columns])
    value = F.col("value")
    digest = [F.when(value.isNotNull(), F.xxhash64(*salt, value)) for salt in ((), (F.lit("second"),))]
    rows = df.select(F.inline(pairs)).select("Variable", digest[0].alias("a"), digest[1].alias("b"))
    return rows.groupBy("Variable", "a", "b").agg(F.count("*").alias("n"))


def string_profile(df: DataFrame, columns: Sequence[str], count_nulls: bool = True) -> DataFrame:
    """(Variable, Mode, distinct_values) of string columns.

    The highest count wins, then a value before null, then the smaller value. With
    ``count_nulls`` null may win. Values are counted by digest; the winning strings are
    then looked up in a second pass that keeps one string per column and task.
    """
    counts = stored(_digests(df, columns), "digests")
    known = F.col("a").isNotNull()
    summary = counts.groupBy("Variable").agg(
        F.max(F.when(known, F.col("n"))).alias("most"),
        F.coalesce(F.max(F.when(~known, F.col("n"))), F.lit(0)).alias("nulls"),
        F.count(F.when(known, 1)).alias("distinct_values"),
    )
    summary = stored(summary, "profile")
    wins = F.col("most").isNotNull()
    if count_nulls:
        wins = wins & (F.col("most") >= F.col("nulls"))
    # Where no value comes twice every value wins, and the smallest needs no lookup.
    single = {r["Variable"] for r in summary.filter(wins & (F.col("most") == 1)).collect()}  # a row per column
    several = [c for c in columns if c not in single]
    smallest = [F.min(c).alias(c) for c in single]
    found = []
    if single:
        entries = [F.struct(F.lit(c).alias("Variable"), F.col(c).alias("Mode")) for c in single]
        found.append(df.agg(*smallest).select(F.inline(F.array(*entries))))
    if several:
        winners = counts.join(summary.filter(wins), "Variable").filter(known & (F.col("n") == F.col("most")))
        winners = winners.filter(F.col("Variable").isin(several)).select("Variable", "a", "b")
        pairs = F.array(*[F.struct(F.lit(c).alias("Variable"), F.col(c).alias("value")) for c in several])
        rows = df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
        rows = rows.withColumns({"a": F.xxhash64("value"), "b": F.xxhash64(F.lit("second"), F.col("value"))})
        won = rows.join(stored(winners, "winners"), ["Variable", "a", "b"], "left_semi")
        found.append(won.groupBy("Variable").agg(F.min("value").alias("Mode")))
    modes = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return summary.join(modes, "Variable", "left").select("Variable", "Mode", "distinct_values")


def mode_profile(df: DataFrame, columns: Sequence[str], count_nulls: bool = True) -> DataFrame:
    return string_profile(df, columns, count_nulls).select("Variable", "Mode")


def distinct_profile(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per string column; ``approximate`` uses a sketch instead of a shuffle."""
    if not approximate:
        counts = _digests(df, columns).groupBy("Variable")
        return counts.agg(F.count("a").alias("distinct_values"))
    sketches = df.agg(*[F.approx_count_distinct(c).alias(f"d{k}") for k, c in enumerate(columns)])
    entries = [
        F.struct(F.lit(c).alias("Variable"), F.col(f"d{k}").alias("distinct_values"))
        for k, c in enumerate(columns)
    ]
    return sketches.select(F.inline(F.array(*entries)))


def data_stats(df: DataFrame) -> DataFrame:
    """The full profile, one row per column."""
    categorical = names_with_role(df, CATEGORICAL)
    summary = _with_missing(_column_summary(df))
    if categorical:
        summary = left_join_stats(summary, string_profile(df, categorical))
    else:
        summary = summary.withColumns(
            {"Mode": F.lit(None).cast("string"), "distinct_values": F.lit(None).cast("bigint")}
        )
    return summary.select(
        "Variable",
        "Non_Missing",
        "Missing",
        "total_rows",
        "missing_percent",
        "Mean",
        "Mode",
        "dtype_vars",
        "distinct_values",
    )
