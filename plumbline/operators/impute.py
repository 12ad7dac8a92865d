"""Filling missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.columns import CATEGORICAL, NUMERIC, names_with_role
from plumbline.operators.profile import mean_profile, mode_profile

UNKNOWN = "Unknown_Value"


def modes(df: DataFrame, count_nulls: bool = True) -> dict[str, str]:
    """Mode per string column; a column whose mode is null is absent."""
    columns = names_with_role(df, CATEGORICAL)
    if not columns:
        return {}
    found = mode_profile(df, columns, count_nulls).filter(F.col("Mode").isNotNull()).collect()
    return {r["Variable"]: r["Mode"] for r in found}


def means(df: DataFrame) -> dict[str, float]:
    columns = names_with_role(df, NUMERIC)
    if not columns:
        return {}
    found = mean_profile(df.select(*columns)).filter(F.col("Mean").isNotNull()).collect()
    return {r["Variable"]: r["Mean"] for r in found}


def impute_mode(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.na.fill(dict(values)) if values else df


def impute_mean(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Casts to double first: filling an integer column would cut the mean off."""
    if not values:
        return df
    return df.withColumns({c: F.col(c).cast("double") for c in values}).na.fill(dict(values))


def impute_constant(df: DataFrame, value: str = UNKNOWN, subset: Sequence[str] | None = None) -> DataFrame:
    """Fills what is left in string columns, or in those of ``subset``."""
    columns = [c for c in names_with_role(df, CATEGORICAL) if subset is None or c in subset]
    return df.na.fill(value, subset=columns) if columns else df


class _FillParams(Params):
    modes = Param(Params._dummy(), "modes", "fill value per string column")
    means = Param(Params._dummy(), "means", "fill value per numeric column")
    unknown = Param(
        Params._dummy(), "unknown", "fill value where the mode is null", typeConverter=TypeConverters.toString
    )
    columns = Param(
        Params._dummy(), "columns", "columns to fill", typeConverter=TypeConverters.toListString
    )
    countNulls = Param(
        Params._dummy(), "countNulls", "null may be the mode", typeConverter=TypeConverters.toBoolean
    )


class MixedImputer(Estimator, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    """Mode for string columns, mean for numeric ones, as a pipeline stage.

    With ``countNulls`` null competes for the mode; where it wins, and for values
    missing afterwards, ``unknown`` is filled in.
    """

    @keyword_only
    def __init__(self, *, columns=None, countNulls=False, unknown=UNKNOWN):
        super().__init__()
        self._setDefault(countNulls=False, unknown=UNKNOWN)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MixedImputerModel:
        rows = dataset.select(*self.getOrDefault("columns")) if self.isSet("columns") else dataset
        model = MixedImputerModel()
        model._set(
            modes=modes(rows, self.getOrDefault("countNulls")),
            means=means(rows),
            unknown=self.getOrDefault("unknown"),
            columns=list(rows.columns),
        )
        return model


class MixedImputerModel(Model, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fills the values learnt by :class:`MixedImputer`; a projection, no shuffle."""

    def __init__(self):
        super().__init__()
        self._setDefault(unknown=UNKNOWN)

    def fill_values(self) -> dict[str, object]:
        return {**self.getOrDefault("modes"), **self.getOrDefault("means")}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        present = set(dataset.columns)
        filled = impute_mode(dataset, {c: v for c, v in self.getOrDefault("modes").items() if c in present})
        filled = impute_mean(filled, {c: v for c, v in self.getOrDefault("means").items() if c in present})
        return impute_constant(filled, self.getOrDefault("unknown"), self.getOrDefault("columns"))
