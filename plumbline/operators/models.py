"""The four baseline models, the explanation model, scoring and importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import positive_probability
from plumbline.operators.columns import select_prediction_columns

LABEL, FEATURES, SCALED = "label", "features", "scaled_features"
MODEL_SEED = 91


def tree_bins(max_levels: int) -> int:
    """Trees need a bin per level, the unknown level and the unseen slot."""
    return max(120, max_levels + 2)


def fit_logistic(train: DataFrame, features: str = SCALED, label: str = LABEL, iterations: int = 15) -> Model:
    learner = LogisticRegression(featuresCol=features, labelCol=label, maxIter=iterations, aggregationDepth=3)
    return learner.fit(train.select(features, label))


def fit_mlp(
    train: DataFrame, inputs: int, features: str = SCALED, label: str = LABEL, iterations: int = 50
) -> Model:
    """Perceptron with hidden layers of three and two times the inputs."""
    learner = MultilayerPerceptronClassifier(
        featuresCol=features,
        labelCol=label,
        maxIter=iterations,
        layers=[inputs, inputs * 3, inputs * 2, 2],
        blockSize=512,
        seed=MODEL_SEED,
    )
    return learner.fit(train.select(features, label))


def fit_forest(
    train: DataFrame, features: str = FEATURES, label: str = LABEL, max_levels: int = 20, trees: int = 20
) -> Model:
    learner = RandomForestClassifier(
        featuresCol=features, labelCol=label, maxBins=tree_bins(max_levels), numTrees=trees, seed=MODEL_SEED
    )
    return learner.fit(train.select(features, label))


def fit_gbt(
    train: DataFrame, features: str = FEATURES, label: str = LABEL, max_levels: int = 20, iterations: int = 15
) -> Model:
    learner = GBTClassifier(
        featuresCol=features,
        labelCol=label,
        maxIter=iterations,
        maxBins=tree_bins(max_levels),
        seed=MODEL_SEED,
    )
    return learner.fit(train.select(features, label))


def fit_gbm_baseline(
    train: DataFrame,
    features: str = FEATURES,
    label: str = LABEL,
    iterations: int = 100,
    max_levels: int = 20,
) -> Model:
    """Boosting on label-encoded features: 100 trees of depth 3 with a step of 0.1."""
    learner = GBTClassifier(
        featuresCol=features,
        labelCol=label,
        maxIter=iterations,
        maxDepth=3,
        stepSize=0.1,
        maxBins=tree_bins(max_levels),
        seed=MODEL_SEED,
    )
    return learner.fit(train.select(features, label))


def _importance(df: DataFrame, model: Model, names: Sequence[str]) -> DataFrame:
    values = model.featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(names, values, strict=True)]
    return df.sparkSession.createDataFrame(rows, "Variable string, Variable_Importance double")


def top_variables(df: DataFrame, forest: Model, names: Sequence[str]) -> DataFrame:
    """Forest importances, largest first."""
    return _importance(df, forest, names).orderBy(F.desc("Variable_Importance"), "Variable")


def gbm_importance(df: DataFrame, model: Model, names: Sequence[str]) -> DataFrame:
    """Boosting importances, smallest first."""
    return _importance(df, model, names).orderBy(F.asc("Variable_Importance"), "Variable")


def score_rows(model: Model | PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Predictions with the probability of the positive class; a projection of ``df``."""
    scored = model.transform(df).withColumn("model_probability", positive_probability())
    return select_prediction_columns(scored, *keep)


def score_frames(
    model: Model | PipelineModel, train: DataFrame, test: DataFrame, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    return score_rows(model, train, keep), score_rows(model, test, keep)


def predict_labels(model: Model | PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return model.transform(df).select(*keep, "prediction")
