"""From one table to a leaderboard: profile, fill, encode, split, fit four models, judge them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import columns as C
from plumbline.operators import encode as EN
from plumbline.operators import evaluation as EV
from plumbline.operators import models as M
from plumbline.operators.impute import MixedImputer
from plumbline.operators.profile import data_stats
from plumbline.operators.split import random_split
from plumbline.session import scratch_scope, stored
from plumbline.sources.tables import cached_scope, write_report
from plumbline.spec import ModelSpec

TARGET, SPLIT, ALGORITHM = "_target", "split", "algorithm"


@dataclass(frozen=True)
class Prepared:
    """Encoded rows (keys, target, label, split, feature vectors) and how they came about."""

    rows: DataFrame
    stats: DataFrame
    categorical: list[str]
    numeric: list[str]
    encoders: PipelineModel


@dataclass(frozen=True)
class BenchResult:
    stats: DataFrame
    predictions: DataFrame
    gains: DataFrame
    metrics: DataFrame
    leaderboard: DataFrame
    top_variables: DataFrame
    models: dict[str, object]

    def report(self, folder: str) -> dict[str, str]:
        tables = {
            "Summary_Stats": self.stats,
            "Top_Vars": self.top_variables,
            "Performance_metrics": self.leaderboard,
            "KS": self.gains,
        }
        return write_report(tables, folder)


def model_columns(df: DataFrame, spec: ModelSpec) -> tuple[DataFrame, list[str]]:
    """Labelled rows with usable columns only, and the names of the candidate features."""
    labelled = df.filter(F.col(spec.target).isNotNull())
    candidates = C.exclude_by_pattern(df, spec.exclude_patterns, spec.use_patterns)
    candidates = C.exclude_by_name(candidates, [*spec.exclude, *spec.keys, spec.target])
    features = C.drop_unusable(candidates).columns
    flags = [f.name for f in df.schema.fields if f.name in features and f.dataType.typeName() == "boolean"]
    label = EN.target_label(spec.target, spec.positive_label)
    rows = C.cast_columns(labelled, {c: "int" for c in flags}).select(
        *spec.keys, label.cast("int").alias(TARGET), label.alias(M.LABEL), *[f for f in features if f not in spec.keys]
    )
    return rows, features


def prepare(df: DataFrame, spec: ModelSpec) -> Prepared:
    rows, features = model_columns(df, spec)
    # The joins behind the table run once; fitting and scoring read it many times.
    rows = stored(random_split(rows, spec.keys, spec.train_fraction, spec.seed, SPLIT), "labelled")
    named = F.when(F.col("Variable") == TARGET, spec.target).otherwise(F.col("Variable"))
    stats = data_stats(rows.select(TARGET, *features)).withColumn("Variable", named)
    stats = stored(stats, "stats")
    kept = C.drop_high_cardinality(rows.select(*features), stats, spec.max_levels)
    categorical = C.names_with_role(kept, C.CATEGORICAL)
    numeric = C.names_with_role(kept, C.NUMERIC)
    marked = rows.select(*spec.keys, TARGET, M.LABEL, *kept.columns, SPLIT)
    fitting = marked if spec.fit_scope == "all" else marked.filter(F.col(SPLIT) == "train")
    stages = [MixedImputer(columns=kept.columns, countNulls=True, unknown=spec.unknown)]
    if categorical:
        stages += [EN.string_indexer(categorical), EN.one_hot_encoder(categorical)]
    stages += [
        EN.onehot_assembler(categorical, numeric, "onehot_features"),
        EN.standard_scaler("onehot_features", "scaled_onehot"),
        EN.tree_assembler(categorical, numeric, M.FEATURES),
        EN.standard_scaler(M.FEATURES, M.SCALED),
    ]
    with cached_scope(fitting):
        encoders = EN.compose_stages(fitting, stages)
    encoded = encoders.transform(marked).select(
        *spec.keys, TARGET, M.LABEL, SPLIT, "scaled_onehot", M.FEATURES, M.SCALED
    )
    return Prepared(encoded, stats, categorical, numeric, encoders)


def fit_models(train: DataFrame, inputs: list[str], spec: ModelSpec) -> dict[str, object]:
    return {
        "Logistic": M.fit_logistic(train, "scaled_onehot"),
        "MultiLayerPerceptron": M.fit_mlp(train, len(inputs)),
        "RandomForest": M.fit_forest(train, max_levels=spec.max_levels),
        "GradientBoosting": M.fit_gbt(train, max_levels=spec.max_levels),
    }


def model_bench(df: DataFrame, spec: ModelSpec) -> BenchResult:
    """Fits and judges the four models.

    The predictions of all models are written to the shared folder once; every
    judging pass then reads just the columns it needs, and a lost executor costs
    neither a refit nor a rescoring.
    """
    prepared = prepare(df, spec)
    inputs = EN.tree_inputs(prepared.categorical, prepared.numeric)
    keep = [*spec.keys, TARGET, SPLIT]
    with cached_scope(prepared.rows):
        models = fit_models(prepared.rows.filter(F.col(SPLIT) == "train"), inputs, spec)
        scored = [
            M.score_rows(model, prepared.rows, keep).withColumn(ALGORITHM, F.lit(name))
            for name, model in models.items()
        ]
        predictions = stored(reduce(DataFrame.unionByName, scored).drop("rawPrediction"), "predictions")
    by = [ALGORITHM, SPLIT]
    gains = EV.gains_table(predictions, TARGET, "model_probability", spec.keys, by)
    gains = stored(gains, "gains")
    metrics = EV.metric_rows(predictions, gains, TARGET, "model_probability", "prediction", by)
    tagged = gains.join(EV.ks_statistic(gains, by), by).withColumn(
        "type_of_model", F.concat_ws(" ", F.col(ALGORITHM), F.initcap(SPLIT))
    )
    return BenchResult(
        prepared.stats,
        predictions,
        tagged.select("type_of_model", *EV.GAINS_COLUMNS, "ks"),
        metrics,
        EV.leaderboard(metrics, ALGORITHM, SPLIT),
        M.top_variables(df, models["RandomForest"], inputs),
        models,
    )


def bench_table(spark: SparkSession, table: str, spec: ModelSpec, folder: str) -> dict[str, str]:
    """From a table name to the written report; returns the path of every dataset.

    Intermediate datasets are deleted once the report is written.
    """
    with scratch_scope(spark):
        return model_bench(spark.table(table), spec).report(folder)
