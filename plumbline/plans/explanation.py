"""Fits one boosted model and computes everything its plots need."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.scalars import positive_probability
from plumbline.operators import columns as C
from plumbline.operators import encode as EN
from plumbline.operators import explain as X
from plumbline.operators import models as M
from plumbline.operators import evaluation as EV
from plumbline.operators.attribution import split_points, tree_shap
from plumbline.operators.impute import MixedImputer
from plumbline.operators.profile import distinct_profile
from plumbline.operators.split import stratified_split
from plumbline.plans.model_bench import SPLIT, TARGET, model_columns
from plumbline.session import scratch_scope, stored
from plumbline.spec import ModelSpec

SPLIT_SEED = 2020


@dataclass(frozen=True)
class Explained:
    """Label-encoded rows of the whole table, the fitted model and the encoder."""

    rows: DataFrame
    features: list[str]
    model: Model
    mapping: DataFrame | None

    @property
    def train(self) -> DataFrame:
        return self.rows.filter(F.col(SPLIT) == "train")

    @property
    def cv(self) -> DataFrame:
        return self.rows.filter(F.col(SPLIT) == "cv")

    def assembled(self, df: DataFrame) -> DataFrame:
        return EN.tree_assembler([], self.features).transform(df)

    def scored(self, df: DataFrame) -> DataFrame:
        """Adds prediction and ``score``, the probability of the positive value."""
        return self.model.transform(self.assembled(df)).withColumn("score", positive_probability())

    def scored_once(self, keep: Sequence[str] = ()) -> DataFrame:
        """Kept columns, features and score of all rows, written once for readers with several passes."""
        scored = self.scored(self.rows).select(*keep, *self.features, "score")
        return stored(scored, "scored")

    def cuts(self) -> dict[str, list[float]]:
        """Test limits of the model per feature."""
        return split_points(self.rows, self.model, self.features)

    def importances(self) -> DataFrame:
        return M.gbm_importance(self.rows, self.model, self.features)

    def top_pair(self) -> tuple[str, str]:
        """The two features of largest importance (the only one twice)."""
        names = [r["Variable"] for r in self.importances().collect()][::-1]
        return names[0], names[min(1, len(names) - 1)]

    def attributions(self, keep: Sequence[str] = ()) -> DataFrame:
        """Log-odds attributions of the training rows."""
        return tree_shap(self.assembled(self.train), self.model, self.features, keep=keep, scale=2.0)


def explain_table(
    spark: SparkSession,
    table: str,
    spec: ModelSpec,
    folder: str,
    iterations: int = 100,
    pair: tuple[str, str] | None = None,
) -> dict[str, str]:
    """From a table name to the written plot data and judgements; returns the path of every dataset.

    ``pair``: the features of the two-way plots; those of largest importance if not given. The
    mapping of text levels is written if there are any. Intermediate datasets go at the end.
    """
    with scratch_scope(spark):
        return _explain_table(spark, table, spec, folder, iterations, pair)


def _explain_table(spark, table, spec, folder, iterations, pair) -> dict[str, str]:
    explained = explain(spark.table(table), spec, iterations)
    scored, attributions = explained.scored_once(), stored(explained.attributions(), "attributions")
    pair = pair or explained.top_pair()
    grids, cuts = X.grid_values(explained.rows, explained.features), explained.cuts()
    features = explained.rows.select(*explained.features)
    judged = stored(explained.scored(explained.cv).select(TARGET, "prediction"), "judged")
    tables = {
        "Target_Plot": X.target_plot_data(explained.rows, explained.features, TARGET),
        "Actual_Plot": X.actual_plot_data(scored, explained.features, "score"),
        "Partial_Dependence": X.partial_dependence(features, grids, explained.scored, cuts=cuts),
        "Importance": explained.importances(),
        "Accuracy": EV.accuracy_score(judged, TARGET, "prediction"),
        "Report": EV.classification_report(judged, TARGET, "prediction"),
        "Shap_Summary": X.shap_summary(attributions),
        "Shap_Density": X.shap_density(attributions),
        "Shap_Ranking": X.abs_shap(attributions),
    }
    if pair[0] != pair[1]:
        tables["Actual_Interact"] = X.actual_interact_data(scored, pair, "score")
        tables["Partial_Dependence_2way"] = X.partial_dependence_2way(features, pair, grids, explained.scored, cuts=cuts)
    if explained.mapping is not None:
        tables["Mapping"] = explained.mapping
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in tables}
    for name, frame in tables.items():
        frame.write.mode("overwrite").parquet(paths[name])
    return paths


def explain(df: DataFrame, spec: ModelSpec, iterations: int = 100) -> Explained:
    rows, features = model_columns(df, spec)
    texts = C.names_with_role(rows.select(*features), C.CATEGORICAL)
    if texts:
        # A tree needs a bin per level, so wide columns cannot take part.
        levels = distinct_profile(rows, texts)
        kept = C.drop_high_cardinality(rows.select(*features), levels, spec.max_levels)
        features = kept.columns
        rows = rows.select(*spec.keys, TARGET, M.LABEL, *features)
    marked = stratified_split(rows, TARGET, spec.keys, seed=SPLIT_SEED, output=SPLIT)
    train = marked if spec.fit_scope == "all" else marked.filter(F.col(SPLIT) == "train")
    filled = MixedImputer(columns=features).fit(train).transform(marked)
    categorical = C.names_with_role(filled.select(*features), C.CATEGORICAL)
    mapping = None
    coded = filled
    if categorical:
        # Codes come from every row, so that rows outside the training part have one too.
        encoder = EN.label_encoder(categorical).fit(filled)
        coded = EN.label_encode(filled, categorical, encoder)
        mapping = EN.encoding_map(df, encoder)
    # Fitting makes many passes; they read the encoded rows, not the joins behind them.
    coded = stored(coded, "encoded")
    assembled = EN.tree_assembler([], features).transform(coded.filter(F.col(SPLIT) == "train"))
    model = M.fit_gbm_baseline(assembled, iterations=iterations, max_levels=spec.max_levels)
    return Explained(coded, features, model, mapping)
