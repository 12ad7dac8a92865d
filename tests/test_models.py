"""Splits, encoders, models, attributions and the decisions taken for odd inputs."""

import itertools
import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plumbline import ModelSpec
from plumbline.operators import attribution as A
from plumbline.operators import columns as C
from plumbline.operators import encode as EN
from plumbline.operators import evaluation as EV
from plumbline.operators import explain as X
from plumbline.operators import impute as I
from plumbline.operators import models as M
from plumbline.operators import profile as P
from plumbline.operators.split import random_split, stratified_split
from plumbline.plans.catalog import frames
from plumbline.plans.explanation import explain
from plumbline.plans.model_bench import SPLIT, TARGET, model_bench, model_columns, prepare
from plumbline.session import scratch_scope, shared_folder, stored

PEOPLE = """row_id bigint, Person_ID bigint, Family string, Rating int, Country string, Age int, Balance double,
active boolean, joined timestamp_ntz, tags array<string>, left_bank int"""


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        country = [None, "FR", "DE", "ES"][rng.integers(0, 4)]
        age = None if i % 13 == 0 else int(rng.integers(18, 80))
        target = None if i % 50 == 0 else int(rng.random() < 0.2 + 0.006 * ((age or 40) - 18))
        rows.append(
            (i, 10_000 + i, f"name{i % 90}", int(rng.integers(300, 850)), country, age,
             float(rng.integers(0, 9)) * 100, bool(i % 2), None, [], target)
        )
    return spark.createDataFrame(rows, PEOPLE).coalesce(1).cache()


SPEC = ModelSpec(target="left_bank", keys=("row_id",), exclude_patterns=("_id",), exclude=("FAMILY",))


def test_patterns_and_names_ignore_case(people):
    assert "Person_ID" not in C.exclude_by_pattern(people, ["_id"]).columns
    assert "Person_ID" in C.exclude_by_pattern(people, ["_id"], active=False).columns
    assert "Family" not in C.exclude_by_name(people, ["fAmIlY"]).columns


def test_roles(people):
    roles = C.roles(people)
    assert roles["active"] == C.NUMERIC and roles["joined"] == C.TEMPORAL and roles["tags"] == C.OTHER
    assert set(C.drop_unusable(people).columns) == set(people.columns) - {"joined", "tags"}


def test_target_never_becomes_a_feature(people):
    rows, features = model_columns(people, SPEC)
    assert set(features) == {"Rating", "Country", "Age", "Balance", "active"}
    assert rows.count() == 392  # rows without a target are dropped
    text = ModelSpec(target="Country", positive_label="FR", keys=("row_id",))
    assert "Country" not in model_columns(people, text)[1]


def test_null_can_be_the_mode(spark):
    df = spark.createDataFrame([(None,), (None,), ("b",), ("a",)], "c string")
    assert P.mode_profile(df, ["c"]).first()["Mode"] is None
    assert P.mode_profile(df, ["c"], count_nulls=False).first()["Mode"] == "a"  # ties: smaller value
    assert I.modes(df) == {}
    assert [r[0] for r in I.impute_constant(df).collect()].count("Unknown_Value") == 2
    tie = spark.createDataFrame([(None,), ("b",)], "c string")
    assert P.mode_profile(tie, ["c"]).first()["Mode"] == "b"  # ties: a value before null


def test_mean_of_integers_is_not_cut_off(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    assert sorted(r[0] for r in I.impute_mean(df, I.means(df)).collect()) == [1.0, 1.5, 2.0]


def test_nothing_missing_after_imputing(people, tmp_path):
    columns = ["Country", "Age", "Balance", "Rating"]
    model = I.MixedImputer(columns=columns, countNulls=True).fit(people)
    filled = model.transform(people)
    assert filled.select(*[F.count_if(F.col(c).isNull()) for c in columns]).first() == (0,) * 4
    model.write().overwrite().save(str(tmp_path / "imputer"))
    again = I.MixedImputerModel.load(str(tmp_path / "imputer"))
    assert again.fill_values() == model.fill_values()


def test_level_threshold(people):
    stats = P.data_stats(people.select("Family", "Country"))
    assert C.drop_high_cardinality(people.select("Family", "Country"), stats, 20).columns == ["Country"]
    assert C.drop_high_cardinality(people.select("Country"), stats, 3).columns == []


def test_label_follows_positive_value(spark, folder):
    rows = frames.doc_quality(spark, folder)
    marked = rows.withColumn("label", EN.target_label("quality", 1))
    assert marked.filter(F.col("label") != F.col("quality")).count() == 0
    indexed = EN.label_index(rows, "quality").transform(rows)
    assert indexed.filter((F.col("quality") == 1) & (F.col("label") != 0)).count() == 0


def test_confusion_without_a_predicted_class(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0)], "y int, prediction double")
    cells = EV.confusion_matrix(df, "y", "prediction")
    assert cells.first().asDict() == {"TP": 0, "FP": 0, "TN": 1, "FN": 1}
    metrics = EV.binary_metrics(cells).first()
    assert (metrics["Precision"], metrics["Recall"], metrics["F1"], metrics["Accuracy"]) == (None, 0.0, None, 0.5)


def test_random_split(spark):
    df = random_split(spark.range(20_000), ["id"], 0.7, 42)
    assert abs(df.filter("split = 'train'").count() / 20_000 - 0.7) < 0.02
    again = random_split(spark.range(20_000).repartition(13), ["id"], 0.7, 42)
    assert df.join(again.withColumnRenamed("split", "s"), "id").filter("s <> split").count() == 0


def test_stratified_split_has_exact_shares(spark):
    df = spark.range(5000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    counts = {(r["y"], r["split"]): r["count"] for r in stratified_split(df, "y", ["id"]).groupBy("y", "split").count().collect()}
    assert counts == {
        (0, "test"): 450, (0, "cv"): 405, (0, "train"): 3645,
        (1, "test"): 50, (1, "cv"): 45, (1, "train"): 405,
    }


def test_prepared_vectors(people):
    prepared = prepare(people, SPEC)
    assert prepared.categorical == ["Country"] and "Age" in prepared.numeric
    row = prepared.rows.select(vector_to_array(M.FEATURES).alias("f"), vector_to_array("scaled_onehot").alias("o")).first()
    assert len(row["f"]) == 5
    levels = prepared.encoders.stages[1].labelsArray[0]
    assert len(row["o"]) == len(levels) + 4
    assert {r[0] for r in prepared.rows.select(SPLIT).distinct().collect()} == {"train", "test"}
    everything = prepare(people, ModelSpec(**{**SPEC.__dict__, "fit_scope": "all"}))
    means = [p.encoders.stages[0].fill_values()["Age"] for p in (prepared, everything)]
    assert means[0] != means[1]
    assert means[1] == pytest.approx(people.filter("left_bank IS NOT NULL").agg(F.avg("Age")).first()[0])


def test_bench_end_to_end(people, tmp_path):
    result = model_bench(people, SPEC)
    board = result.leaderboard.collect()
    assert {r["Algorithms"] for r in board} == {"Logistic", "MultiLayerPerceptron", "RandomForest", "GradientBoosting"}
    assert len(result.leaderboard.columns) == 13
    assert all(0 <= r["Test_ROC"] <= 1 for r in board)
    assert result.predictions.filter("model_probability < 0 OR model_probability > 1").count() == 0
    assert result.predictions.count() == 4 * 392
    gains = result.gains.collect()
    assert len(gains) == 80
    for model in {r["type_of_model"] for r in gains}:
        counts = [r["count"] for r in gains if r["type_of_model"] == model]
        assert max(counts) - min(counts) <= 1
        assert max(r["%Dist_Target"] for r in gains if r["type_of_model"] == model) == pytest.approx(100)
    paths = result.report(str(tmp_path / "report"))
    assert set(paths) == {"Summary_Stats", "Top_Vars", "Performance_metrics", "KS"}
    assert "left_bank" in {r["Variable"] for r in result.stats.collect()}
    again = model_bench(people, SPEC).leaderboard
    assert sorted(map(str, again.collect())) == sorted(map(str, board))


@pytest.fixture(scope="module")
def explained(people):
    return explain(people, SPEC, iterations=8)


def test_attributions_add_up(explained):
    leaves = A.model_leaves(explained.rows, explained.model)
    rows = explained.assembled(explained.train)
    wide = A.tree_shap_wide(explained.model.transform(rows), explained.model, keep=["row_id", "probability"])
    base = A.expected_margin(leaves)
    for row in wide.collect():
        margin = base + sum(row["shap_values"])
        assert 1 / (1 + math.exp(-2 * margin)) == pytest.approx(row["probability"][1], abs=1e-9)


def brute_force(leaves, x, width):
    """Shapley values straight from their definition, by all feature subsets."""

    def holds(test):
        left = x[test.feature] <= test.limit if test.categories is None else x[test.feature] in test.categories
        return left == test.left

    def game(known):
        total = 0.0
        for leaf in leaves:
            weight = leaf.value
            for test in leaf.tests:
                weight *= (1.0 if holds(test) else 0.0) if test.feature in known else test.share
            total += weight
        return total

    values = np.zeros(width)
    for j in range(width):
        others = [k for k in range(width) if k != j]
        for size in range(width):
            for chosen in itertools.combinations(others, size):
                weight = math.factorial(size) * math.factorial(width - 1 - size) / math.factorial(width)
                values[j] += weight * (game({*chosen, j}) - game(set(chosen)))
    return values


def test_attributions_equal_brute_force(explained):
    leaves = A.model_leaves(explained.rows, explained.model)
    wide = A.tree_shap_wide(explained.assembled(explained.train), explained.model)
    for row in wide.limit(25).collect():
        expected = brute_force(leaves, row["feature_values"], len(explained.features))
        np.testing.assert_allclose(row["shap_values"], expected, atol=1e-10)


def test_attributions_long_form_and_ranking(explained):
    long = explained.attributions(["row_id"])
    assert long.count() == explained.train.count() * len(explained.features)
    ranking = X.abs_shap(long).collect()
    assert [r["SHAP_abs"] for r in ranking] == sorted(r["SHAP_abs"] for r in ranking)
    assert {r["Sign"] for r in ranking} <= {"red", "blue"}


def test_partial_dependence_of_fitted_model(explained):
    grids = X.grid_values(explained.rows, ["Age"])
    table = {r["grid_value"]: r["partial_dependence"] for r in X.partial_dependence(explained.rows, grids, explained.scored).collect()}
    value = grids["Age"][4]
    fixed = explained.scored(explained.rows.withColumn("Age", F.lit(value)))
    assert table[value] == pytest.approx(fixed.agg(F.avg("score")).first()[0], abs=1e-12)


def test_dependence_by_cells_equals_plain(explained, monkeypatch):
    """Rows of one cell are scored once; the curve of a fitted tree model stays the same."""
    rows = explained.rows.select(*explained.features)
    grids = X.grid_values(rows, ["Age", "Rating"])
    seen = []

    def scorer(df):
        seen.append(df.agg(F.count("*").alias("scored"), F.sum("_n").alias("n")).first())
        return explained.scored(df)

    cells = X.model_cells(rows, explained.cuts())
    plain, joint = explained.scored(rows), explained.scored(cells)
    totals = [df.agg(F.sum("score"), F.sum(F.col("score") ** 2)).first() for df in (plain, joint)]
    assert totals[0] == pytest.approx(totals[1], rel=1e-12)
    for cuts in (None, explained.cuts()):
        got = {(r["Variable"], r["grid_value"]): tuple(r)[2:] for r in X.partial_dependence(rows, grids, scorer, cuts=cuts).collect()}
        for (feature, value), (count, mean) in got.items():
            fixed = explained.scored(rows.withColumn(feature, F.lit(value)))
            assert (count, mean) == (400 - 8, pytest.approx(fixed.agg(F.avg("score")).first()[0], abs=1e-12))
    two = X.partial_dependence_2way(rows, ["Age", "Rating"], grids, scorer, cuts=explained.cuts()).collect()
    pick = two[len(two) // 2]
    fixed = explained.scored(rows.withColumns({"Age": F.lit(pick["grid_1"]), "Rating": F.lit(pick["grid_2"])}))
    assert pick["partial_dependence"] == pytest.approx(fixed.agg(F.avg("score")).first()[0], abs=1e-12)
    assert {r["position_1"] for r in two} == {k / (len(grids["Age"]) - 1) for k in range(len(grids["Age"]))}
    points = len(grids["Age"]) * len(grids["Rating"])
    others = cells.select([c for c in rows.columns if c not in ("Age", "Rating")]).distinct().count()
    assert seen[-1]["n"] == 392 * points and seen[-1]["scored"] in (others * points, 392 * points)


def test_equal_rows_are_scored_once(spark):
    rows = spark.range(2000).selectExpr("id % 10 AS a", "id % 3 * 1.0D AS b", "IF(id % 7 = 0, NULL, 'x') AS c")
    seen = []

    def scorer(df):
        seen.append(df.count())
        return df.withColumn("score", F.when(F.col("c").isNotNull(), F.col("a") * F.col("b")))

    grid = {"a": [1.0, 2.5], "b": [0.0, 1.0, 4.0]}
    got = {(r["Variable"], r["grid_value"]): tuple(r)[2:] for r in X.partial_dependence(rows, grid, scorer).collect()}
    assert seen == [2 * 6 + 3 * 20]
    for (name, value), (count, mean) in got.items():
        plain = scorer(rows.withColumn(name, F.lit(value))).agg(F.count("*"), F.avg("score")).first()
        assert (count, mean) == (plain[0], pytest.approx(plain[1], abs=1e-12))


def test_patterns_are_worked_once(monkeypatch):
    rng = np.random.default_rng(8)
    worked, plain = [], A.leaf_attributions
    monkeypatch.setattr(A, "leaf_attributions", lambda held, *rest: worked.append(len(held)) or plain(held, *rest))
    for size, most in ((3, 8), (12, 2048)):
        held, away = rng.integers(0, 2, (2048, size)).astype(float), rng.uniform(0.1, 0.9, size)
        np.testing.assert_allclose(A._by_pattern(held, away, 1.5), plain(held, away, 1.5), atol=1e-14)
        assert worked[-1] <= min(most, len(np.unique(held, axis=0)))


def test_buckets_cover_every_row(explained):
    plot = X.target_plot_data(explained.rows, explained.features, TARGET)
    totals = {r["Variable"]: r["n"] for r in plot.groupBy("Variable").agg(F.sum("count").alias("n")).collect()}
    assert totals == {f: 392 for f in explained.features}
    numbers = [r["bucket"] for r in plot.filter("Variable = 'Rating'").collect()]
    assert max(numbers) <= 8
    assert plot.filter("Variable = 'active'").count() == 2


def test_too_many_levels_are_refused(people):
    with pytest.raises(ValueError, match="Family"):
        EN.fit_string_index(people, ["Family", "Country"], limit=20)


def test_wide_columns_get_the_same_codes(people):
    narrow = EN.label_encode(people.select("row_id", "Family"), ["Family"])
    wide = EN.label_encode(people.select("row_id", "Family"), ["Family"], limit=5)
    assert sorted(narrow.collect()) == sorted(wide.collect())


@pytest.mark.parametrize("heavy", [1, 100, 100_000])
def test_string_index_beyond_the_driver(spark, heavy):
    """A third of the rows share a level, every other one is rare; numbers as the ML stage gives them."""
    rows = spark.range(30_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 <> 1 THEN concat('v', id % 11000) END AS c", "'k' AS _code_"
    )
    plain = EN.string_indexer(["c"]).fit(rows).transform(rows)
    ours = EN.string_index(rows, ["c"], heavy=heavy)
    assert ours.columns == [*rows.columns, "c_index"] and ours.count() == 30_000
    both = ours.join(plain.select("id", F.col("c_index").alias("plain")), "id")
    assert both.filter("c_index = plain").count() == 30_000
    new = EN.string_index(spark.createDataFrame([(1, "no"), (2, None), (3, "hot")], "id long, c string"), ["c"], EN.frequency_codes(rows, ["c"]))
    levels = rows.select("c").distinct().filter("c IS NOT NULL").count()
    assert levels > 10_000 and {r["id"]: r["c_index"] for r in new.collect()} == {1: levels, 2: levels, 3: 0.0}


def test_unseen_level_has_its_own_index(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    model = EN.string_indexer(["c"]).fit(train)
    new = spark.createDataFrame([("z",), (None,), ("b",)], "c string")
    assert [r["c_index"] for r in model.transform(new).collect()] == [2.0, 2.0, 1.0]
    assert M.tree_bins(200) == 202


def test_path_of_many_features():
    """Quadrature equals the sum over all subsets; deep paths need no table."""
    rng = np.random.default_rng(19)
    for size in (1, 2, 5, 8):
        away, held = rng.uniform(0.05, 0.95, size), rng.integers(0, 2, (4, size)).astype(float)
        ours = A.leaf_attributions(held, away, 2.0)
        for row in range(4):
            for j in range(size):
                others, total = [k for k in range(size) if k != j], 0.0
                for taken in range(size):
                    weight = math.factorial(taken) * math.factorial(size - 1 - taken) / math.factorial(size)
                    for chosen in itertools.combinations(others, taken):
                        total += weight * np.prod([held[row, k] if k in chosen else away[k] for k in others])
                assert math.isclose(ours[row, j], 2 * total * (held[row, j] - away[j]), rel_tol=1e-9, abs_tol=1e-12)
    away, held = rng.uniform(0.3, 0.9, 20), rng.integers(0, 2, (50, 20)).astype(float)
    gap = A.leaf_attributions(held, away, 1.0).sum(1) - (held.prod(1) - away.prod())
    assert np.abs(gap).max() < 1e-12


def test_imputer_leaves_other_columns(spark):
    rows = [(None, None, 1.0), ("k", "c", None), ("k", "c", 3.0)]
    df = spark.createDataFrame(rows, "k string, c string, x double")
    filled = I.MixedImputer(columns=["c", "x"], countNulls=True).fit(df).transform(df).collect()
    assert [r["k"] for r in filled] == [None, "k", "k"] and [r["x"] for r in filled] == [1.0, 2.0, 3.0]


def test_reports_from_a_table_name(spark, tmp_path):
    from plumbline.plans.explanation import explain_table
    from plumbline.plans.model_bench import bench_table

    rng = np.random.default_rng(20)
    rows = [(i, float(a), float(b), "uv"[i % 2], int(a + b > 0)) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    spark.createDataFrame(rows, "k long, a double, b double, c string, y int").createOrReplaceTempView("report_rows")
    spec = ModelSpec(target="y", keys=("k",))
    stored(spark.range(1), "other")
    before = set((Path(shared_folder(spark)) / "plumbline").iterdir())
    paths = bench_table(spark, "report_rows", spec, str(tmp_path / "bench"))
    assert spark.read.parquet(paths["Performance_metrics"]).count() == 4
    paths = explain_table(spark, "report_rows", spec, str(tmp_path / "explain"), iterations=3)
    shared = Path(shared_folder(spark)) / "plumbline"
    assert set(paths) >= {"Partial_Dependence_2way", "Actual_Interact", "Importance", "Accuracy", "Report", "Mapping"}
    assert not set(shared.iterdir()) - before
    density = spark.read.parquet(paths["Shap_Density"])
    assert {r["n"] for r in density.groupBy("Variable").agg(F.sum("count").alias("n")).collect()} == {243}
    assert all(spark.read.parquet(p).count() for p in paths.values())


def test_grid_positions():
    assert X.grid_positions({"a": [3.0, 1.0, 2.0], "b": [5.0]}) == [("a", 1.0, 0.0), ("a", 2.0, 0.5), ("a", 3.0, 1.0), ("b", 5.0, 0.0)]


def test_scope_deletes_what_it_owns(spark):
    outside = stored(spark.range(3), "outside")
    with scratch_scope(spark) as owned:
        kept, gone = stored(spark.range(4), "kept"), stored(spark.range(5), "gone")
        with scratch_scope(spark):
            stored(spark.range(6), "inner")
        assert len(owned) == 2 and gone.count() == 5
        path = owned.pop(0)
    assert outside.count() == 3 and kept.count() == 4 and Path(path).exists()
    assert not [p for p in Path(path).parent.iterdir() if p.name.startswith(("gone", "inner"))]


def test_larger_customers_stay_off_the_driver(spark, tmp_path, monkeypatch):
    """Beyond the limit customers are joined by shuffles, and only once for all fits; the rows stay."""
    orders = [(i, "FO"[i % 2], i * 1.5, "1-URGENT", i % 40 if i % 9 else None) for i in range(200)]
    customers = [(i, i * 2.0, "BUILDING", i % 3) for i in (*range(30), 5)] + [(None, 0.0, None, 0)]
    tables = {
        "orders": (orders, "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderpriority string, o_custkey long"),
        "customer": (customers, "c_custkey long, c_acctbal double, c_mktsegment string, c_nationkey int"),
        "nation": ([(0, "A"), (1, "B")], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        frame = spark.createDataFrame(rows, schema)
        if name == "orders":
            frame = frame.withColumn("o_orderdate", F.lit("2020-01-01").cast("date"))
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    small = frames.order_status(spark, str(tmp_path))
    monkeypatch.setattr(frames, "BROADCAST_ROWS", 10)
    large = frames.order_status(spark, str(tmp_path))
    assert "SortMergeJoin" in large._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in small._jdf.queryExecution().toString()
    assert sorted(map(tuple, large.collect())) == sorted(map(tuple, small.collect()))
    prepared = prepare(large, ModelSpec(target="o_orderstatus", positive_label="F", keys=("o_orderkey",)))
    assert "Join" not in prepared.rows._jdf.queryExecution().toString()
    assert prepared.rows.count() == large.count()
