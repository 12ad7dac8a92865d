"""Tiles, ranks and quantiles against single-partition windows and numpy, with heavy skew."""

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.functions import tie_number
from plumbline.operators import evaluation as EV
from plumbline.operators import order_stats as O
from plumbline.operators import radix as RX
from plumbline.operators import ranking as R


def skewed(spark, rows=6000):
    """A third of the rows share one score; the rest are spread out, negative or missing."""
    k = F.col("id")
    score = F.when(k % 3 == 0, 0.5).when(k % 97 == 0, None).otherwise(F.sin(k.cast("double")))
    return spark.range(rows).select(k, score.alias("score"), (k % 7 < 3).cast("int").alias("y"), (k % 2).alias("g"))


def window_order(df):
    return [F.col("score").desc_nulls_last(), tie_number(df, ["id"])]


@pytest.mark.parametrize("tiles", [1, 3, 10])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_ntile_equals_window(spark, tiles, by):
    df = skewed(spark)
    ours = R.score_ntile(df, "score", ["id"], tiles, by, "ours")
    both = ours.withColumn("plain", F.ntile(tiles).over(W.partitionBy(*by).orderBy(*window_order(df))))
    assert both.count() == 6000
    assert both.filter("ours <> plain").count() == 0


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("cells", [1, 7, 64])
def test_rank_equals_window(spark, by, cells):
    df = skewed(spark)
    ours = R.score_rank(df, "score", ["id"], by, "ours", cells=cells)
    both = ours.withColumn("plain", F.row_number().over(W.partitionBy(*by).orderBy(*window_order(df))))
    assert both.count() == 6000
    assert both.filter("ours <> plain").count() == 0


def test_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(i, float(i), i % 2) for i in range(4)], "id long, score double, y int")
    tiles = {r["id"]: r["deciles"] for r in R.score_ntile(df, "score", ["id"]).collect()}
    assert tiles == {3: 1, 2: 2, 1: 3, 0: 4}
    assert [r["count"] for r in EV.gains_table(df, "y", "score", ["id"]).orderBy("deciles").collect()] == [1] * 4


def copies(spark):
    """One row, repeated, makes up a third of the table and spans several tiles."""
    once = spark.range(2000).select(F.col("id"), F.cos("id").alias("score"), (F.col("id") % 2).cast("int").alias("y"))
    again = spark.range(1000).select(F.lit(5000).cast("long").alias("id"), F.lit(0.1).alias("score"), F.lit(1).alias("y"))
    return once.unionByName(again)


def test_copies_of_a_row_are_dealt_out(spark):
    df = copies(spark)
    tiled = R.score_ntile(df, "score", ["id"])
    assert tiled.count() == 3000
    assert {r["deciles"]: r["count"] for r in tiled.groupBy("deciles").count().collect()} == {d: 300 for d in range(1, 11)}
    plain = df.withColumn("d", F.ntile(10).over(W.orderBy(F.desc("score"), tie_number(df, ["id"]), F.desc("y"))))
    expected = {r["d"]: (r["n"], r["t"]) for r in plain.groupBy("d").agg(F.count("*").alias("n"), F.sum("y").alias("t")).collect()}
    gains = {r["deciles"]: (r["count"], r["target"]) for r in EV.gains_table(df, "y", "score", ["id"]).collect()}
    assert gains == expected


def test_copies_with_different_targets(spark):
    df = spark.range(1000).select(F.lit(1).cast("long").alias("id"), F.lit(0.5).alias("score"), (F.col("id") % 2).cast("int").alias("y"))
    gains = EV.gains_table(df, "y", "score", ["id"]).orderBy("deciles").collect()
    assert [r["count"] for r in gains] == [100] * 10
    assert sum(r["target"] for r in gains) == 500


def test_rank_of_hot_copies(spark, monkeypatch):
    monkeypatch.setattr(R, "HOT_CELL_ROWS", 50)
    monkeypatch.setattr(R, "CHUNK", 64)
    ranks = [r["rownum"] for r in R.score_rank(copies(spark), "score", ["id"], cells=64).collect()]
    assert sorted(ranks) == list(range(1, 3001))
    by_rank = R.score_rank(copies(spark), "score", ["id"], cells=64).orderBy("rownum").collect()
    scores = [r["score"] for r in by_rank]
    assert scores == sorted(scores, reverse=True)


@pytest.mark.parametrize("limit", [0, 500_000])
def test_quantiles_equal_numpy(spark, monkeypatch, limit):
    monkeypatch.setattr(O, "FINISH_ROWS", limit)
    rng = np.random.default_rng(5)
    columns = {
        "normal": rng.normal(size=999),
        "heavy": np.exp(rng.normal(scale=40, size=1000)) * rng.choice([-1, 1], 1000),
        "hot": np.where(rng.random(1000) < 0.4, 7.0, rng.random(1000)),
        "constant": np.full(10, 3.5),
        "close": np.nextafter(np.full(9, 1.0), 2.0) * rng.choice([1.0, 1.0 + 2**-52], 9),
        "edge": np.array([-np.inf, -1e308, 0.0, 5e-324, 1e308, np.inf]),
    }
    rows = [(name, float(v)) for name, values in columns.items() for v in values]
    df = spark.createDataFrame(rows, "name string, v double")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    found = O.quantiles(df, "v", probabilities, ["name"])
    for name, values in columns.items():
        if name == "edge":
            continue
        np.testing.assert_allclose(found[(name,)], np.quantile(values, probabilities), rtol=1e-12)
    at = {s.rank: s.value for s in O.order_statistics(df.filter("name = 'edge'"), "v", lambda g, n: range(n))}
    assert [at[k] for k in range(6)] == sorted(columns["edge"])


def test_large_integers_are_told_apart(spark):
    base = 2**61
    df = spark.range(300).select((F.col("id") + F.lit(base)).alias("v"))
    found = O.order_statistics(df, "v", lambda g, n: [0, 150, 299])
    assert {s.rank: s.value for s in found} == {0: base, 150: base + 150, 299: base + 299}


def test_input_that_changes_is_refused(spark):
    cells = (np.array([1.0]), np.array([2.0]), np.array([5]))
    with pytest.raises(RuntimeError):
        O._descend(O._Interval((), 1.0, 2.0, 0, 6, 6, [0]), cells, [], [])


@pytest.mark.parametrize("cell_scores", [1000, 90, 7])
def test_auc_equals_pair_count(spark, cell_scores):
    df = skewed(spark, 600).filter("score IS NOT NULL")
    rows = df.collect()
    pos = [r["score"] for r in rows if r["y"] == 1]
    neg = [r["score"] for r in rows if r["y"] == 0]
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert EV.roc_auc(df, "y", "score", cell_scores=cell_scores).first()[0] == pytest.approx(pairs, abs=1e-12)


def test_no_single_partition_over_rows(spark):
    """Only tables of a few rows per group may meet in one partition."""
    df = skewed(spark)
    tiled = R.score_ntile(df, "score", ["id"])
    plan = tiled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    ranked = R.score_rank(df, "score", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in ranked


@pytest.mark.parametrize("by", [[], ["g"]])
def test_many_tiles(spark, by):
    df = skewed(spark)
    ours = R.score_ntile(df, "score", ["id"], 1000, by, "ours")
    both = ours.withColumn("plain", F.ntile(1000).over(W.partitionBy(*by).orderBy(*window_order(df))))
    assert both.count() == 6000
    assert both.filter("ours <> plain").count() == 0


def test_many_tiles_of_copies(spark):
    tiled = R.score_ntile(copies(spark), "score", ["id"], 100)
    assert {r["deciles"]: r["count"] for r in tiled.groupBy("deciles").count().collect()} == {d: 30 for d in range(1, 101)}


@pytest.mark.parametrize("value", [float("nan"), None, float("inf")])
def test_frequent_end_of_the_order_is_cut(spark, value):
    """A third of the rows without a usable score must not meet in one cell."""
    k = F.col("id")
    hot = F.lit(value).cast("double")
    df = spark.range(20_000).select(k, F.when(k % 3 == 0, hot).otherwise(F.sin(k.cast("double"))).alias("score"))
    scored = df.withColumns({"_s": R.sortable_score("score"), "_t": tie_number(df, ["id"])})
    sizes = [r["count"] for r in R._with_cell(scored, 64).groupBy("_cell").count().collect()]
    assert max(sizes) < 3 * 20_000 / 64
    ours = R.score_rank(df, "score", ["id"], output="ours", cells=64)
    order = [F.coalesce(F.nanvl("score", F.lit(float("inf"))), F.lit(float("-inf"))).desc(), tie_number(df, ["id"])]
    both = ours.withColumn("plain", F.row_number().over(W.orderBy(*order)))
    assert both.filter("ours <> plain").count() == 0 and both.count() == 20_000


def test_order_code_follows_descending_doubles(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate(
        [
            [0.0, -0.0, np.inf, -np.inf, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308],
            np.exp2(np.arange(-1074, 1024, 1.0)),
            np.nextafter(np.exp2(np.arange(-1000, 1024, 7.0)), 0),
            rng.normal(size=500) * np.exp(rng.normal(scale=90, size=500)),
        ]
    )
    values = np.concatenate([values, -values])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", RX.order_code(F.col("v")).alias("c"))
    pairs = sorted((-r["v"], r["c"]) for r in df.collect())
    codes = [c for _, c in pairs]
    assert codes == sorted(codes)
    spread = rng.normal(size=1000)
    df = spark.createDataFrame([(float(v),) for v in spread], "v double")
    assert df.select(RX.order_code(F.col("v")).alias("c")).distinct().count() == 1000


@pytest.mark.parametrize("finish", [0, 50, 100_000])
@pytest.mark.parametrize("bits", [4, 12])
def test_passes_end_at_the_same_rows(spark, monkeypatch, finish, bits):
    monkeypatch.setattr(RX, "FINISH_ROWS", finish)
    monkeypatch.setattr(RX, "DIGIT_BITS", bits)
    df = skewed(spark, 900).unionByName(skewed(spark, 40).withColumn("score", F.lit(1e300) * F.sin("id")))
    ours = R.score_ntile(df, "score", ["id"], 7, ["g"], "ours").select("id", "score", "g", "ours")
    plain = df.withColumn("plain", F.ntile(7).over(W.partitionBy("g").orderBy(*window_order(df)))).select("id", "score", "g", "plain")
    assert sorted(map(str, map(tuple, ours.collect()))) == sorted(map(str, map(tuple, plain.collect())))


def test_rows_without_keys_spread(spark):
    """A third of the rows share one score and lack the key: their cell is cut by their content."""
    k = F.col("id")
    df = spark.range(20_000).select(
        F.when(k % 3 != 0, k).alias("id"), F.when(k % 3 == 0, 0.5).otherwise(F.sin(k.cast("double"))).alias("score"), k.alias("other")
    )
    scored = df.withColumns({"_s": R.sortable_score("score"), "_t": tie_number(df, ["id"], 0, R.content_columns(df))})
    sizes = [r["count"] for r in R._with_cell(scored, 64).groupBy("_cell").count().collect()]
    assert max(sizes) < 3 * 20_000 / 64
    tiles = R.score_ntile(df, "score", ["id"])
    assert {r["deciles"]: r["count"] for r in tiles.groupBy("deciles").count().collect()} == {d: 2000 for d in range(1, 11)}
    ranked = R.score_rank(df, "score", ["id"], cells=64).join(tiles.select("other", "deciles"), "other")
    assert ranked.filter("deciles <> floor((rownum - 1) / 2000) + 1").count() == 0
    assert ranked.agg(F.countDistinct("rownum")).first()[0] == 20_000


def test_auc_ranges_hold_a_set_number_of_scores(spark):
    """By group, with one score in a third of the rows: ranges depend on distinct scores only."""
    df = skewed(spark, 4000).filter("score IS NOT NULL")
    got = {r["g"]: r["roc_auc"] for r in EV.roc_auc(df, "y", "score", ["g"], cell_scores=50).collect()}
    want = {r["g"]: r["roc_auc"] for r in EV.roc_auc(df, "y", "score", ["g"]).collect()}
    assert got.keys() == want.keys() and all(got[g] == pytest.approx(want[g], abs=1e-12) for g in got)
