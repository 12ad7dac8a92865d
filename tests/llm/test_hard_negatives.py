import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import hard_negatives as hn
from plumbline.llm.common import materialise

SCHEMA = "score long, vec_id long, embedding array<float>, label int, row string, norm int"


def brute(rows, every=3, k=5, low=80, high=100):
    usable = []
    for _, vec_id, vector, label, *_ in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []

    def order(found):
        return sorted(found, key=lambda f: (-f[1], f[0] is None, f[0] or 0))[:k]

    for i, (anchor, label, v) in enumerate(usable):
        if anchor is None or anchor % every:
            continue
        scored = [(o, sum(a * b for a, b in zip(v, w)), l == label) for j, (o, l, w) in enumerate(usable) if j != i]
        for positive, p in order([s[:2] for s in scored if s[2]]):
            fitting = [s[:2] for s in scored if not s[2] and low * p <= 100 * s[1] <= high * p]
            out += [(anchor, positive, n, *f[:1], p, f[1]) for n, f in enumerate(order(fitting), 1)]
    return sorted(out, key=str)


def got(spark, rows, every=3):
    df = spark.createDataFrame(rows, SCHEMA)
    held = materialise(hn.integer_rows(df, F.col("vec_id"), F.col("label"), F.col("embedding")), "test")
    return sorted((tuple(r) for r in hn.hard_negatives(held, F.col("id") % every == 0).collect()), key=str)


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hn, "SHARD", 40 * 9)
    monkeypatch.setattr(hn, "BLOCK", 10 * 9)
    monkeypatch.setattr(hn, "STEP", 2)
    monkeypatch.setattr(hn, "AT_ONCE", 4)
    rng = random.Random(11)
    rows = []
    for i in range(130):
        size = rng.choice([9, 9, 9, 9, 4, 0])
        vector = [rng.gauss(0, 0.3) for _ in range(size)]
        rows.append((1, rng.choice([i, i, i, rng.randrange(40), -i, None]), vector, rng.choice([0, 0, 0, 1, 2, None]), "x", 2))
    rows += [(1, 300 + i, [0.5] * 9, i % 3, "x", 2) for i in range(25)]
    rows += [(1, 402, None, 1, "x", 2), (1, 405, [0.1, None], 1, "x", 2), (1, 408, [float("nan")], 1, "x", 2), (1, 411, [float("-inf")], 0, "x", 2)]
    rows += rows[:5] + [(1, 900, [1.0] * 9, 77, "x", 2), (1, 903, [-5.0] * 9, 1, "x", 2), (1, 906, [0.0] * 9, 1, "x", 2)]
    assert got(spark, rows) == brute(rows)


def test_large_components_are_exact(spark):
    rng = random.Random(5)
    rows = [(1, i, [rng.uniform(-9e5, 9e5) for _ in range(5)], i % 2, "x", 2) for i in range(24)]
    rows.append((1, 27, [3e38, 1.0], 1, "x", 2))
    assert got(spark, rows) == brute(rows[:-1])


@pytest.mark.parametrize("rows", [[], [(1, 0, [1.0], 0, "x", 2)], [(1, 0, [1.0], 0, "x", 2), (1, 1, [1.0], 1, "x", 2)]])
def test_nothing_to_return(spark, rows):
    assert got(spark, rows) == []


@pytest.mark.parametrize("least", [-(10**9), 0, 2000, 9000, 16000, 10**9])
@pytest.mark.parametrize("spread", [0.0, 0.5])
def test_pairs_equal_products(least, spread):
    rng = np.random.default_rng(7)
    weight = np.exp(-spread * np.arange(40))
    rows, anchors = (np.floor(40 * rng.normal(size=(n, 40)) * weight) for n in (700, 150))
    need = np.full(150, least) + rng.integers(0, 500, 150)
    found = {(q, int(r), int(s)) for q, near, scores in hn.pairs_above(rows, anchors, need) for r, s in zip(near, scores)}
    scores = anchors @ rows.T
    assert found == {(int(q), int(r), int(scores[q, r])) for q, r in zip(*np.nonzero(scores >= need[:, None]))}
