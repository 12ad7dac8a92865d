import random
import re

import numpy as np
import pytest

from plumbline.llm import decontaminate as d
from plumbline.llm.fm_index import FMIndex, suffix_array


def test_suffix_array():
    rng = np.random.default_rng(8)
    for symbols, size in ((1, 50), (2, 300), (5, 400), (1000, 300)):
        text = rng.integers(1, symbols + 1, size)
        want = sorted(range(size), key=lambda i: text[i:].tolist())
        assert suffix_array(text).tolist() == want


def test_index_finds_all():
    rng = np.random.default_rng(9)
    text = rng.integers(1, 5, 700)
    index = FMIndex(text, 6)
    patterns = np.zeros((60, 4), np.int64)
    lengths = rng.integers(1, 5, 60)
    for i, n in enumerate(lengths):
        patterns[i, :n] = rng.integers(1, 6, n)
    low, high = index.search(patterns, lengths)
    for i, n in enumerate(lengths):
        want = [p for p in range(len(text) - n + 1) if (text[p : p + n] == patterns[i, :n]).all()]
        assert sorted(index.locate(np.arange(low[i], max(low[i], high[i]))).tolist()) == want


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    mine, hit, ids = words(text), set(), set()
    for item, passage in items:
        w = words(passage)
        windows = {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
        for i in range(len(mine)):
            for x in windows:
                if tuple(mine[i : i + len(x)]) == x:
                    hit.update(range(i, i + len(x)))
                    if item is not None:
                        ids.add(item)
    return len(mine), len(hit), sorted(ids)


@pytest.mark.parametrize("block", [500_000, 40])
def test_rows(spark, monkeypatch, block):
    monkeypatch.setattr(d, "BLOCK_WORDS", block)
    rng = random.Random(10)
    vocabulary = ["a", "b", "É", "c", "d9", "ñ"]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, prose(rng.randint(1, 30) + 8)) for i in range(8)] + [(8, None), (9, ""), (10, "c c d9"), (None, "b b b b"), (3, "dup id a"), (10, "c c d9")]
    docs = [(i, prose(rng.randint(0, 200)), i) for i in range(40)]
    docs += [(100, None, 1), (101, "", 1), (102, "--- !!", 1), (103, " ".join(items[0][1].split()).upper().replace("É", "É") + ".", 1), (103, items[1][1], 2), (None, items[2][1] + " x " + items[2][1], 1)]
    docs += [(200, "x " * 60_000 + items[3][1] + " y" * 60_000, 1)]
    left = spark.createDataFrame(docs, "doc_id long, text string, items long")
    right = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r["items"]) for r in d.find_passages(left, right).na.fill(-1, ["doc_id"]).collect())
    want = sorted((-1 if k is None else k, *brute(t, items)) for k, t, _ in docs if k != 200)
    assert [g for g in got if g[0] != 200] == want
    big = [g for g in got if g[0] == 200][0]
    assert big[1] == 120_000 + len(words(items[3][1])) and big[2] >= len(words(items[3][1])) and 3 in big[3]
    assert d.find_passages(left.limit(0), right).count() == 0
    none = d.contamination_report(d.find_passages(left, right.limit(0)))
    assert none.count() == len(docs) and not any(r.n_hit or r.contaminated for r in none.collect())
