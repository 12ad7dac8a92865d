import hashlib
import random
import zlib

import pytest

from plumbline.llm import manifest

SCHEMA = "text string, lang string, doc_id long, source string, n_chars long, root string, `group` string, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(leaves, fanout):
    """Top and, for each leaf, the pairs (left, right) on the way up."""
    paths, places, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for path, place in zip(paths, places):
            run = nodes[place // fanout * fanout :][:fanout]
            path.append(("".join(run[: place % fanout]), "".join(run[place % fanout + 1 :])))
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        places = [p // fanout for p in places]
    return nodes[0], paths


def brute(rows, fanout):
    groups = {}
    for text, lang, doc_id, source, n_chars, *_ in rows:
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and text is not None
        other = "".join(c.lower() if c.isascii() else c for c in text) if hit else text
        pair = leaf(doc_id, source, lang, n_chars, text), leaf(doc_id, source, lang, n_chars, other)
        groups.setdefault((source is not None, (source or "").encode()), []).append((doc_id is not None, doc_id or 0, *pair))
    names = sorted(groups)
    below = {}
    for name in names:
        groups[name].sort()
        below[name] = tree([r[2] for r in groups[name]], fanout)
    root, above = tree([below[n][0] for n in names], fanout) if names else (None, [])
    out = []
    for name, up in zip(names, above):
        for (known, doc_id, first, other), path in zip(groups[name], below[name][1]):
            held = other
            for left, right in path + up:
                held = sha(left + held + right)
            proof = sha("".join(left + right for left, right in path + up))
            out.append((doc_id if known else None, first, below[name][0], root, proof, held, held == root))
    return sorted(out, key=str)


def some_rows(rng, sizes):
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            doc_id = rng.choice([None, rng.randrange(-50, 10**12), rng.randrange(400)])
            text = rng.choice([None, "", "Aa é\nB", "lower", "X" * rng.randrange(40)])
            rows.append((text, rng.choice(["en", None]), doc_id, source, rng.choice([None, 3]), "r", "g", "d"))
    return rows + rows[:7]


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_equals_brute_force(spark, monkeypatch, fanout):
    monkeypatch.setattr(manifest, "FANOUT", fanout)
    sizes = {None: 5, "": 1, "a": 1, "b": 17, "c": 16, "é": 33, "z": 290, "Z": 2}
    rows = some_rows(random.Random(12), sizes)
    got = manifest.audited(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, fanout)


def test_many_groups(spark):
    rows = some_rows(random.Random(3), {f"s{i}": 1 + i % 3 for i in range(300)})
    got = manifest.audited(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 16)


@pytest.mark.parametrize("n", [0, 1, 16, 17, 257])
def test_one_group(spark, n):
    rows = [("Text", "en", i, "s", 4, None, None, None) for i in range(n)]
    got = manifest.audited(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 16)


def test_copies_of_one_row_are_numbered_in_several_tasks(spark):
    rows = spark.range(40_000).selectExpr("'s' AS grp", "1 AS k")
    ranges = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        salted = rows.selectExpr("*", "monotonically_increasing_id() AS salt")
        placed = manifest.numbered(salted, "grp", ["k", "salt"])
        assert placed.selectExpr("count(DISTINCT index)", "min(index)", "max(index)", "max(width)").first() == (40_000, 0, 39_999, 40_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", ranges)


def test_general_rows(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "k long, v string")
    held = manifest.build(rows, F.col("v"), F.col("k"), manifest.digest_of([F.col("k"), F.col("v")]))
    found = manifest.proofs(held)
    assert found.filter(manifest.folded(F.col("digest"), F.col("path")) == F.col("root")).count() == 3
    assert found.filter(manifest.folded(F.unhex(F.sha2(F.lit("no"), 256)), F.col("path")) == F.col("root")).count() == 0
