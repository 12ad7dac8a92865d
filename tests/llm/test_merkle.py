import hashlib
import random

from plumbline.llm import merkle

SCHEMA = "file string, offset long, payload string, size int"


def digest(items):
    found = sorted(hashlib.sha256((p or "").encode()).hexdigest() for p in items)
    return found[0] if len(found) == 1 else hashlib.sha256(",".join(found).encode()).hexdigest()


def brute(left, right):
    sides = []
    for rows in (left, right):
        held = {}
        for file, offset, payload, _ in rows:
            held.setdefault((file or "", -1 if offset is None else offset), []).append(payload)
        sides.append({k: digest(v) for k, v in held.items()})
    out = []
    for key in set(sides[0]) | set(sides[1]):
        a, b = (s.get(key) for s in sides)
        if a != b:
            out.append((*key, "missing" if b is None else "extra" if a is None else "corrupt", a, b))
    return sorted(out, key=str)


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE", 64)
    monkeypatch.setattr(merkle, "FANOUT", 3)
    rng = random.Random(18)
    left = []
    for f in ("a", "b", "c", None):
        at = 0
        for _ in range(rng.randint(1, 80)):
            body = "x" * rng.randint(0, 30) + str(rng.random())
            left.append((f, at, body, 0))
            at += len(body)
    left += [("d", None, None, 0), ("d", 0, "", 0), ("d", 0, "q", 0), ("d", 0, "q", 0), ("e", 5, "z" * 300_000, 0)]
    right = [r for i, r in enumerate(left) if i % 17 != 3]
    right = [(f, o, (p or "") + "!", s) if i % 13 == 5 and f != "a" else (f, o, p, s) for i, (f, o, p, s) in enumerate(right)]
    right += [("new", 3, "n", 1), ("b", 99_999, "far", 1)]
    a, b = (spark.createDataFrame(rows, SCHEMA) for rows in (left, right))
    got = sorted((tuple(r) for r in merkle.fixity_audit(a, b).collect()), key=str)
    assert got == brute(left, right)
    assert merkle.fixity_audit(a, a).count() == 0
    assert merkle.fixity_audit(a.limit(0), a.limit(0)).count() == 0
    assert merkle.fixity_audit(a, a.limit(0)).count() == len(brute(left, []))


def test_only_broken_branches_are_open(spark):
    rows = [("f", i * 1000, "p%d" % i, 0) for i in range(3000)]
    a, b = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([*rows[:-1], ("f", 2_999_000, "other", 0)], SCHEMA)
    trees = [merkle.tree(merkle.record_digests(x), 2) for x in (a, b)]
    assert [merkle._different(x, y, ["file", "index"]).count() for x, y in zip(*trees)] == [1, 1, 1]
    assert [x.count() for x in trees[0]] == [12, 2, 1]
