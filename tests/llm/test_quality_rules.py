import math
import random
import re

import numpy as np

from plumbline.llm import quality_rules as q


def brute(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit.update((i, i + 1, i + 2))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_statistics(spark):
    rng = random.Random(4)
    cases = ["", None, " ", "a", "a b", "a b c", "a a a a", "x\n\nx\n x\nx", "é#é |\t<>\n", "\n\n", "a b c d a b c", "a\x0bb\x0cc\rd", "a b c"]
    cases += ["".join(rng.choice(["a", "b", "c", " ", " ", "\n", "#", "é", "\t"]) for _ in range(rng.randint(1, 120))) for _ in range(150)]
    cases.append("w " * 30_000)
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(cases)], "doc_id long, text string, words string")
    for r in q.text_statistics(df).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        want = (30_000, 30_000, 0, 0, 30_000) if r.doc_id == len(cases) - 1 else brute(cases[r.doc_id])
        assert got == want, cases[r.doc_id]


def test_estimates_equal_brute_force(spark):
    """Contaminated group: same concentration steps in numpy, and the contamination stays out."""
    rng = np.random.default_rng(5)
    x = rng.normal([1.5, 0.2, 0.3, 0.3], [0.05, 0.02, 0.1, 0.08], (900, 4))
    x[:150] += [1.0, 0.7, 0.5, 0.4]
    ints = np.round(x * q.SCALE).astype(np.int64)
    df = spark.createDataFrame([("en", "=s", *map(int, r)) for r in ints], "lang string, cell string, " + ", ".join(f"{f} long" for f in q.FEATURES))
    model = q.covariance_estimates(df).collect()[0]
    values, step = ints / q.SCALE, q.SCALE // q.GRID

    def middle(v):
        return (np.sort(np.floor(v / step), axis=0)[(len(v) + 1) // 2 - 1] + 0.5) / q.GRID

    centre = middle(ints)
    cov = np.diag(np.maximum(1.4826 * middle(np.abs(ints - centre * q.SCALE)), q.FLOORS) ** 2)
    inner = q.chi_square_quantile(q.SUBSET, 4)
    for _ in range(q.STEPS):
        diff = values - centre
        bucket = np.floor(np.log2(1 + np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff)) * q.FINE)
        order = np.sort(bucket)
        near = values[bucket <= order[math.ceil(len(values) * q.SUBSET) - 1]]
        centre = near.mean(0)
        cov = np.cov(near.T, bias=True) * q.SUBSET / q.chi_square(inner, 6) + np.diag(np.square(q.FLOORS))
    assert np.allclose([model[f"m_{f}"] for f in q.FEATURES], centre, atol=1e-9)
    low = np.array([[model[f"l_{i}{j}"] if j <= i else 0 for j in range(4)] for i in range(4)])
    assert np.allclose(low @ low.T, cov, atol=1e-9)
    assert np.allclose(centre, [1.5, 0.2, 0.3, 0.3], atol=0.03)


def test_rules(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(2000)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    rows = [(i, prose(rng.randint(60, 200)), "en", "s", i) for i in range(300)]
    rows += [(1000 + i, " ".join(w + "%%%" for w in prose(80).split()), "en", "s", i) for i in range(20)]
    rows += [(2000, None, "en", None, 1), (2001, "", None, "s", 1), (2002, prose(70), "xx", "tiny", 1), (None, prose(70), "en", "s", 1), (0, rows[0][1], "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, cell long")
    got = q.quality_rules(df)
    kept = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert sum(not kept[i].kept for i in range(300)) <= 3
    assert not any(kept[1000 + i].kept for i in range(20))
    assert kept[2000].base_failed and kept[2001].base_failed and kept[2002].kept
    assert q.quality_rules(df.limit(0)).count() == 0
    assert "Python" not in got._jdf.queryExecution().toString()


def _words(rng, count=2000):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(count)]


def test_a_third_of_a_source_is_junk(spark):
    """Identical junk in one source, varied junk in another: all of it goes, clean rows stay."""
    rng = random.Random(8)
    vocabulary = _words(rng)
    same = " ".join(rng.choice(vocabulary) + "%%%" for _ in range(80))
    rows = []
    for source in ("same", "varied"):
        rows += [(len(rows) + i, " ".join(rng.choices(vocabulary, k=rng.randint(60, 200))), "en", source, True) for i in range(300)]
        for _ in range(150):
            sign = rng.choice(["%%%", "#$", "||*<>", "&&"])
            varied = " ".join(rng.choice(vocabulary) + sign for _ in range(rng.randint(60, 200)))
            rows.append((len(rows), same if source == "same" else varied, "en", source, False))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, clean boolean")
    kept = {r.doc_id: r.kept for r in q.quality_rules(df).collect()}
    for source in ("same", "varied"):
        assert not any(kept[r[0]] for r in rows if r[3] == source and not r[4])
        assert sum(not kept[r[0]] for r in rows if r[3] == source and r[4]) <= 3


def test_repeated_words_alone_are_rejected(spark):
    """45 % repeated words among clean texts go; clean texts, also with a repeated phrase, stay."""
    rng = random.Random(9)
    vocabulary = _words(rng, 6000)

    def text(n, repeated):
        found = rng.choices(vocabulary, k=n)
        half = round(n * repeated / 2)
        return " ".join(found[:half] + found[half : n - half] + found[:half])

    rows = [(i, text(rng.randint(60, 300), 0), "en", "s") for i in range(300)]
    rows += [(1000 + i, text(n, 0.45), "en", "s") for i, n in enumerate((60, 100, 200, 400))]
    rows += [(2000 + i, text(n, 6 / n), "en", "s") for i, n in enumerate((60, 100, 200, 400))]
    rows += [(3000, "same line of text\nsame line of text\n" + text(80, 0).replace(" ", "\n", 1), "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in q.quality_rules(df).collect()}
    assert all(not got[1000 + i].base_failed and not got[1000 + i].kept for i in range(4))
    assert sum(not got[i].kept for i in range(300)) <= 1
    assert all(got[2000 + i].kept for i in range(4)) and got[3000].kept


def test_verdict_does_not_jump_with_size(spark):
    """Eight junk texts go from groups of any of these sizes, and clean texts of small groups stay."""
    rng = random.Random(10)
    vocabulary = _words(rng)
    for clean in (60, 110):
        rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(60, 200))), "en", "s") for i in range(clean)]
        rows += [(1000 + i, " ".join(w + "%%%" for w in rng.choices(vocabulary, k=80)), "en", "s") for i in range(8)]
        rows += [(2000 + i, " ".join(rng.choices(vocabulary, k=90)), "en", f"small {i // 3}") for i in range(9)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        kept = {r.doc_id: r.kept for r in q.quality_rules(df).collect()}
        assert not any(kept[1000 + i] for i in range(8)), clean
        assert sum(not kept[i] for i in range(clean)) <= 1 and all(kept[2000 + i] for i in range(9)), clean
    few = df.filter("doc_id in (0, 1, 2000)")
    assert q.quality_rules(few).filter("kept").count() == 3


def test_small_groups_lean_on_larger_ones(spark):
    """Weighted means of centres and covariances over the three levels, by hand."""
    rng = np.random.default_rng(3)
    levels = {("en", "=s"): 7, ("en", "*"): 40, ("", "**"): 90, ("fr", "=t"): 50, ("fr", "*"): 50}
    centre = {k: rng.normal(size=4) for k in levels}
    low = {k: np.tril(rng.normal(size=(4, 4))) + 3 * np.eye(4) for k in levels}
    rows = [(*k, n, *map(float, centre[k]), *[float(low[k][i, j]) for i in range(4) for j in range(i + 1)]) for k, n in levels.items()]
    df = spark.createDataFrame(rows, ["lang", "cell", "n", *q._model_columns()])
    got = {(r.lang, r.cell): r for r in q.leaning(df, 10).collect()}
    assert set(got) == {("en", "=s"), ("fr", "=t")}
    mean, cov = centre[("", "**")], (90 * low[("", "**")] @ low[("", "**")].T + 10 * np.diag(np.square(q.PRIOR))) / 100
    for lang, cell in got:
        m, c = mean, cov
        for k in ((lang, "*"), (lang, cell)):
            n = levels[k]
            m, c = (n * centre[k] + 10 * m) / (n + 10), (n * low[k] @ low[k].T + 10 * c) / (n + 10)
        r = got[lang, cell]
        factor = np.array([[r[f"l_{i}{j}"] if j <= i else 0 for j in range(4)] for i in range(4)])
        assert np.allclose([r[f"m_{f}"] for f in q.FEATURES], m) and np.allclose(factor @ factor.T, c)
