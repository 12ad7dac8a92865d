import collections
import math
import random
from pathlib import Path

import numpy as np

from plumbline.llm import kneser_ney as k


def brute_model(docs):
    """Textbook interpolated modified Kneser-Ney with dictionaries."""
    three = collections.Counter()
    for d in docs:
        w = ["<s>", "<s>", *d.split(), "</s>"]
        three.update(zip(w, w[1:], w[2:]))
    two = collections.Counter(t[1:] for t in three)
    one = collections.Counter(t[1:] for t in two)
    levels = []
    for counts in (one, two, three):
        n = [sum(v == i for v in counts.values()) for i in (1, 2, 3, 4)]
        if n[0] and n[1] and n[2]:
            y = n[0] / (n[0] + 2 * n[1])
            raw = [i + 1 - (i + 2) * y * n[i + 1] / n[i] for i in range(3)]
            cut = [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]
        else:
            cut = [0.5, 0.75, 1.0]
        total, left = collections.Counter(), collections.Counter()
        for g, v in counts.items():
            total[g[:-1]] += v
            left[g[:-1]] += cut[min(v, 3) - 1]
        levels.append((counts, cut, total, left))

    def p(gram):
        counts, cut, total, left = levels[len(gram) - 1]
        low = p(gram[1:]) if len(gram) > 1 else 1 / (len(one) + 1)
        if not total[gram[:-1]]:
            return low
        v = counts[gram]
        return (v - cut[min(v, 3) - 1] if v else 0) / total[gram[:-1]] + left[gram[:-1]] / total[gram[:-1]] * low

    return p


def prose(rng, vocabulary, n):
    return " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=n))


def test_equals_textbook(spark):
    rng = random.Random(12)
    vocabulary = ["w%d" % i for i in range(60)]
    docs = [prose(rng, vocabulary, rng.randint(0, 60)) for _ in range(60)]
    model = k.train(spark.createDataFrame([(d,) for d in docs], "text string"))
    p = brute_model(docs)
    tests = docs[:5] + [prose(rng, vocabulary + ["new"], 30) for _ in range(5)] + ["", "never seen"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(tests)], "doc_id long, text string, lang string")
    for r in k.score(df, model).collect():
        w = ["<s>", "<s>", *tests[r.doc_id].split(), "</s>"]
        logs = [math.log10(p(g)) for g in zip(w, w[1:], w[2:])]
        assert math.isclose(r.log_perplexity, -sum(logs) / len(logs), rel_tol=1e-9), tests[r.doc_id]
    assert math.isclose(sum(p(("w1", "w2", x)) for x in [*vocabulary, "</s>"]) + p(("w1", "w2", "zzz")), 1, abs_tol=0.02)


def test_separates(spark):
    rng = random.Random(13)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(300)]
    rows = [(i, prose(rng, vocabulary, rng.randint(60, 150)), "en" if i % 3 else "fr", 0) for i in range(600)]
    rows += [(1000 + i, prose(rng, vocabulary, 90).upper() + " !!", "en", 0) for i in range(30)]
    rows += [(2000, None, "en", 0), (2001, "", None, 0), (2002, rows[1][1], "xx", 0), (None, rows[2][1], "en", 0), (1, rows[1][1], "en", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 600, 2)] + [(None, 1, 0), (1001, 0, 0), (0, 0, 0), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    result = k.quality_classifier(df, labels, train_documents=150)
    got = {r.doc_id: r for r in result.collect()}
    assert result.count() == len(rows)
    assert np.mean([got[i].kept for i in range(600)]) > 0.97
    assert not any(got[1000 + i].kept for i in range(30))
    assert not got[2000].kept and not got[2001].kept and got[2002].kept and got[None].kept
    assert k.quality_classifier(df.limit(0), labels).count() == 0
    assert k.quality_classifier(df, labels.limit(0)).filter("kept").count() == len(rows) - 2


def _tongue(rng, letters, count=300):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(count)]


def test_small_language_keeps_its_documents(spark):
    """Own words, no, ten or forty labels: clean documents stay; foreign words go where labels exist."""
    rng = random.Random(14)
    large = _tongue(rng, "abcdefgh")
    rows = [(i, prose(rng, large, rng.randint(60, 150)), "large") for i in range(400)]
    labels = [(i, 1) for i in range(0, 400, 2)]
    for n, (labelled, letters) in enumerate(((0, "ijkl"), (10, "mnop"), (40, "qrst"))):
        words, first = _tongue(rng, letters), 1000 * (n + 1)
        rows += [(first + i, prose(rng, words, rng.randint(60, 150)), f"small {labelled}") for i in range(100)]
        rows += [(first + 500 + i, prose(rng, _tongue(rng, "uvwxyz"), 90), f"small {labelled}") for i in range(10)]
        labels += [(first + i, 1) for i in range(labelled)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    result = k.quality_classifier(df, spark.createDataFrame(labels, "doc_id long, quality int"), train_documents=120)
    got = {r.doc_id: r for r in result.collect()}
    for first, labelled in ((1000, 0), (2000, 10), (3000, 40)):
        assert np.mean([got[first + i].kept for i in range(100)]) >= 0.95, labelled
        assert (got[first].limit is None) == (labelled == 0)
        assert all(got[first + 500 + i].kept == (labelled == 0) for i in range(10)), labelled
    assert np.mean([got[i].kept for i in range(400)]) > 0.97


def test_verdict_equals_brute_force(spark):
    """Draw, limits and verdicts from the perplexities alone; ids that repeat with other texts included."""
    rng = random.Random(15)
    words = _tongue(rng, "abcdefgh")
    rows = [(i // 2 if i < 20 else i, prose(rng, words, rng.randint(5, 60)), rng.choice(["en", "en", "fr", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)], "doc_id long, quality int")
    got = k.quality_classifier(df, labels, train_documents=10, doubt=4).collect()
    assert len(got) == len(rows)
    keyed = df.selectExpr("*", "coalesce(lang, '') l", "pmod(xxhash64(doc_id, 'half'), 2) = 0 half", "xxhash64(text) h")
    keyed = keyed.selectExpr("*", "pmod(xxhash64(doc_id, h), 1 << 30) u").filter("doc_id % 3 > 0 and half").collect()
    by_lang = collections.defaultdict(list)
    for r in keyed:
        by_lang[r.l].append((r.u, r.doc_id, r.h))
    turns = sorted((t, *x, lang) for lang, found in by_lang.items() for t, x in enumerate(sorted(found)))[:10]
    seen = {t[2] for t in turns}
    drawn = k.draw(spark.createDataFrame([(r.doc_id, r.l, r.h) for r in keyed], "doc_id long, lang string, text_hash long"), 10)
    assert {(r.doc_id, r.text_hash) for r in drawn.collect()} == {(t[2], t[3]) for t in turns}
    for lang in ("en", "fr", ""):
        own = [r for r in got if r.lang == lang]
        logs = sorted(math.ceil(math.log10(r.perplexity) * k.GRID - 1e-7) for r in own if r.doc_id % 3 and r.doc_id not in seen)
        limit = logs[math.ceil(k.QUANTILE * len(logs)) - 1] / k.GRID + k.MARGIN * (1 + 4 / len(logs))
        assert all(math.isclose(math.log10(r.limit), limit, abs_tol=1e-9) for r in own)
        assert all(r.kept == (r.perplexity <= r.limit) for r in own)


def test_learns_from_every_trusted_text(spark):
    """More texts than any bound and one of 25,000 characters: perplexities are those of a textbook model of them all."""
    rng = random.Random(16)
    words = _tongue(rng, "abcdefgh")
    rows = [(i, prose(rng, words, rng.randint(2, 8)), "en") for i in range(6_600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    half = [r.doc_id for r in df.filter("pmod(xxhash64(doc_id, 'half'), 2) = 0").select("doc_id").collect()]
    rows[half[0]] = (half[0], prose(rng, _tongue(rng, "mnop"), 6_000), "en")
    assert len(half) > 3_000 and len(rows[half[0]][1]) > 20_000
    df = spark.createDataFrame(rows, df.schema)
    labels = spark.createDataFrame([(i, 1) for i in range(6_600)], "doc_id long, quality int")
    got = {r.doc_id: r for r in k.quality_classifier(df, labels).collect()}
    p = brute_model([rows[i][1] for i in half])
    for i in [half[0], *range(0, 6_600, 300)]:
        w = ["<s>", "<s>", *rows[i][1].split(), "</s>"]
        logs = [math.log10(p(g)) for g in zip(w, w[1:], w[2:])]
        assert math.isclose(math.log10(got[i].perplexity), -sum(logs) / len(logs), rel_tol=1e-9), i


def test_slices_shards_and_waves_change_nothing(spark, monkeypatch):
    rng = random.Random(17)
    words = _tongue(rng, "abcdefgh")
    df = spark.createDataFrame([(i % 90, prose(rng, words, rng.randint(0, 40)), "en") for i in range(100)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(90)], "doc_id long, quality int")

    def result():
        return sorted((r.doc_id, r.n_words, round(r.perplexity, 6), r.kept) for r in k.quality_classifier(df, labels).collect())

    whole = result()
    monkeypatch.setattr(k, "SHARD", 100)
    monkeypatch.setattr(k, "SLICE_BYTES", 2_000)
    assert result() == whole and len(whole) == 100


def test_entries_are_packed_by_shard(spark, monkeypatch):
    """A row per order and shard, so that scoring moves no row per n-gram; every n-gram is in it once, sorted."""
    monkeypatch.setattr(k, "SHARD", 400)
    monkeypatch.setattr(k, "PIECE", 50)
    rng = random.Random(18)
    vocabulary = ["w%d" % i for i in range(60)]
    docs = [prose(rng, vocabulary, 40) for _ in range(40)]
    model = k.train(spark.createDataFrame([(d,) for d in docs], "text string"))
    padded = [["<s>", "<s>", *d.split(), "</s>"] for d in docs]
    three = {g for w in padded for g in zip(w, w[1:], w[2:])}
    pairs, single = {g[1:] for g in three} | {g[:-1] for g in three}, {w for g in three for w in g}
    rows = model.entries.collect()
    assert model.shards > 3 and len(rows) <= 3 * model.shards
    keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
    assert all((x[1:] > x[:-1]).all() for x in keys)
    assert sum(map(len, keys)) == len(three) + len(pairs) + len(single)
    assert all(set(k._shard(x, model.shards)) == {r.shard} for x, r in zip(keys, rows))


def test_model_goes_when_texts_are_scored(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "plumbline"
    before = set(folder.glob("*"))
    df = spark.createDataFrame([(i, f"a b c w{i % 5} w{i % 7}", "en") for i in range(40)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    assert k.quality_classifier(df, labels).count() == 40
    assert {p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - before} == {"trusted", "scored", "limits"}


def test_model_is_narrow_and_turns_change_nothing(spark, monkeypatch):
    """Entries take a few bytes beside their keys, counts beyond a byte included; middle words may take turns."""
    monkeypatch.setattr(k, "SHARD", 400)
    rng = random.Random(19)
    docs = [prose(rng, ["w%d" % i for i in range(60)], 40) for _ in range(40)] + ["often said"] * 300
    rows = spark.createDataFrame([(d,) for d in docs], "text string")

    def entries(turns):
        monkeypatch.setattr(k, "TURNS", turns)
        return {(r.kind, r.shard): r for r in k.train(rows).entries.collect()}

    got = entries(3)
    assert got == entries(1) and sum(r.tally[5] for (kind, _), r in got.items() if kind == 3) == 40 * 41 + 300 * 3
    size = sum(len(r[name]) for r in got.values() for name in k.VALUES)
    assert size < 6 * sum(len(r["keys"]) // 8 for r in got.values())
    values = np.array([0, 1, 254, 255, 256, 1 << 40, 0])
    assert (k._wide(k._narrow(values), len(values)) == values).all() and k._narrow(values * 0) == b""
    keys = np.sort(np.array([rng.getrandbits(64) for _ in range(500)], np.uint64))
    assert (k._from_planes(k._planes(keys)) == keys).all()
    near = np.repeat(np.array([5, 4, 5, 3], np.uint64), 200)
    assert (near[k._order(near)] == np.sort(near)).all() and (np.sort(k._order(near)) == np.arange(800)).all()


def test_pieces_go_when_the_model_is_made(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "plumbline"
    before = set(folder.glob("*"))
    model = k.train(spark.createDataFrame([("a b c a b d",), ("b c d",)], "text string"))
    assert {p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - before} == {"entries"}
    assert model.entries.count() == 3
