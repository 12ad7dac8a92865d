import itertools
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest

from plumbline.llm import lattice as m

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lattice():
    with open(PATH, "rb") as file:
        return m.Lattice(file.read())


def all_paths(lattice, word):
    """Sum over every way to cut the word, by enumeration."""
    text = m._SPACE + word
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        parts, start = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                parts.append(text[start:i])
                start = i
        parts.append(text[start:])
        p = math.exp(lattice.end)
        for part in parts:
            arc = math.exp(lattice.logs[part]) if part in lattice.logs else 0.0
            if len(part) == 1:
                arc += math.exp(lattice.byte * len(part.encode()))
            p *= arc
        total += p
    return math.log(total)


def test_sum_over_segmentations(lattice):
    for word in ("", "a", "the", "thention", "érß", "x9!", "漢字", "😀", "inginging"):
        assert math.isclose(lattice.log_probability(word), all_paths(lattice, word), rel_tol=1e-9), word


def test_long_word(lattice):
    assert -1e7 < lattice.log_probability("thing" * 20_000) < -1e5


def test_rows(spark, lattice, monkeypatch):
    monkeypatch.setattr(m, "SLICE_BYTES", 300)
    rng = random.Random(14)
    vocabulary = ["the", "The", "thing", "é", "ing,", "rare%d"]
    rows = [(i, " ".join(rng.choice(vocabulary).replace("%d", str(rng.randint(0, 99))) for _ in range(rng.randint(0, 40))), 5) for i in range(60)]
    rows += [(100, None, 5), (101, "\x0b\n", 5), (None, "the", 5), (3, "again the", 5), (102, "ÀB a" * 3000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = m.lattice_scores(df, PATH).collect()

    def tokens(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w] + [""]

    def held(key):
        return zlib.crc32(("" if key is None else str(key)).encode()) % 10 == 0

    counts = Counter(t for k, x, _ in rows if not held(k) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    unseen = sum(c == 1 for c in counts.values()) / n
    want = []
    for key, text, _ in rows:
        mine = tokens(text)
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in mine)
        full = sum(math.log10((1 - unseen) * counts[t] / n + unseen * math.exp(lattice.log_probability(t))) if len(t) < 100 else math.log10((1 - unseen) * counts[t] / n) for t in mine)
        want.append((str(key), held(key), len(mine), sum(counts[t] > 0 for t in mine), n, base, full))
    for a, b in zip(sorted((str(r.doc_id), *r[1:]) for r in got), sorted(want), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9), (a, b)
    assert m.lattice_scores(df.limit(0), PATH).count() == 0
    only = m.lattice_scores(df.filter("doc_id is null"), PATH).first()
    assert only.base_score is None and only.score < 0 and only.train_tokens == 0
