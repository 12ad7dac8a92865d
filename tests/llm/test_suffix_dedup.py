import collections
import hashlib
import random
from pathlib import Path

import numpy as np
import pytest

from plumbline.llm import suffix_dedup as s


def brute(docs, length):
    data = [(t or "").encode() for t in docs]
    seen = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        covered = np.zeros(len(d) + 1, np.int8)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                covered[i : i + length] = 1
        runs = int((np.diff(np.concatenate([[0], covered])) == 1).sum())
        kept = bytes(b for b, c in zip(d, covered) if not c)
        out.append((len(d), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_sort_equals_plain_sort():
    rng = np.random.default_rng(16)
    for symbols, length in ((1, 8), (2, 20), (4, 200)):
        data = rng.integers(97, 97 + symbols, 3000).astype(np.uint8)
        start = np.concatenate([rng.integers(0, 3000 - length, n) for n in (1, 2, 3, 700)])
        segment = np.repeat(np.arange(4), (1, 2, 3, 700))
        order = s.SuffixSort(data, length).sort(start, segment)
        raw = data.tobytes()
        want = sorted(range(len(start)), key=lambda i: (segment[i], raw[start[i] : start[i] + length], i))
        assert order.tolist() == want


def test_anchor_depends_on_window_only():
    rng = random.Random(17)
    docs = [bytes(rng.choice(b"ab c") for _ in range(rng.randint(0, 300))) for _ in range(20)]
    owner, first, runs, place, value = s.anchors(docs, 50, 10)
    at = {}
    for o, f, r, p, v in zip(owner, first, runs, place, value):
        for w in range(f, f + r):
            assert w <= p <= w + 40
            at[(o, w)] = (p - w, v)
    assert len(at) == sum(max(0, len(d) - 49) for d in docs)
    for (o, w), found in list(at.items())[:300]:
        assert s.anchors([docs[o][w : w + 50]], 50, 10)[3][0] == found[0]


def test_shared_hashes_are_split_by_bytes(monkeypatch):
    """Two letters of one code: windows that differ in them alone share a hash and stay apart."""
    letters = s._LETTERS.copy()
    letters[ord("b")] = letters[ord("a")]
    monkeypatch.setattr(s, "_LETTERS", letters)
    rng = random.Random(18)
    data = [bytes(rng.choice(b"abc") for _ in range(3)) for _ in range(40)] + [b"aba", b"bab", b"aba"]
    entries = [(i % 2, 5, d, 1) for i, d in enumerate(data)]
    seen = collections.Counter((e[0], e[2]) for e in entries)
    got = [bool(mask[0]) for mask in s.repeated_windows(entries, 3)]
    assert got == [seen[(e[0], e[2])] > 1 for e in entries]
    assert not all(got) and any(got)


@pytest.mark.parametrize("length, anchor, seed", [(30, 8, 1), (200, 40, 2)])
def test_equals_brute_force(spark, monkeypatch, length, anchor, seed):
    monkeypatch.setattr(s, "SORT_BYTES", 4000)
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdéf") for _ in range(rng.randint(1, 6))) for _ in range(200)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    shared = [prose(n) for n in (8, 30, 60, 90)]
    docs = [prose(rng.randint(0, 150)) for _ in range(30)]
    docs += [prose(rng.randint(0, 40)) + rng.choice(shared) + prose(rng.randint(0, 40)) for _ in range(30)]
    for _ in range(10):
        words = docs[35].split(" ")
        words[rng.randrange(len(words))] = "edit"
        docs.append(" ".join(words))
    docs += ["", None, "x" * (length - 1), "y" * (length + 5), "ab" * length, docs[3], docs[3], shared[2] + "|" + shared[2], shared[3][:length], shared[3][: length - 1]]
    rows = [(i, t, "z") for i, t in enumerate(docs)] + [(3, docs[3], "z"), (None, docs[4], "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, data string")
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in s.repeats_report(s.find_repeats(df, length, anchor)).collect())
    want = sorted((-1 if r[0] is None else r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows], length)))
    assert got == want


def test_long_and_empty(spark):
    df = spark.createDataFrame([(1, "ab" * 100_000), (2, "q" + "ab" * 300)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in s.repeats_report(s.find_repeats(df)).collect()}
    assert got == {1: (200_000, 200_000, 1), 2: (601, 600, 1)}
    assert s.repeats_report(s.find_repeats(df.limit(0))).count() == 0


def test_only_spans_stay_on_disk(spark):
    """Surroundings and verdicts are deleted before the texts are shuffled for the last time."""
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "plumbline"
    before = set(folder.glob("*"))
    df = spark.createDataFrame([(i, "ab" * 150 + str(i)) for i in range(3)], "doc_id long, text string")
    assert s.repeats_report(s.find_repeats(df)).count() == 3
    assert {p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - before} == {"spans"}


def letters(rng, n):
    return "".join(rng.choice("abcdefgh") for _ in range(n))


@pytest.mark.parametrize("phrase, seed", [(20, 3), (33, 4), (90, 5)])
def test_large_groups_are_filed_again(spark, monkeypatch, phrase, seed):
    """One phrase in many texts, more of its surroundings than are sorted at once: the same result."""
    monkeypatch.setattr(s, "HOT", 8)
    rng = random.Random(seed)
    common = letters(rng, phrase)
    shared = [letters(rng, 25) + common + letters(rng, 25) for _ in range(3)]
    docs = [letters(rng, rng.randint(0, 40)) + rng.choice([common] * 4 + shared) + letters(rng, rng.randint(0, 40)) for _ in range(150)]
    docs += [shared[0] + common + shared[1], common * 3, docs[7], docs[7]]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = sorted(tuple(r) for r in s.repeats_report(s.find_repeats(df, 30, 8)).collect())
    assert got == [(i, *b) for i, b in enumerate(brute(docs, 30))]


def test_only_small_groups_are_sorted(spark, monkeypatch):
    """Entries of a group of more than HOT come back in halves, each half with all its windows."""
    monkeypatch.setattr(s, "HOT", 8)
    rng = random.Random(8)
    common = letters(rng, 10)
    rows = [(g, i, 20, 25, (letters(rng, 25) + common + letters(rng, 25)).encode(), 1) for g, n in ((1, 8), (2, 50), (3, 2)) for i in range(n)]
    columns = "anchor long, digest long, reach int, offset int, data binary, n long"
    got = s._judged(spark.createDataFrame(rows, columns), 30).filter("part is not null").collect()
    windows = sorted((r.digest, r["shift"] + i) for r in got for i in range(len(r.part_data) - 29))
    assert {r.anchor for r in got} == {2}
    assert windows == [(i, at) for i in range(50) for at in range(5, 26)]
    assert all(rows[8 + r.digest][4][r["shift"] :].startswith(r.part_data) for r in got)


def test_two_suffixes_are_sorted_for_each_entry(monkeypatch):
    """The windows of an entry are judged by what follows and what precedes its anchor, not sorted one by one."""
    rng = random.Random(9)
    entries = [(i % 5, 80, letters(rng, 80).encode() + b"x" * 40 + letters(rng, 160).encode(), 1) for i in range(50)]
    entries += [(g, o, d[:9] + b"!" + d[10:], n) for g, o, d, n in entries[:20]]
    seen = collections.Counter((e[0], e[1] - i, e[2][i : i + 200]) for e in entries for i in range(len(e[2]) - 199))
    sorted_, sort = [], s.SuffixSort.sort
    monkeypatch.setattr(s.SuffixSort, "sort", lambda self, start, segment: sorted_.append(len(start)) or sort(self, start, segment))
    masks = s.repeated_windows(entries, 200)
    assert sum(sorted_) <= 2 * len(entries)
    for (g, o, d, _), mask in zip(entries, masks):
        assert mask.tolist() == [seen[g, o - i, d[i : i + 200]] > 1 for i in range(len(d) - 199)]


def test_equal_texts_are_judged_once(spark):
    """Copies of a text go through the sort as one, and are removed whole; a repeat inside a copy counts elsewhere."""
    rng = random.Random(6)
    body = letters(rng, 400)
    docs = [body, body, "z" + body[100:320], "short", "short"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = sorted(tuple(r) for r in s.repeats_report(s.find_repeats(df)).collect())
    assert got == [(i, *b) for i, b in enumerate(brute(docs, 200))]
    assert [r[2] for r in got] == [400, 400, 220, 0, 0]
