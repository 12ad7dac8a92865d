import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import url_filter

WORD = rb"[a-z0-9\x80-\xff]"


def brute(urls, terms):
    found = set()
    for i, url in enumerate(urls):
        for j, term in enumerate(terms):
            if re.search(rb"(?<!" + WORD + rb")" + re.escape(term.encode()) + rb"(?!" + WORD + rb")", url.lower()):
                found.add((i, j))
    return found


def hits(urls, terms):
    machine = url_filter.automaton(terms, [])
    return {(int(u), int(t)) for u, t in zip(*url_filter.term_hits(machine, urls))}


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.text("ab-./\x00é", max_size=40).map(str.encode), max_size=6),
    st.lists(st.text("ab-", min_size=1, max_size=4), min_size=1, max_size=6, unique=True).map(sorted),
)
def test_automaton_equals_search(urls, terms):
    assert hits(urls, terms) == brute(urls, terms)


def test_stretches_lose_nothing(monkeypatch):
    rng = np.random.default_rng(13)
    urls = [bytes(rng.choice(list(b"abc./-"), n)) for n in (0, 1, 7, 8, 9, 50, 400, 3000)]
    terms = ["a", "ab", "abc", "b-a", "c.a.b", "bcab"]
    for size in (1, 2, 7, 64, 256):
        monkeypatch.setattr(url_filter, "STRETCH", size)
        assert hits(urls, terms) == brute(urls, terms)


def test_vocabulary_has_a_bound(monkeypatch):
    monkeypatch.setattr(url_filter, "MOST_STATES", 5)
    with pytest.raises(ValueError):
        url_filter.automaton(["abcdef"], [])


CASES = [
    # url, host, path, rule, verdict
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("no scheme casino", "", "", None, "block"),
    ("http://A.Example.NET/en/x?casino#y", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://example.net/EN/x", "example.net", "/EN/x", "net/", "block"),
    ("http://example.net", "example.net", "", None, "allow"),
    ("http://net/?q", "net", "/", "net/", "block"),
    ("http://planet/", "planet", "/", None, "allow"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
    ("http://m.example.com/de/1", "m.example.com", "/de/1", "example.com/de/", "block"),
    ("http://x.org/fr/casino", "x.org", "/fr/casino", "org/fr/", "allow"),
    ("x://h.io?a=/b#c://d", "h.io", "", None, "allow"),
    ("http://h.io#/de/", "h.io", "", None, "allow"),
    ("http://casino.io/", "casino.io", "/", None, "block"),
    ("http://casinoland.io/", "casinoland.io", "/", None, "allow"),
    ("http://écasino.io/", "écasino.io", "/", None, "allow"),
    ("http://h.io/c%61sino", "h.io", "/c%61sino", None, "block"),
    ("http://h.io/%ff%zz%", "h.io", "/%ff%zz%", None, "allow"),
    ("http://free.io/", "free.io", "/", None, "allow"),
    ("http://free.io/free/free", "free.io", "/free/free", None, "allow"),
    ("http://free.io/BETS", "free.io", "/BETS", None, "block"),
    ("http://h.io/" + "x" * 300_000 + "/casino", "h.io", "/" + "x" * 300_000 + "/casino", None, "block"),
    ("http://" + "a." * 50_000 + "org/fr/", "a." * 50_000 + "org", "/fr/", "org/fr/", "allow"),
    ("http://line\nbreak.net/a\nb", "line\nbreak.net", "/a\nb", "net/", "block"),
]


def test_cases(spark):
    rows = [(i, c[0], "x", "y") for i, c in enumerate(CASES)] + [(None, "http://h.io/", None, None), (0, None, "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = url_filter.url_verdicts(pages).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: tuple(r)[1:5] for r in got}
    for i, case in enumerate(CASES):
        assert by_id[i] == case[1:], case[0]
    assert by_id[None] == ("h.io", "/", None, "allow")
    empty = url_filter.url_verdicts(pages.limit(0))
    assert empty.count() == 0 and empty.dtypes[0] == ("page_id", "bigint")


def test_longest_rule_wins_whatever_the_order(spark):
    pages = spark.createDataFrame([(1, "h://a.b.c/p/q"), (2, "h://b.c/p"), (3, "h://c/")], "page_id long, url string")
    rules = [("c", "/p", "block"), ("b.c", "/", "allow"), ("a.b.c", "/p/", "block"), ("c", "", "block")]
    for order in (rules, rules[::-1]):
        got = {r["page_id"]: r["rule"] for r in url_filter.url_verdicts(pages, rules=order).collect()}
        assert got == {1: "a.b.c/p/", 2: "b.c/", 3: "c"}
    assert {r["rule"] for r in url_filter.url_verdicts(pages, rules=()).collect()} == {None}


