import random
import re

import pytest

from plumbline.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_pattern(text):
    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), m.end(), kind))
    return sorted(found, key=lambda s: (s[0], list(BASE).index(s[2])))


def test_base_equals_patterns():
    rng = random.Random(3)
    parts = ["a", "b.c", "@", "@x.y", "1", "25", "256", ".", "+1", " ", "-", "(", ")", "4242", "4111111111111111", "\n", "é", "x@y", "..", "%", "0001", "999-555"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert pii.identifiers(text) == by_pattern(text), text


@pytest.mark.parametrize(
    "text, source, kind",
    [
        ("write to john dot doe at example dot com today", "john dot doe at example dot com", "email"),
        ("mail jane[at]mail [dot] example.org!", "jane[at]mail [dot] example.org", "email"),
        ("mail jane (at) example.org", "jane (at) example.org", "email"),
        ("mail jane@exаmple.com now", "jane@exаmple.com", "email"),
        ("x ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ y", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email"),
        ("host one nine two dot one six eight dot zero dot one up", "one nine two dot one six eight dot zero dot one", "ip"),
        ("card four one one one 1111 1111 one one one one ok", "four one one one 1111 1111 one one one one", "card"),
        ("call plus one four one five five five five two six seven one now", "plus one four one five five five five two six seven one", "phone"),
        ("call +１ (４１５) 555-２６７１ now", "+１ (４１５) 555-２６７１", "phone"),
        ("é +1 415 555​2671", "+1 415 555​2671", "phone"),
        ("ruf plus vier neun drei null eins zwei drei vier fünf sechs", "plus vier neun drei null eins zwei drei vier fünf sechs", "phone"),
        ("visa 4111–1111–1111–1111 end", "4111–1111–1111–1111", "card"),
        ("john @ example.com", "john @ example.com", "email"),
        ("ask rob.42 at mail8.example.com now", "rob.42 at mail8.example.com", "email"),
        ("ana arroba correo punto example punto es", "ana arroba correo punto example punto es", "email"),
    ],
)
def test_disguises(text, source, kind):
    base, added = pii.find(text)
    assert any(text[a:b] == source and k == kind for a, b, k in added), (base, added)
    assert source not in pii.redact(text) and f"[{kind.upper()}]" in pii.redact(text)


@pytest.mark.parametrize("text", ["", "meet at the dot on the map", "un deux trois nous irons", "look at this. Then go", "price 12 un 14", "é à ü ñ ß", "look at one point in time", "visit us at example.com", "look (at) that", "A six one B"])
def test_plain_text_stays(text):
    assert pii.find(text) == ([], []) and pii.redact(text) == text


def test_long_text():
    assert pii.find("a" * 300_000 + "1" * 300_000 + "." * 1000) == ([], [])
    assert pii.find("+" + "1 " * 200_000) == ([], [])


def test_rows(spark):
    rows = [(1, "a@b.co and a[at]b.co", "x"), (2, None, "y"), (3, "", None), (1, "a@b.co and a[at]b.co", "x"), (None, "ip 1.2.3.4", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.pii_report(pii.find_pii(df)).collect()}
    assert got[1].spans == "email:0:6,email:11:20" and (got[1].n_email, got[1].n_added) == (1, 1)
    assert got[2].spans == got[3].spans == "" and got[None].n_ip == 1
    assert pii.find_pii(df).count() == 5 and pii.find_pii(df.limit(0)).count() == 0
    texts = [r.t for r in df.select(pii.redacted(df.text).alias("t")).collect()]
    assert texts[0] == "[EMAIL] and [EMAIL]" and texts[1] is None and texts[2] == ""


@pytest.mark.parametrize(
    "text, source, kind",
    [
        ("call plus 49 30 1234567 now", "plus 49 30 1234567", "phone"),
        ("call +49 30 12345 six now", "+49 30 12345 six", "phone"),
        ("card 4111 1111 1111 111 one ok", "4111 1111 1111 111 one", "card"),
        ("card 4111 1111 1111 11 one one ok", "4111 1111 1111 11 one one", "card"),
        ("card 4111 1111 1111 111 one, two apples", "4111 1111 1111 111 one", "card"),
        ("tarjeta un 4242 ok, una 4111 1111 1111 111 un", "4111 1111 1111 111 un", "card"),
        ("host 192.168.0.one up", "192.168.0.one", "ip"),
        ("card four\none\tone   one\n1111 1111 1111 ok", "four\none\tone   one\n1111 1111 1111", "card"),
        ("write ana_k at firma dot pl now", "ana_k at firma dot pl", "email"),
        ("ana arroba firma punto jp", "ana arroba firma punto jp", "email"),
        ("write ana_k at firma[.]se now", "ana_k at firma[.]se", "email"),
    ],
)
def test_disguises_without_other_signs(text, source, kind):
    base, added = pii.find(text)
    assert any(text[a:b] == source and k == kind for a, b, k in added), (base, added)


@pytest.mark.parametrize("text", ["plus 3 more", "call +49 30 1234567 one more time", "one\n\n2019\n\ntwo", "we met at noon dot by dot"])
def test_no_new_reading(text):
    base, added = pii.find(text)
    assert not added


def test_long_blanks():
    assert pii.find("one 1" + " " * 300_000 + "x" + "1 \n" * 100_000 + " six") == ([], [])


@pytest.mark.parametrize(
    "text, source, kind",
    [
        ("john@example[.]com", "john@example[.]com", "email"),
        ("192[.]168[.]0[.]1", "192[.]168[.]0[.]1", "ip"),
        ("john&#64;example.com", "john&#64;example.com", "email"),
        ("john&commat;example&#x2e;com", "john&commat;example&#x2e;com", "email"),
        ("card 4l11 1111 1111 1111 ok", "4l11 1111 1111 1111", "card"),
        ("card 4111 11ll 1111 11I1", "4111 11ll 1111 11I1", "card"),
    ],
)
def test_found_alone(text, source, kind):
    base, added = pii.find(text)
    assert [(text[a:b], k) for a, b, k in added] == [(source, kind)], (base, added)


DISGUISED = [
    "john", "rob_1", "@", " at ", "[at]", "(at)", " AT ", "_at_", " @ ", "example", "firma", ".", "[.]", " (.) ", " dot ", "_dot_", " punto ",
    "com", "pl", "192", "168", "0", "one", "ΟΝΕ", "four", "SİX", "fünf", "plus ", "+", " ", " ", "\n", "-", "4111", "4l11", "1111", "&#64;",
    "&#49;", "а", "е", "４", "\u200b", " arroba ", "ät", "point", "e",
]


def test_gate_never_decides():
    """All transducers, or only those whose words and signs occur: the same tape."""
    rng = random.Random(11)
    for _ in range(20_000):
        text = "".join(rng.choice(DISGUISED) for _ in range(rng.randint(1, 14)))
        tape, every = pii.normalised(text), pii.normalised(text, always=True)
        assert every.text == (tape.text if tape else text), text
        if tape:
            assert (tape.starts, tape.ends) == (every.starts, every.ends), text


def test_unrelated_text_changes_nothing():
    rng = random.Random(12)
    tails = ["good point", "three apples", "look at this", "Добрый день", "plus a dot", "R&#38;D"]
    for _ in range(5_000):
        text = "".join(rng.choice(DISGUISED) for _ in range(rng.randint(1, 12))) + " end"
        assert pii.find(text + " ;;\n;; and " + rng.choice(tails)) == pii.find(text), text
