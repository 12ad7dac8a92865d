"""Personal data in plain and disguised form, with spans in source characters.

Plain identifiers (e-mail, IP, card, phone) are found in the text as it is. Disguised
ones are found on a normalised tape: transducers rewrite look-alike characters, spelled
digits and at/dot disguises, and every character of the tape remembers the source span
it came from. Identifiers found on the tape map back through these spans; those inside
a plain span of the same kind are dropped, the others are added.

Null text counts as empty: no spans. Repeated rows give repeated results; other columns
are ignored. Text length is not limited, all patterns are linear. Spans are code
points, the end is exclusive; ties are ordered by start, then kind as listed in KINDS.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import slices, texts

KINDS = ("email", "ip", "card", "phone")
ORDER = {kind: i for i, kind in enumerate(KINDS)}
Span = tuple[int, int, str]

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]++\Z")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[Span]:
    floor = 0
    for match in _DOMAIN.finditer(text):
        start = match.start()
        while start > floor and text[start - 1] in _LOCAL_SET:
            start -= 1
        if start < match.start():
            yield start, match.end(), "email"
            floor = match.end()


def _ips(text: str) -> Iterator[Span]:
    for match in _IP.finditer(text):
        parts = [p.lstrip("0") for p in match[0].split(".")]
        if all(len(p) < 4 and int(p or 0) < 256 for p in parts):
            yield match.start(), match.end(), "ip"


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(found: str) -> str:
    return "".join(c for c in found if "0" <= c <= "9")


def _cards(text: str) -> Iterator[Span]:
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 14 and 14 <= len(digits := _digits(match[0])) <= 19 and luhn(digits):
            yield match.start(), match.end(), "card"


def _phones(text: str) -> Iterator[Span]:
    for match in _PHONE.finditer(text):
        if 10 <= len(_digits(match[0])) <= 15:
            yield match.start(), match.end(), "phone"


def identifiers(text: str) -> list[Span]:
    """Plain identifiers: leftmost, non-overlapping per kind."""
    found: list[Span] = []
    if "@" in text:
        found += _emails(text)
    if "+" in text:
        found += _phones(text)
    found += _cards(text)
    if "." in text:
        found += _ips(text)
    return sorted(found, key=lambda s: (s[0], ORDER[s[2]]))


# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ё": "e", "ї": "i",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ℓ": "l", "ⅼ": "l", "ո": "n", "օ": "o", "ս": "u", "ց": "g",
    "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-",
    " ": " ", " ": " ", " ": " ", " ": " ", "　": " ",
    "­": "", "​": "", "‌": "", "‍": "", "⁠": "", "﻿": "", "᠎": "",
}

# Digits as words in the four languages of the corpus.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "null": "0", "zéro": "0", "cero": "0",
    "one": "1", "un": "1", "une": "1", "uno": "1", "una": "1", "eins": "1", "ein": "1",
    "two": "2", "deux": "2", "dos": "2", "zwei": "2", "zwo": "2",
    "three": "3", "trois": "3", "tres": "3", "drei": "3",
    "four": "4", "quatre": "4", "cuatro": "4", "vier": "4",
    "five": "5", "cinq": "5", "cinco": "5", "fünf": "5",
    "six": "6", "seis": "6", "sechs": "6",
    "seven": "7", "sept": "7", "siete": "7", "sieben": "7",
    "eight": "8", "huit": "8", "ocho": "8", "acht": "8",
    "nine": "9", "neuf": "9", "nueve": "9", "neun": "9",
}


def _plain(char: str) -> str | None:
    """ASCII reading of one character, or None if it has none."""
    if char in LOOK_ALIKES:
        return LOOK_ALIKES[char]
    if unicodedata.category(char) == "Nd":
        return str(unicodedata.decimal(char))
    folded = unicodedata.normalize("NFKC", char)
    return folded if len(folded) == 1 and folded.isascii() else LOOK_ALIKES.get(folded) if len(folded) == 1 else None


_READINGS: dict[str, str | None] = {}


def _reading(char: str) -> str | None:
    if char not in _READINGS:
        if len(_READINGS) > 200_000:
            _READINGS.clear()
        _READINGS[char] = _plain(char)
    return _READINGS[char]


class Tape:
    """Text under rewriting; every character knows the source span it stands for."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts = list(range(len(text)))
        self.ends = list(range(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace spans of the tape (in order, not overlapping) by other text."""
        if not edits:
            return
        parts, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            parts += self.text[at:a], new
            starts += self.starts[at:a] + [self.starts[a]] * len(new)
            ends += self.ends[at:a] + [self.ends[b - 1]] * len(new)
            at = b
        self.text = "".join([*parts, self.text[at:]])
        self.starts, self.ends = starts + self.starts[at:], ends + self.ends[at:]

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]


def fold_characters(tape: Tape) -> None:
    """Look-alikes, full-width forms and foreign digits become ASCII; invisible ones vanish."""
    edits = []
    for i, char in enumerate(tape.text):
        if char > "\x7f" and (new := _reading(char)) is not None:
            edits.append((i, i + 1, new))
    tape.rewrite(edits)


_WORD = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_EDGE = r"(?<![^\W_])", r"(?![^\W_])"
_UNIT = rf"(?:{_EDGE[0]}{_WORD}{_EDGE[1]}|[0-9])"
_SPELLED = re.compile(rf"{_UNIT}(?:(?:\s*+[,.\-]{{0,2}}+\s*+|\s++(?:dot|point|punkt|punto)\s++){_UNIT})+", re.IGNORECASE)
_SPELLED_WORD = re.compile(rf"{_EDGE[0]}{_WORD}{_EDGE[1]}", re.IGNORECASE)
_PLUS = re.compile(r"(?<![^\W_])(?:plus|más|mas)\s++(?=\(?[0-9])", re.IGNORECASE)
_PLUS_WORDS = frozenset(("plus", "más", "mas"))
_PLUS_BEFORE = re.compile(r"(?:\+|(?<![^\W_])(?:plus|más|mas)\s{1,3})\(?\Z", re.IGNORECASE)
_WIDE = re.compile(r"\s{2,}|[^\S ]")
_DIGIT_DOT = re.compile(r"(?<=[0-9])\s{1,3}(?:dot|point|punkt|punto)\s{1,3}(?=[0-9])", re.IGNORECASE)
SPELLED_AT_LEAST = 3


def _as_digits(text: str, start: int, end: int, spelled: list[re.Match]) -> list[tuple[int, int, str]]:
    """Edits that make digits of a run's spelled ones: blanks between those go, others become one space."""
    edits: list[tuple[int, int, str]] = []
    for word, after in zip(spelled, [*spelled[1:], None]):
        close = after and not re.sub(r"[\s,\-]", "", text[word.end() : after.start()])
        edits.append((word.start(), after.start() if close else word.end(), DIGIT_WORDS[word[0].lower().replace("\u0307", "")]))
    taken = [(a, b) for a, b, _ in edits]
    wide = [(m.start(), m.end(), " ") for m in _WIDE.finditer(text, start, end)]
    return sorted([*edits, *(w for w in wide if not any(a < w[1] and w[0] < b for a, b in taken))])


def _completed(text: str, start: int, end: int, spelled: list[re.Match]) -> list[tuple[int, int, str]]:
    """The edits if they give an identifier that the run does not hold as it is, else none."""
    plus = "+" if _PLUS_BEFORE.search(text, max(0, start - 12), start) else ""
    kinds = {kind for _, _, kind in identifiers(plus + text[start:end])}
    for chosen in (spelled, spelled[:1], spelled[-1:]):
        edits, parts, at = _as_digits(text, start, end, chosen), [plus], start
        for a, b, new in edits:
            parts += text[at:a], new
            at = b
        found = "".join([*parts, text[at:end]])
        found = _DIGIT_DOT.sub(".", found)
        if any(kind not in kinds for _, _, kind in identifiers(found)):
            return edits
    return []


def read_digits(tape: Tape) -> None:
    """Runs with at least three spelled digits become digits, others if that completes an identifier."""
    edits: list[tuple[int, int, str]] = []
    for run in _SPELLED.finditer(tape.text):
        spelled = list(_SPELLED_WORD.finditer(tape.text, run.start(), run.end()))
        if len(spelled) >= SPELLED_AT_LEAST:
            edits += _as_digits(tape.text, run.start(), run.end(), spelled)
        elif spelled:
            edits += _completed(tape.text, run.start(), run.end(), spelled)
    tape.rewrite(edits)
    tape.rewrite([(m.start(), m.end(), "+") for m in _PLUS.finditer(tape.text)])
    tape.rewrite([(m.start(), m.end(), ".") for m in _DIGIT_DOT.finditer(tape.text)])


_ENTITY = re.compile(r"&(?:#[0-9]{2,7}|#[xX][0-9A-Fa-f]{2,6}|commat|period|plus|nbsp|hyphen|lowbar|num);")


def read_entities(tape: Tape) -> None:
    """Character references of signs, letters and digits become the characters themselves."""
    found = [(m.start(), m.end(), html.unescape(m[0])) for m in _ENTITY.finditer(tape.text)]
    tape.rewrite([edit for edit in found if len(edit[2]) == 1])


# Digits with letters among them that look like digits, in a run as long as a card number.
_MIXED = re.compile(r"[0-9](?<![^\W_][0-9])(?:[ -]?[0-9lIOo]){13,18}(?![^\W_])")
_AS_DIGIT = str.maketrans("lIOo", "1100")


def read_mixed(tape: Tape) -> None:
    """Letters in a run of digits become digits if that makes a card number of it."""
    edits = []
    for run in _MIXED.finditer(tape.text):
        letters = [i for i in range(run.start(), run.end()) if tape.text[i] in "lIOo"]
        if letters and 4 * len(letters) <= len(run[0]) and any(_cards(run[0].translate(_AS_DIGIT))):
            edits += [(i, i + 1, tape.text[i].translate(_AS_DIGIT)) for i in letters]
    tape.rewrite(edits)


_AT_WORD, _DOT_WORD = "(?:at|arroba|arobase|chez|ät|@)", r"(?:dot|point|punkt|punto|\.)"
_OPEN, _CLOSE = r"\s{0,3}[\[({<]\s{0,2}", r"\s{0,2}[\])}>]\s{0,3}"
_LEFT, _RIGHT = r"(?<=[A-Za-z0-9])", r"(?=[A-Za-z0-9])"
_JOINT = rf"(?:{_OPEN}{_DOT_WORD}{_CLOSE}|\s{{1,3}}(?:dot|point|punkt|punto)\s{{1,3}}|\s{{0,2}}[_*-]{{1,2}}(?:dot|punkt|punto)[_*-]{{1,2}}\s{{0,2}})"
_DOT = re.compile(f"{_LEFT}{_JOINT}{_RIGHT}", re.IGNORECASE)
_FRAMED_AT = re.compile(
    rf"{_LEFT}(?:{_OPEN}{_AT_WORD}{_CLOSE}|[_*-]{{1,2}}at[_*-]{{1,2}}|\s{{1,2}}@\s{{0,2}}|@\s{{1,2}}){_RIGHT}", re.IGNORECASE
)
# Last parts of names after which a bare "at" is believed.
_ENDINGS = "com|org|net|edu|gov|mil|int|info|biz|name|io|co|ai|app|dev|eu|uk|us|de|fr|es|it|nl|ch|at|be|mx|ar|ca|au|example|test"
_NAME = r"[A-Za-z0-9-]+"
_BARE_AT = re.compile(
    rf"{_LEFT}\s{{1,3}}(?:at|arroba|arobase)\s{{1,3}}(?={_NAME}(?P<rest>(?:(?:{_JOINT}|\.){_NAME})*?(?:{_JOINT}|\.)(?:{_ENDINGS}))(?![A-Za-z0-9-]))",
    re.IGNORECASE,
)
# Any other ending, where its dot is disguised.
_BARE_AT_ANY = re.compile(
    rf"{_LEFT}\s{{1,3}}(?P<at>at|arroba|arobase)\s{{1,3}}(?={_NAME}(?:(?:{_JOINT}|\.){_NAME})*?{_JOINT}[A-Za-z]{{2,}}(?![A-Za-z0-9-]))",
    re.IGNORECASE,
)
_TOKEN_LEFT = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")


def _mailbox_before(match: re.Match) -> bool:
    left = _TOKEN_LEFT.search(match.string, max(0, match.start() - 64), match.start())
    return left is not None and re.search(r"[0-9._]", left[0]) is not None


def _believed(match: re.Match) -> bool:
    """Either the name's dots are disguised as well, or what stands before looks like a mailbox."""
    return _DOT.search(match["rest"].join("xx")) is not None or _mailbox_before(match)


def _believed_any(match: re.Match) -> bool:
    """A bare "at" with any ending is also plain English ("look at one point in time"), so a mailbox must stand before."""
    return match["at"].lower() != "at" or _mailbox_before(match)


def join_addresses(tape: Tape) -> None:
    """At and dot disguises become ``@`` and ``.``."""
    tape.rewrite([(m.start(), m.end(), "@") for m in _BARE_AT.finditer(tape.text) if _believed(m)])
    tape.rewrite([(m.start(), m.end(), "@") for m in _BARE_AT_ANY.finditer(tape.text) if _believed_any(m)])
    for pattern, new in ((_FRAMED_AT, "@"), (_DOT, ".")):
        tape.rewrite([(m.start(), m.end(), new) for m in pattern.finditer(tape.text)])


_LETTERS = re.compile(r"[a-zà-ÿ]+")
_CLOSED = re.compile(r"[\[({<]\s{0,2}(?:at|arroba|arobase|chez|ät|@|\.)\s{0,2}[\])}>]|[_*-]at[_*-]|\s@|@\s", re.IGNORECASE)
_DOT_WORDS = frozenset(("dot", "point", "punkt", "punto", "arroba", "arobase"))


def _words_of(text: str) -> set[str]:
    return set(_LETTERS.findall(text.lower().replace("\u0307", "")))


def normalised(text: str, always: bool = False) -> Tape | None:
    """The rewritten tape, or None if nothing in the text calls for a transducer.

    A transducer is left out only where none of its rules can apply to the tape as it stands
    then: each rule needs a word or a sign that is looked for first. ``always`` runs them all.
    """
    tape: Tape | None = None
    now = text
    if always or "&" in text and _ENTITY.search(text):
        tape = Tape(text)
        read_entities(tape)
        now = tape.text
    if always or not now.isascii() and any(_reading(c) is not None for c in set(now) if c > "\x7f"):
        tape = tape or Tape(text)
        fold_characters(tape)
        now = tape.text
    names = _words_of(now)
    digits = not names.isdisjoint(DIGIT_WORDS) or not names.isdisjoint(_PLUS_WORDS)
    if always or digits or not names.isdisjoint(_DOT_WORDS) and _DIGIT_DOT.search(now):
        tape = tape or Tape(text)
        read_digits(tape)
        now = tape.text
    if always or _MIXED.search(now):
        tape = tape or Tape(text)
        read_mixed(tape)
        now = tape.text
    bare = "at" in names and (_BARE_AT.search(now) or _BARE_AT_ANY.search(now))
    if always or bare or not names.isdisjoint(_DOT_WORDS) or _CLOSED.search(now):
        tape = tape or Tape(text)
        join_addresses(tape)
    return tape


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans and added spans of one text."""
    base = identifiers(text)
    tape = normalised(text)
    if tape is None:
        return base, []
    by_kind: dict[str, list[Span]] = {}
    for span in base:
        by_kind.setdefault(span[2], []).append(span)
    added = set()
    for start, end, kind in identifiers(tape.text):
        a, b = tape.source(start, end)
        if not any(x <= a and b <= y for x, y, _ in by_kind.get(kind, ())):
            added.add((a, b, kind))
    return base, sorted(added, key=_place)


def _place(span: Span) -> tuple[int, int, int]:
    return span[0], ORDER[span[2]], span[1]


def redact(text: str) -> str:
    """The text with every found span (overlapping ones as one) replaced by its kind."""
    base, added = find(text)
    parts, at = [], 0
    for start, end, kind in sorted([*base, *added], key=_place):
        if start >= at:
            parts += text[at:start], f"[{kind.upper()}]"
        at = max(at, end)
    return "".join([*parts, text[at:]])


def find_pii(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, spans): structs (start, end, kind, plain) of every whole text."""
    item = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("plain", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for value in batch.column("text"):
                base, added = find(value.as_py())
                spans = [(*s, True) for s in base] + [(*s, False) for s in added]
                spans.sort(key=lambda s: _place(s[:3]))
                rows.append([dict(zip(("start", "end", "kind", "plain"), s)) for s in spans])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(item))], ["doc_id", "spans"])

    schema = "doc_id bigint, spans array<struct<start:int,end:int,kind:string,plain:boolean>>"
    return texts(df, key, text).mapInArrow(run, schema)


def _redacted(text: pd.Series) -> pd.Series:
    return text.map(redact)


def redacted(text: Column) -> Column:
    """Text column without personal data; null stays null."""
    return F.when(text.isNotNull(), F.pandas_udf(_redacted, T.StringType())(F.coalesce(text, F.lit(""))))


def pii_report(found: DataFrame) -> DataFrame:
    """Counts and digest of the plain spans and a list of all spans, per row of ``find_pii``."""

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["plain"] & (s["kind"] == kind))).cast("bigint")

    plain = F.filter("spans", lambda s: s["plain"])
    counts = [number(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(plain), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(plain)).cast("bigint").alias("n_added"),
    )
