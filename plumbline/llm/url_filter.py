"""URL filter: host and path rules first, then a weighted vocabulary found by Aho-Corasick.

The vocabulary has strict and soft terms. One automaton holds them all; a task walks the
URLs of a slice in lockstep through its transition table, a column of many stretches at a
time. A stretch starts early enough for the longest term, so cutting a long URL loses
nothing. A hit counts where no letter or digit touches the term. One strict term or
``several`` different soft ones reject a URL.

A rule is (host, path, verdict). It fits its host and all subdomains where the URL's path
starts with the rule's; the longest one (host and path together, then the longer host)
decides before the vocabulary does.

Null or empty URL, or one without ``://``: empty host and path; its text, if any, still
meets the vocabulary. Percent escapes are decoded for the vocabulary only. Characters
beyond ASCII count as letters. Repeated rows give repeated rows, an empty table an empty
one; other columns are ignored. Neither length nor number of URLs is limited; rules and
terms travel with the task and have the bounds below.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import lower_ascii, slices

# The rules of the contract and the vocabulary.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
STRICT = (
    "casino", "casinos", "escorts", "hentai", "jackpot", "malware", "phishing", "porn", "porno", "roulette", "viagra", "warez", "xxx",
)
SOFT = (
    "ads", "adult", "adserver", "banner", "bet", "bets", "betting", "bonus", "cheap", "cracked", "dating", "free", "keygen", "loans",
    "lottery", "lotto", "payday", "pharmacy", "pills", "poker", "popup", "sex", "slots", "torrent", "track", "tracker", "tracking", "win",
)
#: Different soft terms that reject a URL.
SEVERAL = 2
#: Bytes between the starts of two stretches; most states of an automaton and most rules.
STRETCH, MOST_STATES, MOST_RULES = 256, 100_000, 10_000

_WORD = np.zeros(256, bool)
_WORD[[*b"abcdefghijklmnopqrstuvwxyz0123456789", *range(128, 256)]] = True


@dataclass(frozen=True)
class Automaton:
    """Transitions by state and class of byte; a state's terms lie at ends[first[s]:first[s + 1]]."""

    classes: np.ndarray
    step: np.ndarray
    first: np.ndarray
    ends: np.ndarray
    lengths: np.ndarray
    strict: np.ndarray


def automaton(strict: Sequence[str], soft: Sequence[str]) -> Automaton:
    """Aho-Corasick automaton of both vocabularies; a term of both is strict."""
    kinds = {t.lower().encode(): False for t in soft} | {t.lower().encode(): True for t in strict}
    kinds.pop(b"", None)
    terms = sorted(kinds)
    alphabet = sorted(set(b"".join(terms)))
    classes = np.zeros(256, np.int32)
    classes[alphabet] = np.arange(1, len(alphabet) + 1)
    children, own = [{}], [[]]
    for number, term in enumerate(terms):
        at = 0
        for byte in term:
            if byte not in children[at]:
                children[at][byte] = len(children)
                children.append({})
                own.append([])
            at = children[at][byte]
        own[at].append(number)
        if len(children) > MOST_STATES:
            raise ValueError(f"the vocabulary needs more than {MOST_STATES} states")
    step = np.zeros((len(children), len(alphabet) + 1), np.int32)
    back, queue = [0] * len(children), deque([0])
    while queue:  # breadth first: the fall-back state is shorter, so it is finished
        at = queue.popleft()
        step[at] = step[back[at]] if at else 0
        for byte, child in children[at].items():
            back[child] = int(step[at, classes[byte]]) if at else 0
            own[child] += own[back[child]]
            step[at, classes[byte]] = child
            queue.append(child)
    first = np.concatenate([[0], np.cumsum([len(o) for o in own])])
    ends = np.array([t for o in own for t in o], np.int64)
    return Automaton(classes, step, first, ends, np.array([len(t) for t in terms], np.int64), np.array([kinds[t] for t in terms], bool))


def term_hits(found: Automaton, urls: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (URL number, term number), each once, of terms that stand alone in a URL."""
    if not len(found.lengths) or not urls:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.frombuffer(b"\0".join(urls).lower() + b"\0", np.uint8)
    reach = int(found.lengths.max())
    rows = -(-len(text) // STRETCH)
    padded = np.zeros(reach + rows * STRETCH, np.uint8)
    padded[reach : reach + len(text)] = text
    view = np.lib.stride_tricks.as_strided(padded, (rows, reach + STRETCH), (STRETCH, 1))
    columns = np.ascontiguousarray(found.classes[view].T)
    ending = found.first[1:] > found.first[:-1]
    state, places, states = np.zeros(rows, np.int32), [], []
    for c, column in enumerate(columns):
        state = found.step[state, column]
        if c >= reach and len(hit := np.flatnonzero(ending[state])):
            places.append(hit * STRETCH + (c - reach))
            states.append(state[hit])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, state = np.concatenate(places), np.concatenate(states)
    several = found.first[state + 1] - found.first[state]
    inside = np.arange(several.sum()) - np.repeat(np.cumsum(several) - several, several)
    term = found.ends[np.repeat(found.first[state], several) + inside]
    place = np.repeat(place, several) + reach
    alone = ~_WORD[padded[place - found.lengths[term]]] & ~_WORD[np.append(padded, 0)[place + 1]]
    starts = np.cumsum([0, *(len(u) + 1 for u in urls[:-1])])
    url = np.searchsorted(starts, place[alone] - reach, "right") - 1
    pairs = np.unique(url * len(found.lengths) + term[alone])
    return np.divmod(pairs, len(found.lengths))


def _counting(found: Automaton):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "url"):
            urls = [unquote_to_bytes(u) if "%" in u else u.encode("utf-8", "surrogatepass") for u in batch.column("url").to_pylist()]
            url, term = term_hits(found, urls)
            strict = np.bincount(url[found.strict[term]], minlength=len(urls))
            soft = np.bincount(url[~found.strict[term]], minlength=len(urls))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(strict, pa.int64()), pa.array(soft, pa.int64())],
                [*batch.schema.names, "n_strict", "n_soft"],
            )

    return count


def _parts(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*+", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*+", 0)
    return lower_ascii(host), path


def _rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct (size, host_size, name, verdict); null if none does."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    kind = "struct<size:int,host_size:int,name:string,path:string,verdict:string>"
    if not rules:
        return F.lit(None).cast(kind)
    by_host: dict[str, list[Column]] = {}
    for name, prefix, verdict in rules:
        name = name.lower()
        fields = {"size": len(name + prefix), "host_size": len(name), "name": name + prefix, "path": prefix, "verdict": verdict}
        by_host.setdefault(name, []).append(F.struct(*(F.lit(v).alias(k) for k, v in fields.items())))
    known = F.create_map(*(c for name, found in by_host.items() for c in (F.lit(name), F.array(*found))))
    longest = max(name.count(".") + 1 for name in by_host)
    ends = F.array_distinct(F.array(*(F.substring_index(host, ".", -n) for n in range(1, longest + 1))))
    fitting = F.flatten(F.filter(F.transform(ends, lambda e: F.try_element_at(known, e)), lambda f: f.isNotNull()))
    return F.array_max(F.filter(fitting, lambda r: F.startswith(path, r["path"])))


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    several: int = SEVERAL,
    key: str = "page_id",
) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, n_strict, n_soft) of every row of ``pages`` (key, url).

    The counts are those of different terms; they do not matter where a rule decides.
    """
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    counted = rows.mapInArrow(_counting(automaton(strict, soft)), "page_id long, url string, n_strict long, n_soft long")
    host, path = _parts(F.col("url"))
    placed = counted.select("page_id", "n_strict", "n_soft", host.alias("host"), path.alias("path"))
    judged = placed.withColumn("found", _rule_of(F.col("host"), F.col("path"), rules))
    bad = (F.col("n_strict") > 0) | (F.col("n_soft") >= several)
    verdict = F.coalesce(F.col("found.verdict"), F.when(bad, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", F.col("found.name").alias("rule"), verdict.alias("verdict"), "n_strict", "n_soft")


def _alone(term: str) -> str:
    word = r"a-z0-9\x{80}-\x{10FFFF}"
    return f"CAST(regexp_matches(body, '(^|[^{word}]){term}($|[^{word}])') AS BIGINT)"


SQL = f"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), places AS (
  SELECT page_id, url, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts
), split AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path,
    translate(coalesce(try(url_decode(url)), url), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM places
), counted AS (
  SELECT page_id, host, path,
    CASE WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
    {" + ".join(map(_alone, STRICT))} AS n_strict,
    {" + ".join(map(_alone, SOFT))} AS n_soft
  FROM split
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN n_strict > 0 OR n_soft >= {SEVERAL} THEN 'block' ELSE 'allow' END AS verdict,
  n_strict, n_soft
FROM counted
"""
