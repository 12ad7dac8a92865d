"""Benchmark passages in training documents, by an FM-index per shard.

Documents stream through the tasks; each task gathers a shard of bounded size (at least
one document) and indexes it. Only words that benchmark items use can take part in a
match, so all others act as one separator and only stretches of item words enter the
index. Every distinct item window is searched backwards through wavelet-tree ranks, its
occurrences are located by sampled suffix positions, and per document the covered words
are merged into spans. Nothing is shuffled; every document is searched whole.

The item side is cut into blocks of bounded size; each block is sent to the tasks and
makes one pass over the documents, so its broadcast does not grow with the benchmark.

Null and empty texts have no words: nothing is hit, and such items match nothing.
Repeated documents are answered one by one, repeated items count by their id once. Items
with a null id take part in hits but in no item list. Empty tables, other columns and
very long texts need no special care.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import materialise, texts
from plumbline.llm.fm_index import FMIndex

WINDOW = 13
#: Bytes of text gathered before a shard is indexed, and words of items sent at once.
SHARD_BYTES = 4 << 20
BLOCK_WORDS = 500_000
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def word_bytes(text: bytes) -> list[bytes]:
    """Words after lower-casing A-Z; bytes above 127 belong to words, as their characters do."""
    return _WORD.findall(text.lower())


class Patterns:
    """Distinct windows of a block of items as rows of symbols."""

    def __init__(self, items: list[tuple[int | None, bytes]], window: int) -> None:
        self.symbols: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            ids = [self.symbols.setdefault(w, len(self.symbols) + 2) for w in word_bytes(text)]
            for start in range(max(1, len(ids) - window + 1) if ids else 0):
                mine = owners.setdefault(tuple(ids[start : start + window]), set())
                if item is not None:
                    mine.add(item)
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.rows = np.zeros((len(owners), window), np.int64)
        for i, pattern in enumerate(owners):
            self.rows[i, : len(pattern)] = pattern
        self.items = list(owners.values())
        self.shortest = int(self.lengths.min(initial=window))


def search_shard(documents: list[bytes], patterns: Patterns) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
    """Per document: number of words, merged spans of hit words (end exclusive), item ids."""
    lookup = patterns.symbols.get
    counts, pieces, origin, offsets = [], [], [], []
    for number, text in enumerate(documents):
        found = word_bytes(text)
        counts.append(len(found))
        ids = np.fromiter((lookup(w, 1) for w in found), np.int64, len(found))
        # Stretches of item words that are long enough to hold a window.
        known = np.concatenate([[0], ids != 1, [0]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(known))
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= patterns.shortest:
                pieces += ids[a:b], [1]
                origin.append(np.full(b - a + 1, number))
                offsets.append(np.arange(a, b + 1))
    spans: list[list[tuple[int, int]]] = [[] for _ in documents]
    items: list[set[int]] = [set() for _ in documents]
    if pieces:
        text = np.concatenate(pieces).astype(np.int64)
        index = FMIndex(text, len(patterns.symbols) + 2)
        low, high = index.search(patterns.rows, patterns.lengths)
        sizes = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(sizes)), sizes)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]
        at = index.locate(rows)
        documents_of, starts = np.concatenate(origin)[at], np.concatenate(offsets)[at]
        ends = starts + patterns.lengths[which]
        for d, p in set(zip(documents_of.tolist(), which.tolist())):
            items[d] |= patterns.items[p]
        for i in np.lexsort((starts, documents_of)):
            mine, a, b = spans[documents_of[i]], int(starts[i]), int(ends[i])
            if mine and a <= mine[-1][1]:
                mine[-1] = (mine[-1][0], max(mine[-1][1], b))
            else:
                mine.append((a, b))
    return [(n, s, sorted(x)) for n, s, x in zip(counts, spans, items)]


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int | None, bytes]]]:
    """Items in blocks of bounded size, read partition by partition."""
    rows = benchmark.select(F.col(item).cast("bigint").alias("item"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    block, held = [], 0
    for row in rows.distinct().toLocalIterator():
        block.append((row.item, row.text.encode("utf-8")))
        held += len(row.text) // 2 + 1
        if held >= BLOCK_WORDS:
            yield block
            block, held = [], 0
    yield block


_SCHEMA = "doc_id bigint, n_words bigint, spans array<struct<start:int,end:int>>, items array<bigint>"


def _search_block(rows: DataFrame, block: list[tuple[int | None, bytes]], window: int, carried: list[str]) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(block)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def answer(shard: list[pa.RecordBatch], patterns: Patterns) -> pa.RecordBatch:
        table = pa.Table.from_batches(shard).combine_chunks()
        found = search_shard(table.column("text").cast(pa.binary()).to_pylist(), patterns)
        columns = {
            "doc_id": table.column("doc_id").combine_chunks(),
            "n_words": pa.array([n for n, _, _ in found], pa.int64()),
            "spans": pa.array([[{"start": a, "end": b} for a, b in s] for _, s, _ in found], pa.list_(span)),
            "items": pa.array([i for _, _, i in found], pa.list_(pa.int64())),
        }
        columns |= {c: table.column(c).combine_chunks() for c in carried if c != "doc_id"}
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, shard, held = Patterns(sent.value, window), [], 0
        for whole in batches:
            sizes = [len(v.as_buffer()) for v in whole.column("text")]
            start = 0
            for i, size in enumerate(sizes):
                held += size
                if held >= SHARD_BYTES:
                    yield answer([*shard, whole.slice(start, i + 1 - start)], patterns)
                    shard, held, start = [], 0, i + 1
            if start < whole.num_rows:
                shard.append(whole.slice(start))
        if shard:
            yield answer(shard, patterns)

    kept = [f for f in rows.schema.fields if f.name in carried]
    extra = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept if f.name != "doc_id")
    return rows.mapInArrow(run, _SCHEMA + (f", {extra}" if extra else ""))


def find_passages(
    df: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Rows (doc_id, n_words, spans, items): merged hit spans in word numbers, end exclusive.

    ``key`` must tell rows apart only if the benchmark needs more than one block; then the
    blocks' answers meet by a row number that is fixed by writing the rows once.
    """
    blocks = _blocks(benchmark, item, item_text)
    rows, block, following = texts(df, key, text), next(blocks), next(blocks, None)
    if following is None:
        return _search_block(rows, block, window, ["doc_id"]).select("doc_id", "n_words", "spans", "items")
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
    merged = None
    # The driver holds two blocks at a time; answers are written before the next one comes.
    while block is not None:
        part = materialise(_search_block(rows, block, window, ["doc_id", "row"]), "passages")
        merged = part if merged is None else merged.unionByName(part)
        block, following = following, next(blocks, None)
    grouped = merged.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    joined = F.aggregate(
        "spans",
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda a, s: F.when(
            (F.size(a) > 0) & (s["start"] <= F.get(a, F.size(a) - 1)["end"]),
            F.concat(
                F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.get(a, F.size(a) - 1)["start"].alias("start"),
                        F.greatest(F.get(a, F.size(a) - 1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(a, F.array(s))),
    )
    return grouped.select("doc_id", "n_words", joined.alias("spans"), "items")


def with_verdict(found: DataFrame) -> DataFrame:
    """Adds n_hit and contaminated: at least a twentieth of the words is hit."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def contamination_report(found: DataFrame) -> DataFrame:
    ids = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return with_verdict(found).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        "contaminated",
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SQL = f"""
WITH doc AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
pattern AS (
  SELECT DISTINCT item_id, p, len(p) AS n FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda i: w[i:i+12])) AS p
    FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM pattern),
place AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n),
found AS (SELECT doc_id, i, n, item_id FROM (SELECT doc_id, i, n, w[i:i+n-1] AS p FROM place) JOIN pattern USING (n, p)),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (
  SELECT DISTINCT doc_id, word FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM found)) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
