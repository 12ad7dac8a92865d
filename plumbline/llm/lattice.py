"""Document probability over all segmentations of its words into existing subword pieces.

A word is a lattice: every vocabulary piece that fits is an arc, and a forward recursion
in log space sums over all paths. Arc weights come from the scores stored in the
vocabulary file. Those of a merge vocabulary are negative ranks, not log-probabilities,
so a piece of score -r weighs 1 / (1 + r), the Zipf law of ranks; weights are normalised
and a word stops after each piece with probability one half. The corpus adds one more
arc, the whole word, with its relative frequency in the training documents; the two kinds
are mixed by the Good-Turing estimate of unseen mass (words met once / all words).

Documents are cut into slices of bounded size. A slice's words are numbered, so the
corpus gathers one row per slice and distinct word, however often it occurs; counts are
summed by word, each distinct word of the corpus is scored once, and the scores return to
their slices, where documents are sums. A word in every document is one row per slice.

Null text counts as empty: the end token alone. A null id counts as an empty id for the
split. Repeated rows are scored one by one; other columns are ignored; an empty table
gives an empty result; words and texts of any length are summed whole. Without training
documents only the lattice speaks, and base scores are null (no counts).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import materialise, slices, texts

SLICE_BYTES = 8 << 20
FOLDS = 10
STOP = 0.5
_SPACE = "▁"


class Lattice:
    """Forward recursion over the pieces of one vocabulary file."""

    def __init__(self, model: bytes) -> None:
        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        weights, fallback = {}, len(range(pieces.get_piece_size()))
        for i in range(pieces.get_piece_size()):
            if pieces.is_byte(i):
                weights[i] = 1 / (1 + fallback)
            elif not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_unused(i)):
                weights[i] = 1 / (1 - min(0.0, pieces.get_score(i)))
        total = sum(weights.values())
        go = math.log(1 - STOP)
        self.logs = {
            pieces.id_to_piece(i): math.log(w / total) + go for i, w in weights.items() if not pieces.is_byte(i)
        }
        self.byte = math.log(1 / (1 + fallback) / total) + go
        self.longest = max(map(len, self.logs))
        self.end = math.log(STOP / (1 - STOP))
        # Lengths of pieces by their first two characters.
        lengths: dict[str, set[int]] = {}
        for piece in self.logs:
            lengths.setdefault(piece[:2], set()).add(len(piece))
        self.lengths = {k: sorted(v) for k, v in lengths.items()}

    def log_probability(self, word: str) -> float:
        """Natural logarithm of the sum over all segmentations of the word."""
        text = _SPACE + word
        size, logs, lengths = len(text), self.logs.get, self.lengths
        forward = [-math.inf] * (size + 1)
        forward[0] = 0.0
        exp, log1p = math.exp, math.log1p
        for start in range(size):
            here = forward[start]
            arcs = [(start + 1, logs(text[start], None))]
            for length in lengths.get(text[start : start + 2], ()):
                if length > 1:
                    arcs.append((start + length, logs(text[start : start + length])))
            # Every character can also be spelled by its bytes.
            arcs.append((start + 1, self.byte * len(text[start].encode("utf-8", "surrogatepass"))))
            for end, weight in arcs:
                if weight is not None and end <= size:
                    value, old = here + weight, forward[end]
                    high, low = (value, old) if value > old else (old, value)
                    forward[end] = high + log1p(exp(low - high)) if low > -math.inf else high
        return forward[size] + self.end


def _numbered(rows: DataFrame) -> DataFrame:
    """Documents as word numbers and tallies, and the words of each slice, in one table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, index = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", SLICE_BYTES):
            yield from answer(batch, part << 32 | index)
            index += 1

    def answer(batch: pa.RecordBatch, name: int) -> Iterator[pa.RecordBatch]:
        numbers: dict[bytes, int] = {b"": 0}
        sizes, ids, tallies, train = [], [], [], [0]
        for value, held in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("held_out").to_pylist()):
            found = value.lower().split()
            found.append(b"")
            for word in found:
                if word not in numbers:
                    numbers[word] = len(numbers)
            mine, counts = np.unique(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)), return_counts=True)
            sizes.append(len(mine))
            ids.append(mine)
            tallies.append(counts.astype(np.int32))
            train.append(0 if held else 1)
        known = np.zeros(len(numbers), np.int64)
        flat, counts = np.concatenate(ids), np.concatenate(tallies)
        weight = np.repeat(np.array(train[1:]), sizes)
        np.add.at(known, flat, counts * weight)
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        n, m = batch.num_rows, len(numbers)
        lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (flat, counts)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, name)), batch.column("doc_id"), batch.column("held_out"), *lists, pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())],
            _NAMES,
        )
        empty = pa.nulls(m, pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, name)), pa.array(np.arange(m)), pa.nulls(m, pa.bool_()), empty, empty, pa.array(list(numbers), pa.binary()), pa.array(known)],
            _NAMES,
        )

    return rows.mapInArrow(run, _SCHEMA)


_NAMES = ["slice", "doc_id", "held_out", "ids", "tallies", "word", "n"]
_SCHEMA = "slice bigint, doc_id bigint, held_out boolean, ids array<int>, tallies array<int>, word binary, n bigint"


def _word_scores(counted: DataFrame, model: bytes, total: int, distinct: int, once: int) -> DataFrame:
    """Rows (word, known, base, score) of every distinct word, logarithms to base 10."""
    sent = counted.sparkSession.sparkContext.broadcast(model)
    unseen = min(max(once / total, 1 / (total + 1)), 0.5) if total else 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(sent.value)
        for batch in batches:
            counts = batch.column("n").to_numpy().astype(float)
            words = batch.column("word").to_pylist()
            spelled = np.array([lattice.log_probability(w.decode("utf-8", "replace")) for w in words]) / math.log(10)
            whole = np.log10(counts * (1 - unseen) / total, where=counts > 0, out=np.full(len(counts), -np.inf)) if total else np.full(len(counts), -np.inf)
            a, b = whole, spelled + math.log10(unseen)
            high, low = np.maximum(a, b), np.minimum(a, b)
            score = high + np.log10(1 + 10 ** np.maximum(low - high, -400.0))
            base = np.log10((counts + 0.1) / (total + 0.1 * (distinct + 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(counts > 0), pa.array(base), pa.array(score)], ["word", "known", "base", "score"]
            )

    return counted.mapInArrow(run, "word binary, known boolean, base double, score double")


def _summed(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of one slice with the scores of its words."""
    number = right.column("number").to_numpy()
    known, base, score = (np.zeros(len(number)) for _ in range(3))
    for values, name in ((known, "known"), (base, "base"), (score, "score")):
        values[number] = right.column(name).to_numpy(zero_copy_only=False)
    ids, tallies = (left.column(c).combine_chunks() for c in ("ids", "tallies"))
    sizes = np.diff(ids.offsets.to_numpy())
    flat, counts = ids.flatten().to_numpy(), tallies.flatten().to_numpy()
    begins = np.cumsum(sizes) - sizes

    def total(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, begins) if len(begins) else np.zeros(0)

    return pa.table(
        {
            "doc_id": left.column("doc_id"),
            "held_out": left.column("held_out"),
            "n_tokens": pa.array(total(counts.astype(np.int64)), pa.int64()),
            "n_known": pa.array(total((counts * known[flat]).astype(np.int64)), pa.int64()),
            "base_score": pa.array(total(counts * base[flat])),
            "score": pa.array(total(counts * score[flat])),
        }
    )


def lattice_scores(df: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", folds: int = FOLDS) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every whole text.

    Documents whose crc32(id) is divisible by ``folds`` are held out of the counts.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    held = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == 0
    table = materialise(_numbered(texts(df, key, text, held.alias("held_out"))), "numbered")
    words = table.filter("word is not null").select("slice", F.col("doc_id").alias("number"), "word", "n")
    counted = materialise(words.groupBy("word").agg(F.sum("n").alias("n")), "words")
    total, distinct, once = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.count(F.when(F.col("n") > 0, 1)),
        F.count(F.when(F.col("n") == 1, 1)),
    ).first()
    scores = _word_scores(counted, model, total, distinct, once)
    dictionary = words.join(scores, "word").select(F.col("slice").alias("part"), "number", "known", "base", "score")
    documents = table.filter("word is null").select("slice", "doc_id", "held_out", "ids", "tallies")
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = documents.groupBy("slice").cogroup(dictionary.groupBy("part")).applyInArrow(_summed, schema)
    base = F.when(F.lit(total > 0), F.col("base_score")).alias("base_score")
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), base, "score"
    )
