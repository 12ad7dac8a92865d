"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece exactly one token can end its encoding. The table of these
last tokens is filled from left to right: a token that ends at position i is the right
one if it may follow the last token of the prefix before it, that is if merging would
not have chosen a token across their boundary. An automaton over all tokens yields those
that end at a position, longest first. Encoding walks the table backwards. An
append only adds entries; an edit keeps the entries before it and stops recomputing as
soon as a full token length of entries repeats the old ones.

Null text: no tokens. Repeated rows are encoded one by one; extra columns are ignored.
An empty table gives an empty result. Piece length is not limited: the work is linear.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import slices, texts, worker_memory

#: Pieces remembered per generation; two generations are kept in a Python worker.
REMEMBERED = 200_000
#: Pairs of tokens whose verdict is remembered.
MOST_VERDICTS = 1_000_000


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Vocabulary in the public rank format: base64 bytes and rank, one per line."""
    pairs = (line.split() for line in lines.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class PrefixTable:
    """Encoding of one growing and editable piece of bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data = vocabulary, b""
        self.last: list[int] = []
        self.append(data)

    def append(self, data: bytes) -> None:
        state = self._state(len(self.data))
        self.data += data
        self.vocabulary.fill(self.data, self.last, len(self.data), state)

    def _state(self, stop: int) -> int:
        """The automaton's state after ``stop`` bytes; older ones than the longest token do not matter."""
        state = 0
        for byte in self.data[max(0, stop - self.vocabulary.longest) : stop]:
            state = self.vocabulary.move(state, byte)
        return state

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Put ``data`` in place of bytes start..stop; returns how many entries were recomputed."""
        old, shift = self.last, len(data) - (stop - start)
        self.data = self.data[:start] + data + self.data[stop:]
        self.last = old[:start]
        agree, begin, state = 0, start + len(data), self._state(start)
        for end in range(start + 1, len(self.data) + 1):
            state = self.vocabulary.fill(self.data, self.last, end, state)
            agree = agree + 1 if end > begin and self.last[-1] == old[end - 1 - shift] else 0
            if agree >= self.vocabulary.longest:
                self.last.extend(old[end - shift :])
                return end - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        return self.vocabulary.walk(self.last)


class Vocabulary:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.sizes = list(map(len, self.tokens))
        self.longest = max(self.sizes)
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.verdicts: list[dict[int, bool]] = [{} for _ in self.tokens]
        self.judged = 0
        # Automaton: moves of a state (the others are added when met), its fall-back state, its own
        # token, the state and byte it comes from and, once asked, all tokens that end there.
        self.moves: list[dict[int, int]] = [{}]
        self.back: list[int | None] = [0]
        self.own: list[tuple[int, int] | None] = [None]
        self.path: list[tuple[int, int]] = [(0, 0)]
        for token, rank in ranks.items():
            state = 0
            for byte in token:
                below = self.moves[state].get(byte)
                if below is None:
                    below = self.moves[state][byte] = len(self.moves)
                    self.moves.append({})
                    self.back.append(None)
                    self.own.append(None)
                    self.path.append((state, byte))
                state = below
            self.own[state] = (rank, len(token))
        self.ending: list[tuple[tuple[int, int], ...] | None] = [()] + [None] * (len(self.moves) - 1)

    def fall_back(self, state: int) -> int:
        """State of the longest proper suffix of the state's bytes that begins a token."""
        known = self.back[state]
        if known is None:
            above, byte = self.path[state]
            known = self.back[state] = self.move(self.fall_back(above), byte) if above else 0
        return known

    def move(self, state: int, byte: int) -> int:
        found = self.moves[state].get(byte)
        if found is None:
            found = self.move(self.fall_back(state), byte) if state else 0
            self.moves[state][byte] = found
        return found

    def endings(self, state: int) -> tuple[tuple[int, int], ...]:
        """(token, length) of all tokens that end in a state, longest first."""
        found = self.ending[state]
        if found is None:
            own = self.own[state]
            found = self.ending[state] = ((own,) if own else ()) + self.endings(self.fall_back(state))
        return found

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; None for a single byte."""
        if token not in self.halves:
            data = self.tokens[token]
            self.halves[token] = self._merge_below(data, token) if len(data) > 1 else None
        return self.halves[token]

    def _merge_below(self, data: bytes, limit: int) -> tuple[int, int]:
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:
            best, at = min((self.ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best >= limit:
                raise ValueError(f"token {limit} cannot be built by merges")
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def follows(self, left: int, right: int) -> bool:
        """Whether merging keeps a boundary between the two tokens.

        Undo the merges of both sides from the latest to the earliest. Whenever the two
        tokens now at the boundary would have merged earlier than the merge just undone,
        the boundary could not have survived.
        """
        if self.judged > MOST_VERDICTS:
            for known in self.verdicts:
                known.clear()
            self.judged = 0
        self.judged += 1
        verdict = self.verdicts[left][right] = self._boundary_survives(left, right)
        return verdict

    def _boundary_survives(self, left: int, right: int) -> bool:
        # Merges of equal rank run from left to right, so the left side's own merge comes
        # before one across the boundary, and the right side's own merge after it.
        ranks, tokens = self.ranks, self.tokens
        before = len(tokens) + (1 << 30)
        while True:
            across = ranks.get(tokens[left] + tokens[right])
            if across is not None and across < before:
                return False
            a, b = self.split(left), self.split(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                before, left = left, a[1]
            else:
                before, right = right + 1, b[0]

    def fill(self, data: bytes, last: list[int], stop: int, state: int) -> int:
        """Extend the last tokens to the prefix of ``stop`` bytes; takes and gives the automaton's state."""
        moves, ending, verdicts = self.moves, self.ending, self.verdicts
        for end in range(len(last), stop):
            byte = data[end]
            into = moves[state].get(byte)
            state = self.move(state, byte) if into is None else into
            tokens = ending[state]
            for token, size in self.endings(state) if tokens is None else tokens:
                if size > end:
                    break
                left = last[end - size]
                allowed = verdicts[left].get(token)
                if allowed or (allowed is None and self.follows(left, token)):
                    break
            else:
                raise ValueError("the vocabulary is not closed under merges")
            last.append(token)
        return state

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.fill(piece, last, len(piece), 0)
        return self.walk(last)

    def walk(self, last: list[int]) -> list[int]:
        """Tokens of the whole from the last tokens of its prefixes."""
        found, end, sizes = [], len(last), self.sizes
        while end:
            token = last[end - 1]
            found.append(token)
            end -= sizes[token]
        found.reverse()
        return found

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Memory(dict):
    """Encoding of a piece of text as 32-bit ids in bytes, computed once while remembered.

    When a generation is full it becomes the old one; pieces met again move on.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("i", self.vocabulary.encode(piece.encode("utf-8"))).tobytes()
        if len(piece) <= 64:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids



def _name(lines: bytes) -> str:
    return f"bpe-{xxhash.xxh3_64_hexdigest(lines)}"


def _memory(lines: bytes) -> _Memory:
    """One memory per Python worker, also across its tasks."""
    return worker_memory(_name(lines), lambda: _Memory(Vocabulary(read_ranks(lines))))


def _shared(df: DataFrame, path: str):
    """The vocabulary file, read once by the driver; its size does not depend on the data."""
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _encoder(lines, pattern: str) -> Run:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(pattern).findall
        for batch in slices(batches, "text", keep=_name(lines.value)):
            memory = _memory(lines.value)
            coded = [b"".join(map(memory.__getitem__, cut(value.as_py()))) for value in batch.column("text")]
            ends = np.cumsum([0, *map(len, coded)]) // 4
            flat = np.frombuffer(b"".join(coded), np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return run


def _decoder(lines) -> Run:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            vocabulary = _memory(lines.value).vocabulary
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                decoded = [vocabulary.decode(value.values.to_numpy().tolist()) for value in batch.column("ids")]
                columns = [batch.column("doc_id"), batch.column("ids"), pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return run


DECODED = "doc_id bigint, ids array<int>, decoded binary"


def bpe_encode(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, ids): token ids of every whole text; each pattern match is encoded by itself."""
    run = _encoder(_shared(df, ranks_path), pattern)
    return texts(df, key, text).mapInArrow(run, "doc_id bigint, ids array<int>")


def bpe_decode(df: DataFrame, ranks_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Rows (doc_id, ids, decoded): the bytes that the ids stand for."""
    listed = F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids")
    rows = df.select(F.col(key).cast("bigint").alias("doc_id"), listed)
    return rows.mapInArrow(_decoder(_shared(df, ranks_path)), DECODED)


def bpe_round_trip(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256): encoded, and the ids decoded, in one task."""
    lines = _shared(df, ranks_path)
    encode, decode = _encoder(lines, pattern), _decoder(lines)
    coded = texts(df, key, text).mapInArrow(lambda batches: decode(encode(batches)), DECODED)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
