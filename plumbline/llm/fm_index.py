"""FM-index over a sequence of integers, in numpy: wavelet matrix, backward search, sampled positions."""

from __future__ import annotations

import numpy as np


class Bits:
    """Bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        block, rest = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


class WaveletMatrix:
    def __init__(self, sequence: np.ndarray, symbols: int) -> None:
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bits = ((sequence >> shift) & 1).astype(np.uint8)
            zeros = len(bits) - int(bits.sum())
            self.levels.append((shift, Bits(bits), zeros))
            sequence = np.concatenate([sequence[bits == 0], sequence[bits == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        start = np.zeros_like(at)
        for shift, bits, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = bits.rank(start), bits.rank(at)
            start = np.where(one, zeros + a, start - a)
            at = np.where(one, zeros + b, at - b)
        return at - start

    def get(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for _, bits, zeros in self.levels:
            bit, ones = bits.get(at), bits.rank(at)
            symbol = symbol << 1 | bit
            at = np.where(bit == 1, zeros + ones, at - ones)
        return symbol


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order, by doubling; settled suffixes take no further part."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    key = text[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n, np.int64)
    # A suffix ranks with the first place of its equals, so that ranks stay valid as groups split.
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    step = 1
    while True:
        single = new & np.concatenate([new[1:], [True]])
        places = np.flatnonzero(~single)
        if not len(places):
            return order
        suffixes = order[places]
        after = suffixes + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        first = rank[suffixes]
        by = np.lexsort((second, first))
        suffixes, first, second = suffixes[by], first[by], second[by]
        order[places] = suffixes
        fresh = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        new[places] |= fresh
        rank[suffixes] = np.maximum.accumulate(np.where(fresh, places, 0))
        step *= 2


class FMIndex:
    """Index of a text whose symbols are positive; finds where patterns occur."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 8) -> None:
        text = np.concatenate([text, [0]]).astype(np.int64)
        order = suffix_array(text)
        last = text[order - 1]
        self.matrix = WaveletMatrix(last, symbols)
        counts = np.bincount(text, minlength=symbols)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        sampled = order % sample == 0
        self.sampled, self.samples = Bits(sampled), order[sampled]
        self.size = len(text)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of patterns (rows, left-aligned), all searched backwards at once."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            symbol = patterns[live, lengths[live] - back]
            low[live] = self.first[symbol] + self.matrix.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.matrix.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back until a sampled one is met."""
        found, rows = np.zeros(len(rows), np.int64), rows.copy()
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            hit = self.sampled.get(rows[open_]) == 1
            done = open_[hit]
            found[done] = self.samples[self.sampled.rank(rows[done])] + steps
            open_ = open_[~hit]
            symbol = self.matrix.get(rows[open_])
            rows[open_] = self.first[symbol] + self.matrix.rank(symbol, rows[open_])
            steps += 1
        return found
