"""64-bit hashes of words and of word sequences."""

from __future__ import annotations

import numpy as np
import xxhash

REMEMBERED = 150_000
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """Hash of a word, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of each row of columns; depends on their number and order."""
    value = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        value = (value ^ part) * _P
        value ^= value >> np.uint64(29)
        value *= _Q
        value ^= value >> np.uint64(32)
    return value
