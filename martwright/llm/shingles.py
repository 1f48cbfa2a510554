"""Word hashes and shingle hashes of one text, in numpy, for operators that work inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import SHINGLE

#: Words kept in a task's table of hashes before it is emptied; it only saves time.
TABLE = 400_000

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


class WordTable(dict):
    """word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= TABLE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def run_hashes(word_hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order."""
    count = len(word_hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = word_hashes[:count].copy()
    for k in range(1, size):
        out ^= out >> _SHIFT
        out *= _FACTOR
        out += word_hashes[k : k + count]
    out ^= out >> _SHIFT
    out *= _FACTOR
    out ^= out >> _SHIFT
    return out


def hashes_of(words: list[bytes], table: WordTable) -> np.ndarray:
    return np.fromiter(map(table.__getitem__, words), np.uint64, count=len(words))


def shingle_set(text: bytes | None, table: WordTable) -> np.ndarray:
    """Sorted distinct shingle hashes: runs of five lower-cased words, or all words if fewer; empty without words."""
    found = (text or b"").translate(LOWER).split()
    if not found:
        return np.empty(0, np.uint64)
    return np.unique(run_hashes(hashes_of(found, table), min(SHINGLE, len(found))))
