"""Words and shingles of whole texts as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

#: words whose hash a worker remembers; a full memory starts anew
REMEMBERED = 500_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


class Words(dict):
    """Word (bytes) -> hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the words between ASCII white space, A-Z in lower case."""
        words = (text or "").encode().lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def rolled(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each ``n`` words in a row; of fewer words, one for all of them; of none, none."""
    m = len(words)
    size = min(n, m)
    total = np.full(m - size + 1 if m else 0, 0 if m >= n else m, np.uint64)
    for k in range(size):
        total = total * _STEP + words[k : m - size + 1 + k]
    total ^= total >> _HALF
    total *= _MIX
    total ^= total >> _HALF
    return total


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """The distinct shingles in ascending order."""
    return np.unique(rolled(words, n))
