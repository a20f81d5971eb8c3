"""Words and n-grams as integers, in numpy, the same on every machine."""

from __future__ import annotations

import numpy as np
import xxhash

#: Entries a word cache keeps before it starts anew, so that its memory is bounded; a small one also stays in the processor's caches.
CACHE_WORDS = 50_000

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """Word (bytes) to a 64-bit hash, kept while the cache has room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of all runs of so many words; of a shorter, not empty sequence, of the whole."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(words, n)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total = (total ^ hashes[i : n - width + 1 + i]) * _GOLDEN
        total = total ^ (total >> np.uint64(32))
    return mix(total)
