"""Word shingles as 64-bit hashes, for whole texts.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text with fewer
than five words is one shingle of all its words.
"""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
#: words whose hashes a worker keeps
WORDS_KEPT = 300_000
_RNG = np.random.default_rng(5)
_FACTORS = _RNG.integers(1, 1 << 63, size=SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LENGTHS = _RNG.integers(1, 1 << 63, size=SHINGLE + 1, dtype=np.uint64)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


_WORDS = _Words()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (in place)."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; empty without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    known = _WORDS
    h = np.fromiter([known[w] for w in words], dtype=np.uint64, count=len(words))
    k = min(len(h), SHINGLE)
    out = np.full(len(h) - k + 1, _LENGTHS[k], dtype=np.uint64)
    for j in range(k):
        out += h[j:len(h) - k + 1 + j] * _FACTORS[j]
    return np.unique(mixed(out))
