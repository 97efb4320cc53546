"""Words and word shingles of whole texts as 64-bit hashes, in Python workers."""

from __future__ import annotations

import numpy as np
import xxhash

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        got = self[word] = xxhash.xxh64_intdigest(word)
        return got


class WordHasher:
    """Hashes of words, kept for up to ``most`` different ones at a time."""

    def __init__(self, most: int = 500_000):
        self.most, self.known = most, _Hashes()

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


def split_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``; bytes split at just this white space, and
    their ``lower`` changes A-Z only."""
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; with fewer words, of the whole sequence; of none, none."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    last = len(hashes) - n + 1
    out = mix(hashes[:last] + _A)
    for k in range(1, n):
        out = mix(out * _A + hashes[k:last + k])
    return out
