"""Word and window hashes of whole texts, vectorised inside Python tasks."""

from __future__ import annotations

import numpy as np
import xxhash

#: Distinct words whose hashes a worker remembers.
MEMO = 150_000
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class WordHashes(dict):
    """128-bit hash of each word as 16 bytes, computed once per word while it is remembered."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        found = self[word] = xxhash.xxh3_128_digest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        """An array of two 64-bit numbers per word."""
        return np.frombuffer(b"".join([self[w] for w in words]), "<u8").reshape(-1, 2)


class Powers:
    """Powers of BASE and of its inverse modulo 2**64, as far as texts have needed them."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])) for b in (BASE, INVERSE))
        return self.up[:n], self.down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, size: int, powers: Powers) -> np.ndarray:
    """Hash of the ``size`` consecutive numbers of ``words`` that start at each place."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers.upto(len(words))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up, dtype=np.uint64)])
    return mix((sums[size:] - sums[:-size]) * down[:n])


def anchors(hashes: np.ndarray, span: int) -> np.ndarray:
    """Places of the least hash in each run of ``span`` hashes, the last of equal ones: the same in equal runs anywhere."""
    if len(hashes) < span:
        return np.zeros(0, np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(hashes, span)
    least = span - 1 - runs[:, ::-1].argmin(axis=1)
    return np.unique(np.arange(len(runs)) + least)
