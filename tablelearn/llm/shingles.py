"""Hashed word shingles of texts, inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix constants), element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """Hashes of the words of a text, without making the words: a word's hash
    is the sum of table[byte] * base**place over its bytes, read off a running
    sum of the text (A-Z count as a-z)."""

    PIECE = 1 << 20

    def __init__(self):
        rng = np.random.default_rng(17)
        self.table = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.table[65:91] = self.table[97:123]
        self.space = np.zeros(256, bool)
        self.space[[32, 9, 10, 11, 12, 13]] = True
        self.up = self.down = np.zeros(0, np.uint64)

    def _powers(self, n: int) -> None:
        base = 0x9E3779B97F4A7C15
        for name, x in (("up", base), ("down", pow(base, -1, 1 << 64))):
            p = np.full(n, x, dtype=np.uint64)
            p[0] = 1
            setattr(self, name, np.cumprod(p, dtype=np.uint64))

    def of(self, text: bytes) -> np.ndarray:
        if len(text) <= self.PIECE:
            return self._piece(np.frombuffer(text, np.uint8))
        parts, at = [], 0
        body = np.frombuffer(text, np.uint8)
        while at < len(body):       # long texts in pieces that end at white space
            end = min(at + self.PIECE, len(body))
            while end < len(body) and not self.space[body[end]]:
                step = np.flatnonzero(self.space[body[end:end + self.PIECE]])
                end = end + int(step[0]) if len(step) else min(end + self.PIECE, len(body))
            parts.append(self._piece(body[at:end]))
            at = end
        return np.concatenate(parts)

    def _piece(self, body: np.ndarray) -> np.ndarray:
        n = len(body)
        if n > len(self.up):
            self._powers(max(4096, 2 * n))
        gap = self.space[body]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
        start, end = edge[::2], edge[1::2]
        c = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.table[body] * self.up[:n], out=c[1:])
        return mix((c[end] - c[start]) * self.down[start])


def shingle_set(text: bytes | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words (A-Z lower-cased);
    a shorter text is one shingle, a text without words has none."""
    h = hashes.of(text or b"")
    if not len(h):
        return np.zeros(0, np.uint64)
    if len(h) < size:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes())], np.uint64)
    n = len(h) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        odd = np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1) | 1) & _MASK)
        total += h[k:k + n] * odd
    return np.unique(mix(total))


def set_key(shingles: np.ndarray) -> int:
    """One signed 64-bit key for a whole set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def texts(column) -> list:
    return column.cast(pa.binary()).to_pylist()
