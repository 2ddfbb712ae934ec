"""Word and word n-gram hashes of many texts at once, as numpy arrays over their concatenated UTF-8 bytes.

A word is a run of bytes that are digits, letters a-z (A-Z are lower-cased) or parts of non-ASCII characters. Its hash is a
polynomial in random byte values modulo 2^64, taken from prefix sums, so that no text is ever looped over in Python.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
STEP = np.uint64(0xD6E8FEB86659FD93)
BLOCK = 1 << 19


def _table() -> np.ndarray:
    out = np.zeros(256, dtype=np.uint64)
    values = np.random.default_rng(77).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for b in range(256):
        if 48 <= b < 58 or 97 <= b < 123 or b >= 128:
            out[b] = values[b]
        elif 65 <= b < 91:
            out[b] = values[b + 32]
    return out


VALUES = _table()
IS_WORD = VALUES > 0
_powers: list[np.ndarray] = []


def _wrapping(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, BLOCK + 1)
        _powers[:] = [_wrapping(BASE, n), _wrapping(INVERSE, n)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= STEP
    x ^= x >> np.uint64(29)
    return x


class Words:
    """The words of some texts: doc (index of the text), start and end (bytes of the joined texts), hash; first[i] is the number of words before text i."""

    def __init__(self, texts: list[str]):
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b"\n".join(parts)
        sizes = np.fromiter((len(p) + 1 for p in parts), dtype=np.int64, count=len(parts))
        self.offset = np.concatenate([[0], np.cumsum(sizes)])
        raw = np.frombuffer(self.data, dtype=np.uint8)
        inside = np.zeros(len(raw) + 2, dtype=np.int8)
        inside[1:-1] = IS_WORD[raw]
        edge = np.diff(inside)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.start, self.offset)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.hash = self._hashes(raw)

    def _hashes(self, raw: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.start), dtype=np.uint64)
        w = 0
        while w < len(self.start):  # blocks of whole words
            a = self.start[w]
            v = max(w + 1, int(np.searchsorted(self.end, a + BLOCK, "right")))
            b = self.end[v - 1]
            up, down = powers(int(b - a) + 1)
            sums = np.zeros(int(b - a) + 1, dtype=np.uint64)
            np.cumsum(VALUES[raw[a:b]] * up[: b - a], out=sums[1:])
            s, e = self.start[w:v] - a, self.end[w:v] - a
            out[w:v] = mix((sums[e] - sums[s]) * down[s])
            w = v
        return out

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of all runs of k words inside one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        h = self.hash[:n].copy()
        for j in range(1, k):
            h *= STEP
            h += self.hash[j : j + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return at, mix(h[at])

    def word(self, i: int) -> str:
        """Word i, lower-cased in A-Z only."""
        return self.data[self.start[i] : self.end[i]].lower().decode("utf-8", "surrogatepass")


def gram_hashes(text: str, k: int) -> np.ndarray:
    return Words([text]).grams(k)[1]


class HashSet:
    """Which of many hashes are in a sorted set: a bitmap of their low bits first, then a search."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(np.asarray(hashes, dtype=np.uint64))
        bits = min(24, max(16, int(len(self.sorted)).bit_length() + 6))
        self.mask = np.uint64((1 << bits) - 1)
        self.map = np.zeros(1 << bits, dtype=bool)
        self.map[(self.sorted & self.mask).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in hashes, positions in the sorted set) of all that are in it."""
        if not len(self.sorted):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at = np.flatnonzero(self.map[(hashes & self.mask).astype(np.int64)])
        spot = np.searchsorted(self.sorted, hashes[at])
        spot[spot == len(self.sorted)] = 0
        same = self.sorted[spot] == hashes[at]
        return at[same], spot[same]
