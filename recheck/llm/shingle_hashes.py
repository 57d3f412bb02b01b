"""Hashes of word runs of one text, in NumPy: the arithmetic behind substring dedup."""

from __future__ import annotations

import numpy as np
import xxhash

# Two odd multipliers, one for each 64-bit half of a run's hash.
_BASE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def _inverse(b: int) -> int:
    x = b
    for _ in range(6):  # Newton's iteration doubles the number of right bits
        x = x * (2 - b * x) & (2**64 - 1)
    return x


_BACK = np.array([_inverse(int(b)) for b in _BASE], np.uint64)
_POWERS = np.ones((2, 1), np.uint64)
_BACK_POWERS = np.ones((2, 1), np.uint64)


def _grow(n: int) -> None:
    global _POWERS, _BACK_POWERS
    if _POWERS.shape[1] < n:
        size = max(n, 2 * _POWERS.shape[1])
        for base, name in ((_BASE, "_POWERS"), (_BACK, "_BACK_POWERS")):
            p = np.repeat(base[:, None], size, axis=1)
            p[:, 0] = 1
            globals()[name] = np.cumprod(p, axis=1, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Word hashes of a text (a list of words in UTF-8) summed up so that any run's 128-bit hash is one subtraction."""

    def __init__(self, words: list[bytes]):
        self.n = len(words)
        digest = xxhash.xxh3_128_digest
        own = np.frombuffer(b"".join([digest(w) for w in words]), np.uint64).reshape(-1, 2).T
        _grow(self.n + 1)
        self.sums = np.zeros((2, self.n + 1), np.uint64)
        np.cumsum(own * _POWERS[:, : self.n], axis=1, dtype=np.uint64, out=self.sums[:, 1:])

    def runs(self, start: np.ndarray, end: np.ndarray, lanes: int = 2) -> np.ndarray:
        """(lanes, runs): hashes of the words [start, end); equal runs of words have equal hashes wherever they are."""
        d = self.sums[:lanes, end] - self.sums[:lanes, start]
        return mixed(d * _BACK_POWERS[:lanes, start])


def anchors(h: Hashes, k: int, window: int, s: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the closed syncmers: the k-word runs whose least s-word run (the first, of equal ones)
    stands at their beginning or end. Whether a run is one depends on its own words only, and of k - s runs in a row one
    at least is: so every ``window`` words hold one if k - s <= window - k + 1. Shorter texts have none."""
    if k - s > window - k + 1:
        raise ValueError(f"runs of {k} words leave gaps in windows of {window}")
    m = h.n - k + 1
    if h.n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(h.n - s + 1)
    small = h.runs(at, at + s, 1)[0]
    found = np.zeros(m, bool)
    for b in range(0, m, 1 << 16):
        view = np.lib.stride_tricks.sliding_window_view(small[b: min(m, b + (1 << 16)) + k - s], k - s + 1)
        least = view.argmin(1)
        found[b: b + len(view)] = (least == 0) | (least == k - s)
    pos = np.flatnonzero(found)
    return pos, h.runs(pos, pos + k, 1)[0]
