"""Polynomial prefix hashes of byte strings, modulo 2^64, on numpy arrays.

``span(s, e)`` is the hash of ``data[s:e]`` in constant time, independent of where it stands. The
base is odd, so its powers can be inverted. Equal strings always have equal hashes; users of a hash
name how they guard against different strings with one hash.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(int(BASE), -1, 2**64))
_grown: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, kept for the next call."""
    if len(_grown.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, base, U)
            steps[0] = 1
            _grown[name] = np.multiply.accumulate(steps)
    return _grown["up"][:n], _grown["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class PrefixHashes:
    """Prefix hashes of one byte array."""

    def __init__(self, data: np.ndarray):
        up, self._down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * up[:-1], out=self.sums[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self._down[start]

    def fixed(self, length: int) -> np.ndarray:
        """Hashes of all substrings of one length."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self._down[:n] if n > 0 else np.zeros(0, U)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes above the space."""
    inside = np.concatenate([[False], data > 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]
