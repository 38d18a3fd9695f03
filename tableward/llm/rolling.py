"""Rolling hashes over sequences held in numpy arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=8)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers, and those of its inverse modulo 2^64, for a power of two of places."""
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))
    both = []
    for base in (np.uint64(_BASE), inverse):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: A random number for each byte.
BYTES = mix(np.arange(1, 257, dtype=np.uint64))


class Prefix:
    """Sums from which the hash of any stretch follows: equal stretches have equal hashes wherever they stand."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.power, inverse = _powers(1 << max(n + 1, 2).bit_length())
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values.astype(np.uint64) * self.power[:n], out=self.sums[1:])
        self.inverse = inverse

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def windows(self, width: int) -> np.ndarray:
        """The hash of each stretch of ``width`` values."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.inverse[:n]) if n > 0 else np.zeros(0, np.uint64)


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text's bytes start and end."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_WHITE[raw]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of each word of a text's bytes, its length included."""
    starts, ends = word_bounds(raw)
    if not len(starts):
        return np.zeros(0, np.uint64)
    return mix(Prefix(BYTES[raw]).hashes(starts, ends) + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each stretch of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out
