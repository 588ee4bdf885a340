"""Words, lines and rolling hashes of many texts at once, in numpy.

All texts of a slice lie in one byte array; words are runs of bytes other
than 0x20 and 0x09-0x0D and never cross a text's end.  Hashes are
polynomials over random byte values modulo 2^64, taken from prefix sums,
so the hash of any byte range costs one subtraction and one product.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

U = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
STEP = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * STEP)


def _power(name: str, factor: np.uint64, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        steps = np.full(n, factor, U)
        steps[0] = 1
        _powers[name] = np.cumprod(steps)
    return _powers[name][:n]


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    #: words of text i are first[i] .. first[i + 1]
    first: np.ndarray


class RangeHash:
    """Hashes of byte ranges of one array."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(BYTE_VALUES[data] * _power("up", STEP, max(n, 1))[:n], out=self.sums[1:])
        self.down = _power("down", INVERSE, n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(value + (end - start).astype(U))


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of each text, in order."""
    ink = ~WHITE[data]
    if not ink.any():
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(len(offsets), np.int64))
    edge = np.zeros(len(data) + 1, bool)  # a text begins or ends before this byte
    edge[offsets] = True
    opens = ink.copy()
    opens[1:] &= ~ink[:-1] | edge[1:-1]
    closes = ink.copy()
    closes[:-1] &= ~ink[1:] | edge[1:-1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, doc, first)


def windows(values: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every n consecutive values of one text, and where they begin."""
    count = len(values) - n + 1
    if count <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    value = values[:count].copy()
    for j in range(1, n):
        value *= STEP
        value += values[j : count + j]
    at = np.flatnonzero(doc[:count] == doc[n - 1 :])
    return mix(value[at]), at


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    if len(keys) < 2:
        return np.zeros(len(keys), bool)
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys


def per_doc(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights=weights, minlength=n).astype(np.int64)
