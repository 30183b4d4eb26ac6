"""Hashes of words, shingles and windows of a text, as numpy arrays."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, base, np.uint64)) if n else np.zeros(0, np.uint64)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_UP, _DOWN = _powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if n > len(_UP):
        _UP, _DOWN = _powers(_BASE, 2 * n), _powers(_INVERSE, 2 * n)
    return _UP, _DOWN


def word_hashes(data: bytes, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of UTF-8 text, and where each word starts.

    ``breaks`` says for each byte value whether it stands between words. A word's hash is
    a polynomial of its bytes, taken as a difference of sums over the whole text.
    """
    b = np.frombuffer(data, np.uint8)
    inside = np.empty(len(b) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(breaks[b], out=inside[1:-1])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    up, down = _grown(len(b))
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:len(b)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` words in a row."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    factors = mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out += words[i:i + m] * factors[i]
    return mixed(out)
