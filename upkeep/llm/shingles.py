"""Hashes of word shingles, computed over whole batches of texts at once."""

from __future__ import annotations

import numpy as np

_BREAK = np.zeros(256, bool)
_BREAK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (one to one)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse."""
    if len(_powers[0]) <= n:
        size = 1 << (n + 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _powers[k] = np.multiply.accumulate(row)
    return _powers[0], _powers[1]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word (stretch without white space), A-Z counting as a-z."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate(([False], ~_BREAK[raw], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    up, down = _power(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """For each text its distinct k-word shingles as sorted 64-bit hashes.

    A text with fewer words, but at least one, has one shingle: all its words. A text without words has none.
    """
    coded = [t.encode() for t in texts]
    out: list[np.ndarray] = []
    lo = 0
    while lo < len(coded):
        hi, size = lo, 0
        while hi < len(coded) and (hi == lo or size + len(coded[hi]) < 1 << 20):
            size += len(coded[hi]) + 1
            hi += 1
        starts, words = word_hashes(b" ".join(coded[lo:hi]))
        offsets = np.cumsum([0, *(len(x) + 1 for x in coded[lo:hi])])
        bounds = np.searchsorted(starts, offsets)
        factor = np.array([pow(0xD6E8FEB86659FD93, j + 1, 1 << 64) for j in range(k)], np.uint64)
        n = len(words) - k + 1
        if n > 0:
            every = words[:n] * factor[0]
            for j in range(1, k):
                every = every + words[j:j + n] * factor[j]
            every = mixed(every)
        for a, b in zip(bounds, bounds[1:], strict=False):
            if b - a >= k:
                out.append(np.unique(every[a:b - k + 1]))
            elif b > a:
                short = (words[a:b] * factor[:b - a]).sum(keepdims=True, dtype=np.uint64)
                out.append(mixed(short ^ np.uint64(0xA5A5A5A5A5A5A5A0 + int(b - a))))
            else:
                out.append(np.empty(0, np.uint64))
        lo = hi
    return out
