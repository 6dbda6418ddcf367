"""Improved consistent weighted sampling over weighted sets, one block of sets at a time."""

from __future__ import annotations

import numpy as np

from cartflow.llm.words import mix

BANDS, ROWS = 16, 4
_POOL_BITS = 16
_TIMES = np.uint64(0x9E3779B97F4A7C15)


def _ordered(x: np.ndarray) -> np.ndarray:
    """Numbers as 32-bit integers in the same order, moved to the upper half of 64 bits."""
    bits = x.astype(np.float32).view(np.uint32)
    flip = np.where(bits >> np.uint32(31), np.uint32(0xFFFFFFFF), np.uint32(0x80000000))
    return (bits ^ flip).astype(np.uint64) << np.uint64(32)


class Sampler:
    """``BANDS * ROWS`` samples a set; two sets share one with probability of their weighted Jaccard.

    For element i and sample k, r and c are Gamma(2, 1) and b uniform, all three drawn by a
    hash of (i, k) from a fixed pool. With t = floor(ln w / r + b) the element's value is
    ln a = ln c - r (t - b) - r, and the sample is the element of least value, with its t.
    Where t is 0, as for weight 1 and most near it, the value is read from the pool.
    """

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        n = 1 << _POOL_BITS
        self.r, self.c, self.b = rng.gamma(2, 1, n), rng.gamma(2, 1, n), rng.random(n)
        self.unit = _ordered(np.log(self.c) + self.r * self.b - self.r)
        self.odd = rng.integers(1 << 63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def bands(self, doc: np.ndarray, h: np.ndarray, w: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Sets that have elements, and for each its band keys; elements come grouped by ``doc`` (below ``n``)."""
        begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.empty(0, np.int64)
        keys = np.zeros((len(begin), BANDS), np.uint64)
        if not len(begin):
            return doc, keys
        spread = mix(h)
        low = spread & np.uint64(0xFFFFFFFF)
        other = np.flatnonzero(w != 1)
        log_w = np.log(w[other])
        for k in range(BANDS * ROWS):
            at = ((spread * self.odd[k]) >> np.uint64(64 - _POOL_BITS)).view(np.int64)
            value = self.unit[at] | low
            if len(other):
                i = at[other]
                t = np.floor(log_w / self.r[i] + self.b[i])
                moved = np.flatnonzero(t)
                i, t, on = i[moved], t[moved], other[moved]
                mixed = mix(spread[on] + t.astype(np.int64).astype(np.uint64) * _TIMES) & np.uint64(0xFFFFFFFF)
                value[on] = _ordered(np.log(self.c[i]) - self.r[i] * (t - self.b[i]) - self.r[i]) | mixed
            band = k // ROWS
            keys[:, band] = mix(keys[:, band] * _TIMES + np.minimum.reduceat(value, begin) + np.uint64(k))
        return doc[begin], keys
