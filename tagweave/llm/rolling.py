"""Hashes of all windows of a byte string, by prefix sums of a polynomial modulo 2^64."""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20
LONGEST_WINDOW = 400
_FACTOR = 0x9E3779B97F4A7C15


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + LONGEST_WINDOW, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_FACTOR), _powers(pow(_FACTOR, -1, 1 << 64))


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """One hash for every start of ``width`` bytes in ``data``, of at most ``BLOCK`` starts.

    Equal windows have equal hashes wherever they stand. The upper bits are the
    well-mixed ones.
    """
    n = len(data) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _DOWN[: len(data)], dtype=np.uint64)
    hashes = sums[width - 1 :].copy()
    hashes[1:] -= sums[: n - 1]
    hashes *= _UP[:n]
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(32))
