"""Hashes of many substrings at once, from running sums over an array of characters."""

from __future__ import annotations

import numpy as np

_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _table(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept for the next call unless it is very long."""
    if len(_powers[base]) >= n:
        return _powers[base][:n]
    steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
    steps[0] = 1
    table = np.multiply.accumulate(steps)
    if n <= 1 << 22:
        _powers[base] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over all 64 (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``codes[begin:end]``; it depends on these codes (not 0) alone."""
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes.astype(np.uint64) * _table(_BASE, len(codes)), out=sums[1:])
    return mix((sums[ends] - sums[begins]) * _table(_INVERSE, len(codes) + 1)[begins])


def chain(*parts: np.ndarray) -> np.ndarray:
    """One hash of several in order."""
    out = np.full(len(parts[0]), len(parts), dtype=np.uint64)
    for part in parts:
        out = mix(out * np.uint64(_BASE) + part)
    return out
