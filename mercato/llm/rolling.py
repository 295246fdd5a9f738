"""Hashes of all byte stretches of a text from prefix sums, in NumPy."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_MASK = (1 << 64) - 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``count`` powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < count:
        size = 1 << (count - 1).bit_length()
        for at, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            out, step = np.ones(1, np.uint64), base
            while len(out) < size:
                out = np.concatenate([out, out * np.uint64(step)])
                step = step * step & _MASK
            _powers[at] = out
    return _powers[0][:count], _powers[1][:count]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of hashes over all 64 (in place)."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    values ^= values >> np.uint64(31)
    return values


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of (code + 1) * base**position over [i, j)."""
    up, _ = powers(len(codes))
    sums = np.empty(len(codes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each stretch [start, end), whatever its place."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])
