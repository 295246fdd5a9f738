"""One-bit codes of rotated vectors, with bounds on inner products that hold for certain.

A vector is rotated, and the signs of what it becomes are its code: a unit vector c with entries of one size. Stored with
it is its alignment a = <c, v>, so that v = a c + e with e at right angles to c. The residual e is coded the same way,
some levels deep. A query is rotated alike and rounded to eight bits an entry; its product with a code is then a sum of
popcounts of the code with its bit planes. The estimate is the sum of alignment times product; what it misses is the
product with the last residual, which Cauchy-Schwarz bounds by that residual's length times the length of the query's
part at right angles to the last code, and the rounding, bounded by its length times that of v.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

LEVELS = 4  # codes of a vector; each takes a quarter to two fifths off the residual's length
BITS = 8  # of a rounded query entry
# of a vector's length: a shorter residual counts as none, as its length comes from a difference of squares, whose rounding is
# that of their root; intervals allow for it, alike at each level, so that they do not widen again where nothing is left
NOTHING = 3e-7
SLACK = 1e-9  # of the lengths' product, for rounding in double precision


@lru_cache(maxsize=4)
def rotation(wide: int) -> np.ndarray:
    """The same orthogonal matrix wherever it is asked for."""
    return np.linalg.qr(np.random.default_rng(wide).standard_normal((wide, wide)))[0]


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1, bitorder="little")
    out = np.zeros((len(bits), -(-packed.shape[1] // 8) * 8), np.uint8)
    out[:, :packed.shape[1]] = packed
    return out.view("<u8")


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code words (row, level, word) and alignments (row, level)."""
    count, wide = vectors.shape
    rest = vectors @ rotation(wide)
    words, alignments = np.zeros((count, LEVELS, -(-wide // 64)), np.uint64), np.zeros((count, LEVELS))
    for level in range(LEVELS):
        up = rest >= 0
        words[:, level] = _packed(up)
        alignments[:, level] = np.abs(rest).sum(axis=1) / max(wide, 1) ** 0.5
        rest -= np.where(up, 1.0, -1.0) * alignments[:, level, None] / max(wide, 1) ** 0.5
    return words, alignments


class Query:
    """A rotated query, rounded, in bit planes."""

    def __init__(self, vector: np.ndarray):
        self.wide = len(vector)
        turned = vector @ rotation(self.wide)
        self.low = turned.min(initial=0.0)
        self.step = (turned.max(initial=0.0) - self.low) / ((1 << BITS) - 1) or 1.0
        steps = np.rint((turned - self.low) / self.step).astype(np.int64)
        rounded = self.low + self.step * steps
        self.planes = _packed((steps >> np.arange(BITS)[:, None] & 1).astype(bool))
        self.steps = int(steps.sum())
        self.size = float(np.linalg.norm(vector))
        self.square = float(rounded @ rounded)
        self.missed = float(np.linalg.norm(turned - rounded))

    def products(self, words: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """<c, rounded query> of codes given by their words and number of ones."""
        weighed = np.zeros(len(words), np.int64)
        for bit, plane in enumerate(self.planes):
            weighed += np.bitwise_count(words & plane).sum(axis=1, dtype=np.int64) << bit
        return (self.step * (2 * weighed - self.steps) + self.low * (2 * ones - self.wide)) / max(self.wide, 1) ** 0.5


class Codes:
    """Codes of a block of rows."""

    def __init__(self, words: np.ndarray, alignments: np.ndarray, sizes: np.ndarray):
        self.words, self.sizes = words, sizes
        self.ones = np.bitwise_count(words).sum(axis=2, dtype=np.int64)
        left = sizes[:, None] ** 2 - np.cumsum(alignments ** 2, axis=1)
        rest = np.sqrt(np.maximum(left, 0.0))
        self.rest = np.where(rest > NOTHING * sizes[:, None], rest, 0.0)
        self.alignments = alignments.copy()
        self.alignments[:, 1:][self.rest[:, :-1] == 0.0] = 0.0  # nothing is left to be coded

    def narrow(self, query: Query, rows: np.ndarray, level: int, estimate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rows' estimate with one more level, and the least and greatest that their products can be."""
        along = query.products(self.words[rows, level], self.ones[rows, level])
        estimate = estimate + self.alignments[rows, level] * along
        across = np.sqrt(np.maximum(query.square - along ** 2, 0.0))
        sizes = self.sizes[rows]
        half = self.rest[rows, level] * across + (NOTHING + 1e-7) * sizes * query.size + query.missed * sizes + SLACK * (1 + query.size) * (1 + sizes)
        return estimate, estimate - half, estimate + half
