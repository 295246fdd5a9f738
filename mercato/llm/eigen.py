"""Leading eigenvectors of a symmetric matrix: Householder tridiagonalisation, bisection on Sturm counts, inverse
iteration. The matrix is as wide as a vector, whatever the number of rows, so this is the driver's small part."""

from __future__ import annotations

import numpy as np

CLOSE = 1e-3  # eigenvalues this near, as a share of the matrix's size, are one cluster: their vectors are made orthogonal
ROUNDS = 4  # of inverse iteration; two suffice for a shift that is right to the last digits


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the unit vectors of the reflections that lead to them."""
    a = np.array(matrix, float)
    reflections = []
    for at in range(len(a) - 2):
        column = a[at + 1:, at].copy()
        size = np.linalg.norm(column)
        vector = np.zeros_like(column)
        if np.any(column[1:]):
            vector = column
            vector[0] += np.copysign(size, column[0])
            vector /= np.linalg.norm(vector)
            rest = a[at + 1:, at + 1:]
            moved = rest @ vector
            moved -= (vector @ moved) * vector
            rest -= 2 * (np.outer(vector, moved) + np.outer(moved, vector))
            a[at + 1:, at] -= 2 * vector * (vector @ a[at + 1:, at])
            a[at, at + 1:] = a[at + 1:, at]
        reflections.append(vector)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each shift: negative terms of the sequence of pivots."""
    tiny = np.finfo(float).tiny
    squares = np.concatenate([[0.0], off ** 2])
    count, pivot = np.zeros(len(shifts), int), np.ones(len(shifts))
    for value, square in zip(diagonal, squares):
        pivot = value - shifts - square / pivot
        pivot = np.where(np.abs(pivot) < tiny ** 0.5, -(tiny ** 0.5), pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, wanted: int) -> np.ndarray:
    """The ``wanted`` largest eigenvalues, falling, each by bisection between bounds that hold all of them."""
    count = len(diagonal)
    around = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    below = count - 1 - np.arange(wanted)  # eigenvalues below the wanted one
    low, high = np.full(wanted, (diagonal - around).min()), np.full(wanted, (diagonal + around).max())
    for _ in range(2000):
        middle = low + (high - low) / 2
        if not np.any((middle > low) & (middle < high)):
            break
        less = sturm_counts(diagonal, off, middle) <= below
        low, high = np.where(less, middle, low), np.where(less, high, middle)
    return low + (high - low) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """(T - shift) x = right by elimination with row exchanges; a vanishing pivot counts as rounding."""
    count = len(diagonal)
    tiny = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), 1e-300)
    main, first, second = diagonal - shift, np.append(off, 0.0), np.zeros(count)
    x = right.copy()
    for i in range(count - 1):
        lower = off[i]
        if abs(lower) > abs(main[i]):
            factor = main[i] / lower
            main[i], first[i], main[i + 1], second[i] = lower, main[i + 1], first[i] - factor * main[i + 1], first[i + 1]
            first[i + 1] *= -factor
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            factor = lower / (main[i] if abs(main[i]) > tiny else tiny)
            main[i + 1] -= factor * first[i]
            x[i + 1] -= factor * x[i]
    for i in range(count - 1, -1, -1):
        rest = x[i]
        if i + 1 < count:
            rest -= first[i] * x[i + 1]
        if i + 2 < count:
            rest -= second[i] * x[i + 2]
        x[i] = rest / (main[i] if abs(main[i]) > tiny else np.copysign(tiny, main[i] or 1.0))
    return x


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (all, if fewer), falling, and their unit vectors as rows. Each vector's entry of
    largest size is positive."""
    count = len(matrix)
    wanted = min(wanted, count)
    scale = float(np.abs(matrix).max(initial=0.0))
    if not wanted or not scale:
        return np.zeros(wanted), np.eye(wanted, count)
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, wanted)
    size = np.abs(diagonal).max() + np.abs(off).max(initial=0)
    start = np.random.default_rng(1)
    vectors = np.zeros((wanted, count))
    for i, value in enumerate(values):
        near = [j for j in range(i) if abs(values[j] - value) <= CLOSE * size]
        x = start.standard_normal(count)
        for _ in range(ROUNDS):
            x = _solve(diagonal, off, value, x / np.linalg.norm(x))
            x /= np.abs(x).max()
            for _ in range(2):  # twice, as one pass leaves rounding where much was taken away
                for j in near:
                    x -= (vectors[j] @ x) * vectors[j]
        vectors[i] = x / np.linalg.norm(x)
    for at in range(len(reflections) - 1, -1, -1):
        part = vectors[:, at + 1:]
        part -= 2 * np.outer(part @ reflections[at], reflections[at])
    sign = np.sign(vectors[np.arange(wanted), np.abs(vectors).argmax(axis=1)])
    return values * scale, vectors * sign[:, None]
