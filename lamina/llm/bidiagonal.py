"""Singular values and right singular vectors of a small square matrix by way of a bidiagonal one.

Householder reflections make the matrix upper bidiagonal. The differential quotient-difference algorithm
with shifts (dqds) finds the singular values to high relative accuracy, and a twisted factorisation gives
the vector of each value. Only the d x d factor of a QR decomposition comes here, never rows.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Neighbouring values closer than this share of the larger one are treated together.
CLOSE = 1e-3
#: Singular values up to this share of the largest are rounding of dependent columns.
ROUNDING = 1e-12


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, V): matrix = U B V' with a on the diagonal of B and b above it."""
    work = np.array(matrix, float)
    size = len(work)
    right = np.eye(size)
    for k in range(size):
        _reflect(work[k:, k:], work[k:, k])
        if k + 2 < size:
            direction = _reflect(work[k:, k + 1 :].T, work[k, k + 1 :])
            if direction is not None:
                right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ direction, direction)
    return np.diag(work).copy(), np.diag(work, 1).copy(), right


def _reflect(rows: np.ndarray, column: np.ndarray) -> np.ndarray | None:
    """Applies to the rows, in place, the reflection that leaves only the first entry of the column."""
    direction = column.copy()
    length = np.linalg.norm(direction)
    if length == 0:
        return None
    direction[0] += np.copysign(length, direction[0])
    direction /= np.linalg.norm(direction)
    rows -= 2 * np.outer(direction, direction @ rows)
    return direction


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal matrix, falling."""
    largest = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if largest == 0:
        return np.zeros(len(a))
    found = []
    parts = [([*(a / largest) ** 2], [*(b / largest) ** 2], 0.0)]
    tiny = (4 * EPS) ** 2
    while parts:
        q, e, moved = parts.pop()
        while len(q) > 1:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= tiny * (moved + min(q[i], q[i + 1])) or e[i] < 1e-300), None)
            if cut is not None:
                # A negligible entry: the parts on its two sides are independent.
                parts.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if q[0] < q[-1]:
                q.reverse()
                e.reverse()
            shift = _smallest(q[-2], e[-1], q[-1])
            for attempt in range(4):
                if done := _transformed(q, e, shift):
                    break
                shift = shift / 2 if attempt < 2 else 0.0
            q, e = done
            moved += shift
        found += [moved + value for value in q]
    return np.sort(np.array(found) * largest**2)[::-1]


def _smallest(upper: float, between: float, lower: float) -> float:
    """A shift a little below the smaller eigenvalue of the last two rows; the step is undone where it is too large."""
    total, product = upper + between + lower, upper * lower
    root = np.sqrt(max(total * total / 4 - product, 0.0))
    return float(product / (total / 2 + root)) * (1 - 1e-8) if total else 0.0


def _transformed(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One step of the algorithm, or None if the shift was above the smallest value."""
    new_q, new_e, d = [], [], q[0] - shift
    for i, between in enumerate(e):
        if d < 0:
            return None
        pivot = d + between
        ratio = q[i + 1] / pivot if pivot else 0.0
        new_q.append(pivot)
        new_e.append(between * ratio)
        d = d * ratio - shift if pivot else q[i + 1] - shift
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B for an eigenvalue, by the factorisation twisted where it is nearest to singular."""
    size = len(a)
    safe = np.where(np.abs(a) > EPS * np.abs(a).max(), a, EPS * np.abs(a).max())
    diagonal, lower = safe**2, b / safe[:-1]
    nothing = EPS**2 * diagonal.max()
    down, s = np.zeros(size - 1), np.full(size, -value)
    for i in range(size - 1):
        pivot = diagonal[i] + s[i]
        pivot = pivot if abs(pivot) > nothing else nothing
        down[i] = lower[i] * diagonal[i] / pivot
        s[i + 1] = down[i] * lower[i] * s[i] - value
    up, p = np.zeros(size - 1), np.full(size, diagonal[-1] - value)
    for i in range(size - 2, -1, -1):
        pivot = diagonal[i] * lower[i] ** 2 + p[i + 1]
        pivot = pivot if abs(pivot) > nothing else nothing
        up[i] = lower[i] * diagonal[i] / pivot
        p[i] = p[i + 1] * diagonal[i] / pivot - value
    at = int(np.argmin(np.abs(s + p + value)))
    vector = np.zeros(size)
    vector[at] = 1
    for i in range(at - 1, -1, -1):
        vector[i] = -down[i] * vector[i + 1]
    for i in range(at, size - 1):
        vector[i + 1] = -up[i] * vector[i]
    return vector / np.linalg.norm(vector)


def principal(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the largest squared singular values, falling, and their right vectors as columns.

    The largest entry of each vector is positive. Directions whose value is no more than rounding are
    left out. Values that nearly coincide have no directions of their own to working precision; theirs
    are made orthogonal together by inverse iteration on the whole group.
    """
    a, b, right = bidiagonal(matrix)
    size = len(a)
    # Where the bidiagonal matrix falls apart, each part has its own values and vectors.
    edges = np.flatnonzero(np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:])))
    begins, ends = [0, *(edges + 1)], [*(edges + 1), size]
    pairs = sorted(
        ((value, begin, end) for begin, end in zip(begins, ends) for value in dqds(a[begin:end], b[begin : end - 1])),
        key=lambda pair: -pair[0],
    )
    values = np.array([pair[0] for pair in pairs])
    rank = int(np.count_nonzero(values > ROUNDING**2 * values[0])) if size else 0
    keep = min(most, rank)
    stop = keep
    while 0 < stop < rank and values[stop - 1] - values[stop] < CLOSE * values[stop - 1]:
        stop += 1
    vectors = np.zeros((size, stop))
    for k, (value, begin, end) in enumerate(pairs[:stop]):
        vectors[begin:end, k] = twisted(a[begin:end], b[begin : end - 1], value)
    gram = np.diag(a**2) + np.diag(np.append(0.0, b**2)[:size])
    gram += np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    first = 0
    for k in range(1, stop + 1):
        if k == stop or values[k - 1] - values[k] >= CLOSE * values[k - 1]:
            group = slice(first, k)
            if k - first > 1:
                vectors[:, group] = _together(gram, values[group], vectors[:, group])
            first = k
    vectors = right @ vectors[:, :keep]
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(keep)])
    return values[:keep], vectors * signs


def _together(gram: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Orthogonal eigenvectors of a group of close eigenvalues, near the vectors given if those are sound."""
    wide = np.abs(vectors.T @ vectors - np.eye(len(values))).max()
    if wide > 1e-6:
        draws = np.random.default_rng(len(values)).standard_normal(vectors.shape)
        vectors = np.linalg.qr(vectors + 1e-3 * draws)[0]
    moved = gram - np.eye(len(gram)) * (values[0] + values[-1]) / 2 * (1 + 16 * EPS)
    for _ in range(3 if wide > 1e-6 else 1):
        vectors = np.linalg.qr(np.linalg.solve(moved, vectors))[0]
    within, turn = np.linalg.eigh(vectors.T @ gram @ vectors)
    return vectors @ turn[:, ::-1]
