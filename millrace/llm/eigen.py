"""Leading eigenpairs of a symmetric matrix: Householder tridiagonalisation, Sturm counts, inverse iteration."""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
#: Neighbouring eigenvalues closer than this share of the matrix norm form a cluster.
CLUSTER = 1e-3


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and unit eigenvectors as rows; the largest entry of each is positive."""
    n = len(matrix)
    k = min(k, n)
    scale = np.abs(matrix).max(initial=0.0)
    if scale == 0:
        return np.zeros(k), np.eye(k, n)
    diagonal, beside, reflectors = tridiagonal(matrix / scale)
    values = largest(diagonal, beside, k)
    vectors = inverse_iteration(diagonal, beside, values)
    for at in range(len(reflectors) - 1, -1, -1):
        v = reflectors[at]
        vectors[:, at + 1 :] -= 2 * np.outer(vectors[:, at + 1 :] @ v, v)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors *= np.sign(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=1)[:, None], axis=1))
    return values * scale, vectors


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit Householder vectors that led there."""
    a, n = matrix.astype(float, copy=True), len(matrix)
    beside, reflectors = np.zeros(max(n - 1, 0)), []
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        beside[k] = -length if v[0] > 0 else length
        v[0] -= beside[k]
        size = np.linalg.norm(v)
        if size > 0:
            v /= size
            p = a[k + 1 :, k + 1 :] @ v
            q = p - (v @ p) * v
            a[k + 1 :, k + 1 :] -= 2 * (np.outer(v, q) + np.outer(q, v))
        reflectors.append(v)
    if n > 1:
        beside[-1] = a[-1, -2]
    return np.diag(a).copy(), beside, reflectors


def sturm_counts(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of the given points."""
    least = _EPS**2
    squares = np.concatenate(([0.0], beside**2))
    q, below = np.ones(len(at)), np.zeros(len(at), dtype=int)
    for d, s in zip(diagonal, squares, strict=True):
        q = d - at - s / q
        q = np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def largest(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues by bisection, to the last bits."""
    n = len(diagonal)
    reach = np.concatenate(([0.0], np.abs(beside), [0.0]))
    reach = reach[:-1] + reach[1:]
    low = np.full(k, (diagonal - reach).min() - _EPS)
    high = np.full(k, (diagonal + reach).max() + _EPS)
    index = n - 1 - np.arange(k)
    for _ in range(120):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        above = sturm_counts(diagonal, beside, middle) <= index
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


def _solver(diagonal: np.ndarray, beside: np.ndarray, shift: float):
    """Gaussian elimination with row exchanges of the shifted tridiagonal matrix, ready to solve."""
    n = len(diagonal)
    norm = np.abs(diagonal).max() + 2 * np.abs(beside).max(initial=0.0)
    least = _EPS * norm
    first, second, third = (diagonal - shift).tolist(), [*beside.tolist(), 0.0], [0.0] * n
    steps = []
    for i in range(n - 1):
        under = float(beside[i])
        exchange = abs(under) > abs(first[i])
        if exchange:
            below = (first[i + 1], second[i + 1])
            factor = first[i] / under
            first[i + 1] = second[i] - factor * below[0]
            second[i + 1] = -factor * below[1]
            first[i], second[i], third[i] = under, below[0], below[1]
        else:
            if abs(first[i]) < least:
                first[i] = least
            factor = under / first[i]
            first[i + 1] -= factor * second[i]
        steps.append((exchange, factor))
    if abs(first[-1]) < least:
        first[-1] = least

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.tolist()
        for i, (exchange, factor) in enumerate(steps):
            if exchange:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factor * x[i]
        for i in range(n - 1, -1, -1):
            value = x[i]
            if i + 1 < n:
                value -= second[i] * x[i + 1]
            if i + 2 < n:
                value -= third[i] * x[i + 2]
            x[i] = value / first[i]
        return np.array(x)

    return solve


def inverse_iteration(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as rows; those of a cluster are made orthogonal to each other in every step."""
    n = len(diagonal)
    norm = np.abs(diagonal).max() + 2 * np.abs(beside).max(initial=0.0)
    found, cluster = np.zeros((len(values), n)), 0
    chance = np.random.default_rng(n)
    shift = np.inf
    for c, value in enumerate(values):
        if c and values[c - 1] - value > CLUSTER * norm:
            cluster = c
        # equal eigenvalues get shifts a few last bits apart, so that their systems differ
        shift = min(value, shift - 10 * _EPS * norm) if c > cluster else value
        solve = _solver(diagonal, beside, shift)
        x = chance.standard_normal(n)
        for _ in range(5):
            others = found[cluster:c]
            x = x - others.T @ (others @ x)
            x = solve(x / np.linalg.norm(x))
            size = np.abs(x).max()
            x = x / size
            x = x - others.T @ (others @ x)
            x /= np.linalg.norm(x)
        found[c] = x
    return found
