"""Leading eigenpairs of a symmetric matrix of bounded size: Householder
tridiagonalisation, Sturm counts with bisection for the eigenvalues, inverse
iteration with reorthogonalisation inside clusters for the eigenvectors."""

from __future__ import annotations

import numpy as np


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit Householder vectors of ``a``."""
    a, n, mirrors = a.copy(), len(a), []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        length = np.sqrt(x @ x)
        v = x
        v[0] += np.copysign(length, x[0])
        norm = np.sqrt(v @ v)
        if norm > 0:
            v = v / norm
            block = a[k + 1 :, k + 1 :]
            p = block @ v
            w = p - (p @ v) * v
            block -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1 :, k] = a[k, k + 1 :] = 0
            a[k + 1, k] = a[k, k + 1] = -np.copysign(length, x[0])
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def _below(d: np.ndarray, e2: np.ndarray, x: np.ndarray, tiny: float) -> np.ndarray:
    """Sturm count: how many eigenvalues lie below each of ``x``."""
    q = d[0] - x
    count = (q < 0).astype(np.int64)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d[i] - x - e2[i - 1] / q
        count += q < 0
    return count


def leading(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` greatest eigenvalues, falling, all bisected at once."""
    n = len(d)
    reach = np.abs(np.append(e, 0)) + np.abs(np.append(0, e))
    lo, hi = float((d - reach).min()), float((d + reach).max())
    scale = max(abs(lo), abs(hi), np.finfo(float).tiny)
    lo, hi = np.full(k, lo - 1e-15 * scale), np.full(k, hi + 1e-15 * scale)
    rank = n - 1 - np.arange(k)  # counted from the least
    tiny = np.finfo(float).eps ** 2 * scale
    while True:
        mid = (lo + hi) / 2
        if ((mid <= lo) | (mid >= hi) | (hi - lo <= 1e-16 * scale)).all():
            return mid
        low = _below(d, e * e, mid, tiny) > rank
        lo, hi = np.where(low, lo, mid), np.where(low, mid, hi)


def _solve(d: np.ndarray, e: np.ndarray, x: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """Solution of ``(T - x) y = b``: elimination with row exchanges, pivots
    that vanish replaced by ``tiny``."""
    n = len(d)
    y, p, u, w = b.copy(), np.zeros(n), np.zeros(n), np.zeros(n)  # pivots and the two diagonals above
    here, above = d[0] - x, (e[0] if n > 1 else 0.0)
    for i in range(n - 1):
        nxt, up = d[i + 1] - x, (e[i + 1] if i + 2 < n else 0.0)
        if abs(e[i]) > abs(here):
            m = here / e[i]
            p[i], u[i], w[i] = e[i], nxt, up
            here, above = above - m * nxt, -m * up
            y[i], y[i + 1] = y[i + 1], y[i] - m * y[i + 1]
        else:
            here = here if abs(here) > tiny else tiny
            m = e[i] / here
            p[i], u[i] = here, above
            here, above = nxt - m * above, up
            y[i + 1] -= m * y[i]
    p[n - 1] = here if abs(here) > tiny else tiny
    for i in range(n - 1, -1, -1):
        s = y[i] - (u[i] * y[i + 1] if i + 1 < n else 0.0) - (w[i] * y[i + 2] if i + 2 < n else 0.0)
        y[i] = s / p[i]
    return y


def vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit eigenvector of the tridiagonal matrix for each of the falling
    ``values``. Vectors of values closer than a thousandth of the norm are
    kept orthogonal to each other."""
    n = len(d)
    scale = max(float(np.abs(d).max()), float(np.abs(e).max()) if len(e) else 0.0, np.finfo(float).tiny)
    out = np.zeros((len(values), n))
    rng, first = np.random.default_rng(11), 0
    for k, x in enumerate(values):
        if k and values[k - 1] - x > 1e-3 * scale:
            first = k
        shift = x - (k - first) * 4e-16 * scale  # equal values: shifts apart
        y = rng.standard_normal(n)
        for _ in range(5):
            for j in range(first, k):
                y -= (y @ out[j]) * out[j]
            y /= np.sqrt(y @ y)
            y = _solve(d, e, shift, y, 1e-17 * scale)
            y /= np.abs(y).max()
        for _ in range(2):
            for j in range(first, k):
                y -= (y @ out[j]) * out[j]
            y /= np.sqrt(y @ y)
        out[k] = y
    return out


def eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues, falling, and their unit eigenvectors
    as rows."""
    n = len(a)
    if not n or not k:
        return np.zeros(0), np.zeros((0, n))
    scale = float(np.abs(a).max())
    if not scale:
        return np.zeros(k), np.eye(k, n)
    d, e, mirrors = tridiagonal(a / scale)
    values = leading(d, e, k)
    rows = vectors(d, e, values)
    for at in range(len(mirrors) - 1, -1, -1):
        v = mirrors[at]
        rows[:, at + 1 :] -= 2 * np.outer(rows[:, at + 1 :] @ v, v)
    rows /= np.sqrt((rows * rows).sum(1, keepdims=True))
    return values * scale, rows
