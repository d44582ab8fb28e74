"""Largest singular values and right singular vectors of a small square matrix.

A matrix is reduced to an upper bidiagonal B by Householder reflections.  The
differential qd transform with shifts (dqds) finds the eigenvalues of B'B with
a small relative error, as it adds and multiplies positive numbers only; shifts
are the safe bound 1 / trace of the inverse, which the transform without shift
gives on the way.  Each wanted eigenvector of B'B comes from a twisted
factorisation: one factored from the top, one from the bottom, joined where the
remainder is least.  Vectors of close eigenvalues are made orthogonal by
inverse iteration with the same factors.

Work is cubic in the dimension and does not depend on the rows behind it.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
NEGLIGIBLE = (100 * EPS) ** 2       # of a squared coupling, beside its neighbours
CLOSE = 0.1                         # relative gap under which vectors are made orthogonal


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit w for which (I - 2 w w') x lies on the first axis; None if it does already."""
    size = np.abs(x).max(initial=0.0)
    if size == 0 or not np.any(x[1:]):
        return None
    w = x / size
    w[0] += np.copysign(np.linalg.norm(w), w[0])
    return w / np.linalg.norm(w)


def bidiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) of B, where a = U B V' with orthogonal U and V."""
    a = np.array(a, float)
    n = len(a)
    v = np.eye(n)
    for j in range(n):
        w = _reflector(a[j:, j])
        if w is not None:
            a[j:, j:] -= 2 * np.outer(w, w @ a[j:, j:])
        w = _reflector(a[j, j + 1:])
        if w is not None:
            a[j:, j + 1:] -= 2 * np.outer(a[j:, j + 1:] @ w, w)
            v[:, j + 1:] -= 2 * np.outer(v[:, j + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """(q, e, d) after one transform with a shift; None if the shift passes the least eigenvalue."""
    d, left = q[0] - shift, []
    new_q, new_e = [], []
    for i in range(len(e)):
        if d < 0:
            return None
        left.append(d)
        top = d + e[i]
        new_q.append(top)
        ratio = q[i + 1] / top if top > 0 else 0.0
        new_e.append(e[i] * ratio)
        d = (d * ratio if top > 0 else q[i + 1]) - shift
    if d < 0:
        return None
    return [*new_q, d], new_e, [*left, d]


def qd_eigenvalues(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Eigenvalues of B'B in falling order, by dqds with deflation and splitting."""
    found = []
    parts = [(list(map(float, diagonal ** 2)), list(map(float, above ** 2)), 0.0)]
    while parts:
        q, e, shifted = parts.pop()
        while len(q) > 1:
            cut = next((i for i in range(len(e) - 1, -1, -1)
                        if e[i] <= NEGLIGIBLE * (min(q[i], q[i + 1]) + shifted)
                        or e[i] <= EPS * shifted and q[i] * e[i] <= (EPS * shifted) ** 2), None)
            if cut is not None:
                parts.append((q[:cut + 1], e[:cut], shifted))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            q, e, d = _dqds(q, e, 0.0)
            if min(d) <= 0:
                continue
            bound = (1 - 1e-12) / sum(1 / x for x in d)       # at most the least eigenvalue
            step = _dqds(q, e, bound) if bound > EPS * shifted else None
            if step:
                q, e, _ = step
                shifted += bound
        found.append(q[0] + shifted)
    return np.array(sorted(found, reverse=True))


class Twisted:
    """B'B - value I, factored from the top down to a row and from the bottom up to it."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float) -> None:
        n = len(diagonal)
        q, e, side = diagonal ** 2, above ** 2, diagonal[:-1] * above
        tiny = EPS * EPS * max(float((q.max() + e.max(initial=0.0))), np.finfo(float).tiny)
        s, p = np.empty(n), np.empty(n)
        self.top, self.bottom = np.empty(n), np.empty(n)
        s[0] = -value
        for i in range(n):
            self.top[i] = (s[i] + q[i]) or tiny
            if i + 1 < n:
                s[i + 1] = e[i] / self.top[i] * s[i] - value
        p[n - 1] = q[n - 1] - value
        self.bottom[n - 1] = p[n - 1] or tiny
        for i in range(n - 2, -1, -1):
            full = (e[i] + p[i + 1]) or tiny
            self.bottom[i + 1] = full
            p[i] = p[i + 1] * (q[i] / full) - value
        rest = s + p + value
        rest[~np.isfinite(rest)] = np.inf
        self.at = int(np.abs(rest).argmin())
        self.middle = rest[self.at] or tiny
        self.down = side / self.top[:-1]                 # multipliers above the twist
        self.up = side / self.bottom[1:]                 # and under it

    def back(self, z: np.ndarray) -> np.ndarray:
        for i in range(self.at - 1, -1, -1):
            z[i] -= self.down[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] -= self.up[i] * z[i]
        return z

    def vector(self) -> np.ndarray:
        """The eigenvector: the twist row is 1, the others follow from it."""
        z = np.zeros(len(self.top))
        z[self.at] = 1
        z = self.back(z)
        return z / np.linalg.norm(z)

    def solve(self, x: np.ndarray) -> np.ndarray:
        z = x.copy()
        for i in range(self.at):
            z[i + 1] -= self.down[i] * z[i]
        for i in range(len(z) - 1, self.at, -1):
            z[i - 1] -= self.up[i - 1] * z[i]
        z[:self.at] /= self.top[:self.at]
        z[self.at + 1:] /= self.bottom[self.at + 1:]
        z[self.at] /= self.middle
        return self.back(z)


def _without(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for o in others:
            x = x - (o @ x) * o
    return x


def _eigenvector(diagonal: np.ndarray, above: np.ndarray, value: float, close: list[np.ndarray]) -> np.ndarray:
    factors = Twisted(diagonal, above, value)
    z = factors.vector()
    if not close and np.all(np.isfinite(z)):
        return z
    rest = _without(z, close)
    if not np.all(np.isfinite(rest)) or np.linalg.norm(rest) < 0.9:
        # another vector of the same few directions: inverse iteration from a fixed start, away from those found
        rest = _without(np.random.default_rng(len(close)).normal(size=len(z)), close)
        for _ in range(3):
            rest = _without(factors.solve(rest / np.abs(rest).max()), close)
            rest /= np.linalg.norm(rest)
    return rest / np.linalg.norm(rest)


def directions(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest squared singular values of ``r`` and their right singular vectors, as columns.

    Values under ``len(r) * EPS`` times the largest singular value count as
    none, so a matrix of lower rank gives fewer.  A vector's largest entry is
    positive.
    """
    scale = np.abs(r).max(initial=0.0)
    if scale == 0:
        return np.zeros(0), np.zeros((len(r), 0))
    diagonal, above, v = bidiagonalise(r / scale)
    cuts = np.flatnonzero(np.abs(above) <= EPS * np.minimum(np.abs(diagonal[:-1]), np.abs(diagonal[1:])))
    edges = [0, *(cuts + 1).tolist(), len(diagonal)]
    found = []
    for a, b in zip(edges, edges[1:]):
        found += [(value, a, b) for value in qd_eigenvalues(diagonal[a:b], above[a:b - 1])]
    found.sort(key=lambda x: (-x[0], x[1]))
    least = (len(r) * EPS) ** 2 * found[0][0]
    values, vectors = [], []
    for value, a, b in found[:k]:
        if value <= least:
            break
        close = [z[a:b] for w, z, at in vectors if at == a and w - value <= CLOSE * w]
        z = np.zeros(len(diagonal))
        z[a:b] = _eigenvector(diagonal[a:b], above[a:b - 1], value, close)
        vectors.append((value, z, a))
        values.append(value)
    out = np.column_stack([v @ z for _, z, _ in vectors])
    out *= np.where(out[np.abs(out).argmax(0), np.arange(out.shape[1])] < 0, -1.0, 1.0)
    return np.array(values) * scale ** 2, out
