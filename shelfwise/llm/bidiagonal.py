"""Singular values and right singular vectors of a small triangular factor.

Householder reflections make the factor bidiagonal, the differential qd algorithm with shifts
(dqds) finds its singular values to high relative accuracy, and a twisted factorisation at each
of them gives the vector. Everything here is of the size of the vectors' length squared.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
CLOSE = 1e-3
"""Relative gap below which neighbouring vectors are made orthogonal to each other explicitly."""


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit vector v with (I - 2 v v') x = alpha e1."""
    alpha = -np.copysign(np.sqrt((x * x).sum()), x[0])
    v = x.copy()
    v[0] -= alpha
    norm = np.sqrt((v * v).sum())
    return (v / norm if norm > 0 else v), float(alpha)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and W with r = U B W', all orthogonal but B."""
    work = np.array(r, dtype=np.float64)
    n = len(work)
    right = np.eye(n)
    for k in range(n):
        v, _ = _reflector(work[k:, k])
        work[k:, k:] -= 2 * np.outer(v, v @ work[k:, k:])
        if k < n - 2:
            v, _ = _reflector(work[k, k + 1 :])
            work[k:, k + 1 :] -= 2 * np.outer(work[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(work).copy(), np.diag(work, 1).copy(), right


def _lower_bound(q: list[float], e: list[float]) -> float:
    """1 / trace of the inverse: no squared singular value lies below it. One pass of the qd algorithm without shift."""
    d, total = q[0], 0.0
    for k in range(len(q)):
        if d <= 0:
            return 0.0
        total += 1 / d
        if k < len(e):
            d = d * (q[k + 1] / (d + e[k]))
    return 1 / total if total < float("inf") else 0.0


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One transform of the differential qd algorithm with shift; None if the shift was too large."""
    out_q, out_e, d = [], [], q[0] - shift
    for k in range(len(e)):
        if d < 0:
            return None
        top = d + e[k]
        if top == 0:  # decoupled
            out_q.append(0.0)
            out_e.append(0.0)
            d = q[k + 1] - shift
            continue
        t = q[k + 1] / top
        out_q.append(top)
        out_e.append(e[k] * t)
        d = d * t - shift
    if d < 0:
        return None
    return [*out_q, d], out_e


def squared_values(a: np.ndarray, b: np.ndarray) -> list[float]:
    """The squares of the singular values of a bidiagonal matrix, largest first, by dqds.

    A block is split where an offdiagonal entry is negligible. The shift is a proven lower bound,
    so a transform fails only by rounding and is then repeated without one.
    """
    found: list[float] = []
    todo = [([float(x * x) for x in a], [float(x * x) for x in b], 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        while len(q) > 1:
            if e[-1] <= EPS * EPS * (sigma + q[-1]):
                found.append(sigma + q.pop())
                e.pop()
                continue
            cut = next((k for k in range(len(e)) if e[k] <= EPS * EPS * (sigma + min(q[k], q[k + 1]))), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], sigma))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:  # graded the wrong way round
                q, e = q[::-1], e[::-1]
            shift = 0.9999 * _lower_bound(q, e)
            if sigma + shift == sigma:
                shift = 0.0
            made = _sweep(q, e, shift)
            if made is None:
                made, shift = _sweep(q, e, 0.0), 0.0
            (q, e), sigma = made, sigma + shift
            if max(q) <= EPS * sigma:  # what is left is one cluster at sigma
                found.extend([sigma] * (len(q) - 1))
                q, e = q[:1], []
        found.append(sigma + q[0])
    return sorted(found, reverse=True)


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Right singular vector of a bidiagonal matrix without zeros for a squared singular value.

    L D L' = B'B is factored from the top by the stationary and from the bottom by the progressive
    qd transform; the two meet where the remaining pivot is smallest, and the vector is solved for
    from there in both directions.
    """
    n = len(a)
    low, pivot = b / a[:-1], a * a
    s, p = np.empty(n), np.empty(n)
    down, up = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
    tiny = EPS * EPS * max(value, float(pivot.max()))
    s[0] = -value
    for k in range(n - 1):
        top = pivot[k] + s[k]
        top = top if abs(top) > tiny else tiny
        down[k] = pivot[k] * low[k] / top
        s[k + 1] = down[k] * low[k] * s[k] - value
    p[n - 1] = pivot[n - 1] - value
    for k in range(n - 2, -1, -1):
        bottom = pivot[k] * low[k] * low[k] + p[k + 1]
        bottom = bottom if abs(bottom) > tiny else tiny
        t = pivot[k] / bottom
        up[k] = low[k] * t
        p[k] = p[k + 1] * t - value
    twist = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -down[k] * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -up[k] * z[k]
    return z / np.sqrt((z * z).sum())


def _orthogonal(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """z without its parts along `others`, as a unit vector; taken twice against rounding."""
    for other in others * 2:
        z = z - (z @ other) * other
    return z / np.sqrt((z * z).sum())


def _again(a: np.ndarray, b: np.ndarray, value: float, others: list[np.ndarray], seed: int) -> np.ndarray:
    """A vector of a multiple value that is orthogonal to `others`, by inverse iteration from a random start."""
    square = np.diag(a * a) + np.diag(np.r_[0.0, b * b]) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    near = square - (value * (1 + 16 * EPS) + EPS * EPS * np.abs(square).max()) * np.eye(len(a))
    z = _orthogonal(np.random.default_rng(seed).normal(size=len(a)), others)
    for _ in range(4):
        z = _orthogonal(np.linalg.solve(near, z), others)
    return z


def leading(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Squared singular values and right singular vectors (columns) of a triangular factor for its `most` largest
    values, largest first, and the sum of all squares. Values that are zero up to rounding are left out."""
    total = float((r * r).sum())
    scale = float(np.abs(r).max())
    if not scale > 0:
        return np.empty(0), np.empty((len(r), 0)), 0.0
    a, b, right = bidiagonalise(r / scale)
    size = max(np.abs(a).max(), np.abs(b).max() if len(b) else 0.0)
    b = np.where(np.abs(b) <= 4 * EPS * size, 0.0, b)
    a = np.where(np.abs(a) <= EPS * size / len(a), EPS * size / len(a), a)  # far below the values that count
    edges = [0, *(np.flatnonzero(b == 0) + 1).tolist(), len(a)]
    blocks = [(i, j, squared_values(a[i:j], b[i : j - 1])) for i, j in zip(edges[:-1], edges[1:], strict=True)]
    wanted = sorted(((value, i, j) for i, j, values in blocks for value in values), key=lambda x: (-x[0], x[1]))[:most]
    wanted = [w for w in wanted if w[0] > (EPS * len(r)) ** 2 * wanted[0][0] * 100]
    vectors: list[np.ndarray] = []
    for k, (value, i, j) in enumerate(wanted):
        near = [z[i:j] for z, (other, first, _) in zip(vectors, wanted, strict=False) if first == i and other - value <= CLOSE * other]
        z = twisted_vector(a[i:j], b[i : j - 1], value)
        own = 1 - sum((z @ other) ** 2 for other in near)
        whole = np.zeros(len(a))
        whole[i:j] = _orthogonal(z, near) if own > 0.01 else _again(a[i:j], b[i : j - 1], value, near, k)
        vectors.append(whole)
    found = right @ np.array(vectors).T
    return np.array([w[0] for w in wanted]) * scale * scale, found, total
