"""Right singular vectors of a small triangular factor: bidiagonal form, qd values, twisted vectors.

The matrices here are as wide as an embedding, whatever the number of rows. Householder reflections bring R to an upper
bidiagonal B; the dqds recurrence finds the squares of its singular values without forming B'B, so that small ones keep
their relative accuracy; the vector of each value comes from a twisted factorisation of B'B less that value, joined at
the pivot of least size. Vectors of values that lie close together are made orthogonal as they are refined.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
TINY = np.finfo(np.float64).tiny
#: Values nearer than this share of the larger one are a cluster.
CLUSTER = 1e-3
SWEEPS = 60


def reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(v, beta, alpha): I - beta v v' turns x into alpha times the first unit vector."""
    scale = np.abs(x).max(initial=0.0)
    if scale == 0 or not np.any(x[1:]):
        return np.zeros_like(x), 0.0, float(x[0]) if len(x) else 0.0
    v = x / scale
    norm = np.sqrt(v @ v)
    alpha = -np.copysign(norm, v[0])
    v[0] -= alpha
    return v, 2.0 / (v @ v), float(alpha * scale)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, q): diagonal and superdiagonal of U' r q, with q orthogonal."""
    a = np.array(r, np.float64)
    d = a.shape[1]
    q = np.eye(d)
    diagonal, above = np.zeros(d), np.zeros(max(d - 1, 0))
    for k in range(d):
        v, beta, alpha = reflector(a[k:, k].copy())
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        diagonal[k] = alpha
        if k < d - 1:
            v, beta, alpha = reflector(a[k, k + 1 :].copy())
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
            q[:, k + 1 :] -= beta * np.outer(q[:, k + 1 :] @ v, v)
            above[k] = alpha
    return diagonal, above, q


def dqds_step(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One transform with a shift; the least d tells whether the shift was below all values."""
    n = len(q)
    new_q, new_e = np.empty(n), np.empty(n - 1)
    d = least = q[0] - shift
    for k in range(n - 1):
        new_q[k] = d + e[k]
        if new_q[k] == 0:
            new_q[k] = TINY
        t = q[k + 1] / new_q[k]
        new_e[k] = e[k] * t
        d = d * t - shift
        least = min(least, d) if d == d else -np.inf
    new_q[n - 1] = d
    return new_q, new_e, least


def tail_value(q: np.ndarray, e: np.ndarray) -> float:
    """The smaller eigenvalue of the trailing two rows."""
    a, b, c = q[-2] + (e[-3] if len(e) > 2 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    half = (a - b) / 2
    return max(0.0, b - c / (abs(half) + np.sqrt(half * half + c)) if half >= 0 else a - c / (abs(half) + np.sqrt(half * half + c)))


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the upper bidiagonal matrix (a, b), falling."""
    largest = max(np.max(np.abs(a), initial=0.0), np.max(np.abs(b), initial=0.0))
    if largest == 0:
        return np.zeros(len(a))
    found: list[float] = []
    parts = [((a / largest) ** 2, (b / largest) ** 2, 0.0)]
    sweeps = 0
    while parts:
        q, e, shifted = parts.pop()
        while len(q) > 1:
            negligible = np.flatnonzero(e <= 100 * EPS * EPS * (shifted + np.minimum(q[:-1], q[1:])))
            if len(negligible):
                k = int(negligible[-1])
                parts.append((q[: k + 1], e[:k], shifted))
                q, e = q[k + 1 :], e[k + 1 :]
                continue
            sweeps += 1
            if sweeps > SWEEPS * len(a):
                raise ArithmeticError("the qd values did not settle")
            shift = tail_value(q, e) * (1 - 4 * EPS)
            new_q, new_e, least = dqds_step(q, e, shift)
            while not least >= 0 and shift > 0:
                # above the smallest value: the failed step tells by how much, and no shift at all is always safe
                lower = shift + least if np.isfinite(least) else 0.0
                shift = 0.99 * lower if 0 < lower < 0.9 * shift else 0.25 * shift
                shift = shift if shift > EPS * (shifted + q.min()) else 0.0
                new_q, new_e, least = dqds_step(q, e, shift)
            q, e, shifted = new_q, new_e, shifted + shift
        found.extend(shifted + np.maximum(q, 0.0))
    return np.sort(np.array(found))[::-1] * largest * largest


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit vector of B'B for one of its values: factors from both ends, joined where the pivot between them is least."""
    n = len(a)
    floor = EPS * EPS * max(float(np.max(a * a)), float(np.max(b * b, initial=0.0)), TINY)
    low, high, s, p = np.zeros(n - 1), np.zeros(n - 1), np.empty(n), np.empty(n)

    def pivot(x: float) -> float:
        return x if abs(x) > floor else floor

    s[0] = -value
    for k in range(n - 1):  # stationary, downwards
        down = pivot(s[k] + a[k] * a[k])
        low[k] = a[k] * b[k] / down
        s[k + 1] = b[k] * b[k] * (s[k] / down) - value
    p[n - 1] = a[n - 1] * a[n - 1] - value
    for k in range(n - 2, -1, -1):  # progressive, upwards
        up = pivot(b[k] * b[k] + p[k + 1])
        high[k] = a[k] * b[k] / up
        p[k] = a[k] * a[k] * (p[k + 1] / up) - value
    twist = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -low[k] * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -high[k] * z[k]
    z /= np.abs(z).max()
    return z / np.sqrt(z @ z)


def refined(a: np.ndarray, b: np.ndarray, value: float, before: np.ndarray, number: int) -> np.ndarray:
    """Inverse iteration within a cluster, orthogonal to the vectors already found (rows of `before`)."""
    n = len(a)
    diagonal = a * a
    diagonal[1:] += b * b
    beside = a[:-1] * b
    scale = max(float(np.max(diagonal)), TINY)
    matrix = np.diag(diagonal - value * (1 + 2 * EPS)) + np.diag(beside, 1) + np.diag(beside, -1)
    matrix[np.diag_indices(n)] += EPS * scale * EPS
    z = np.cos(np.arange(1, n + 1) * (number + 1.0))  # any start that is not orthogonal to the cluster
    for _ in range(4):
        for _ in range(2):
            z = z - before.T @ (before @ z)
        z /= np.sqrt(z @ z)
        try:
            z = np.linalg.solve(matrix, z)
        except np.linalg.LinAlgError:
            matrix[np.diag_indices(n)] += EPS * scale
            z = np.linalg.solve(matrix, z)
        z /= np.abs(z).max()
    for _ in range(2):
        z = z - before.T @ (before @ z)
        z /= np.sqrt(z @ z)
    return z


def blocks(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows that a zero above the diagonal parts from the others."""
    size = np.abs(a[:-1]) + np.abs(a[1:])
    cuts = [0, *(np.flatnonzero(np.abs(b) <= EPS * size * 1e-2) + 1).tolist(), len(a)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def right_singular(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the `count` largest squared singular values of r, falling, and their unit right vectors as rows.

    Values that are zero but for rounding are left out. A vector's entry of greatest size is positive.
    """
    a, b, q = bidiagonalise(r)
    ranges = blocks(a, b)
    own = [dqds(a[i:j], b[i : j - 1]) for i, j in ranges]
    every = sorted(((-v, block, k) for block, values in enumerate(own) for k, v in enumerate(values)))
    floor = (16 * len(a) * EPS) ** 2 * max((-v for v, _, _ in every), default=0.0)
    wanted = [(block, k) for v, block, k in every[:count] if -v > floor]
    made: dict[tuple[int, int], np.ndarray] = {}
    for block, (i, j) in enumerate(ranges):
        group: list[np.ndarray] = []
        for k in range(sum(w[0] == block for w in wanted)):
            value = own[block][k]
            if k and own[block][k - 1] - value > CLUSTER * own[block][k - 1]:
                group = []
            z = None if group else twisted_vector(a[i:j], b[i : j - 1], value)
            if z is None or not np.isfinite(z).all():
                z = refined(a[i:j], b[i : j - 1], value, np.array(group).reshape(len(group), j - i), k)
            group.append(z)
            made[block, k] = q[:, i:j] @ z
    vectors = np.array([made[w] for w in wanted]).reshape(len(wanted), len(a))
    peak = np.abs(vectors).argmax(axis=1) if len(wanted) else np.zeros(0, int)
    vectors *= np.sign(vectors[np.arange(len(vectors)), peak])[:, None]
    return np.array([own[block][k] for block, k in wanted]), vectors
