"""Eigenvalues of a symmetric matrix in an interval, by contour integration (FEAST).

The spectral projector onto an interval is the integral of the resolvent
(zI - A)^-1 around it.  A few Gauss-Legendre nodes on the upper half circle,
each one complex shifted solve, apply it to a block of vectors; Rayleigh-Ritz
on the projected block gives eigenpairs, and the step is repeated until they
settle.  The number of eigenvalues in an interval is known beforehand from
the inertia of A - xI (Sylvester): the signs of a symmetric indefinite
factorisation's blocks.  A count that differs from the pairs found means a
missed one, so the block grows and the search is made again.
"""

from __future__ import annotations

import sys

import numpy as np

from retentia.session import ship_by_value

#: Nodes of the half circle; extra vectors beside the counted eigenvalues; refinements.
NODES, EXTRA, STEPS = 8, 6, 40
#: Pairs have settled when a step no longer halves their residual and it is below this share of the matrix's norm, a dimension.
SETTLED = 1e-14


def negatives(a: np.ndarray) -> int:
    """How many eigenvalues are below zero: signs of D in P A P' = L D L', D of 1 x 1 and 2 x 2 blocks (complete diagonal pivoting)."""
    a = np.array(a, float)
    limit = (1 + np.sqrt(17)) / 8
    count, k, n = 0, 0, len(a)
    zero = n * np.finfo(float).eps * np.abs(a).max(initial=0.0)
    while k < n:
        rest = np.abs(a[k:, k:])
        d = int(np.argmax(np.diag(rest)))
        i, j = np.unravel_index(int(np.argmax(rest)), rest.shape)
        if rest[i, j] <= zero:
            break  # the rest is zero but for rounding: no eigenvalue below
        one = rest[d, d] >= limit * rest[i, j]
        for at, chosen in enumerate([d] if one else sorted((int(i), int(j)))):
            x, y = k + at, k + chosen
            a[[x, y]] = a[[y, x]]
            a[:, [x, y]] = a[:, [y, x]]
        width = 1 if one else 2
        block = a[k : k + width, k : k + width]
        # A 2 x 2 block is chosen only if its determinant is negative.
        count += int(block[0, 0] < 0) if one else 1
        side = a[k + width :, k : k + width]
        a[k + width :, k + width :] -= side @ np.linalg.solve(block, side.T)
        k += width
    return count


def count_above(a: np.ndarray, x: float) -> int:
    """Eigenvalues above x."""
    return negatives(x * np.eye(len(a)) - a)


def feast(a: np.ndarray, low: float, high: float, expected: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``expected`` eigenpairs in (low, high): values in falling order, unit vectors as columns."""
    n = len(a)
    scale = np.linalg.norm(a) or 1.0
    x, weight = np.polynomial.legendre.leggauss(NODES)
    middle, radius = (low + high) / 2, (high - low) / 2
    turn = np.exp(1j * np.pi / 2 * (1 - x))  # the upper half circle
    shifted = (middle + radius * turn)[:, None, None] * np.eye(n) - a
    extra = EXTRA
    while True:
        size = min(n, expected + extra)
        q = np.random.default_rng(seed).standard_normal((n, size))
        worst = np.inf
        for _ in range(STEPS):
            solved = np.linalg.solve(shifted, np.broadcast_to(q.astype(complex), (NODES, n, size)))
            q, _ = np.linalg.qr(np.einsum("e,enk->nk", weight * radius * turn / 2, solved).real)
            value, y = np.linalg.eigh(q.T @ a @ q)
            q = q @ y
            inside = (value > low) & (value < high)
            left = np.linalg.norm(a @ q[:, inside] - q[:, inside] * value[inside], axis=0).max(initial=0.0) / scale
            if inside.sum() == expected and left >= worst / 2 and left < SETTLED * n:
                order = np.argsort(-value[inside], kind="stable")
                return value[inside][order], q[:, inside][:, order]
            worst = min(worst, left)
        if size == n:
            raise ArithmeticError(f"{int(inside.sum())} of {expected} eigenvalues found in ({low}, {high})")
        extra *= 2


#: Eigenvalues whose distance is a smaller share of their value stay in one interval, so that Rayleigh-Ritz makes their vectors orthogonal.
CLOSE = 1e-3


def intervals(a: np.ndarray, want: int, least: float, top: float) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) in falling order, for the ``want`` largest in (least, top); counted by inertia, halved where two or more lie apart."""
    known = {top: 0, least: count_above(a, least)}
    while True:
        points = sorted(known, reverse=True)
        spans = list(zip(points[1:], points))
        wide = [(lo, hi) for lo, hi in spans if known[lo] - known[hi] > 1 and known[hi] < want and hi - lo > CLOSE * hi]
        if not wide:
            return [(lo, hi, known[lo] - known[hi]) for lo, hi in spans if known[lo] > known[hi] and known[hi] < want]
        lo, hi = wide[0]
        at = (hi * lo) ** 0.5 if hi > 4 * lo else (hi + lo) / 2
        known[at] = count_above(a, at)


def largest(a: np.ndarray, want: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenpairs of a symmetric matrix above ``least`` > 0 (fewer if fewer are): values in falling order, unit vectors as columns."""
    top = float(np.abs(a).sum(axis=1).max(initial=0.0)) * (1 + 1e-9)
    if top <= least:
        return np.empty(0), np.empty((len(a), 0))
    found = [feast(a, lo, hi, n) for lo, hi, n in intervals(a, want, least, top)]
    if not found:
        return np.empty(0), np.empty((len(a), 0))
    return np.concatenate([v for v, _ in found])[:want], np.concatenate([x for _, x in found], axis=1)[:, :want]


ship_by_value(sys.modules[__name__])
