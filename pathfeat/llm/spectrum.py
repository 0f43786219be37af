"""Leading eigenpairs of a symmetric matrix by slicing its spectrum.

The number of eigenvalues above a shift is the number of positive ones of the block
diagonal D in L D L' = P (A - shift I) P', by the law of inertia. Bisection on these
counts isolates the k-th largest eigenvalue; Rayleigh quotient iteration, which converges
cubically, takes it from there to full precision; the counts on both sides of the result
then certify that it is the k-th. A quotient that ends at another eigenvalue is refused
and the interval is halved further.

Eigenvalues that agree to rounding can't be told apart by counts. Their vectors are any
orthonormal basis of their common space: each is iterated orthogonally to those before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Of the larger of a pivot's candidates: with it, elements grow by the least factor.
_PIVOT = (1 + 17**0.5) / 8
_EPS = np.finfo(float).eps
_ROUNDS = 60


def inertia(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``a`` exceed ``shift``.

    L D L' with complete pivoting: blocks of one or two rows, so that no matrix needs a
    small pivot. Of a block of two, one eigenvalue is positive and one negative.
    """
    m = a - shift * np.eye(len(a))
    above = 0
    while len(m):
        diagonal = np.abs(np.diagonal(m))
        one = int(np.argmax(diagonal))
        off = np.abs(np.tril(m, -1))
        most = off.max(initial=0.0)
        if max(diagonal[one], most) == 0:
            break
        if diagonal[one] >= _PIVOT * most:
            keep = np.delete(np.arange(len(m)), one)
            pivot, column = m[one, one], m[keep, one]
            above += int(pivot > 0)
            m = m[np.ix_(keep, keep)] - np.outer(column, column / pivot)
        else:
            i, j = np.unravel_index(int(np.argmax(off)), off.shape)
            keep = np.delete(np.arange(len(m)), [i, j])
            block, columns = m[np.ix_([i, j], [i, j])], m[np.ix_(keep, [i, j])]
            above += 1
            m = m[np.ix_(keep, keep)] - columns @ np.linalg.solve(block, columns.T)
        m = (m + m.T) / 2
    return above


@dataclass(frozen=True)
class Pair:
    """An eigenvalue, its unit vector, and how many eigenvalues lie above an interval
    around it and above its lower end."""

    value: float
    vector: np.ndarray
    above: int
    upto: int


def _orthogonal(v: np.ndarray, found: list[Pair]) -> np.ndarray:
    for _ in range(2):  # the second pass removes what rounding left
        for p in found:
            v = v - (p.vector @ v) * p.vector
    size = np.linalg.norm(v)
    return v / size if size else v


def _solved(a: np.ndarray, shift: float, v: np.ndarray, scale: float) -> np.ndarray:
    """Solution of (a - shift I) w = v, or one beside an exactly singular shift."""
    for off in (0, 4, 64):
        try:
            with np.errstate(all="ignore"):
                w = np.linalg.solve(a - (shift + off * _EPS * scale) * np.eye(len(a)), v)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(w).all() and w.any():
            return w
    return v


def _refined(a: np.ndarray, shift: float, near: list[Pair], scale: float) -> tuple[float, np.ndarray]:
    """An eigenpair near ``shift``, orthogonal to those in ``near``."""
    n = len(a)
    start = np.cos(np.arange(n) * 1.6180339887 + 0.5)
    taken = sum((p.vector**2 for p in near), np.zeros(n))
    inside = sum((p.vector * (p.vector @ start) for p in near), np.zeros(n))
    if np.linalg.norm(start - inside) < 1e-3 * np.linalg.norm(start):
        start = np.eye(n)[int(np.argmin(taken))]
    v = _orthogonal(start, near)
    value = shift
    for step in range(_ROUNDS):
        w = _solved(a, value, v, scale)
        v = _orthogonal(w / np.abs(w).max(), near)
        # The first steps hold the shift, so that the start turns to the isolated value.
        quotient = float(v @ a @ v)
        if np.linalg.norm(a @ v - quotient * v) <= 4 * _EPS * scale * n**0.5:
            return quotient, v
        value = quotient if step >= 2 else shift
    return quotient, v


def leading(a: np.ndarray, k: int) -> list[Pair]:
    """The ``k`` largest eigenvalues of ``a`` in falling order, with their vectors."""
    n = len(a)
    a = (a + a.T) / 2
    radius = np.abs(a).sum(axis=1) - np.abs(np.diagonal(a))
    low = float((np.diagonal(a) - radius).min()) if n else 0.0
    high = float((np.diagonal(a) + radius).max()) if n else 0.0
    if not a.any():
        return [Pair(0.0, axis, 0, n) for axis in np.eye(n)[:k]]
    scale = max(abs(low), abs(high))
    tell = 16 * n * _EPS * scale  # counts of shifts closer than this may be rounding
    low, high = low - 2 * tell, high + 2 * tell
    counts = {low: n, high: 0}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = inertia(a, shift)
        return counts[shift]

    found: list[Pair] = []
    for number in range(1, min(k, n) + 1):
        # Counts of earlier eigenvalues have already halved some of the way.
        lo = max(s for s, c in counts.items() if c >= number)
        hi = min(s for s, c in counts.items() if c < number and s > lo)
        while True:
            alone = above(lo) == number and above(hi) == number - 1
            # Rayleigh quotients start well inside an interval that holds one value only.
            if alone or hi - lo <= tell:
                near = [p for p in found if abs(p.value - lo) <= 64 * tell] if not alone else found
                value, vector = _refined(a, (lo + hi) / 2, near, scale)
                if lo - tell <= value <= hi + tell:
                    break
            if hi - lo <= tell / 4:
                raise ArithmeticError(f"eigenvalue {number} could not be isolated")
            middle = (lo + hi) / 2
            if above(middle) >= number:
                lo = middle
            else:
                hi = middle
        pair = Pair(value, vector, inertia(a, value + tell), inertia(a, value - tell))
        if not pair.above < number <= pair.upto:
            raise ArithmeticError(f"eigenvalue {number} is numbered {pair.above + 1} to {pair.upto}")
        found.append(pair)
    return found
