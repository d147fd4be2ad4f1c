"""Probability of the two-sample Kolmogorov-Smirnov statistic.  Three numbers in, one out."""

from __future__ import annotations

import math

import numpy as np

#: Samples of up to this size are tested exactly.
EXACT = 10_000


def exact(n1: int, n2: int, gap: int) -> float:
    """The share of lattice paths from (0, 0) to (n1, n2) with |i * n2 - j * n1| >= gap somewhere.

    A path to (i, j) comes from (i - 1, j) with probability i / (i + j), so the share is a
    recurrence over the diagonals i + j, each of which is one array.
    """
    if gap <= 0:
        return 1.0
    n1, n2 = min(n1, n2), max(n1, n2)
    i = np.arange(n1 + 1)
    far = np.zeros(n1 + 1)  # of the diagonal before, by i
    for k in range(1, n1 + n2 + 1):
        a, b = max(0, k - n2), min(k, n1)
        own = i[a : b + 1]
        from_left = far[own - 1] * own  # own is 0 only where the product is 0
        new = (from_left + far[a : b + 1] * (k - own)) / k
        new[np.abs(own * n2 - (k - own) * n1) >= gap] = 1.0
        far[a : b + 1] = new
    return float(far[n1])


def series(d: float, size: float) -> float:
    """The limiting distribution at a statistic corrected for the effective sample size (Vrbik 2018)."""
    root = math.sqrt(size)
    z = d * root
    z = z + 1 / (6 * root) + (z - 1) / (4 * size)
    if z < 0.2:
        return 1.0
    return min(1.0, max(0.0, sum((2 if k % 2 else -2) * math.exp(-2 * k * k * z * z) for k in range(1, 101))))


def p_value(n1: int, n2: int, gap: int) -> float:
    """``gap`` is n1 * n2 times the statistic."""
    if max(n1, n2) <= EXACT:
        return exact(n1, n2, gap)
    return series(gap / n1 / n2, max(1, round(n1 * n2 / (n1 + n2))))
