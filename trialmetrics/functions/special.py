"""A special function numpy does not have."""

from __future__ import annotations

from math import lgamma

import numpy as np

_TINY = 1e-300


def incomplete_beta(a: float, b: float, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function I_x(a, b) for an array of x in [0, 1]."""
    upper = x > (a + 1) / (a + b + 2)
    result = np.empty_like(x, dtype="float64")
    result[~upper] = _fraction(a, b, x[~upper])
    result[upper] = 1 - _fraction(b, a, 1 - x[upper])
    return result


def _fraction(a: float, b: float, x: np.ndarray) -> np.ndarray:
    """The continued fraction, evaluated forwards (modified Lentz)."""
    if not x.size:
        return x
    with np.errstate(divide="ignore"):
        front = np.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * np.log(x) + b * np.log1p(-x)) / a
    value, c, d = np.ones_like(x), np.ones_like(x), np.zeros_like(x)
    # The number of terms needed grows with the root of the parameters.
    for k in range(200 + int(20 * np.sqrt(max(a, b)))):
        m = k // 2
        if k == 0:
            term = np.ones_like(x)
        elif k % 2 == 0:
            term = m * (b - m) * x / ((a + k - 1) * (a + k))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + k - 1) * (a + k))
        d = 1 + term * d
        d = 1 / np.where(d == 0, _TINY, d)
        c = 1 + term / c
        c = np.where(c == 0, _TINY, c)
        value = value * c * d
        if k and np.abs(1 - c * d).max() < 1e-15:
            return front * (value - 1)
    raise ArithmeticError(f"no convergence of the incomplete beta function for a={a}, b={b}")
