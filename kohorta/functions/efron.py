"""Sums over tied events in closed form.

With risk ``a``, tied mass ``b`` and ``d`` events at one time, Efron's method sums
over the masses a - b j / d for j below d. With x = a d / b those are multiples of
x - j, so the sums are differences of log-gamma and its derivatives at x + 1 and
x + 1 - d, whatever the number of ties.
"""

from __future__ import annotations

import numpy as np

# The terms nearest to zero are summed one by one; series serve from there on.
EXACT = 16


def _log_gamma_rest(z: np.ndarray) -> np.ndarray:
    z2 = z * z
    return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * z2)) / z2) / z2) / z


def _digamma_rest(z: np.ndarray) -> np.ndarray:
    z2 = z * z
    return -(1 / 12 - (1 / 120 - (1 / 252 - 1 / (240 * z2)) / z2) / z2) / z2


def _trigamma_rest(z: np.ndarray) -> np.ndarray:
    z2 = z * z
    return (1 / 6 - (1 / 30 - (1 / 42 - 1 / (30 * z2)) / z2) / z2) / (z2 * z)


def tie_sums(risk: np.ndarray, tied: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over j < d of log(m / risk), risk / m and (risk / m)^2, with m = risk - tied j / d.

    Differences are written so that nothing cancels: neither for few ties in a
    large risk set nor for many that are the whole risk set.
    """
    d = np.asarray(d, np.float64)
    with np.errstate(divide="ignore", over="ignore"):
        # A tied mass too small to matter is as good as none.
        x = np.minimum(risk * d / tied, 1e15 * d)
    low = np.maximum(x - d + 1, 1.0)
    log, first, second = np.zeros_like(x), np.zeros_like(x), np.zeros_like(x)
    for k in range(EXACT):
        part = (low + k) / x
        here = k < d
        log += np.where(here, np.log(part), 0.0)
        first += np.where(here, 1 / part, 0.0)
        second += np.where(here, 1 / part**2, 0.0)
    many = d > EXACT
    if many.any():
        n, a, x = d[many] - EXACT, low[many] + EXACT, x[many]
        b = a + n
        grown = np.log1p(n / a)
        log[many] += (a - 0.5) * grown - n + n * np.log(b / x) + _log_gamma_rest(b) - _log_gamma_rest(a)
        first[many] += x * (grown + n / (2 * a * b) + _digamma_rest(b) - _digamma_rest(a))
        squares = n / (a * b) + n * (a + b) / (2 * (a * b) ** 2) + _trigamma_rest(a) - _trigamma_rest(b)
        second[many] += x * x * squares
    return log, first, second
