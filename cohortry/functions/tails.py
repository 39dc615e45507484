"""Upper-tail probabilities for a handful of test statistics (result tables of a few rows).

Gamma and beta tails are integrals of their densities on the log and log-odds scale, from the statistic outwards. The densities are
written by deviations from their peak (the remainder of Stirling's formula and ``v - log(1 + v)``), so nothing cancels at large
degrees of freedom; a few dozen panels of Gauss-Legendre nodes do for any parameters.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Ship the functions of this module with the task, so that executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HALF_LOG_2PI = 0.5 * math.log(2 * math.pi)
NODES, WEIGHTS = np.polynomial.legendre.leggauss(24)
#: Tables that Fisher's test sums at a time.
CHUNK = 1 << 16


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def stirling_rest(x: float) -> float:
    """log x! without x log x - x + log(2 pi x) / 2, for x above 0."""
    if x < 16:
        return math.lgamma(x + 1) - (x + 0.5) * math.log(x) + x - HALF_LOG_2PI
    y = 1 / (x * x)
    return (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y * (1 / 1680 - y / 1188)))) / x


def _log_rest(v, log_one_plus):
    """v - log(1 + v), exact to the last digits also where v is small or near -1. Numbers or arrays."""
    v = np.asarray(v, dtype="float64")
    small = np.abs(v) < 0.2
    w = np.where(small, v, 0.0)
    # By s = v / (2 + v): log(1 + v) = 2 (s + s^3/3 + s^5/5 + ...), and v - 2 s = s v.
    s = w / (2 + w)
    q, series = s * s, np.zeros_like(w)
    for k in range(23, 1, -2):
        series = q * (1 / k + series)
    return np.where(small, s * w - 2 * s * series, v - log_one_plus)


def _outwards(log_density: Callable[[np.ndarray], np.ndarray], width: float, sign: int) -> float:
    """Log of the integral of a log-concave density from 0 outwards, away from its peak."""
    top = float(log_density(np.zeros(1))[0])
    at, last, total = 0.0, 0.0, 0.0
    while True:
        values = log_density(sign * (at + width * (NODES + 1) / 2)) - top
        part = float(np.exp(values) @ WEIGHTS) * width / 2
        total += part
        if part <= 1e-18 * total:
            return top + math.log(total)
        at += width
        end = float(log_density(np.array([sign * at]))[0]) - top
        drop, last = last - end, end
        width *= 1.5 if drop < 2 else 0.6 if drop > 6 else 1.0


def _either(log_tail: float, upper: bool) -> float:
    tail = min(1.0, math.exp(log_tail))
    return tail if upper else 1.0 - tail


def chi2_upper(x: float, df: float) -> float:
    if x <= 0:
        return 1.0
    a, x = df / 2.0, x / 2.0
    front = math.log(a) - HALF_LOG_2PI - 0.5 * math.log(a) - stirling_rest(a)

    def log_density(shift: np.ndarray) -> np.ndarray:
        return front - a * _log_rest((x - a + x * np.expm1(shift)) / a, math.log(x / a) + shift)

    width = 1 / max(abs(x - a), math.sqrt(x), 0.25)
    return _either(_outwards(log_density, width, 1 if x > a else -1), x > a)


def f_upper(x: float, df1: float, df2: float) -> float:
    if x <= 0:
        return 1.0
    a, b = df1 / 2.0, df2 / 2.0
    n = a + b
    share = df1 * x / (df1 * x + df2)
    rest = df2 / (df1 * x + df2)
    # Distance of n * share from a, which would cancel if it were computed like that.
    off = df1 * df2 * (x - 1) / (2 * (df1 * x + df2))
    front = stirling_rest(n) - stirling_rest(a) - stirling_rest(b) - HALF_LOG_2PI + 0.5 * (math.log(a) + math.log(b) - math.log(n))

    def log_density(shift: np.ndarray) -> np.ndarray:
        # The share whose odds are exp(shift) times as large.
        grown = np.expm1(shift)
        moved = off + n * share * rest * grown / (1 + share * grown)
        scaled = np.log1p(share * grown)
        logs = math.log(n * share / a) + shift - scaled, math.log(n * rest / b) - scaled
        return front - a * _log_rest(moved / a, logs[0]) - b * _log_rest(-moved / b, logs[1])

    width = 1 / max(abs(off), math.sqrt(n * share * rest), 0.25)
    return _either(_outwards(log_density, width, 1 if off > 0 else -1), off > 0)


def t_two_sided(t: float, df: float) -> float:
    return f_upper(t * t, 1.0, df)


def beta_lower(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    return f_upper(a * (1 - x) / (b * x), 2 * b, 2 * a)


def _log_factorial_part(k: int) -> float:
    """log k! without k log k - k."""
    return 0.0 if k == 0 else HALF_LOG_2PI + 0.5 * math.log(k) + stirling_rest(k)


def _log_table(a: int, row: int, col: int, n: int) -> float:
    """Log probability of a 2x2 table with given margins, by its cells' deviations from their expectation."""
    off = (a * n - row * col) / n
    out = sum(map(_log_factorial_part, (row, col, n - row, n - col))) - _log_factorial_part(n)
    for k, d in ((a, off), (row - a, -off), (col - a, -off), (n - row - col + a, off)):
        out -= _log_factorial_part(k) + (k * float(_log_rest(-d / k, math.log((k - d) / k))) if k else -d)
    return out


def _tail_terms(a: int, step: int, row: int, col: int, n: int) -> float:
    """Sum of the tables from ``a`` on in one direction, in units of the first; ratios of neighbours, chunk by chunk, until
    the geometric series of the last ratio cannot change the sum."""
    end = min(row, col) if step > 0 else max(0, row + col - n)
    total, log_last, at = 1.0, 0.0, a
    while at != end:
        k = at + step * np.arange(min(CHUNK, abs(end - at)), dtype="float64")
        if step > 0:
            ratio = np.log((col - k) * (row - k)) - np.log((k + 1) * (n - col - row + k + 1))
        else:
            ratio = np.log(k * (n - col - row + k)) - np.log((col - k + 1) * (row - k + 1))
        logs = log_last + np.cumsum(ratio)
        total += float(np.exp(logs).sum())
        at, log_last = at + step * len(k), float(logs[-1])
        last = math.exp(ratio[-1])
        if last < 1 and math.exp(log_last) * last / (1 - last) < 1e-17 * total:
            break
    return total


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Sum of the table probabilities not above the observed one, margins fixed.

    Both tails are summed outwards: from the observed table, and from the first table on the other side of the expected one that is no
    more likely, which is found by bisection. Memory does not grow with the margins.
    """
    a, b, c, d = (int(v) for v in (a, b, c, d))
    row, col, n = a + b, a + c, a + b + c + d
    if n < 2 or min(row, col, n - row, n - col) == 0:
        return 1.0
    low, high = max(0, row + col - n), min(row, col)
    seen = _log_table(a, row, col, n)
    mode = min(max((row + 1) * (col + 1) // (n + 2), low), high)
    # Another table counts as equally likely within rounding.
    limit = seen + 1e-7
    if _log_table(mode, row, col, n) <= limit:
        return 1.0
    step = 1 if a > mode else -1
    log_p = seen + math.log(_tail_terms(a, step, row, col, n))
    inside, outside = mode, low if step > 0 else high
    if _log_table(outside, row, col, n) <= limit:
        while abs(inside - outside) > 1:
            mid = (inside + outside) // 2
            inside, outside = (inside, mid) if _log_table(mid, row, col, n) <= limit else (mid, outside)
        other = _log_table(outside, row, col, n) + math.log(_tail_terms(outside, -step, row, col, n))
        log_p = max(log_p, other) + math.log1p(math.exp(-abs(log_p - other)))
    return min(1.0, math.exp(log_p))


def p_value(fn: Callable[..., float], *cols: Column | str) -> Column:
    """A tail function over columns of a small result table; NULL in, NULL out."""

    @F.pandas_udf("double")
    def apply(frame: pd.DataFrame) -> pd.Series:
        rows = frame.itertuples(index=False, name=None)
        return pd.Series([None if any(pd.isna(v) for v in r) else fn(*r) for r in rows], dtype="float64")

    return apply(F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols]))
