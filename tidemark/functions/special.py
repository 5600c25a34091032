"""Tail probabilities for one aggregated row per group or pair.

The heavy part of every test is a distributed aggregate; these run on its few result rows.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

LARGE_DF = 1e7
_TINY = 1e-300


def _beta_fraction(a: float, b: float, x: float) -> float:
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 20_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > _TINY else _TINY)
            c = 1.0 + term / c
            c = c if abs(c) > _TINY else _TINY
            h *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    front = math.exp(log_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def gamma_upper(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    front = math.exp(s * math.log(x) - x - math.lgamma(s)) if x < 1e6 else 0.0
    if x < s + 1.0:
        term = total = 1.0 / s
        for k in range(1, 20_000):
            term *= x / (s + k)
            total += term
            if term < total * 1e-16:
                break
        return 1.0 - front * total
    b = x + 1.0 - s
    c, d = 1.0 / _TINY, 1.0 / b
    h = d
    for i in range(1, 20_000):
        an = -i * (i - s)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return front * h


def norm_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi2_sf(x: float, df: float) -> float:
    return gamma_upper(df / 2.0, x / 2.0)


def f_sf(f: float, d1: float, d2: float) -> float:
    if f <= 0.0:
        return 1.0
    if d2 > LARGE_DF:
        return chi2_sf(f * d1, d1)
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def t_two_sided(t: float, df: float) -> float:
    if df > LARGE_DF:
        return norm_two_sided(t)
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def t_quantile(p: float, df: float) -> float:
    """Quantile of Student's t for p >= 0.5, by bisection."""
    if df > LARGE_DF:
        return NormalDist().inv_cdf(p)
    lo, hi = 0.0, 2.0
    while t_two_sided(hi, df) > 2.0 * (1.0 - p):
        hi *= 2.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        lo, hi = (mid, hi) if t_two_sided(mid, df) > 2.0 * (1.0 - p) else (lo, mid)
        if hi - lo <= 1e-15 * hi:
            break
    return (lo + hi) / 2.0


def u_exact_two_sided(u: float, n1: int, n2: int) -> float:
    """Exact two-sided p-value of U without ties, from the Gaussian binomial coefficients."""
    small, large = sorted((int(n1), int(n2)))
    ways = np.zeros(small * large + 1, dtype=object)
    ways[0] = 1
    for i in range(1, small + 1):
        step = large + i
        if step < len(ways):
            ways[step:] = ways[step:] - ways[:-step]
        for r in range(min(i, len(ways))):
            ways[r::i] = np.add.accumulate(ways[r::i])
    upper = math.ceil(max(u, n1 * n2 - u))
    tail = int(ways[upper:].sum()) / math.comb(small + large, small)
    return min(1.0, 2.0 * tail)


def shapiro_wilk(values: np.ndarray) -> tuple[float, float]:
    """W and p after Royston (1995), for 3 to 5000 values."""
    x = np.sort(np.asarray(values, dtype=float))
    n = len(x)
    if n < 3 or x[-1] == x[0]:
        return (1.0, 1.0) if n >= 3 else (math.nan, math.nan)
    dist = NormalDist()
    m = np.array([dist.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    ssq = float(m @ m)
    if n == 3:
        a = np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    else:
        r = 1.0 / math.sqrt(n)
        c = m / math.sqrt(ssq)
        # Polynomial coefficients published with the algorithm.
        an = np.polyval([-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, c[-1]], r)
        a = np.empty(n)
        if n > 5:
            an1 = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, c[-2]], r)
            phi = (ssq - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * an**2 - 2 * an1**2)
            a[2:-2] = m[2:-2] / math.sqrt(phi)
            a[-2], a[1] = an1, -an1
        else:
            phi = (ssq - 2 * m[-1] ** 2) / (1 - 2 * an**2)
            a[1:-1] = m[1:-1] / math.sqrt(phi)
        a[-1], a[0] = an, -an
    centred = x - x.mean()
    w = min(1.0, float(a @ x) ** 2 / float(centred @ centred))
    if n == 3:
        p = 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return w, max(0.0, p)
    y = math.log(max(1.0 - w, 1e-300))
    if n <= 11:
        gamma = -2.273 + 0.459 * n
        if y >= gamma:
            return w, 1e-99
        y = -math.log(gamma - y)
        mu = np.polyval([-0.0006714, 0.025054, -0.39978, 0.5440], n)
        sigma = math.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
    else:
        ln = math.log(n)
        mu = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], ln)
        sigma = math.exp(np.polyval([0.0030302, -0.082676, -0.4803], ln))
    return w, 0.5 * math.erfc((y - mu) / sigma / math.sqrt(2.0))


def _over(fn, *cols: pd.Series) -> pd.Series:
    rows = zip(*[c.astype(float) for c in cols])
    return pd.Series([fn(*v) if all(math.isfinite(x) for x in v) else math.nan for v in rows], dtype=float)


def _p_norm(z: pd.Series) -> pd.Series:
    return _over(norm_two_sided, z)


def _p_t(t: pd.Series, df: pd.Series) -> pd.Series:
    return _over(t_two_sided, t, df)


def _p_f(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _over(f_sf, f, d1, d2)


def _p_chi2(x: pd.Series, df: pd.Series) -> pd.Series:
    return _over(chi2_sf, x, df)


def _q_t(p: pd.Series, df: pd.Series) -> pd.Series:
    return _over(t_quantile, p, df)


def _p_u(u: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return _over(u_exact_two_sided, u, n1, n2)


norm_p = F.pandas_udf(_p_norm, T.DoubleType())
t_p = F.pandas_udf(_p_t, T.DoubleType())
f_p = F.pandas_udf(_p_f, T.DoubleType())
chi2_p = F.pandas_udf(_p_chi2, T.DoubleType())
t_ppf = F.pandas_udf(_q_t, T.DoubleType())
u_exact_p = F.pandas_udf(_p_u, T.DoubleType())
