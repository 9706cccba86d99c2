"""p-values for the significance and drift tests.

scipy is not available, so the tail probabilities are computed here from the
regularised incomplete gamma and beta functions (series and continued
fraction, see Press et al., *Numerical Recipes*, ch. 6) and the asymptotic
Kolmogorov series.  They are only ever applied to aggregated rows (one row per
tested column), through Arrow-batched pandas UDFs, never per data row.
"""

from __future__ import annotations

import math
from itertools import count

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15
_STOP = 3e-15  # of a continued fraction: a few units in the last place, so it is always reached
_TINY = 1e-300


def _gamma_series(a: float, x: float) -> float:
    term = 1.0 / a
    total = term
    ap = a
    while True:  # the terms fall geometrically once ap > x
        ap += 1.0
        term *= x / ap
        total += term
        if abs(term) < abs(total) * _EPS:
            break
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gamma_cfrac(a: float, x: float) -> float:
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in count(1):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = _TINY if abs(d) < _TINY else d
        c = b + an / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _STOP:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def gamma_q(a: float, x: float) -> float:
    """Upper regularised incomplete gamma Q(a, x)."""
    if math.isnan(a) or math.isnan(x):
        return float("nan")
    if math.isinf(x):
        return 0.0
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        return 1.0 - _gamma_series(a, x)
    return _gamma_cfrac(a, x)


def _beta_cfrac(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = 1.0
    d = 1.0 - qab * x / qap
    d = _TINY if abs(d) < _TINY else d
    d = 1.0 / d
    h = d
    for m in count(1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = _TINY if abs(d) < _TINY else d
        c = 1.0 + aa / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = _TINY if abs(d) < _TINY else d
        c = 1.0 + aa / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _STOP:
            break
    return h


def beta_i(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_cfrac(a, b, x) / a
    return 1.0 - front * _beta_cfrac(b, a, 1.0 - x) / b


def chi2_sf(stat: float, dof: float) -> float:
    """P(X >= stat) for a chi-square variable with ``dof`` degrees of freedom."""
    if stat is None or dof is None or math.isnan(stat) or dof <= 0:
        return float("nan")
    return gamma_q(dof / 2.0, stat / 2.0)


def t_two_sided(t: float, dof: float) -> float:
    """Two-sided p-value of Student's t."""
    if t is None or dof is None or math.isnan(t) or dof <= 0:
        return float("nan")
    return beta_i(dof / 2.0, 0.5, dof / (dof + t * t))


def normal_two_sided(z: float) -> float:
    if z is None or math.isnan(z):
        return float("nan")
    return math.erfc(abs(z) / math.sqrt(2.0))


def ks_two_sample_p(d: float, n: float, m: float) -> float:
    """Asymptotic two-sample Kolmogorov–Smirnov p-value (Stephens' correction)."""
    if d is None or math.isnan(d) or n <= 0 or m <= 0:
        return float("nan")
    en = math.sqrt(n * m / (n + m))
    lam = (en + 0.12 + 0.11 / en) * d
    if lam < 1e-3:
        return 1.0
    total, sign = 0.0, 1.0
    for k in range(1, 101):
        term = sign * math.exp(-2.0 * k * k * lam * lam)
        total += term
        if abs(term) < 1e-12:
            break
        sign = -sign
    return min(1.0, max(0.0, 2.0 * total))


@F.pandas_udf(T.DoubleType())
def chi2_sf_udf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(float(s), float(d)) if pd.notna(s) and pd.notna(d) else None
                      for s, d in zip(stat, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def t_two_sided_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(float(a), float(b)) if pd.notna(a) and pd.notna(b) else None
                      for a, b in zip(t, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_two_sided_udf(z: pd.Series) -> pd.Series:
    return pd.Series([normal_two_sided(float(a)) if pd.notna(a) else None for a in z], dtype="float64")


@F.pandas_udf(T.DoubleType())
def ks_p_udf(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([ks_two_sample_p(float(a), float(b), float(c))
                      if pd.notna(a) and pd.notna(b) and pd.notna(c) else None
                      for a, b, c in zip(d, n, m)], dtype="float64")
