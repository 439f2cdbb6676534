"""Tail probabilities and log-gamma as vectorised column kernels (Spark SQL has none)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_erfc = np.vectorize(math.erfc, otypes=[float])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0: shift to x >= 10, then Stirling's series."""
    x = np.asarray(x, dtype=float)
    shift = np.zeros_like(x)
    z = x.copy()
    for _ in range(10):
        low = z < 10.0
        shift = np.where(low, shift + np.log(np.where(low, z, 1.0)), shift)
        z = np.where(low, z + 1.0, z)
    inv = 1.0 / (z * z)
    series = (1.0 / 12 - inv * (1.0 / 360 - inv * (1.0 / 1260 - inv * (1.0 / 1680 - inv / 1188)))) / z
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - shift


def trigamma(x: float) -> float:
    """Second derivative of ln Gamma at x > 0."""
    total = 0.0
    while x < 10.0:
        total += 1.0 / (x * x)
        x += 1.0
    inv = 1.0 / (x * x)
    return total + 1.0 / x + inv / 2 + inv / x * (1.0 / 6 - inv * (1.0 / 30 - inv * (1.0 / 42 - inv / 30)))


def beta_tail(a: np.ndarray, b: np.ndarray, x: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b) by its continued fraction."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    flip = x > (a + 1.0) / (a + b + 2.0)
    p, q, t = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1.0 - x, x)
    inner = np.clip(t, 1e-300, 1.0 - 1e-16)
    front = np.exp(log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * np.log(inner) + q * np.log1p(-inner)) / p
    tiny = 1e-300
    guard = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c, d = np.ones_like(p), 1.0 / guard(1.0 - (p + q) * t / (p + 1.0))
    frac = d.copy()
    for m in range(1, rounds):
        even = m * (q - m) * t / ((p + 2 * m - 1) * (p + 2 * m))
        d, c = 1.0 / guard(1.0 + even * d), guard(1.0 + even / c)
        frac = frac * d * c
        odd = -(p + m) * (p + q + m) * t / ((p + 2 * m) * (p + 2 * m + 1))
        d, c = 1.0 / guard(1.0 + odd * d), guard(1.0 + odd / c)
        step = d * c
        frac = frac * step
        if np.all(np.abs(step - 1.0) < 1e-14):
            break
    part = np.where(t <= 0.0, 0.0, np.where(t >= 1.0, 1.0, front * frac))
    return np.where(flip, 1.0 - part, part)


def t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    return beta_tail(df / 2.0, np.full_like(df, 0.5), df / (df + t * t))


def _normal_p(z: pd.Series) -> pd.Series:
    out = _erfc(np.abs(z.fillna(0.0).to_numpy(float)) / math.sqrt(2.0))
    return pd.Series(out, index=z.index).where(z.notna())


def _student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    ok = t.notna() & df.notna()
    out = t_two_sided(t.where(ok, 0.0).to_numpy(float), df.where(ok, 1.0).to_numpy(float))
    return pd.Series(out, index=t.index).where(ok)


def normal_p(z) -> Column:
    """Two-sided standard normal p-value of a column."""
    return F.pandas_udf(_normal_p, "double")(z)


def student_p(t, df) -> Column:
    """Two-sided Student t p-value of a (t, df) column pair."""
    return F.pandas_udf(_student_p, "double")(t, df)
