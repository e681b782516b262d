"""Tail probabilities as Arrow functions over result rows (NumPy only).

Spark has no erf, lgamma or incomplete beta/gamma. These functions run on result tables (one row per test), in
vectorised batches, so they never sit on the wide part of a plan.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Lanczos coefficients for g = 7, n = 9.
_LANCZOS = np.array([
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
])


def log_gamma(x):
    """log of the gamma function for x > 0."""
    x = np.asarray(x, dtype=float) - 1.0
    series = np.full_like(x, _LANCZOS[0])
    for i in range(1, 9):
        series = series + _LANCZOS[i] / (x + i)
    t = x + 7.5
    return 0.5 * np.log(2 * np.pi) + (x + 0.5) * np.log(t) - t + np.log(series)


def gamma_upper(a, x):
    """Regularised upper incomplete gamma Q(a, x): series below a + 1, continued fraction above."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    safe = np.maximum(x, 1e-300)
    front = np.exp(-safe + a * np.log(safe) - log_gamma(a))
    term = 1.0 / a
    total = term.copy()
    for n in range(1, 500):
        term = term * safe / (a + n)
        total = total + term
    low = 1.0 - front * total
    tiny = 1e-300
    b = safe + 1.0 - a
    c = np.full_like(b, 1.0 / tiny)
    d = 1.0 / np.where(np.abs(b) < tiny, tiny, b)
    h = d
    for n in range(1, 300):
        an = -n * (n - a)
        b = b + 2.0
        d = an * d + b
        d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
        c = b + an / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        h = h * d * c
    out = np.where(safe < a + 1.0, low, front * h)
    return np.clip(np.where(x <= 0, 1.0, out), 0.0, 1.0)


def beta_inc(a, b, x):
    """Regularised incomplete beta I_x(a, b) by its continued fraction."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float))
    x = np.clip(x, 0.0, 1.0)
    swap = x > (a + 1.0) / (a + b + 2.0)
    p, q = np.where(swap, b, a), np.where(swap, a, b)
    z = np.where(swap, 1.0 - x, x)
    inside = np.clip(z, 1e-300, 1 - 1e-16)
    front = np.exp(log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * np.log(inside) + q * np.log1p(-inside))
    tiny = 1e-300
    c = np.ones_like(z)
    d = 1.0 - (p + q) * z / (p + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d
    for m in range(1, 300):
        even = m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + step / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    out = front * h / p
    out = np.where(z <= 0, 0.0, out)
    return np.clip(np.where(swap, 1.0 - out, out), 0.0, 1.0)


def normal_two_sided(z):
    return gamma_upper(0.5, np.square(z) / 2.0)


def _clean(values, *inputs):
    bad = np.zeros(len(values), dtype=bool)
    for item in inputs:
        bad |= ~np.isfinite(np.asarray(item, float))
    return pd.Series(np.where(bad, np.nan, values)).astype(object).where(~bad, None).astype("Float64")


@F.pandas_udf(DoubleType())
def p_normal(z: pd.Series) -> pd.Series:
    """Two-sided normal p."""
    z = z.to_numpy(dtype=float, na_value=np.nan)
    return _clean(normal_two_sided(np.nan_to_num(z)), z)


@F.pandas_udf(DoubleType())
def p_chi2(stat: pd.Series, df: pd.Series) -> pd.Series:
    """Upper chi-squared tail."""
    s, k = stat.to_numpy(float, na_value=np.nan), df.to_numpy(float, na_value=np.nan)
    k = np.where(k > 0, k, np.nan)
    return _clean(gamma_upper(np.nan_to_num(k, nan=1.0) / 2.0, np.maximum(np.nan_to_num(s), 0) / 2.0), s, k)


@F.pandas_udf(DoubleType())
def p_t(stat: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided Student p."""
    t, k = stat.to_numpy(float, na_value=np.nan), df.to_numpy(float, na_value=np.nan)
    k = np.where(k > 0, k, np.nan)
    k1, t1 = np.nan_to_num(k, nan=1.0), np.nan_to_num(t, posinf=1e150, neginf=-1e150)
    return _clean(beta_inc(k1 / 2.0, 0.5, k1 / (k1 + t1 * t1)), k, np.where(np.isnan(t), np.nan, 0.0))


@F.pandas_udf(DoubleType())
def p_f(stat: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    """Upper F tail."""
    s = stat.to_numpy(float, na_value=np.nan)
    a, b = df1.to_numpy(float, na_value=np.nan), df2.to_numpy(float, na_value=np.nan)
    a, b = np.where(a > 0, a, np.nan), np.where(b > 0, b, np.nan)
    s1, a1, b1 = np.maximum(np.nan_to_num(s, posinf=1e150), 0), np.nan_to_num(a, nan=1.0), np.nan_to_num(b, nan=1.0)
    return _clean(beta_inc(b1 / 2.0, a1 / 2.0, b1 / (b1 + a1 * s1)), a, b, np.where(np.isnan(s), np.nan, 0.0))


def _log_choose(n, k):
    return log_gamma(n + 1.0) - log_gamma(k + 1.0) - log_gamma(n - k + 1.0)


@F.pandas_udf(DoubleType())
def p_fisher(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """Two-sided Fisher p of [[a, b], [c, d]]: sum of the tables that are no more likely."""
    w, x, y, z = (s.to_numpy(float) for s in (a, b, c, d))
    row, col, n = w + x, w + y, w + x + y + z
    lo, hi = np.maximum(0, row + col - n), np.minimum(row, col)
    mode = np.clip(np.floor((row + 1) * (col + 1) / (n + 2)), lo, hi)
    log_p = lambda k, at: (_log_choose(col[at], k) + _log_choose(n[at] - col[at], row[at] - k) - _log_choose(n[at], row[at]))
    every = np.arange(len(w))
    here = log_p(w, every)
    total = np.zeros(len(w))
    # From the mode outwards all tables of the batch go one step at a time; a side ends at its margin or where
    # its terms no longer add anything to the sum.
    for step, k in ((1, mode.copy()), (-1, mode - 1)):
        live = every[(k >= lo) & (k <= hi)]
        while len(live):
            logs = log_p(k[live], live)
            p = np.exp(logs)
            total[live] += np.where(logs <= here[live] + 1e-7, p, 0.0)
            k[live] += step
            going = (k[live] >= lo[live]) & (k[live] <= hi[live]) & ~((logs <= here[live] + 1e-7) & (p <= total[live] * 1e-17))
            live = live[going]
    return pd.Series(np.minimum(1.0, total))


@F.pandas_udf(DoubleType())
def p_absent(total: pd.Series, n: pd.Series, depth: pd.Series) -> pd.Series:
    """C(total - n, depth) / C(total, depth): chance that a feature with n of total reads is missed at a depth."""
    t, k, d = (s.to_numpy(float) for s in (total, n, depth))
    room = t - k - d
    safe = np.maximum(room, 0.0)
    logs = log_gamma(t - k + 1) - log_gamma(safe + 1) - log_gamma(t + 1) + log_gamma(np.maximum(t - d, 0) + 1)
    return pd.Series(np.where(room < 0, 0.0, np.exp(logs)))
