"""Tail probabilities as vectorised functions (small numeric helpers, no tables)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType

_erfc = np.vectorize(math.erfc, otypes=[float])
_lgamma = np.vectorize(math.lgamma, otypes=[float])


@F.pandas_udf(DoubleType())
def _two_sided(z: pd.Series) -> pd.Series:
    return pd.Series(_erfc(np.abs(z.to_numpy(float)) / math.sqrt(2)), index=z.index).where(z.notna())


@F.pandas_udf(DoubleType())
def _upper(z: pd.Series) -> pd.Series:
    return pd.Series(0.5 * _erfc(z.to_numpy(float) / math.sqrt(2)), index=z.index).where(z.notna())


def normal_p(z: Column, side: str = "two") -> Column:
    """P-value of a Z score: two-sided, or one-sided ``lower`` / ``upper``."""
    if side == "two":
        return _two_sided(z)
    return _upper(z if side == "upper" else -z)


def chi2_1_p(stat: Column) -> Column:
    """Upper tail of chi-square with one degree of freedom."""
    return _two_sided(F.sqrt(stat))


def chi2_even_p(stat: Column, half_df: Column) -> Column:
    """Upper tail of chi-square with ``2 * half_df`` degrees of freedom (closed form)."""
    half = stat / 2
    terms = F.aggregate(
        F.sequence(F.lit(1), F.greatest(half_df.cast("int") - 1, F.lit(1))),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda acc, i: F.struct(
            (acc["term"] * half / i).alias("term"), (acc["total"] + acc["term"] * half / i).alias("total")
        ),
        lambda acc: acc["total"],
    )
    return F.exp(-half) * F.when(half_df <= 1, F.lit(1.0)).otherwise(terms)


def gamma_tail(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma function for a >= 1, x > 0: P(X >= a) of a Poisson mean x.

    A series below the mean, a continued fraction above it; each runs until its last step changes
    nothing, which takes a few times sqrt(a) steps near the mean.
    """
    a, x = np.asarray(a, float), np.asarray(x, float)
    # log of x^a exp(-x) / gamma(a + 1); for large a by its distance from the mean, without large differences.
    u = (x - a) / a
    small = a < 1e3
    front = np.where(
        small, a * np.log(x) - x - _lgamma(np.where(small, a, 1.0) + 1),
        a * (np.log1p(np.maximum(u, -1 + 1e-300)) - u) - 0.5 * np.log(2 * math.pi * a) - 1 / (12 * a) + 1 / (360 * a**3),
    )
    out = np.empty_like(a)
    below = x < a + 1
    n, m = a[below], x[below]
    total, term, i = np.ones_like(n), np.ones_like(n), 0
    left = np.arange(len(n))
    while len(left):
        i += 1
        term[left] *= m[left] / (n[left] + i)
        total[left] += term[left]
        left = left[term[left] > total[left] * 1e-17]
    out[below] = np.exp(front[below]) * total
    n, m = a[~below], x[~below]
    tiny = 1e-300
    b = m + 1 - n
    c, d = np.full_like(n, 1 / tiny), 1 / np.where(b == 0, tiny, b)
    h, i = d.copy(), 0
    left = np.arange(len(n))
    while len(left):
        i += 1
        num = -i * (i - n[left])
        b[left] += 2
        dd = num * d[left] + b[left]
        cc = b[left] + num / c[left]
        d[left] = 1 / np.where(np.abs(dd) < tiny, tiny, dd)
        c[left] = np.where(np.abs(cc) < tiny, tiny, cc)
        step = d[left] * c[left]
        h[left] *= step
        left = left[np.abs(step - 1) > 1e-15]
    out[~below] = 1 - np.exp(front[~below]) * n * h
    return np.clip(out, 0, 1)


@F.pandas_udf(DoubleType())
def poisson_sf(k: pd.Series, lam: pd.Series) -> pd.Series:
    """P(X >= k) for a Poisson mean ``lam`` and whole ``k``."""
    kk, mu = np.floor(k.to_numpy(float)), np.maximum(lam.to_numpy(float), 1e-300)
    out = np.where(np.isnan(kk) | np.isnan(mu), np.nan, 1.0)
    todo = kk > 0
    out[todo] = gamma_tail(kk[todo], mu[todo])
    return pd.Series(out, index=k.index)


def beta_tail(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by its continued fraction; NaN if that does not settle."""
    x, a, b = np.broadcast_arrays(np.asarray(x, float), np.asarray(a, float), np.asarray(b, float))
    flip = x > (a + 1) / (a + b + 2)
    xx, aa, bb = np.where(flip, 1 - x, x), np.where(flip, b, a), np.where(flip, a, b)
    safe = np.clip(xx, 1e-300, 1 - 1e-16)
    front = np.exp(
        _lgamma(aa + bb) - _lgamma(aa) - _lgamma(bb) + aa * np.log(safe) + bb * np.log1p(-safe)
    ) / aa
    tiny = 1e-300
    c, d = np.ones_like(safe), 1 - (aa + bb) * safe / (aa + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    steps = 1000 + 20 * int(np.sqrt(np.max(np.r_[aa.ravel(), bb.ravel(), 1.0])))
    for m in range(1, steps):
        for num in (
            m * (bb - m) * safe / ((aa + 2 * m - 1) * (aa + 2 * m)),
            -(aa + m) * (aa + bb + m) * safe / ((aa + 2 * m) * (aa + 2 * m + 1)),
        ):
            d = 1 + num * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        settled = np.abs(d * c - 1) < 1e-14
        if settled.all():
            break
    tail = np.where(xx <= 0, 0.0, np.where(settled, front * h, np.nan))
    return np.where(flip, 1 - tail, tail)


@F.pandas_udf(DoubleType())
def t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value of Student's t."""
    tt, nu = t.to_numpy(float), df.to_numpy(float)
    ok = np.isfinite(tt) & (nu > 0)
    out = np.full(len(tt), np.nan)
    out[ok] = beta_tail(nu[ok] / (nu[ok] + tt[ok] ** 2), nu[ok] / 2, np.full(ok.sum(), 0.5))
    out[np.isinf(tt)] = 0.0
    return pd.Series(out, index=t.index)


@F.pandas_udf(DoubleType())
def f_p(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    """Upper tail of Fisher's F."""
    v, m, n = f.to_numpy(float), df1.to_numpy(float), df2.to_numpy(float)
    ok = np.isfinite(v) & (m > 0) & (n > 0)
    out = np.full(len(v), np.nan)
    out[ok] = beta_tail(n[ok] / (n[ok] + m[ok] * v[ok]), n[ok] / 2, m[ok] / 2)
    return pd.Series(out, index=f.index)
