"""Distribution tails for report rows, through commons-math3 on the Spark classpath.

Reports have one row per feature (bounded by the schema, not by the data),
so p-values are attached on the driver after the distributed aggregation.
The studentized range distribution (Tukey HSD, more than two groups) is not
in commons-math3 and is integrated numerically with NumPy.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import SparkSession


def _m3(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.commons.math3.distribution


def _special(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.commons.math3.special


def t_two_sided_p(spark: SparkSession, t: float, df: float) -> float:
    if df <= 0 or t is None or math.isnan(t):
        return float("nan")
    if math.isinf(t):
        return 0.0
    dist = _m3(spark).TDistribution(float(df))
    return float(2.0 * dist.cumulativeProbability(-abs(float(t))))


def t_quantile(spark: SparkSession, p: float, df: float) -> float:
    return float(_m3(spark).TDistribution(float(df)).inverseCumulativeProbability(float(p)))


def chi2_sf(spark: SparkSession, x: float, dof: float) -> float:
    if dof <= 0 or x is None or math.isnan(x):
        return float("nan")
    # the upper tail itself: 1 - cdf would underflow for strong features
    return float(_special(spark).Gamma.regularizedGammaQ(float(dof) / 2.0, max(0.0, float(x)) / 2.0))


def f_sf(spark: SparkSession, f: float, d1: float, d2: float) -> float:
    if d1 <= 0 or d2 <= 0 or f is None or math.isnan(f):
        return float("nan")
    if math.isinf(f):
        return 0.0
    f = max(0.0, float(f))
    return float(_special(spark).Beta.regularizedBeta(d2 / (d2 + d1 * f), d2 / 2.0, d1 / 2.0))


def pearson_p(spark: SparkSession, r: float, n: int) -> float:
    """Two-sided p of a correlation coefficient (t with n-2 degrees of freedom)."""
    if n is None or n < 3 or r is None or math.isnan(r):
        return float("nan")
    if abs(r) >= 1.0:
        return 0.0
    t = r * math.sqrt((n - 2) / (1.0 - r * r))
    return t_two_sided_p(spark, t, n - 2)


# --- studentized range (numerical) -------------------------------------------------

_GL_X, _GL_W = np.polynomial.legendre.leggauss(96)


def _norm_cdf(z):
    return 0.5 * (1.0 + np.vectorize(math.erf)(z / math.sqrt(2.0)))


def _range_cdf_given_s(q: float, k: int, s: np.ndarray) -> np.ndarray:
    """P(range of k std normals ≤ q*s) for each s."""
    a, b = -8.0, 8.0
    z = 0.5 * (b - a) * _GL_X + 0.5 * (b + a)
    w = 0.5 * (b - a) * _GL_W
    phi = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
    cz = _norm_cdf(z)
    diff = np.clip(cz[None, :] - _norm_cdf(z[None, :] - q * s[:, None]), 0.0, 1.0)
    return k * (diff ** (k - 1) * phi[None, :] * w[None, :]).sum(axis=1)


def studentized_range_cdf(q: float, k: int, df: float) -> float:
    if q <= 0:
        return 0.0
    # density of s = sqrt(chi2_df / df): centred on 1 with a width of about 1 / sqrt(2 df)
    width = 12.0 / math.sqrt(2.0 * df)
    lo, hi = max(1e-9, 1.0 - width), 1.0 + width
    s = 0.5 * (hi - lo) * _GL_X + 0.5 * (hi + lo)
    ws = 0.5 * (hi - lo) * _GL_W
    log_dens = (math.log(2.0) + (df / 2.0) * math.log(df / 2.0) - math.lgamma(df / 2.0)
                + (df - 1) * np.log(s) - df * s * s / 2.0)
    return float(np.clip((np.exp(log_dens) * ws * _range_cdf_given_s(q, k, s)).sum(), 0.0, 1.0))


def studentized_range_sf(q: float, k: int, df: float) -> float:
    return 1.0 - studentized_range_cdf(q, k, df)


def studentized_range_quantile(p: float, k: int, df: float) -> float:
    lo, hi = 0.0, 50.0
    for _ in range(80):
        mid = 0.5 * (lo + hi)
        if studentized_range_cdf(mid, k, df) < p:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)
