"""Numerically safe statistics as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: Abramowitz & Stegun 7.1.26 coefficients for erf
AS_P = 0.3275911
AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pearson(x, y) -> Column:
    """Pearson correlation over rows where both are non-null.

    Built from the numerically stable ``covar_pop`` / ``stddev_pop``
    aggregates; constant input gives NULL instead of raising (``corr``
    divides by zero under ANSI).
    """
    a, b = _c(x).cast("double"), _c(y).cast("double")
    both = a.isNotNull() & b.isNotNull()
    xa, yb = F.when(both, a), F.when(both, b)
    den = F.stddev_pop(xa) * F.stddev_pop(yb)
    return F.when(den > 0, F.try_divide(F.covar_pop(xa, yb), den))


def erf(x) -> Column:
    """erf via Abramowitz-Stegun 7.1.26 (|error| < 1.5e-7), codegen-friendly."""
    z = _c(x)
    az = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(AS_P) * az)
    a1, a2, a3, a4, a5 = AS_A
    poly = t * (F.lit(a1) + t * (F.lit(a2) + t * (F.lit(a3) + t * (F.lit(a4) + t * F.lit(a5)))))
    y = F.lit(1.0) - poly * F.exp(-(az * az))
    return F.when(z >= 0, y).otherwise(-y)


def norm_cdf(z) -> Column:
    return F.lit(0.5) * (F.lit(1.0) + erf(_c(z) / F.lit(math.sqrt(2.0))))


def norm_pdf(z) -> Column:
    zz = _c(z)
    return F.exp(F.lit(-0.5) * zz * zz) / F.lit(math.sqrt(2.0 * math.pi))


def crps_gaussian(y, mu, sigma) -> Column:
    """Closed-form CRPS of N(mu, sigma^2) at y; sigma <= 0 falls back to |y - mu|."""
    s = _c(sigma)
    z = F.try_divide(_c(y) - _c(mu), s)
    val = s * (z * (F.lit(2.0) * norm_cdf(z) - F.lit(1.0)) + F.lit(2.0) * norm_pdf(z) - F.lit(1.0 / math.sqrt(math.pi)))
    return F.when(s > 0, val).otherwise(F.abs(_c(y) - _c(mu)))
