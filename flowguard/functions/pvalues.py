"""P-values of one-row test results."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def chi2_tail(x: float) -> float:
    """P(chi-square with one degree of freedom > x)."""
    return math.erfc(math.sqrt(x / 2.0))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz method)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 2_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + step * d
            c = 1.0 + step / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def pearson_tail(r: float, n: float) -> float:
    """Two-sided p-value of a Pearson correlation."""
    if n is None or r is None or n != n or r != r or n < 2:
        return float("nan")
    if n == 2:
        return 1.0
    if abs(r) >= 1.0:
        return 0.0
    return beta_inc((n - 2) / 2.0, 0.5, 1.0 - r * r)


def chi2_p(statistic: Column) -> Column:
    """P-value column for a chi-square statistic; meant for aggregated rows."""
    @F.pandas_udf("double")
    def tail(s: pd.Series) -> pd.Series:
        return s.map(chi2_tail)
    return tail(statistic)


def pearson_p(r: Column, n: Column) -> Column:
    """P-value column for a correlation; meant for aggregated rows. NULL r gives NULL."""
    @F.pandas_udf("double")
    def tail(rs: pd.Series, ns: pd.Series) -> pd.Series:
        out = [pearson_tail(a, b) for a, b in zip(rs, ns)]
        return pd.Series(out, dtype="float64").replace({np.nan: None}).astype("float64")
    return F.when(r.isNotNull(), tail(r, n.cast("double")))
