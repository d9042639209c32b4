"""Tail probabilities that finish a test statistic; applied to one aggregated row."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F, types as T


def chi_square_tail(x: float, dof: int) -> float:
    """P(X > x) for a chi-square variable with whole degrees of freedom (finite sums)."""
    half = x / 2.0
    if half <= 0:
        return 1.0
    log_half = math.log(half)
    if dof % 2 == 0:
        return math.fsum(math.exp(-half + i * log_half - math.lgamma(i + 1)) for i in range(dof // 2))
    tail = math.erfc(math.sqrt(half))
    return tail + math.fsum(math.exp(-half + (i - 0.5) * log_half - math.lgamma(i + 0.5))
                            for i in range(1, (dof - 1) // 2 + 1))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz evaluation)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    result = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        change = 1.0
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            change = c * d
            result *= change
        if abs(change - 1.0) < 1e-15:
            return result
    raise ArithmeticError(f"incomplete beta function did not converge at a={a}, b={b}, x={x}")


def beta_ratio(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


# Above this number of pairs the t distribution is the normal one to about eight digits, while
# differences of log-gammas lose digits.
_NORMAL_FROM = 10_000_000


def pearson_tail(r: float, n: int) -> float:
    """Two-sided p-value of a correlation coefficient."""
    if n == 2:
        return 1.0
    if n >= _NORMAL_FROM:
        rest = 1.0 - r * r
        return math.erfc(abs(r) * math.sqrt((n - 2) / rest) / math.sqrt(2.0)) if rest > 0 else 0.0
    return beta_ratio((n - 2) / 2.0, 0.5, 1.0 - min(1.0, r * r))


@F.pandas_udf(T.DoubleType())
def chi_square_p(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) or pd.isna(k) else chi_square_tail(float(x), int(k))
                      for x, k in zip(statistic, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def pearson_p(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) or pd.isna(k) else pearson_tail(float(x), int(k))
                      for x, k in zip(r, n)], dtype="float64")
