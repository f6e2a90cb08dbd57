"""p-values of finished test statistics: a few scalars per result table, never data rows."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType

TINY, STEPS, CLOSE = 1e-300, 500, 1e-15


def _fraction(terms) -> float:
    """Value of 1 + a1/(1 + a2/(1 + ...)) by the modified Lentz method."""
    value, c, d = 1.0, 1.0, 0.0
    for a in terms:
        d = 1.0 / ((1.0 + a * d) or TINY)
        c = (1.0 + a / c) or TINY
        value *= c * d
        if abs(c * d - 1.0) < CLOSE:
            break
    return value


def _beta_terms(a: float, b: float, x: float):
    for m in range(STEPS):
        yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        m += 1
        yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_share(b, a, 1.0 - x)
    front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(front) / a / _fraction(_beta_terms(a, b, x))


def gamma_tail(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(s, x)."""
    if x <= 0:
        return 1.0
    front = math.exp(s * math.log(x) - x - math.lgamma(s))
    if x < s + 1:
        term = total = 1.0 / s
        for n in range(1, 10_000):
            term *= x / (s + n)
            total += term
            if term < total * CLOSE:
                break
        return 1.0 - front * total
    value = 0.0
    for n in range(STEPS, 0, -1):
        value = n * (n - s) / (x + 2 * n + 1 - s - value)
    return front / (x + 1 - s - value)


def t_two_sided(t: float, dof: float) -> float:
    return beta_share(dof / 2, 0.5, dof / (dof + t * t))


def chi2_tail(stat: float, dof: float) -> float:
    return gamma_tail(dof / 2, stat / 2)


@F.pandas_udf(DoubleType())
def _t_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(a, b) if b > 0 and a == a else None for a, b in zip(t, dof)], dtype="float64")


@F.pandas_udf(DoubleType())
def _chi2_p(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_tail(a, b) if b > 0 and a == a else None for a, b in zip(stat, dof)], dtype="float64")


def t_p_value(t: str, dof: str) -> Column:
    return _t_p(F.col(t).cast("double"), F.col(dof).cast("double"))


def chi2_p_value(stat: str, dof: str) -> Column:
    return _chi2_p(F.col(stat).cast("double"), F.col(dof).cast("double"))


def ks_p_value(d: Column, n_a: Column, n_b: Column) -> Column:
    """Asymptotic two-sample p-value from the alternating Kolmogorov series, with the usual small-sample correction."""
    en = F.sqrt(n_a.cast("double") * n_b / (n_a + n_b))
    lam = (en + 0.12 + F.lit(0.11) / en) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
