"""Tail probabilities of the t and chi-square distributions, for one-row test results.

The tests reduce to a few numbers on Spark first; these run on that result only.
"""

from __future__ import annotations

from math import erfc, exp, lgamma, log, log1p, sqrt

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

TINY = 1e-300
STEPS = 100_000
NORMAL_FROM = 1e7


def _lentz(terms) -> float:
    """Value of 1 + a1/(b1 + a2/(b2 + ...)) by the modified Lentz method; `terms` yields (a, b)."""
    f, c, d = 1.0, 1.0, 0.0
    for a, b in terms:
        d = 1.0 / (b + a * d or TINY)
        c = b + a / c or TINY
        step = c * d
        f *= step
        if abs(step - 1.0) < 1e-15:
            return f
    raise ArithmeticError("a continued fraction has not converged")


def log_beta(a: float, b: float) -> float:
    """Logarithm of the beta function. With a large argument the difference of two large log-gammas would lose all digits, so
    it is taken from the series of ln(gamma(a + b) / gamma(a)) there."""
    large, small = max(a, b), min(a, b)
    if large < 1e6 or small > 1e3:
        return lgamma(a) + lgamma(b) - lgamma(a + b)
    # Stirling: ln gamma(x + s) - ln gamma(x) with x = large, s = small
    x, s = large, small
    ratio = (x + s - 0.5) * log1p(s / x) + s * log(x) - s + (1 / (x + s) - 1 / x) / 12
    return lgamma(s) - ratio


def beta_regularized(a: float, b: float, x: float, rest: float | None = None) -> float:
    """I_x(a, b). `rest` is 1 - x where that is known with more digits than the difference has."""
    rest = 1.0 - x if rest is None else rest
    if x <= 0.0 or rest >= 1.0:
        return 0.0
    if rest <= 0.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_regularized(b, a, rest, x)

    def terms():
        for m in range(STEPS):
            if m:
                yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0

    log_x = log(x) if x < 0.5 else log1p(-rest)
    log_rest = log(rest) if rest < 0.5 else log1p(-x)
    front = exp(a * log_x + b * log_rest - log_beta(a, b)) / a
    return front / _lentz(terms())


def chi_square_tail(x: float, dof: float) -> float:
    """P(X > x) for a chi-square with `dof` degrees of freedom."""
    a, z = dof / 2.0, x / 2.0
    if z <= 0.0:
        return 1.0
    scale = exp(a * log(z) - z - lgamma(a))
    if z < a + 1.0:
        term = total = 1.0 / a
        for k in range(1, STEPS):
            term *= z / (a + k)
            total += term
            if term < total * 1e-16:
                return max(0.0, 1.0 - scale * total)
        raise ArithmeticError("a series has not converged")

    def terms():
        for k in range(1, STEPS):
            yield -k * (k - a), z + 2 * k + 1.0 - a

    base = z + 1.0 - a
    f, c, d = base, base, 0.0
    for numerator, b in terms():
        d = 1.0 / (b + numerator * d or TINY)
        c = b + numerator / c or TINY
        f *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return scale / f
    raise ArithmeticError("a continued fraction has not converged")


def correlation_p(r: float, n: float) -> float:
    """Two-sided p-value of a correlation over n pairs (Student t with n - 2 degrees of freedom).

    From `NORMAL_FROM` degrees on by the normal tail of a corrected t, whose relative error is below one over
    the square of the degrees there; the beta function's fraction loses digits with them.
    """
    dof = n - 2
    if dof >= NORMAL_FROM and abs(r) < 1e-2:
        squared = r * r * dof / (1.0 - r * r)
        return erfc(sqrt(squared) * (1.0 - 0.25 / dof) / sqrt(1.0 + squared / (2.0 * dof)) / sqrt(2.0))
    return beta_regularized((n - 2) / 2.0, 0.5, max(0.0, 1.0 - r * r), min(1.0, r * r))


@F.pandas_udf(T.DoubleType())
def correlation_p_value(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or pd.isna(b) or b < 3 else correlation_p(a, b) for a, b in zip(r, n)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi_square_p_value(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or pd.isna(b) or b < 1 else chi_square_tail(a, b) for a, b in zip(x, dof)], dtype="float64")
