"""Numeric expressions that turn what cannot be computed into null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(c: Column) -> Column:
    """Double, or null for text that is not a number and for NaN."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def present(c: Column) -> Column:
    """A numeric column as double, with NaN as null."""
    value = c.cast("double")
    return F.when(~F.isnan(value), value)


def log1p_number(c: Column) -> Column:
    value = number(c)
    return F.when(value > -1, F.log1p(value))


def safe_ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den)


def clamp(c: Column, size: float = 1.0) -> Column:
    """Within -size..size; null stays null (least and greatest would skip it), NaN becomes null (it sorts above size)."""
    return F.when(F.isnan(c), F.lit(None)).when(c > size, size).when(c < -size, -size).otherwise(c)


def guarded_corr(x: Column, y: Column) -> tuple[Column, Column]:
    """(r, n) over complete pairs (NaN is missing); r is null for a constant side instead of raising."""
    both = present(x).isNotNull() & present(y).isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread = F.sqrt(F.var_pop(a)) * F.sqrt(F.var_pop(b))
    r = F.try_divide(F.covar_pop(a, b), F.nullif(spread, F.lit(0.0)))
    return clamp(r), F.count(F.when(both, 1))
