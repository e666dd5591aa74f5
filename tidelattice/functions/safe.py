"""Arithmetic that never raises: divisions, returns, scores, correlation and nearest-rank quantiles over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(n: Column | str, d: Column | str) -> Column:
    """n / d; 0.0 where d is null or zero."""
    n, d = _col(n), _col(d)
    return F.when(F.coalesce(d, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(F.try_divide(n, d))


def eps_div(n: Column | str, d: Column | str, eps: float = 1e-8) -> Column:
    """n / (d + eps); null stays null."""
    return F.try_divide(_col(n), _col(d) + eps)


def log_return(x: Column | str, previous: Column | str) -> Column:
    """ln(x / previous); null unless both are above zero."""
    x, p = _col(x), _col(previous)
    return F.when((x > 0) & (p > 0), F.ln(x / p))


def zscore(x: Column | str, mean: Column | str, std: Column | str) -> Column:
    """(x - mean) / std; null where any is null or std is (nearly) zero."""
    s = _col(std)
    return F.when(F.abs(s) >= 1e-12, F.try_divide(_col(x) - _col(mean), s))


def corr(x: Column | str, y: Column | str, where: Column | None = None) -> Column:
    """Aggregate: correlation; 0.0 where it isn't defined."""
    x, y = _col(x), _col(y)
    both = x.isNotNull() & y.isNotNull() if where is None else where & x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.coalesce(F.when(spread > 1e-12, F.try_divide(F.covar_pop(x, y), spread)), F.lit(0.0))


def nearest_rank(sorted_values: Column, q: float) -> Column:
    """Element of a sorted array at round((n - 1) * q)."""
    n = F.size(sorted_values)
    return F.when(n > 0, F.get(sorted_values, F.round((n - 1) * F.lit(q)).cast("int")))


def moments(x: Column) -> tuple[Column, Column]:
    """Aggregates: population skewness and excess kurtosis; 0.0 where they aren't defined."""
    flat = F.stddev_pop(x) <= 1e-12
    return tuple(F.coalesce(F.when(~flat, f(x)), F.lit(0.0)) for f in (F.skewness, F.kurtosis))  # type: ignore[return-value]
