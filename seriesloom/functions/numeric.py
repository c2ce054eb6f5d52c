"""Null-safe arithmetic shared by features and scores."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# Largest finite double, used where infinite features are replaced by a finite stand-in.
MAX_DOUBLE = 1.7976931348623157e308


def ratio(num: Column, den: Column) -> Column:
    """num / den; null when the denominator is zero (x/0 and 0/0 alike)."""
    return F.try_divide(num, den)


def ratio_eps(num: Column, den: Column, eps: float) -> Column:
    """num / (den + eps), null when den + eps is exactly zero."""
    return F.try_divide(num, den + F.lit(eps))


def inf_to_null(x: Column) -> Column:
    """Infinite and NaN values become null."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def inf_to_max(x: Column) -> Column:
    """Infinite values of either sign become the largest finite double."""
    return F.when(F.abs(x) == float("inf"), F.lit(MAX_DOUBLE)).otherwise(x)


def clamp_nonneg(x: Column) -> Column:
    """max(x, 0), keeping null."""
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def clip(x: Column, low: Column | None = None, high: Column | None = None) -> Column:
    """Limit x to [low, high]; null stays null, a null bound does not limit."""
    out = x
    if low is not None:
        out = F.when(out < low, low).otherwise(out)
    if high is not None:
        out = F.when(out > high, high).otherwise(out)
    return out


def corr(x: Column, y: Column, over: WindowSpec | None = None) -> Column:
    """Pearson correlation over pairs, null when either side is constant.

    The built-in ``corr`` raises on a constant column in ANSI mode, hence the
    covariance divided by both deviations with a zero guard.
    """
    px, py = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    cov, sx, sy = F.covar_samp(x, y), F.stddev_samp(px), F.stddev_samp(py)
    if over is not None:
        cov, sx, sy = cov.over(over), sx.over(over), sy.over(over)
    return F.try_divide(cov, sx * sy)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also on null)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def rounded(columns: dict[str, Column], digits: int = 6) -> list[Column]:
    """Named columns rounded, ready for ``select``."""
    return [F.round(c, digits).alias(n) for n, c in columns.items()]


def named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]
