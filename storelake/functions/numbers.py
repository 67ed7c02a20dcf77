"""Money stays DECIMAL (order-independent sums); ratios are rounded doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def half_up(value: Column, digits: int) -> Column:
    """Round a double half away from zero, the same way on every engine."""
    scale = float(10**digits)
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5).cast("double") / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in double; NULL on a zero or NULL denominator (ANSI mode raises otherwise)."""
    return as_double(numerator) / F.nullif(as_double(denominator), F.lit(0.0))
