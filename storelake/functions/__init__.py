"""Column helpers shared by the models and questions (no UDFs)."""

from storelake.functions.calendar import (
    date_key,
    hours_crossed,
    iso_weekday,
    month_floor,
    months_crossed,
    year_month,
    year_quarter,
)
from storelake.functions.keys import surrogate_key, with_audit
from storelake.functions.numbers import as_double, half_up, ratio

__all__ = [
    "as_double",
    "date_key",
    "half_up",
    "hours_crossed",
    "iso_weekday",
    "month_floor",
    "months_crossed",
    "ratio",
    "surrogate_key",
    "with_audit",
    "year_month",
    "year_quarter",
]
