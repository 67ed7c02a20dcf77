"""Calendar expressions.  All differences count crossed boundaries, not elapsed time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def date_key(value: Column | str) -> Column:
    """20240307 for 7 March 2024."""
    day = _col(value)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def year_month(value: Column | str) -> Column:
    return F.date_format(_col(value), "yyyy-MM")


def year_quarter(year: Column | str, quarter: Column | str) -> Column:
    return F.concat(_col(year).cast("string"), F.lit("-Q"), _col(quarter).cast("string"))


def iso_weekday(value: Column | str) -> Column:
    """Monday 1 ... Sunday 7."""
    return F.weekday(_col(value)) + 1


def month_floor(value: Column | str) -> Column:
    return F.trunc(_col(value), "month")


def month_number(value: Column | str) -> Column:
    """Months since year 0; subtracting two of them gives the months crossed."""
    day = _col(value)
    return F.year(day) * 12 + F.month(day) - 1


def months_crossed(start: Column | str, end: Column | str) -> Column:
    return month_number(end) - month_number(start)


def hours_crossed(start: Column | str, end: Column | str) -> Column:
    seconds = F.unix_timestamp(F.date_trunc("hour", _col(end))) - F.unix_timestamp(
        F.date_trunc("hour", _col(start))
    )
    return (seconds / 3600).cast("long")
