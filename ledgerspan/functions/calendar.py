"""Calendar arithmetic on dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = "dt.date | str | Column"


def as_date(value) -> Column:
    """A date column from a Python date, an ISO string or a column."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")


def month_bucket(date: Column) -> Column:
    """``YYYY-MM`` text; sorts like the dates do."""
    return F.date_format(date, "yyyy-MM")


def month_text(value: dt.date | str) -> str:
    """``YYYY-MM`` of a Python date or an ISO date string."""
    return (value if isinstance(value, dt.date) else dt.date.fromisoformat(value)).strftime("%Y-%m")


def days_in_month(date: Column) -> Column:
    return F.dayofmonth(F.last_day(date))


def days_left_in_month(date: Column) -> Column:
    """Days from ``date`` to the end of its month, both included."""
    return F.datediff(F.last_day(date), date) + 1


def days_between(end: Column, start: Column) -> Column:
    """``end - start`` in days as a bigint; negative when ``end`` comes first."""
    return F.datediff(end, start).cast("bigint")


def daily_series(start: Column, end: Column) -> Column:
    """All days from ``start`` to ``end``, both included.

    Null (so ``explode`` yields no row) when a bound is null or ``start > end``; a bare ``sequence``
    would raise or count down there.
    """
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day")))


def month_series(start: Column, end: Column) -> Column:
    """First days of all months touched by ``start .. end``; null when the range is empty."""
    first = F.trunc(start, "month")
    return F.when(start <= end, F.sequence(first, end, F.expr("interval 1 month")))
