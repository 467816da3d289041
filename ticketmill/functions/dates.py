"""Dates and months as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_time(text: str | Column) -> Column:
    """Timestamp of an ISO text; null if it does not parse. The session time zone is UTC."""
    return F.try_to_timestamp(_column(text).cast("string"))


def day_text(ts: str | Column) -> Column:
    return F.date_format(_column(ts), "yyyy-MM-dd")


def month_tag(ts: str | Column) -> Column:
    """A month as ``Nov-2025``."""
    return F.date_format(_column(ts), "MMM-yyyy")


def month_start(ts: str | Column) -> Column:
    return F.date_trunc("month", _column(ts)).cast("date")


def month_end(ts: str | Column) -> Column:
    """First day of the next month, the open end of a month's interval."""
    return F.add_months(month_start(ts), 1)


def in_month(ts: str | Column, month: Column) -> Column:
    return (_column(ts) >= month_start(month)) & (_column(ts) < month_end(month))


def within_days(ts: str | Column, as_of: Column, days: int) -> Column:
    """Not older than a number of days before ``as_of``; the query time is always an argument."""
    return _column(ts) >= as_of - F.make_dt_interval(F.lit(days))


def last_months(as_of: Column, months: int = 3) -> Column:
    """The month of ``as_of`` and those before it, as an array of first days."""
    start = month_start(as_of)
    return F.sequence(F.add_months(start, 1 - months), start, F.expr("interval 1 month"))
