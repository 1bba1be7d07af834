"""Date and time expressions (CLN-18/19, SC-8..21).

All differences count calendar *boundaries* crossed (``b - a``), the
semantics of the warehouse's ``DATEDIFF``; none of them depends on the
session time zone, so they are exact for ``timestamp_ntz`` input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_diff(a, b) -> Column:
    """Days between the calendar dates of ``a`` and ``b`` (negative = b earlier)."""
    return F.datediff(F.to_date(_c(b)), F.to_date(_c(a)))


def minute_diff(a, b) -> Column:
    """Minute boundaries crossed from ``a`` to ``b`` (00:00:59 -> 00:01:01 is 1)."""
    a, b = _c(a), _c(b)
    return (day_diff(a, b).cast("long") * 1440
            + (F.hour(b) * 60 + F.minute(b)) - (F.hour(a) * 60 + F.minute(a)))


def month_diff(a, b) -> Column:
    """Month boundaries crossed (2020-01-31 -> 2020-02-01 is 1)."""
    a, b = _c(a), _c(b)
    return (F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))


def month_start(c) -> Column:
    return F.trunc(F.to_date(_c(c)), "MM")


def date_key(c) -> Column:
    """Smart key ``yyyyMMdd`` as INT, computed arithmetically (no string formatting)."""
    d = F.to_date(_c(c))
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def date_from_key(c) -> Column:
    return F.to_date(_c(c).cast("string"), "yyyyMMdd")


def us_week(c) -> Column:
    """US week number: week 1 holds Jan 1, weeks start on Sunday."""
    d = F.to_date(_c(c))
    return F.floor((F.dayofyear(d) + F.dayofweek(F.trunc(d, "YEAR")) - 2) / 7).cast("int") + 1


def is_weekend(c) -> Column:
    return F.dayofweek(F.to_date(_c(c))).isin(1, 7).cast("int")


def weekday_mon0(c) -> Column:
    """Day of week with Monday = 0 … Sunday = 6."""
    return F.weekday(F.to_date(_c(c)))


def year_month(c) -> Column:
    """``yyyy-MM`` text label."""
    return F.date_format(F.to_date(_c(c)), "yyyy-MM")


def month_name(c) -> Column:
    return F.date_format(F.to_date(_c(c)), "MMMM")


def day_name(c) -> Column:
    return F.date_format(F.to_date(_c(c)), "EEEE")


def add_minutes(ts, n) -> Column:
    return F.timestamp_add("MINUTE", _c(n), _c(ts))


def add_days(ts, n) -> Column:
    return F.timestamp_add("DAY", _c(n), _c(ts))
