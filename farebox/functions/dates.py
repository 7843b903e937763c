"""Calendar keys and boundaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the open end of a current dimension row.
OPEN_END = dt.date(9999, 12, 31)


def date_sk(moment: Column) -> Column:
    """The integer key yyyymmdd of a date or timestamp.

    In arithmetic rather than by formatting: it runs on every fact row.
    """
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def month_key(day: Column) -> Column:
    """The integer month yyyymm of a date."""
    return F.year(day) * 100 + F.month(day)


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def day_or_today(day: dt.date | None) -> Column:
    return F.current_date() if day is None else F.lit(day)


def moment_or_now(moment: dt.datetime | None) -> Column:
    """A zone-less timestamp: the given one, or the clock in the session's zone."""
    now = F.current_timestamp() if moment is None else F.lit(moment.isoformat(sep=" "))
    return now.cast("timestamp_ntz")
