"""Date helpers: integer date keys, year-month, period bounds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_from_int(c: str | Column) -> Column:
    """yyyyMMdd integer -> DATE; invalid keys give NULL instead of an ANSI error."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(col.cast("string"), "yyyyMMdd")


def timestamp_of(at: dt.datetime | None) -> Column:
    """``at`` as a timestamp, a time without a zone being one of the session's zone; the
    session clock if it is None."""
    return F.current_timestamp() if at is None else F.lit(at.isoformat(sep=" ")).cast("timestamp")


def year_month(c: str | Column) -> Column:
    """yyyyMM as INT, e.g. 2001-06-30 -> 200106."""
    d = F.col(c) if isinstance(c, str) else c
    return (F.year(d) * 100 + F.month(d)).cast("int")


def _first_of_month(d: dt.date) -> dt.date:
    return d.replace(day=1)


def _add_months(d: dt.date, months: int) -> dt.date:
    y, m = divmod(d.year * 12 + (d.month - 1) + months, 12)
    return dt.date(y, m + 1, 1)


def period_bounds(as_of: dt.date) -> dict[str, dt.date]:
    """The start dates of every period of the master table.

    Lower bounds for MTD/YTD and the trailing windows ("last n days" keeps n + 1 days, as the
    reference's ``>= today - n`` does, Q4); first days of the three previous months. M-3 is
    the true third previous month (the reference's "minus 62 days" repeats M-2 in February and
    September, Q2).
    """
    first = _first_of_month(as_of)
    return {
        "mtd": first,
        "ytd": as_of.replace(month=1, day=1),
        "last7d": as_of - dt.timedelta(days=7),
        "last14d": as_of - dt.timedelta(days=14),
        "last30d": as_of - dt.timedelta(days=30),
        "last60d": as_of - dt.timedelta(days=60),
        "last90d": as_of - dt.timedelta(days=90),
        "last4w": as_of - dt.timedelta(days=28),
        "m1": _add_months(first, -1),
        "m2": _add_months(first, -2),
        "m3": _add_months(first, -3),
    }


def month_end(first_day: dt.date) -> dt.date:
    return _add_months(first_day, 1) - dt.timedelta(days=1)
