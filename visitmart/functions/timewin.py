"""Calendar and rolling time windows, and date arithmetic.

"Now" is always an explicit ``as_of`` value supplied by the caller (D1);
nothing here reads the wall clock, so reruns are reproducible.

Windows are written as range predicates on the raw timestamp column
(``ts >= lo AND ts < hi``) whenever possible: Catalyst pushes those down to
the parquet reader as row-group filters, while a predicate wrapped in
``date_format`` is not pushed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_datetime(value: dt.date | dt.datetime | str) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(value)


def as_date(value: dt.date | dt.datetime | str) -> dt.date:
    return as_datetime(value).date()


def ts_literal(value: dt.datetime) -> Column:
    """Wall-clock literal of the same type as the parquet columns.

    Built from ISO text: a Python ``datetime`` literal would pass through the
    Python process's zone and then the session's, which need not agree.
    """
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


_ts_lit = ts_literal


def _midnight(d: dt.date) -> dt.datetime:
    return dt.datetime(d.year, d.month, d.day)


def day_window_inclusive(ts: ColumnOrName, as_of, days: int) -> Column:
    """Calendar day of ``ts`` in [day(as_of), day(as_of) + days].

    The source compares a day text with ``now + n days``; the text becomes
    midnight, so day n is included whatever the time of ``as_of``.
    """
    start = _midnight(as_date(as_of))
    end = start + dt.timedelta(days=days + 1)
    c = _c(ts)
    return (c >= _ts_lit(start)) & (c < _ts_lit(end))


def day_window_half_open(ts: ColumnOrName, as_of, days: int) -> Column:
    """Calendar day of ``ts`` in [day(as_of), day(as_of) + days)."""
    start = _midnight(as_date(as_of))
    end = start + dt.timedelta(days=days)
    c = _c(ts)
    return (c >= _ts_lit(start)) & (c < _ts_lit(end))


def rolling_window(ts: ColumnOrName, as_of, lo_days: float, hi_days: float,
                   lo_inclusive: bool = True, hi_inclusive: bool = True) -> Column:
    """``as_of + lo_days <= ts <= as_of + hi_days`` on exact timestamps."""
    now = as_datetime(as_of)
    lo = _ts_lit(now + dt.timedelta(days=lo_days))
    hi = _ts_lit(now + dt.timedelta(days=hi_days))
    c = _c(ts)
    left = (c >= lo) if lo_inclusive else (c > lo)
    right = (c <= hi) if hi_inclusive else (c < hi)
    return left & right


def month_to_date_bounds(as_of, include_last_day: bool = False) -> tuple[dt.datetime, dt.datetime]:
    """First day of the month at 00:00 and the ``EOMONTH`` bound.

    ``EOMONTH`` is a date; compared with a datetime it is midnight of the
    last day, so appointments later that day fall out unless
    ``include_last_day`` (then the bound is the next month's first midnight,
    exclusive).
    """
    d = as_date(as_of)
    first = dt.datetime(d.year, d.month, 1)
    nxt = dt.datetime(d.year + (d.month == 12), d.month % 12 + 1, 1)
    if include_last_day:
        return first, nxt
    return first, nxt - dt.timedelta(days=1)


def month_to_date(ts: ColumnOrName, as_of, include_last_day: bool = False) -> Column:
    first, bound = month_to_date_bounds(as_of, include_last_day)
    c = _c(ts)
    upper = (c < _ts_lit(bound)) if include_last_day else (c <= _ts_lit(bound))
    return (c >= _ts_lit(first)) & upper


def on_or_after_day(ts: ColumnOrName, day) -> Column:
    """``CONVERT(CHAR(10), ts, 120) >= 'yyyy-mm-dd'`` as a pushable bound."""
    return _c(ts) >= _ts_lit(_midnight(as_date(day)))


def before_day(ts: ColumnOrName, as_of, days: int) -> Column:
    """Calendar day of ``ts`` before day(as_of) + days."""
    return _c(ts) < _ts_lit(_midnight(as_date(as_of)) + dt.timedelta(days=days))


def day_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """D3 ``DATEDIFF(day, start, end)``: calendar days from start to end.

    Note the argument order flips against Spark's ``datediff(end, start)``.
    """
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start))).cast("bigint")


def fmt_mdy(ts: ColumnOrName) -> Column:
    """D6 ``CONVERT(CHAR(10), t, 101)``: ``MM/dd/yyyy`` text."""
    return F.date_format(_c(ts), "MM/dd/yyyy")


def fmt_ymd_compact(ts: ColumnOrName) -> Column:
    """D7 style 112: ``yyyyMMdd`` text."""
    return F.date_format(_c(ts), "yyyyMMdd")


def fmt_iso_day(ts: ColumnOrName) -> Column:
    """D7 styles 23/120/121 cut to 10 characters: ``yyyy-MM-dd`` text."""
    return F.date_format(_c(ts), "yyyy-MM-dd")


def fmt_iso_ts(ts: ColumnOrName) -> Column:
    """Style 120 datetime text, as written to the CSV extracts."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def age_years(birth: ColumnOrName, at: ColumnOrName) -> Column:
    """Completed years between birth and ``at``."""
    b, a = F.to_date(_c(birth)), F.to_date(_c(at))
    before_birthday = (F.month(a) * 100 + F.dayofmonth(a)) < (F.month(b) * 100 + F.dayofmonth(b))
    return (F.year(a) - F.year(b) - F.when(before_birthday, 1).otherwise(0)).cast("bigint")
