"""Date and time helpers.

Week semantics follow the reference: weeks start on Sunday, weekday numbers run Monday = 1 to
Sunday = 7.  Spark's ``date_trunc('week', ..)`` starts on Monday, so it is not used.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_start_sunday(c) -> Column:
    """First day (a Sunday) of the week holding ``c``; result is a DATE."""
    d = F.to_date(_col(c))
    return F.date_sub(d, F.dayofweek(d) - 1)


def iso_weekday(c) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(F.to_date(_col(c))) + 1


def weekday_name(c) -> Column:
    """English weekday name, e.g. 'Monday'."""
    return F.date_format(_col(c), "EEEE")


def hour_start(c) -> Column:
    return F.date_trunc("hour", _col(c))


def months_before(as_of, months: int) -> dt.datetime:
    """Calendar arithmetic done on the driver so the bound reaches the scan as a literal."""
    d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of)[:10])
    total = d.year * 12 + (d.month - 1) - months
    year, month = divmod(total, 12)
    month += 1
    # clamp the day the way add_months does
    for day in (d.day, 30, 29, 28):
        try:
            return dt.datetime(year, month, day)
        except ValueError:
            continue
    raise ValueError(as_of)


def _ts(v) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    return dt.datetime.fromisoformat(str(v))


EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_micros(c) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ wall-clock value.

    Built from the date and the time-of-day fields, so no session time zone takes part (Spark's
    ``timestamp_diff`` on NTZ values goes through the session zone and is off by an hour around
    a daylight-saving change)."""
    c = _col(c)
    return (F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400_000_000)
            + F.hour(c).cast("long") * F.lit(3_600_000_000)
            + F.minute(c).cast("long") * F.lit(60_000_000)
            + (F.extract(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long"))


def wall_instant(c) -> Column:
    """A TIMESTAMP (instant) whose UTC reading equals the NTZ wall clock: event time for
    watermarks and windows that follows wall-clock days in any session time zone."""
    return F.timestamp_micros(ntz_micros(c))


def wall_clock(c) -> Column:
    """Inverse of ``wall_instant``: the UTC reading of an instant, as TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(c)), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def seconds_between(start, end) -> Column:
    """``end - start`` in seconds (DOUBLE) for TIMESTAMP_NTZ values, time-zone free."""
    return (ntz_micros(end) - ntz_micros(start)) / F.lit(1_000_000.0)


def ts_lit(v) -> Column:
    """A TIMESTAMP_NTZ literal (wall-clock time, no session time zone involved)."""
    return F.lit(_ts(v).isoformat(sep=" ")).cast("timestamp_ntz")


def between_ts(df: DataFrame, lo, hi, ts_col: str = "ts", date_col: str | None = None,
               grain: str = "day") -> DataFrame:
    """Half-open range ``lo <= ts < hi``.

    When the table is partitioned by a date column derived from ``ts`` (``date_col``: the day,
    or with ``grain='month'`` the first day of the month), the equivalent predicate on that column
    is added too: Spark does not derive partition filters from a predicate on ``ts`` alone, so
    without it every partition would be listed and opened.
    """
    lo_ts, hi_ts = _ts(lo), _ts(hi)
    out = df.filter((F.col(ts_col) >= ts_lit(lo_ts)) & (F.col(ts_col) < ts_lit(hi_ts)))
    if date_col is not None:
        lo_d = lo_ts.date()
        hi_d = hi_ts.date() if hi_ts.time() != dt.time(0) else hi_ts.date() - dt.timedelta(days=1)
        if grain == "month":
            lo_d, hi_d = lo_d.replace(day=1), hi_d.replace(day=1)
        out = out.filter((F.col(date_col) >= F.lit(lo_d)) & (F.col(date_col) <= F.lit(hi_d)))
    return out


def since(df: DataFrame, col: str, as_of, months: int) -> DataFrame:
    """Rows with ``col >= as_of - months`` (F03); ``as_of`` is a parameter, never the clock."""
    return df.filter(F.col(col) >= ts_lit(months_before(as_of, months)))
