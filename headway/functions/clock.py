"""Service-day clocks and dates.

GTFS clocks run past midnight (``25:49:59`` is 01:49:59 on the next calendar
day).  Two conversions exist and disagree around clock changes, so both are
kept under different names:

* ``service_clock_to_epoch`` (F2): local time at ``h % 24`` on the service date
  plus ``floor(h / 24)`` fixed 86 400-second days.
* ``wall_clock_to_epoch`` (F3): local time at ``h % 24`` on the calendar date
  ``service date + floor(h / 24)``; ``strict=True`` raises on local times that
  do not exist or occur twice.

Both build the timestamp with an explicit zone, so the session zone (pinned to
UTC by ``headway.session``) never enters the arithmetic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_TZ = "America/Montreal"
SECONDS_PER_DAY = 86400


def as_date(day: str | dt.date) -> dt.date:
    """Accept ``YYYYMMDD``, ``YYYY-MM-DD`` or a date."""
    if isinstance(day, dt.datetime):
        return day.date()
    if isinstance(day, dt.date):
        return day
    text = str(day).strip()
    fmt = "%Y%m%d" if len(text) == 8 and text.isdigit() else "%Y-%m-%d"
    return dt.datetime.strptime(text, fmt).date()


def shifted_day(day: str | dt.date, days: int) -> dt.date:
    """F8: the job day arithmetic (merge -1, analyse -2, next day +1)."""
    return as_date(day) + dt.timedelta(days=days)


def weekday_name(day: str | dt.date) -> str:
    """F7 on the driver-side parameter: lower-case English weekday name."""
    return as_date(day).strftime("%A").lower()


def weekday_name_col(date_col: Column) -> Column:
    """F7 as an expression for multi-day forms."""
    return F.lower(F.date_format(date_col, "EEEE"))


def date_folder(day: str | dt.date) -> str:
    """``YYYY/MM/DD`` folder text of a day."""
    return as_date(day).strftime("%Y/%m/%d")


def clock_parts(clock: Column) -> tuple[Column, Column, Column]:
    """``H..H:MM:SS`` -> (hours, minutes, seconds) as INT; strict casts raise on bad text."""
    parts = F.split(clock, ":")
    return (parts.getItem(0).cast("int"), parts.getItem(1).cast("int"),
            parts.getItem(2).cast("int"))


def service_clock_to_epoch(clock: Column, day: str | dt.date, tz: str = DEFAULT_TZ) -> Column:
    """fixed-length-day form, any number of extra days, BIGINT epoch seconds."""
    d = as_date(day)
    h, m, s = clock_parts(clock)
    local = F.make_timestamp(F.lit(d.year), F.lit(d.month), F.lit(d.day), h % 24, m, s, F.lit(tz))
    extra_days = F.floor(h / F.lit(24)).cast("bigint")
    return F.unix_seconds(local) + extra_days * F.lit(SECONDS_PER_DAY)


def wall_clock_to_epoch(clock: Column, day: str | dt.date, tz: str = DEFAULT_TZ,
                        strict: bool = False) -> Column:
    """wall-clock form on the calendar date ``day + floor(h / 24)``.

    Lenient (default): a time inside a spring-forward gap moves forward, an
    ambiguous autumn time takes the earlier offset.  ``strict=True`` raises
    for both, like a localisation with DST disambiguation switched off.
    """
    d = as_date(day)
    h, m, s = clock_parts(clock)
    date = F.date_add(F.lit(d), F.floor(h / F.lit(24)).cast("int"))
    y, mo, dd = F.year(date), F.month(date), F.dayofmonth(date)
    instant = F.make_timestamp(y, mo, dd, h % 24, m, s, F.lit(tz))
    epoch = F.unix_seconds(instant)
    if not strict:
        return epoch
    wall = F.make_timestamp(y, mo, dd, h % 24, m, s, F.lit("UTC"))
    missing = F.from_utc_timestamp(instant, tz) != wall
    twice = F.from_utc_timestamp(instant + F.expr("INTERVAL 1 HOUR"), tz) == wall
    return (F.when(missing, F.raise_error(F.concat(F.lit("non-existent local time "), clock)))
            .when(twice, F.raise_error(F.concat(F.lit("ambiguous local time "), clock)))
            .otherwise(epoch))


def yyyymmdd_to_date(col: Column, already_date: bool = False) -> Column:
    """``YYYYMMDD`` text (or integer) -> DATE, untouched when already a date."""
    if already_date:
        return col
    return F.to_date(col.cast("string"), "yyyyMMdd")
