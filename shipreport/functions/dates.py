"""Date and time texts, day truncation and the last-week window.

Times are read from the timestamp's own text, so a zone-free timestamp is never
shifted by the session time zone's daylight saving gaps.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def fmt_date(col: Column) -> Column:
    """``dd/MM/yyyy``."""
    return F.date_format(col.cast("date"), "dd/MM/yyyy")


def fmt_time(col: Column) -> Column:
    """``HH:mm:ss``."""
    return F.substring(col.cast("string"), 12, 8)


def fmt_default(col: Column) -> Column:
    """SQL Server's default text, e.g. ``Mar  5 2024  2:05PM``."""
    day = col.cast("date")
    clock = F.concat(
        ((F.hour(col) + 11) % 12 + 1).cast("string"),
        F.lit(":"),
        F.lpad(F.minute(col).cast("string"), 2, "0"),
        F.when(F.hour(col) < 12, "AM").otherwise("PM"),
    )
    return F.concat(
        F.date_format(day, "MMM"), F.lit(" "),
        F.lpad(F.dayofmonth(day).cast("string"), 2, " "), F.lit(" "),
        F.date_format(day, "yyyy"), F.lit(" "),
        F.lpad(clock, 7, " "),
    )


def day_of(col: Column) -> Column:
    """The timestamp at midnight of its day."""
    return col.cast("date").cast("timestamp_ntz")


def last_week(day: Column) -> tuple[Column, Column]:
    """Sunday and Saturday of the last full week before ``day``.

    On a Saturday the week that ended a week ago is taken.
    """
    back = F.pmod(F.weekday(day) + 2, F.lit(7))
    saturday = F.date_sub(day, F.when(back == 0, 7).otherwise(back))
    return F.date_sub(saturday, 6), saturday


def last_week_of(day: dt.date) -> tuple[dt.date, dt.date]:
    """``last_week`` of one known day, so that it can be pushed to a scan as literals."""
    back = (day.weekday() + 2) % 7 or 7
    saturday = day - dt.timedelta(days=back)
    return saturday - dt.timedelta(days=6), saturday
