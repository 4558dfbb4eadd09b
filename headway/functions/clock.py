"""Times of feeds: epochs, service days, schedule offsets (OP-P9..P11, P18..P20)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import as_col, whole_number

FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799
HMS = r"^\s*(\d{1,5})\s*:\s*([0-5]?\d)\s*:\s*([0-5]?\d)(?:\.\d*)?\s*(?::.*)?$"

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def epoch_to_ts(c: Column | str) -> Column:
    """OP-P9: epoch seconds as text to an instant; NULL if not a number, or none
    of the years 1 to 9999 (say, microseconds)."""
    seconds = whole_number(c, "bigint")
    return F.timestamp_seconds(F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds))


def hms_to_seconds(c: Column | str) -> Column:
    """OP-P10: ``HH:MM:SS`` to seconds. Hours may pass 24; a sign, minutes or
    seconds above 59, too few parts and more than five digits of hours are NULL."""
    text = F.trim(as_col(c).cast("string"))
    part = lambda i: F.regexp_extract(text, HMS, i).try_cast("int")
    return F.when(text.rlike(HMS), part(1) * 3600 + part(2) * 60 + part(3))


def service_midnight(date: Column | str, tz: str, anchor: str = "midnight") -> Column:
    """Epoch seconds schedule offsets of a service date count from.

    ``anchor="midnight"`` is local midnight. ``anchor="noon"`` is noon minus
    twelve hours, as the feed standard has it; the two differ by an hour on
    the days the clocks change.
    """
    if anchor not in ("midnight", "noon"):
        raise ValueError(f"unknown anchor {anchor!r}")
    d = as_col(date)
    hour = 12 if anchor == "noon" else 0
    at = F.make_timestamp(
        F.year(d), F.month(d), F.day(d), F.lit(hour), F.lit(0), F.lit(0), F.lit(tz)
    )
    return F.unix_seconds(at) - F.lit(hour * 3600)


def scheduled_ts(
    date: Column | str, seconds: Column | str, tz: str, anchor: str = "midnight"
) -> Column:
    """OP-P11: instant of a schedule offset on a service date in the feed's zone."""
    at = F.try_add(service_midnight(date, tz, anchor), as_col(seconds).cast("bigint"))
    return F.timestamp_seconds(F.when(at.between(FIRST_SECOND, LAST_SECOND), at))


def runs_on(service_date: dt.date) -> Column:
    """OP-P18/P19: calendar row runs on the date (weekday flag set, range inclusive)."""
    flag = F.col(WEEKDAYS[service_date.weekday()])
    return (flag == 1) & F.lit(service_date).between(F.col("start_date"), F.col("end_date"))
