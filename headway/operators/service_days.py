"""Service days as bitmaps (OP-P18..P20, OP-U1, OP-C4).

A service is one row per 64 days, counted from 1970-01-01, with a bit per day on which it runs. A
calendar row sets the bits of its weekdays within its range, exceptions set or clear single bits; all of
them meet in one aggregation by (service, word), with bit operations before and after the shuffle. From
then on a range of dates is one scan of a few words and a bit test, whatever its length.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.clock import WEEKDAYS

from .snapshot import ADDED, REMOVED

EPOCH = dt.date(1970, 1, 1)
DAYS = 64


def _signed(x: int) -> int:
    return x - (1 << DAYS) if x >> (DAYS - 1) else x


# Bits of every seventh day, by the first of them.
EVERY_SEVENTH = [_signed(sum(1 << i for i in range(r, DAYS, 7))) for r in range(7)]


def _number(day: dt.date) -> int:
    return (day - EPOCH).days


def _weekly(word: Column) -> Column:
    """Bits of a word on the weekdays whose flag is set. 64 days are nine weeks and one day, and
    1970-01-01 was a Thursday, three days after a Monday."""
    out = F.lit(0).cast("bigint")
    for k, name in enumerate(WEEKDAYS):
        bits = F.element_at(F.array(*map(F.lit, EVERY_SEVENTH)), (F.pmod(F.lit(k - 3) - word, F.lit(7)) + 1).cast("int"))
        out = out.bitwiseOR(F.when(F.col(name) == 1, bits).otherwise(0))
    return out


def _between(word: Column, first: Column, last: Column) -> Column:
    """Bits of the days first..last of a word they touch."""
    low = F.greatest(F.lit(0), first - word * DAYS).cast("int")
    high = F.least(F.lit(DAYS - 1), last - word * DAYS).cast("int")
    ones = F.lit(-1).cast("bigint")
    up = F.call_function("shiftleft", ones, low)
    return up.bitwiseAND(F.call_function("shiftrightunsigned", ones, F.lit(DAYS - 1) - high))


def service_days(
    calendar: DataFrame, calendar_dates: DataFrame, first: dt.date, last: dt.date, mode: str = "reference"
) -> DataFrame:
    """service_id, word, days: a bit per day between two dates on which the service runs.

    ``mode`` is that of ``services_on_date``: ``"reference"`` takes every exception as an
    addition, ``"gtfs"`` lets type 2 remove the service and type 1 add it, additions last.
    Words without a day are left out.
    """
    if mode not in ("reference", "gtfs"):
        raise ValueError(f"unknown mode {mode!r}")
    lo, hi = F.lit(_number(first)), F.lit(_number(last))
    begin, end = F.greatest(F.unix_date("start_date"), lo), F.least(F.unix_date("end_date"), hi)
    zero = F.lit(0).cast("bigint")
    none = {n: zero for n in ("regular", "added", "removed")}

    def part(df: DataFrame, name: str, bits: Column) -> DataFrame:
        return df.select("service_id", "word", *[(bits if n == name else c).alias(n) for n, c in none.items()])

    spans = (
        calendar.withColumns({"__begin": begin, "__end": end})
        .filter("start_date <= end_date AND __begin <= __end")
        .withColumn("word", F.explode(F.sequence(F.floor(F.col("__begin") / DAYS), F.floor(F.col("__end") / DAYS))))
    )
    word = F.col("word")
    rows = part(spans, "regular", _weekly(word).bitwiseAND(_between(word, F.col("__begin"), F.col("__end"))))
    day = F.unix_date("date")
    single = calendar_dates.filter(day.between(lo, hi)).withColumn("word", F.floor(day / DAYS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(DAYS)).cast("int"))
    kinds = [("added", F.lit(True))] if mode == "reference" else [("added", F.col("exception_type") == ADDED), ("removed", F.col("exception_type") == REMOVED)]
    for name, wanted in kinds:
        rows = rows.unionByName(part(single.filter(wanted), name, bit))
    runs = F.bit_or("regular").bitwiseAND(F.bitwise_not(F.bit_or("removed"))).bitwiseOR(F.bit_or("added"))
    return rows.groupBy("service_id", "word").agg(runs.alias("days")).filter("days <> 0")


def services_in_range(days: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """service_id and date of every day between two dates on which a service runs."""
    lo, hi = _number(first), _number(last)
    word = F.col("word")
    asked = days.filter(word.between(lo // DAYS, hi // DAYS)).withColumn(
        "__days", F.col("days").bitwiseAND(_between(word, F.lit(lo), F.lit(hi)))
    )
    each = F.filter(F.sequence(F.lit(0), F.lit(DAYS - 1)), lambda i: F.call_function("getbit", F.col("__days"), i) == 1)
    date = F.date_add(F.lit(EPOCH), (word * DAYS + F.col("__i")).cast("int"))
    return asked.filter("__days <> 0").withColumn("__i", F.explode(each)).select("service_id", date.alias("date"))


def running_on(days: DataFrame, date: dt.date) -> DataFrame:
    """service_id of the services that run on a date: one word, one bit."""
    n = _number(date)
    bit = F.call_function("getbit", F.col("days"), F.lit(n % DAYS))
    return days.filter((F.col("word") == n // DAYS) & (bit == 1)).select("service_id")


def active_days(days: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """service_id, n_days: on how many days between two dates a service runs. No day is listed."""
    lo, hi = _number(first), _number(last)
    word = F.col("word")
    bits = F.bit_count(F.col("days").bitwiseAND(_between(word, F.lit(lo), F.lit(hi))))
    asked = days.filter(word.between(lo // DAYS, hi // DAYS))
    return asked.groupBy("service_id").agg(F.sum(bits).alias("n_days")).filter("n_days > 0")


def trips_per_day(days: DataFrame, trips: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """date, trips: how many trips run on each day between two dates.

    Trips are counted by service before they meet the days, so none is listed per day.
    """
    per_service = trips.groupBy("service_id").agg(F.count(F.lit(1)).alias("n"))
    met = services_in_range(days, first, last).join(per_service, "service_id")
    return met.groupBy("date").agg(F.sum("n").alias("trips"))
