"""Timestamp expressions and driver-side calendars."""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def micros(c: Column) -> Column:
    """Microseconds since 1970 for either timestamp type."""
    return F.unix_micros(c.cast("timestamp"))


def slice_start(t: Column, width: int) -> Column:
    """Start of the fixed-width time slice that holds ``t`` (both in micros)."""
    return t - F.pmod(t, F.lit(width))


def hours(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} HOURS")


def parse_compact(c: Column) -> Column:
    """``yyyyMMdd``, ``yyyyMMddHH`` or ``yyyyMMddHHmm`` text; anything else is NULL."""
    text = c.cast("string")
    padded = F.when(F.length(text).isin(8, 10, 12), F.rpad(text, 12, "0"))
    return F.try_to_timestamp(padded, F.lit("yyyyMMddHHmm"))


def parse_day(c: Column) -> Column:
    return F.date_trunc("day", parse_compact(c))


def parse_utc(c: Column) -> Column:
    """ISO text to timestamp, NULL when it does not parse."""
    return c.try_cast("timestamp")


def init_time(valid: Column, lead_hours: Column) -> Column:
    return valid - F.make_dt_interval(F.lit(0), lead_hours.cast("int"))


def lead_hours(step_seconds: Column) -> Column:
    return (step_seconds / F.lit(3600)).cast("int")


def month_starts(start: Column, end: Column) -> Column:
    """Array of the first days of all months from ``start`` to ``end`` inclusive."""
    first = F.trunc(start, "month")
    return F.sequence(first, F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))


def run_times(start: Column, end: Column, cycle_hours: int) -> Column:
    return F.sequence(start, end, hours(cycle_hours))


def lookback_days(start: Column, end: Column, days: int = 3) -> Column:
    """Timestamps one day apart, from ``days`` before ``start`` up to ``end``."""
    first = start - F.expr(f"INTERVAL {int(days)} DAYS")
    return F.sequence(first, end, F.expr("INTERVAL 1 DAY"))


def months_between(start: date, end: date) -> list[tuple[int, int]]:
    """Inclusive (year, month) list, for resolving monthly archive files."""
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [(m // 12, m % 12 + 1) for m in range(first, last + 1)]


def add_month(t: datetime) -> datetime:
    """Same day next month, held back to the month's last day."""
    year, month = (t.year + 1, 1) if t.month == 12 else (t.year, t.month + 1)
    return t.replace(year=year, month=month, day=min(t.day, calendar.monthrange(year, month)[1]))


def month_chunks(start: datetime, end: datetime) -> list[tuple[datetime, datetime]]:
    """Month-long fetch windows, each ending a minute before the next.

    The start is stepped month by month, so a start on the 31st stays on the 28th
    once it has passed through February.
    """
    chunks = []
    while start <= end:
        following = add_month(start)
        chunks.append((start, min(following - timedelta(minutes=1), end)))
        start = following
    return chunks


def ten_day_chunks(start: datetime, end: datetime) -> list[tuple[datetime, datetime]]:
    """Ten-day fetch windows that never cross a month end."""
    chunks = []
    minute = timedelta(minutes=1)
    while start <= end:
        last_day = calendar.monthrange(start.year, start.month)[1]
        month_end = start.replace(day=last_day, hour=23, minute=59)
        stop = min(start + timedelta(days=10) - minute, month_end)
        chunks.append((start, min(stop, end)))
        start = chunks[-1][1] + minute
    return chunks
