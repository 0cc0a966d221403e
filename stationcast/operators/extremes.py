"""Daily temperature extremes over fixed UTC windows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import hours
from ..functions.units import to_number


@dataclass(frozen=True)
class DailyWindow:
    """Hours [start, end) counted from 00Z of the anchor day; ``end`` may pass 24."""

    column: str
    start: int
    end: int
    largest: bool

    def holds(self, time: Column) -> Column:
        hour = F.hour(time)
        if self.end > 24:
            return (hour >= self.start) | (hour < self.end - 24)
        return (hour >= self.start) & (hour < self.end)


# Fixed values.  The closing hours 06Z and 18Z themselves are outside the windows.
TMAX_12_TO_06 = DailyWindow("tmax", 12, 30, largest=True)
TMIN_00_TO_18 = DailyWindow("tmin", 0, 18, largest=False)


def first_known(column: str, time: str) -> Column:
    """Aggregate: the column's first non-null value in time order (ties by value)."""
    return F.min(F.when(F.col(column).isNotNull(), F.struct(time, column)))[column]


def daily_extreme(
    temps: DataFrame,
    window: DailyWindow,
    *,
    station: str = "stid",
    time: str = "valid_time",
    value: str = "temp",
    attributes: Sequence[str] = ("lat", "lon", "elev", "NWSZONE", "NWSCWA"),
    first_day: datetime | None = None,
    last_day: datetime | None = None,
    units: str = "english",
) -> DataFrame:
    """Highest or lowest temperature per station and anchor day.

    ``first_day`` and ``last_day`` bound the anchor day, both inclusive.  A window
    whose temperatures are all missing still yields a row, with a null extreme.

    Reports are first combined per day and set of attributes, of which a station has one
    as a rule.  Times and temperatures are of fixed width, so this is done by hashing, in
    each task before the shuffle; only the few sets of a day are then compared in order.
    """
    if first_day and last_day and last_day < first_day:
        raise ValueError("last_day is before first_day")
    start = F.col(time) - hours(window.start)
    inside = temps.where(F.col(station).isNotNull() & window.holds(F.col(time)))
    if first_day:
        inside = inside.where(F.col(time) >= F.lit(first_day) + hours(window.start))
    if last_day:
        inside = inside.where(F.col(time) < F.lit(last_day) + hours(window.start + 24))
    extreme = F.max if window.largest else F.min
    day = F.date_trunc("day", start).cast(temps.schema[time].dataType)
    sets = inside.groupBy(station, day.alias("date"), *attributes).agg(
        extreme(to_number(F.col(value))).alias(window.column), F.min(time).alias("_first")
    )
    return (
        sets.groupBy(station, "date")
        .agg(extreme(window.column).alias(window.column), *[first_known(c, "_first").alias(c) for c in attributes])
        .select(
            station,
            *[c for c in attributes if not c.startswith("NWS")],
            "date",
            (F.col("date") + hours(window.start)).alias("window_start"),
            (F.col("date") + hours(window.end)).alias("window_end"),
            window.column,
            F.lit("F" if units.lower() == "english" else "C").alias("temp_units"),
            *[c for c in attributes if c.startswith("NWS")],
        )
    )
