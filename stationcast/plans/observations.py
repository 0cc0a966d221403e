"""Station observation responses to archived observation rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from .. import rules
from ..operators.accumulate import rolling_total
from ..operators.extremes import TMAX_12_TO_06, TMIN_00_TO_18, daily_extreme
from ..sources.observations import parse_precipitation, parse_temperatures, parse_timeseries
from ..sources.stations import with_attributes


def wind_observations(payloads: DataFrame, attributes: DataFrame) -> DataFrame:
    rows = with_attributes(parse_timeseries(payloads, rules.OBSERVATION_COLUMNS), attributes)
    values = list(rules.OBSERVATION_COLUMNS.values())
    return rows.select("stid", "lat", "lon", "elev", "valid_time", "NWSZONE", "NWSCWA", *values)


def precipitation_totals(payloads: DataFrame, attributes: DataFrame, element: str) -> DataFrame:
    """Rolling totals; the lookup comes last, on the rows that remain."""
    accum, step = rules.PRECIP_SPANS[element]
    rows = rolling_total(
        parse_precipitation(payloads),
        accum_hours=accum,
        step_hours=step,
        tiebreak=["interval_precip", "lat", "lon", "elev"],
    )
    return with_attributes(rows, attributes).select(
        "stid", "lat", "lon", "elev", "accum_hours", "step_hours", "start_time", "end_time",
        "precip_total", "precip_units", "NWSZONE", "NWSCWA",
    )


def temperature_extremes(
    payloads: DataFrame,
    attributes: DataFrame,
    element: str,
    *,
    first_day: datetime | None = None,
    last_day: datetime | None = None,
    units: str = "english",
) -> DataFrame:
    """Daily maxima ("maxt") or minima ("mint")."""
    rows = daily_extreme(
        parse_temperatures(payloads),
        TMAX_12_TO_06 if element == "maxt" else TMIN_00_TO_18,
        attributes=["lat", "lon", "elev"],
        first_day=first_day,
        last_day=last_day,
        units=units,
    )
    return with_attributes(rows, attributes)


def observations(payloads: DataFrame, attributes: DataFrame, element: str, **days) -> DataFrame:
    """Archive rows of one observation element."""
    if element == "Wind":
        return wind_observations(payloads, attributes)
    if element in rules.PRECIP_SPANS:
        return precipitation_totals(payloads, attributes, element)
    if element in ("maxt", "mint"):
        return temperature_extremes(payloads, attributes, element, **days)
    raise ValueError(f"no observation element {element!r}")
