"""Observation JSON to rows.

Responses are parsed where they lie, one row per response, and exploded in place;
nothing is shuffled except by the optional attribute lookup.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import parse_utc
from ..functions.units import to_number

_PLACE = "STID string, NAME string, LATITUDE string, LONGITUDE string, ELEVATION string"
TIMESERIES_JSON = f"STATION array<struct<{_PLACE}, OBSERVATIONS map<string, array<string>>>>"
PRECIP_JSON = (
    "UNITS struct<precipitation string>, "
    f"STATION array<struct<{_PLACE}, "
    "OBSERVATIONS struct<precipitation array<struct<last_report string, total string>>>>>"
)


def _place() -> list[Column]:
    return [
        F.col("STID").alias("stid"),
        to_number(F.col("LATITUDE")).alias("lat"),
        to_number(F.col("LONGITUDE")).alias("lon"),
        to_number(F.col("ELEVATION")).alias("elev"),
    ]


def _reports(name: str | Column) -> Column:
    return F.try_element_at("OBSERVATIONS", name if isinstance(name, Column) else F.lit(name))


def parse_timeseries(payloads: DataFrame, variables: Mapping[str, str]) -> DataFrame:
    """One row per station and report time with the listed variables.

    ``variables`` maps reported names to column names.  Values belong to times by
    position: a short series leaves nulls, a long one is cut off.  Stations without
    times give no rows.
    """
    stations = payloads.select(F.inline(F.from_json("payload", TIMESERIES_JSON)["STATION"]))
    at = F.col("_at")
    return stations.select("*", F.posexplode(_reports("date_time")).alias("_at", "_time")).select(
        *_place(),
        parse_utc(F.col("_time")).alias("valid_time"),
        *[to_number(F.get(_reports(name), at)).alias(column) for name, column in variables.items()],
    )


def parse_temperatures(payloads: DataFrame) -> DataFrame:
    """One row per station and report time with ``temp``.

    Reads ``air_temp_set_1``, else the first series whose name begins with
    ``air_temp``; stations without one are left out.
    """
    stations = payloads.select(F.inline(F.from_json("payload", TIMESERIES_JSON)["STATION"]))
    names = F.map_keys("OBSERVATIONS")
    preferred = F.when(F.array_contains(names, "air_temp_set_1"), F.lit("air_temp_set_1"))
    fallback = F.get(F.filter(names, lambda n: n.startswith("air_temp")), F.lit(0))
    series = stations.withColumn("_name", F.coalesce(preferred, fallback)).where("_name is not null")
    return series.select("*", F.posexplode(_reports("date_time")).alias("_at", "_time")).select(
        *_place(),
        parse_utc(F.col("_time")).alias("valid_time"),
        to_number(F.get(_reports(F.col("_name")), F.col("_at"))).alias("temp"),
    )


def parse_precipitation(payloads: DataFrame) -> DataFrame:
    """One row per station and reported precipitation interval."""
    parsed = payloads.select(F.from_json("payload", PRECIP_JSON).alias("_p"))
    stations = parsed.select(F.col("_p.UNITS.precipitation").alias("precip_units"), F.inline("_p.STATION"))
    return stations.select(
        "*", F.explode("OBSERVATIONS.precipitation").alias("_report")
    ).select(
        *_place(),
        parse_utc(F.col("_report.last_report")).alias("end_time"),
        to_number(F.col("_report.total")).alias("interval_precip"),
        "precip_units",
    )
