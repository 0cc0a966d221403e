"""Unit conversions, wind, rounding and coercion over whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, times, units
from . import query, table


@query(
    "unit_conversions",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round_even(1.8::DOUBLE * (l_quantity + 250 - 273.0::DOUBLE) + 32.0::DOUBLE, 2) AS fahrenheit,
  round_even(l_quantity * 1.94384::DOUBLE, 2) AS knots, round_even(l_quantity * 2.23694::DOUBLE, 2) AS mph,
  round_even(l_extendedprice * 0.0393701::DOUBLE, 2) AS inches, round_even(l_discount * 39.3701::DOUBLE, 1) AS snow,
  round_even(l_extendedprice * 0.0393701::DOUBLE * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS scaled,
  l_quantity * CASE l_returnflag WHEN 'A' THEN 1.94384::DOUBLE WHEN 'R' THEN 1.9484::DOUBLE ELSE 1.0::DOUBLE END AS keyed
FROM lineitem""",
)
def unit_conversions(spark: SparkSession, folder: str) -> DataFrame:
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        units.round_half_even(units.kelvin_to_fahrenheit(quantity + 250), 2).alias("fahrenheit"),
        units.round_half_even(units.ms_to_knots(quantity), 2).alias("knots"),
        units.round_half_even(units.ms_to_mph(quantity), 2).alias("mph"),
        units.round_half_even(units.mm_to_inches(price), 2).alias("inches"),
        units.round_half_even(units.m_to_inches(F.col("l_discount")), 1).alias("snow"),
        units.round_scaled(units.mm_to_inches(price)).alias("scaled"),
        units.scale_by_key(F.col("l_returnflag"), quantity, {"A": 1.94384, "R": 1.9484}).alias("keyed"),
    )


@query(
    "wind_from_components",
    """WITH w AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity - 25 AS u, l_extendedprice / 1000 - 50 AS v
           FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round_even(sqrt(u * u + v * v) * 1.94384::DOUBLE, 2) AS wind_speed_kt,
  round_even((270.0::DOUBLE - degrees(atan2(v, u)) + 360.0::DOUBLE) % 360.0::DOUBLE, 0) AS wind_dir_deg FROM w""",
)
def wind(spark: SparkSession, folder: str) -> DataFrame:
    u, v = F.col("l_quantity") - 25, F.col("l_extendedprice") / 1000 - 50
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        units.round_half_even(units.ms_to_knots(units.wind_speed(u, v)), 2).alias("wind_speed_kt"),
        units.round_half_even(units.wind_direction(u, v), 0).alias("wind_dir_deg"),
    )


@query(
    "coerced_values",
    """SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1 + o_custkey % 2) AS DOUBLE) AS number,
  CASE WHEN o_totalprice - 200000 < 0 THEN 0.0 ELSE o_totalprice - 200000 END AS clipped,
  date_trunc('day', o_orderdate) AS day,
  o_orderdate - o_custkey % 48 * INTERVAL 1 HOUR AS init_time, CAST(trunc(o_totalprice / 3600) AS INTEGER) AS lead
FROM orders""",
)
def coerced(spark: SparkSession, folder: str) -> DataFrame:
    """Text to number and time where it parses; clipping; lead arithmetic."""
    key = F.col("o_custkey")
    digits = F.substr("o_orderpriority", F.lit(1), (F.pmod(key, F.lit(2)) + 1).cast("int"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        units.to_number(digits).alias("number"),
        units.clip_negative(F.col("o_totalprice") - 200000).alias("clipped"),
        times.parse_day(F.date_format("o_orderdate", "yyyyMMddHHmm")).alias("day"),
        times.init_time(F.col("o_orderdate"), F.pmod(key, F.lit(48))).alias("init_time"),
        times.lead_hours(F.col("o_totalprice")).alias("lead"),
    )


@query(
    "parsed_times",
    """SELECT event_id, CASE event_type WHEN 'view' THEN date_trunc('day', ts) WHEN 'click' THEN date_trunc('hour', ts)
       WHEN 'purchase' THEN date_trunc('minute', ts) END AS compact,
  CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS iso,
  CASE WHEN event_type = 'purchase' THEN date_trunc('minute', ts) END AS in_name
FROM events""",
)
def parsed_times(spark: SparkSession, folder: str) -> DataFrame:
    """Compact stamps of several lengths, ISO text, stamps in file names."""
    kind = F.col("event_type")
    stamp = (
        F.when(kind == "view", F.date_format("ts", "yyyyMMdd"))
        .when(kind == "click", F.date_format("ts", "yyyyMMddHH"))
        .when(kind == "purchase", F.date_format("ts", "yyyyMMddHHmm"))
        .otherwise(F.lit("not a time"))
    )
    iso = F.when(kind == "error", "2024-13-45T99").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, folder, "events").select(
        "event_id",
        times.parse_compact(stamp).alias("compact"),
        times.parse_utc(iso).alias("iso"),
        names.stamp_in_name(F.concat(F.lit("s3://bucket/wspd/YCRZ98_KWBN_"), stamp)).alias("in_name"),
    )
