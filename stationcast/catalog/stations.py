"""Observation parsing, rolling totals, daily extremes, station tables."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.accumulate import interval_from_total, rolling_total, with_exact_lag
from ..operators.extremes import TMAX_12_TO_06, TMIN_00_TO_18, daily_extreme
from ..plans.observations import observations
from ..session import scratch_folder, written
from ..sources import stations as dim
from ..sources.observations import parse_precipitation, parse_temperatures, parse_timeseries
from . import query, table


def temperatures(spark: SparkSession, folder: str) -> DataFrame:
    """Events as temperature reports; clicks lack the latitude, errors the zone."""
    return table(spark, folder, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("stid"),
        F.when(F.col("event_type") != "click", F.col("user_id") / 10).alias("lat"),
        (F.col("user_id") - 150).cast("double").alias("lon"),
        F.lit(12.5).alias("elev"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("NWSZONE"),
        F.lit("AFC").alias("NWSCWA"),
        F.col("ts").alias("valid_time"),
        F.when(F.col("value") > 2, F.col("value")).alias("temp"),
    )


TEMPS_SQL = """
temps AS (
  SELECT 'U' || user_id AS stid, CASE WHEN event_type <> 'click' THEN user_id / 10.0::DOUBLE END AS lat,
         CAST(user_id - 150 AS DOUBLE) AS lon, 12.5::DOUBLE AS elev,
         CASE WHEN event_type <> 'error' THEN event_type END AS zone, 'AFC' AS cwa,
         ts AS valid_time, CASE WHEN value > 2 THEN value END AS temp
  FROM events)
"""


def extreme_sql(column: str, function: str, hours: str, day: str, start: str, end: str, more: str = "") -> str:
    return f"""WITH {TEMPS_SQL}, inside AS (
  SELECT *, {day} AS date FROM temps WHERE {hours})
SELECT stid, arg_min(lat, valid_time) FILTER (WHERE lat IS NOT NULL) AS lat, arg_min(lon, valid_time) AS lon,
       arg_min(elev, valid_time) AS elev, date, date + INTERVAL {start} AS window_start,
       date + INTERVAL {end} AS window_end, {function}(temp) AS {column}, 'F' AS temp_units,
       arg_min(zone, valid_time) FILTER (WHERE zone IS NOT NULL) AS "NWSZONE", min(cwa) AS "NWSCWA"
FROM inside {more} GROUP BY stid, date"""


@query(
    "tmax_12_to_06",
    extreme_sql(
        "tmax",
        "max",
        "hour(valid_time) >= 12 OR hour(valid_time) < 6",
        "date_trunc('day', valid_time - INTERVAL 12 HOURS)",
        "12 HOURS",
        "30 HOURS",
    ),
)
def tmax(spark: SparkSession, folder: str) -> DataFrame:
    return daily_extreme(temperatures(spark, folder), TMAX_12_TO_06)


@query(
    "extremes_in_order",
    f"""WITH {TEMPS_SQL}, days AS (
  SELECT stid, date_trunc('day', valid_time - INTERVAL 12 HOURS) AS date, max(temp) AS tmax FROM temps
  WHERE hour(valid_time) >= 12 OR hour(valid_time) < 6 GROUP BY stid, 2)
SELECT stid, date, tmax FROM days ORDER BY stid, date LIMIT 300""",
)
def extremes_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows of the archive of extremes, which is ordered by station and day."""
    days = daily_extreme(temperatures(spark, folder), TMAX_12_TO_06).select("stid", "date", "tmax")
    return days.orderBy("stid", "date").limit(300)


@query(
    "tmin_00_to_18",
    extreme_sql(
        "tmin",
        "min",
        "hour(valid_time) < 18",
        "date_trunc('day', valid_time)",
        "0 HOURS",
        "18 HOURS",
        "WHERE date BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-28'",
    ),
)
def tmin(spark: SparkSession, folder: str) -> DataFrame:
    return daily_extreme(
        temperatures(spark, folder),
        TMIN_00_TO_18,
        first_day=datetime(2024, 1, 3),
        last_day=datetime(2024, 1, 28),
    )


@query(
    "rolling_total_24_by_12",
    """
WITH r AS (SELECT user_id AS stid, ts AS end_time, value,
             count(value) OVER w AS n, sum(value) OVER w AS total
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 1 PRECEDING AND CURRENT ROW))
SELECT stid, CAST(24 AS INTEGER) AS accum_hours, CAST(12 AS INTEGER) AS step_hours,
       end_time - INTERVAL 24 HOURS AS start_time, end_time, round(total, 6) AS precip_total
FROM r WHERE n = 2
""",
)
def rolling_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Two reports per total, station by station."""
    reports = table(spark, folder, "events").select(
        F.col("user_id").alias("stid"), F.col("ts").alias("end_time"), F.col("value").alias("interval_precip")
    )
    return rolling_total(reports, accum_hours=24, step_hours=12).select(
        "stid", "accum_hours", "step_hours", "start_time", "end_time", F.round("precip_total", 6).alias("precip_total")
    )


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly sums per event type: a few keys that hold everything."""
    return (
        table(spark, folder, "events")
        .groupBy("event_type", F.date_trunc("hour", "ts").alias("hour"))
        .agg(F.round(F.sum("value"), 2).alias("amount"))
    )


HOURLY_SQL = """
hourly AS (SELECT event_type, date_trunc('hour', ts) AS hour, round(sum(value), 2) AS amount
           FROM events GROUP BY 1, 2)
"""


@query(
    "rolling_total_6_by_1",
    f"""
WITH {HOURLY_SQL}, r AS (
  SELECT *, count(amount) OVER w AS n, sum(amount) OVER w AS total FROM hourly
  WINDOW w AS (PARTITION BY event_type ORDER BY hour ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))
SELECT event_type, hour AS end_time, round(total, 4) AS precip_total FROM r WHERE n = 6
""",
)
def rolling_six(spark: SparkSession, folder: str) -> DataFrame:
    """Six reports per total over a few heavy keys."""
    return rolling_total(
        hourly(spark, folder), accum_hours=6, step_hours=1, by=["event_type"], time="hour", value="amount"
    ).select("event_type", F.col("hour").alias("end_time"), F.round("precip_total", 4).alias("precip_total"))


@query(
    "interval_from_total",
    f"""
WITH {HOURLY_SQL}
SELECT h.event_type, h.hour, h.amount,
       CASE WHEN h.amount - e.amount < 0 THEN 0.0
            ELSE round_even((h.amount - e.amount) * 100.0::DOUBLE, 0) / 100.0::DOUBLE END AS amount_6h
FROM hourly h LEFT JOIN hourly e ON e.event_type = h.event_type AND e.hour = h.hour - INTERVAL 6 HOURS
""",
)
def interval(spark: SparkSession, folder: str) -> DataFrame:
    """Six-hour difference of a series, clipped at zero."""
    return interval_from_total(
        hourly(spark, folder), total="amount", out="amount_6h", by=["event_type"], time="hour"
    )


@query(
    "exact_lag",
    f"""
WITH {HOURLY_SQL}
SELECT h.event_type, h.hour, h.amount, e.amount AS amount_before
FROM hourly h LEFT JOIN hourly e ON e.event_type = h.event_type AND e.hour = h.hour - INTERVAL 24 HOURS
""",
)
def exact_lag(spark: SparkSession, folder: str) -> DataFrame:
    return with_exact_lag(
        hourly(spark, folder), by=["event_type"], time="hour", value="amount", lag_hours=24, out="amount_before"
    )


REPEATED_SQL = "repeated AS (SELECT event_id, user_id, date_trunc('hour', ts) AS hour, value FROM events)"


def repeated(spark: SparkSession, folder: str, fan_out: bool) -> DataFrame:
    """Each event with what its user had exactly a day before, by the hour; hours repeat."""
    events = table(spark, folder, "events").select("event_id", "user_id", F.date_trunc("hour", "ts").alias("hour"), "value")
    return with_exact_lag(events, by=["user_id"], time="hour", value="value", lag_hours=24, out="value_before", fan_out=fan_out)


@query(
    "exact_lag_repeated",
    f"""WITH {REPEATED_SQL},
earlier AS (SELECT user_id, hour, max(value) AS value FROM repeated GROUP BY ALL)
SELECT r.*, e.value AS value_before FROM repeated r
LEFT JOIN earlier e ON e.user_id = r.user_id AND e.hour = r.hour - INTERVAL 24 HOURS""",
)
def exact_lag_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """The largest of several earlier values."""
    return repeated(spark, folder, fan_out=False)


@query(
    "exact_lag_fan_out",
    f"""WITH {REPEATED_SQL}
SELECT r.*, e.value AS value_before FROM repeated r
LEFT JOIN repeated e ON e.user_id = r.user_id AND e.hour = r.hour - INTERVAL 24 HOURS""",
)
def exact_lag_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each of several earlier values."""
    return repeated(spark, folder, fan_out=True)


# -- observation JSON ------------------------------------------------------------


def stamps(hours: int) -> Column:
    """ISO times of an event and the hours after it."""
    times = [
        F.date_format(F.col("ts") + F.expr(f"INTERVAL {i} HOURS"), "yyyy-MM-dd'T'HH:mm:ss'Z'") for i in range(hours)
    ]
    return F.array(*times)


def text(c: Column) -> Column:
    return c.cast("string")


def responses(spark: SparkSession, folder: str, reports: Column, extra: Column | None = None) -> DataFrame:
    """One response per event, with one station and the given reports."""
    station = F.struct(
        F.concat(F.lit("U"), text(F.col("user_id"))).alias("STID"),
        F.lit("name").alias("NAME"),
        text(F.col("user_id") / 4).alias("LATITUDE"),
        F.lit("-150.5").alias("LONGITUDE"),
        F.when(F.col("user_id") > 20, F.lit("100.0")).alias("ELEVATION"),
        reports.alias("OBSERVATIONS"),
    )
    parts = [F.array(station).alias("STATION"), *([extra] if extra is not None else [])]
    return table(spark, folder, "events").select(F.to_json(F.struct(*parts)).alias("payload"))


PLACE_SQL = """'U' || user_id AS stid, user_id / 4.0::DOUBLE AS lat, -150.5::DOUBLE AS lon,
       CASE WHEN user_id > 20 THEN 100.0::DOUBLE END AS elev"""


def wind_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Speeds are one short, directions one too many, the first gust is not a number;
    errors carry no times."""
    value, nothing = F.col("value"), F.array().cast("array<string>")
    reports = F.create_map(
        F.lit("date_time"),
        F.when(F.col("event_type") == "error", nothing).otherwise(stamps(3)),
        F.lit("wind_speed_set_1"),
        F.array(text(value), text(value * 2)),
        F.lit("wind_direction_set_1"),
        F.array(*[text(value + i) for i in range(4)]),
        F.lit("wind_gust_set_1"),
        F.array(F.lit("T"), F.lit(None).cast("string"), text(value * 3)),
    )
    return responses(spark, folder, reports)


@query(
    "json_timeseries",
    f"""
SELECT {PLACE_SQL}, date_trunc('second', ts) + i * INTERVAL 1 HOUR AS valid_time,
       CASE i WHEN 0 THEN value WHEN 1 THEN value * 2 END AS speed,
       value + i AS direction, CASE i WHEN 2 THEN value * 3 END AS gust
FROM events CROSS JOIN (VALUES (0), (1), (2)) AS t(i) WHERE event_type <> 'error'
""",
)
def json_timeseries(spark: SparkSession, folder: str) -> DataFrame:
    columns = {"wind_speed_set_1": "speed", "wind_direction_set_1": "direction", "wind_gust_set_1": "gust"}
    return parse_timeseries(wind_responses(spark, folder), columns)


def temperature_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks have the usual series, views only others, purchases none at all."""
    value = F.col("value")
    usual = F.create_map(
        F.lit("air_temp_x"), F.array(F.lit("0"), F.lit("0")),
        F.lit("air_temp_set_1"), F.array(text(value), text(value + 1)),
        F.lit("date_time"), stamps(2),
    )
    others = F.create_map(
        F.lit("date_time"), stamps(2),
        F.lit("air_temp_b"), F.array(text(value - 5)),
        F.lit("air_temp_a"), F.array(F.lit("0"), F.lit("0")),
    )
    none = F.create_map(F.lit("date_time"), stamps(2), F.lit("pressure"), F.array(F.lit("1")))
    kind = F.col("event_type")
    reports = F.when(kind == "purchase", none).when(kind == "view", others).otherwise(usual)
    return responses(spark, folder, reports)


JSON_TEMPS_SQL = f"""
temps AS (
SELECT {PLACE_SQL}, date_trunc('second', ts) + i * INTERVAL 1 HOUR AS valid_time,
       CASE WHEN event_type <> 'view' THEN value + i WHEN i = 0 THEN value - 5 END AS temp
FROM events CROSS JOIN (VALUES (0), (1)) AS t(i) WHERE event_type <> 'purchase')
"""


@query("json_temperatures", f"WITH {JSON_TEMPS_SQL} SELECT * FROM temps")
def json_temperatures(spark: SparkSession, folder: str) -> DataFrame:
    return parse_temperatures(temperature_responses(spark, folder))


def precipitation_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Two intervals per response; the second has no amount for errors."""
    times = stamps(2)

    def report(i: int, total: Column) -> Column:
        return F.struct(F.get(times, F.lit(i)).alias("last_report"), total.alias("total"))

    second = F.when(F.col("event_type") != "error", F.round(F.col("value") / 2, 3))
    reports = F.struct(F.array(report(0, F.col("value")), report(1, second)).alias("precipitation"))
    units = F.struct(F.lit("Inches").alias("precipitation")).alias("UNITS")
    return responses(spark, folder, reports, units)


PRECIP_SQL = f"""
intervals AS (
SELECT {PLACE_SQL}, date_trunc('second', ts) + i * INTERVAL 1 HOUR AS end_time,
       CASE WHEN i = 0 THEN value WHEN event_type <> 'error' THEN round(value / 2, 3) END AS interval_precip,
       'Inches' AS precip_units, user_id
FROM events CROSS JOIN (VALUES (0), (1)) AS t(i))
"""


@query("json_precipitation", f"WITH {PRECIP_SQL} SELECT * EXCLUDE (user_id) FROM intervals")
def json_precipitation(spark: SparkSession, folder: str) -> DataFrame:
    return parse_precipitation(precipitation_responses(spark, folder))


def attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Attributes from responses, as a written table of known size.  Users are
    customers; those of one segment stand under other names, so that some users are unknown."""
    letter = F.when(F.col("c_mktsegment") == "MACHINERY", "X").otherwise("U")
    station = F.struct(
        F.concat(letter, text(F.col("c_custkey"))).alias("STID"),
        F.col("c_mktsegment").alias("NWSZONE"),
        F.concat(F.lit("CWA"), text(F.col("c_nationkey"))).alias("CWA"),
    )
    customers = table(spark, folder, "customer")
    responses = customers.select(F.to_json(F.struct(F.array(station).alias("STATION"))).alias("payload"))
    return written(dim.parse_attributes(responses), "attributes")


ATTRIBUTES_SQL = """
attributes AS (SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN 'X' ELSE 'U' END || c_custkey AS stid,
                      c_mktsegment AS zone, 'CWA' || c_nationkey AS cwa FROM customer)
"""


@query(
    "station_attributes",
    f"""WITH {ATTRIBUTES_SQL}
SELECT e.event_id, 'U' || e.user_id AS stid, a.zone AS "NWSZONE", a.cwa AS "NWSCWA"
FROM events e LEFT JOIN attributes a ON a.stid = 'U' || e.user_id""",
)
def station_attributes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("U"), text(F.col("user_id"))).alias("stid")
    )
    return dim.with_attributes(rows, attributes(spark, folder))


@query(
    "observed_wind",
    f"""WITH {ATTRIBUTES_SQL}
SELECT o.* EXCLUDE (i, value), a.zone AS "NWSZONE", a.cwa AS "NWSCWA",
       value + i AS obs_wind_dir_deg, CASE i WHEN 0 THEN value WHEN 1 THEN value * 2 END AS obs_wind_speed_kts,
       CASE i WHEN 2 THEN value * 3 END AS obs_wind_gust_kts
FROM (SELECT {PLACE_SQL}, date_trunc('second', ts) + i * INTERVAL 1 HOUR AS valid_time, i, value
      FROM events CROSS JOIN (VALUES (0), (1), (2)) AS t(i) WHERE event_type <> 'error') o
LEFT JOIN attributes a ON a.stid = o.stid""",
)
def observed_wind(spark: SparkSession, folder: str) -> DataFrame:
    return observations(wind_responses(spark, folder), attributes(spark, folder), "Wind")


@query(
    "observed_precip24hr",
    f"""WITH {ATTRIBUTES_SQL}, {PRECIP_SQL}, r AS (
  SELECT *, count(interval_precip) OVER w AS n, sum(interval_precip) OVER w AS total FROM intervals
  WINDOW w AS (PARTITION BY stid ORDER BY end_time, interval_precip NULLS FIRST
               ROWS BETWEEN 1 PRECEDING AND CURRENT ROW))
SELECT r.stid, r.lat, r.lon, r.elev, CAST(24 AS INTEGER) AS accum_hours, CAST(12 AS INTEGER) AS step_hours,
       r.end_time - INTERVAL 24 HOURS AS start_time, r.end_time, round(r.total, 6) AS precip_total, r.precip_units,
       a.zone AS "NWSZONE", a.cwa AS "NWSCWA"
FROM r LEFT JOIN attributes a ON a.stid = r.stid WHERE r.n = 2""",
)
def observed_precip(spark: SparkSession, folder: str) -> DataFrame:
    totals = observations(precipitation_responses(spark, folder), attributes(spark, folder), "precip24hr")
    return totals.withColumn("precip_total", F.round("precip_total", 6))


@query(
    "observed_maxt",
    f"""WITH {ATTRIBUTES_SQL}, {JSON_TEMPS_SQL}, inside AS (
  SELECT *, date_trunc('day', valid_time - INTERVAL 12 HOURS) AS date FROM temps
  WHERE hour(valid_time) >= 12 OR hour(valid_time) < 6),
days AS (SELECT stid, min(lat) AS lat, min(lon) AS lon, min(elev) AS elev, date, max(temp) AS tmax
         FROM inside GROUP BY stid, date)
SELECT d.stid, d.lat, d.lon, d.elev, d.date, d.date + INTERVAL 12 HOURS AS window_start,
       d.date + INTERVAL 30 HOURS AS window_end, d.tmax, 'F' AS temp_units, a.zone AS "NWSZONE", a.cwa AS "NWSCWA"
FROM days d LEFT JOIN attributes a ON a.stid = d.stid""",
)
def observed_maxt(spark: SparkSession, folder: str) -> DataFrame:
    return observations(temperature_responses(spark, folder), attributes(spark, folder), "maxt")


STATIONS_SQL = """SELECT s_name AS stid, n_name AS name, CAST(50 + s_suppkey / 8.0 AS DOUBLE) AS latitude,
       CASE WHEN s_nationkey < 20 THEN s_acctbal END AS longitude, CAST(NULL AS DOUBLE) AS elevation
FROM supplier JOIN nation ON n_nationkey = s_nationkey"""


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata responses of one station each; some coordinates are not numbers."""
    suppliers = table(spark, folder, "supplier")
    nations = table(spark, folder, "nation")
    station = F.struct(
        F.col("s_name").alias("STID"),
        F.col("n_name").alias("NAME"),
        text(F.col("s_suppkey") / 8 + 50).alias("LATITUDE"),
        F.when(F.col("s_nationkey") < 20, text(F.col("s_acctbal"))).otherwise("unknown").alias("LONGITUDE"),
    )
    joined = suppliers.join(nations, F.col("n_nationkey") == F.col("s_nationkey"))
    return joined.select(F.to_json(F.struct(F.array(station).alias("STATION"))).alias("payload"))


@query("station_table", STATIONS_SQL)
def station_table(spark: SparkSession, folder: str) -> DataFrame:
    return dim.parse_stations(metadata(spark, folder))


@query("station_csv", STATIONS_SQL)
def station_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The station table by way of a CSV file: written at first, then found."""
    path = f"{scratch_folder(spark, 'stations')}/stations.csv"
    dim.ensure_stations(spark, path, metadata(spark, folder))
    return dim.ensure_stations(spark, path, metadata(spark, folder).where(F.lit(False)))


@query(
    "station_selection",
    """SELECT s_suppkey, s_name FROM supplier JOIN nation ON n_nationkey = s_nationkey
WHERE n_regionkey = 2 AND s_nationkey IN (2, 7, 12, 22) AND s_acctbal > 0
  AND (s_acctbal > 7000 OR s_acctbal < 5000)""",
)
def station_selection(spark: SparkSession, folder: str) -> DataFrame:
    """Stations by state, network, status and reported variable."""
    balance = F.col("s_acctbal")
    reports = (
        F.when(balance > 7000, F.array(F.lit("rain"), F.lit("wind_speed")))
        .when(balance < 5000, F.array(F.lit("air_temp")))
        .otherwise(F.array(F.lit("rain")))
    )
    joined = (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        .select(
            "s_suppkey",
            "s_name",
            F.concat(F.lit("R"), text(F.col("n_regionkey"))).alias("state"),
            text(F.col("s_nationkey")).alias("mnet_id"),
            F.when(F.col("s_acctbal") > 0, "ACTIVE").otherwise("INACTIVE").alias("status"),
            reports.alias("reports"),
        )
    )
    return dim.select_stations(
        joined, state="r2", networks=["2", "7", "12", "22"], status="active", variables=["wind_speed", "air_temp"]
    ).select("s_suppkey", "s_name")
