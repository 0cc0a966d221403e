"""As-of joins and verification: views are forecasts, clicks are observations."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import asof_nearest
from ..operators.metrics import score_all_metrics, series, verification_scores
from ..plans.forecasts import pair_files
from ..plans.verification import DatasetSpec, Units, align
from ..sources.archive import read_archive
from . import query, table

SIX_HOURS = timedelta(hours=6)


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Each view with the nearest click of the same user within six hours."""
    events = table(spark, folder, "events")
    views = events.where("event_type = 'view'").select("event_id", "user_id", "ts", F.col("value").alias("forecast"))
    clicks = events.where("event_type = 'click'").select(
        "user_id", F.col("ts").alias("observed_time"), F.col("value").alias("observed")
    )
    return asof_nearest(
        views, clicks, by=["user_id"], left_time="ts", right_time="observed_time", tolerance=SIX_HOURS
    )


PAIRS_SQL = """
f AS (SELECT event_id, user_id, ts, value AS forecast FROM events WHERE event_type = 'view'),
o AS (SELECT user_id, ts AS observed_time, value AS observed FROM events WHERE event_type = 'click'),
ranked AS (
  SELECT f.event_id, o.observed_time, o.observed,
         row_number() OVER (PARTITION BY f.event_id
                            ORDER BY abs(epoch_us(f.ts) - epoch_us(o.observed_time)), o.observed_time) AS rn
  FROM f JOIN o ON o.user_id = f.user_id
   AND o.observed_time BETWEEN f.ts - INTERVAL 6 HOURS AND f.ts + INTERVAL 6 HOURS),
pairs AS (
  SELECT f.*, r.observed_time, r.observed FROM f LEFT JOIN ranked r ON r.event_id = f.event_id AND r.rn = 1)
"""

SCORES_SQL = """count(forecast - observed) AS count,
  round(avg(forecast - observed), 6) AS bias,
  round(avg(abs(forecast - observed)), 6) AS mae,
  round(sqrt(avg((forecast - observed) * (forecast - observed))), 6) AS rmse"""


def rounded(scores: DataFrame) -> DataFrame:
    """Scores to six digits: sums of doubles depend on their order beyond that."""
    return scores.withColumns({c: F.round(c, 6) for c in ("bias", "mae", "rmse")})


@query("asof_nearest", f"WITH {PAIRS_SQL} SELECT * FROM pairs")
def nearest(spark: SparkSession, folder: str) -> DataFrame:
    return pairs(spark, folder)


@query(
    "asof_duplicate_times",
    """
WITH f AS (SELECT event_id, user_id, time_bucket(INTERVAL 30 MINUTES, ts) AS valid_time
           FROM events WHERE event_type = 'view'),
o AS (SELECT event_id AS report, user_id, date_trunc('hour', ts) AS observed_time, value AS observed
      FROM events WHERE event_type <> 'view'),
ranked AS (
  SELECT f.event_id, o.report, o.observed_time, o.observed,
         row_number() OVER (PARTITION BY f.event_id
           ORDER BY abs(epoch_us(f.valid_time) - epoch_us(o.observed_time)), o.observed_time,
                    CASE WHEN o.observed_time <= f.valid_time THEN -o.report ELSE o.report END) AS rn
  FROM f JOIN o ON o.user_id = f.user_id
   AND o.observed_time BETWEEN f.valid_time - INTERVAL 3 HOURS AND f.valid_time + INTERVAL 3 HOURS)
SELECT f.event_id, f.user_id, f.valid_time, r.report, r.observed_time, r.observed
FROM f LEFT JOIN ranked r ON r.event_id = f.event_id AND r.rn = 1
""",
)
def duplicate_times(spark: SparkSession, folder: str) -> DataFrame:
    """Reports on the hour, often several at once; forecasts on the half hour, often
    equally far from two reports."""
    events = table(spark, folder, "events")
    half_hour = F.date_trunc("hour", "ts") + F.when(F.minute("ts") >= 30, F.expr("INTERVAL 30 MINUTES")).otherwise(
        F.expr("INTERVAL 0 MINUTES")
    )
    forecasts = events.where("event_type = 'view'").select("event_id", "user_id", half_hour.alias("valid_time"))
    reports = events.where("event_type <> 'view'").select(
        "user_id",
        F.col("event_id").alias("report"),
        F.date_trunc("hour", "ts").alias("observed_time"),
        F.col("value").alias("observed"),
    )
    return asof_nearest(
        forecasts,
        reports,
        by=["user_id"],
        left_time="valid_time",
        right_time="observed_time",
        tolerance=timedelta(hours=3),
        seq="report",
    )


@query(
    "asof_equal_order",
    """
WITH f AS (SELECT event_id, user_id, date_trunc('hour', ts) + INTERVAL 20 MINUTES AS valid_time FROM events),
o AS (SELECT user_id, date_trunc('hour', ts) AS observed_time,
             CASE WHEN event_type <> 'error' THEN length(event_type) // 6 END AS seq FROM events),
ranked AS (
  SELECT f.event_id, o.observed_time, o.seq,
         row_number() OVER (PARTITION BY f.event_id
           ORDER BY abs(epoch_us(f.valid_time) - epoch_us(o.observed_time)), o.observed_time,
                    CASE WHEN o.observed_time <= f.valid_time THEN -coalesce(o.seq, -1) ELSE coalesce(o.seq, -1) END) AS rn
  FROM f JOIN o ON o.user_id = f.user_id
   AND o.observed_time BETWEEN f.valid_time - INTERVAL 90 MINUTES AND f.valid_time + INTERVAL 90 MINUTES)
SELECT f.event_id, f.user_id, f.valid_time, r.observed_time, CAST(r.seq AS BIGINT) AS seq,
       CAST(10 * coalesce(r.seq, -1) AS BIGINT) AS observed, r.observed_time IS NOT NULL AS same_report
FROM f LEFT JOIN ranked r ON r.event_id = f.event_id AND r.rn = 1
""",
)
def equal_order(spark: SparkSession, folder: str) -> DataFrame:
    """Reports that share time and order, some without an order.  Which of equal ones is
    taken is up to its content; all its columns are those of one report."""
    events = table(spark, folder, "events")
    hour = F.date_trunc("hour", "ts")
    seq = F.when(F.col("event_type") != "error", F.expr("length(event_type) div 6"))
    reports = events.select(
        "user_id",
        hour.alias("observed_time"),
        seq.alias("seq"),
        F.coalesce(seq * 10, F.lit(-10)).alias("observed"),
        F.col("event_id").alias("report"),
        (F.col("event_id") * 7).alias("check"),
    )
    found = asof_nearest(
        events.select("event_id", "user_id", (hour + F.expr("INTERVAL 20 MINUTES")).alias("valid_time")),
        reports,
        by=["user_id"],
        left_time="valid_time",
        right_time="observed_time",
        tolerance=timedelta(minutes=90),
        seq="seq",
        slice_width=timedelta(hours=1),
    )
    one = F.coalesce(F.col("check") == F.col("report") * 7, F.lit(False))
    return found.select(
        "event_id", "user_id", "valid_time", "observed_time", "seq",
        F.coalesce("observed", F.lit(-10)).cast("long").alias("observed"), one.alias("same_report"),
    )


@query(
    "asof_any_distance",
    """
WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS station, ts, event_type FROM events),
o AS (SELECT station, ts AS observed_time, min(event_id) AS first_report, max(event_id) AS last_report
      FROM e WHERE event_type = 'purchase' GROUP BY station, ts),
b AS (SELECT e.event_id, o.observed_time, o.last_report AS report FROM e ASOF JOIN o ON e.station = o.station AND e.ts >= o.observed_time),
a AS (SELECT e.event_id, o.observed_time, o.first_report AS report FROM e ASOF JOIN o ON e.station = o.station AND e.ts <= o.observed_time),
near AS (
  SELECT e.event_id, e.station, e.ts, b.observed_time AS t0, b.report AS r0, a.observed_time AS t1, a.report AS r1,
         t1 IS NOT NULL AND (t0 IS NULL OR epoch_us(t1) - epoch_us(ts) < epoch_us(ts) - epoch_us(t0)) AS later
  FROM e LEFT JOIN b ON b.event_id = e.event_id LEFT JOIN a ON a.event_id = e.event_id)
SELECT event_id, station, ts, CASE WHEN later THEN t1 ELSE t0 END AS observed_time, CASE WHEN later THEN r1 ELSE r0 END AS report FROM near
""",
)
def any_distance(spark: SparkSession, folder: str) -> DataFrame:
    """All events with the nearest purchase, however far; one station holds a third of them."""
    events = table(spark, folder, "events").withColumn(
        "station", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    )
    reports = events.where("event_type = 'purchase'").select(
        "station", F.col("ts").alias("observed_time"), F.col("event_id").alias("report")
    )
    return asof_nearest(
        events.select("event_id", "station", "ts"),
        reports,
        by=["station"],
        left_time="ts",
        right_time="observed_time",
        tolerance=None,
        seq="report",
    )


@query(
    "file_pairs",
    """
WITH s AS (SELECT 'wspd/' || event_id AS file, date_trunc('minute', ts) AS stamp
           FROM events WHERE event_type = 'signup'),
d AS (SELECT 'wdir/' || event_id AS direction_file, date_trunc('minute', ts) AS stamp
      FROM events WHERE event_type = 'purchase'),
ranked AS (
  SELECT s.file, d.direction_file,
         row_number() OVER (PARTITION BY s.file
           ORDER BY abs(epoch_us(s.stamp) - epoch_us(d.stamp)), d.stamp DESC, d.direction_file DESC) AS rn
  FROM s JOIN d ON d.stamp BETWEEN s.stamp - INTERVAL 2 MINUTES AND s.stamp + INTERVAL 2 MINUTES)
SELECT s.file, r.direction_file FROM s LEFT JOIN ranked r ON r.file = s.file AND r.rn = 1
""",
)
def file_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Speed files with the direction file nearest in time, the later of two."""
    events = table(spark, folder, "events")

    def files(kind: str, component: str) -> DataFrame:
        return events.where(F.col("event_type") == kind).select(
            F.concat(F.lit(f"{component}/"), F.col("event_id").cast("string")).alias("path"),
            F.date_trunc("minute", "ts").alias("stamp"),
        )

    return pair_files(files("signup", "wspd"), files("purchase", "wdir"))


@query("scores_overall", f"WITH {PAIRS_SQL} SELECT {SCORES_SQL} FROM pairs")
def scores_overall(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(verification_scores(pairs(spark, folder), "forecast", "observed"))


@query("scores_by_station", f"WITH {PAIRS_SQL} SELECT user_id, {SCORES_SQL} FROM pairs GROUP BY user_id")
def scores_by_station(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(verification_scores(pairs(spark, folder), "forecast", "observed", ["user_id"]))


@query(
    "scores_by_day",
    f"WITH {PAIRS_SQL} SELECT CAST(ts AS DATE) AS day, {SCORES_SQL} FROM pairs GROUP BY 1",
)
def scores_by_day(spark: SparkSession, folder: str) -> DataFrame:
    dated = pairs(spark, folder).withColumn("day", F.to_date("ts"))
    return rounded(verification_scores(dated, "forecast", "observed", ["day"]))


FORECASTS = DatasetSpec("ts", "user_id", {"speed": "value", "gust": "gust", "dir": "dir"})
OBSERVED = DatasetSpec("ts", "user_id", {"speed": "value", "gust": "gust"})


def aligned(spark: SparkSession, folder: str) -> DataFrame:
    """The verification plan over the middle of the month, with unit conversion."""
    events = table(spark, folder, "events").withColumns(
        {"gust": F.col("value") * 1.5, "dir": F.pmod("event_id", F.lit(360)).cast("double")}
    )
    return align(
        events.where("event_type = 'view'"),
        events.where("event_type = 'click'"),
        FORECASTS,
        OBSERVED,
        first=date(2024, 1, 5),
        last=date(2024, 1, 20),
        tolerance=SIX_HOURS,
        units=Units("m/s", "kt", convert=True),
    )


ALIGNED_SQL = """
f AS (SELECT event_id, user_id, ts, value, value * 1.5::DOUBLE AS gust, CAST(event_id % 360 AS DOUBLE) AS dir
      FROM events WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'),
o AS (SELECT user_id, ts, value, value * 1.5::DOUBLE AS gust
      FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'),
ranked AS (
  SELECT f.event_id, o.value, o.gust,
         row_number() OVER (PARTITION BY f.event_id ORDER BY abs(epoch_us(f.ts) - epoch_us(o.ts)), o.ts) AS rn
  FROM f JOIN o ON o.user_id = f.user_id AND o.ts BETWEEN f.ts - INTERVAL 6 HOURS AND f.ts + INTERVAL 6 HOURS),
aligned AS (
  SELECT f.ts AS valid_time, f.user_id AS station_id,
         f.value AS forecast_speed, f.gust AS forecast_gust, f.dir AS forecast_dir,
         r.value * 1.94384::DOUBLE AS observed_speed, r.gust * 1.94384::DOUBLE AS observed_gust
  FROM f LEFT JOIN ranked r ON r.event_id = f.event_id AND r.rn = 1)
"""


@query("aligned_wide", f"WITH {ALIGNED_SQL} SELECT * FROM aligned")
def aligned_wide(spark: SparkSession, folder: str) -> DataFrame:
    return aligned(spark, folder)


@query(
    "scores_all_metrics",
    f"""WITH {ALIGNED_SQL}, long AS (
  SELECT 'speed' AS metric, forecast_speed AS forecast, observed_speed AS observed FROM aligned
  UNION ALL SELECT 'gust', forecast_gust, observed_gust FROM aligned)
SELECT metric, {SCORES_SQL} FROM long GROUP BY metric""",
)
def scores_all_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(score_all_metrics(aligned(spark, folder)))


@query(
    "series_long",
    f"""WITH {ALIGNED_SQL}
SELECT valid_time AS t, 'forecast' AS series, forecast_speed AS value FROM aligned
UNION ALL SELECT valid_time, 'observed', observed_speed FROM aligned""",
)
def series_long(spark: SparkSession, folder: str) -> DataFrame:
    return series(aligned(spark, folder), "speed")


@query(
    "aligned_sample",
    f"""WITH {ALIGNED_SQL}
SELECT * FROM aligned ORDER BY valid_time, station_id, forecast_speed, forecast_dir LIMIT 200""",
)
def aligned_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The first 200 aligned rows in time order: the sample a viewer is shown."""
    return aligned(spark, folder).orderBy("valid_time", "station_id", "forecast_speed", "forecast_dir").limit(200)


@query(
    "scan_filter",
    """SELECT user_id, ts, value FROM events
WHERE event_type IN ('view', 'click') AND value >= 5 AND value < 40
  AND ts >= TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-25'""",
)
def scan_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Filters and projection pushed to the scan; what does not exist is passed over."""
    return read_archive(
        spark,
        f"{folder}/events.parquet",
        columns=["user_id", "ts", "value", "no_such_column"],
        filters=[
            ("event_type", "in", ["view", "click"]),
            ("value", ">=", 5.0),
            ("value", "<", 40.0),
            ("ts", ">=", F.lit("2024-01-03").cast("timestamp_ntz")),
            ("ts", "<=", F.lit("2024-01-25").cast("timestamp_ntz")),
            ("no_such_column", "==", 1),
            ("value", "like", "x"),
        ],
    )
