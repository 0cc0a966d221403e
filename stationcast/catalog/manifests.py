"""Expected and listed files, calendars, fetch chunks: order dates start the windows."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions import names, times
from ..operators import manifest
from ..session import scratch_folder, written
from ..sources import files
from . import query, table

BASE = "https://example.org/hrrr"


def windows(spark: SparkSession, folder: str) -> DataFrame:
    """Half a day from each order date on."""
    day = F.col("o_orderdate").cast("timestamp")
    return (
        table(spark, folder, "orders").select(day.alias("start")).distinct().withColumn("end", F.col("start") + times.hours(12))
    )


def expected(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.expected_files(windows(spark, folder), "hrrr", "Wind", BASE)


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Files and some of their indexes, named after ship dates, hours and quantities."""
    run = F.date_format("l_shipdate", "yyyyMMdd")
    hour = names.zero_padded(F.pmod("l_linenumber", F.lit(3)) * 6, 2)
    lead = names.zero_padded(F.pmod(F.col("l_quantity").cast("int"), F.lit(7)) * 6 + 12, 2)
    url = F.concat(
        F.lit(f"{BASE}/hrrr."), run, F.lit("/alaska/hrrr.t"), hour, F.lit("z.wrfsfcf"), lead, F.lit(".ak.grib2"),
        F.when(F.col("l_returnflag") == "N", "").otherwise(".idx"),
    )
    return table(spark, folder, "lineitem").select(url.alias("path"))


MANIFEST_SQL = f"""
runs AS (SELECT DISTINCT o_orderdate AS start, o_orderdate + INTERVAL 12 HOURS AS "end" FROM orders),
expected AS (
  SELECT start, "end", start + r * INTERVAL 6 HOURS AS init_time, CAST(fh AS INTEGER) AS forecast_hour,
         '{BASE}/hrrr.' || strftime(start + r * INTERVAL 6 HOURS, '%Y%m%d') || '/alaska/hrrr.t'
         || strftime(start + r * INTERVAL 6 HOURS, '%H') || 'z.wrfsfcf' || printf('%02d', fh) || '.ak.grib2' AS url
  FROM runs CROSS JOIN (VALUES (0), (1), (2)) AS h(r) CROSS JOIN generate_series(12, 48, 6) AS l(fh)),
held AS (
  SELECT DISTINCT '{BASE}/hrrr.' || strftime(l_shipdate, '%Y%m%d') || '/alaska/hrrr.t'
         || printf('%02d', l_linenumber % 3 * 6) || 'z.wrfsfcf'
         || printf('%02d', CAST(l_quantity AS INTEGER) % 7 * 6 + 12) || '.ak.grib2' AS url
  FROM lineitem WHERE l_returnflag <> 'N')
"""


@query("files_expected", f"WITH {MANIFEST_SQL} SELECT * FROM expected")
def files_expected(spark: SparkSession, folder: str) -> DataFrame:
    return expected(spark, folder)


@query("files_available", f"WITH {MANIFEST_SQL} SELECT * FROM expected SEMI JOIN held USING (url)")
def files_available(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.available_files(expected(spark, folder), listing(spark, folder))


@query("files_missing", f"WITH {MANIFEST_SQL} SELECT * FROM expected ANTI JOIN held USING (url)")
def files_missing(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.missing_files(expected(spark, folder), listing(spark, folder))


@query(
    "files_found_by_lead",
    f"""WITH {MANIFEST_SQL}
SELECT forecast_hour, count(h.url) AS found, count(*) - count(h.url) AS missing
FROM expected e LEFT JOIN held h USING (url) GROUP BY forecast_hour""",
)
def files_found(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.availability(expected(spark, folder), listing(spark, folder), ["forecast_hour"])


@query(
    "urls_by_model",
    """SELECT o_orderkey,
  'https://example.org/b/blend.' || strftime(t, '%Y%m%d') || '/' || strftime(t, '%H') || '/core/blend.t' || strftime(t, '%H')
    || 'z.core.f' || printf('%03d', lead) || '.ak.grib2' AS nbm,
  'https://example.org/b/blend.' || strftime(t, '%Y%m%d') || '/' || strftime(t, '%H') || '/qmd/blend.t' || strftime(t, '%H')
    || 'z.qmd.f' || printf('%03d', lead) || '.ak.grib2' AS nbmqmd,
  'https://example.org/b/akurma.' || strftime(t, '%Y%m%d') || '/akurma.t' || strftime(t, '%H') || 'z.2dvaranl_ndfd_3p0.grb2' AS urma
FROM (SELECT o_orderkey, o_orderdate + o_custkey % 24 * INTERVAL 1 HOUR AS t, o_custkey % 169 AS lead FROM orders)""",
)
def urls(spark: SparkSession, folder: str) -> DataFrame:
    run, lead = run_and_lead()
    return table(spark, folder, "orders").select(
        "o_orderkey",
        *[manifest.file_url("https://example.org/b/", m, run, lead).alias(m) for m in ("nbm", "nbmqmd", "urma")],
    )


def run_and_lead() -> tuple[Column, Column]:
    run = F.col("o_orderdate") + F.make_dt_interval(hours=F.pmod("o_custkey", F.lit(24)).cast("int"))
    return run, F.pmod("o_custkey", F.lit(169)).cast("int")


@query(
    "urls_parsed",
    """SELECT o_orderkey, model, lead AS forecast_hour,
  CASE WHEN model = 'nbm' THEN 'blend.' ELSE '' END || strftime(t, '%Y%m%d') AS run_date, strftime(t, '%H') AS run_hour
FROM (SELECT o_orderkey, o_orderdate + o_custkey % 24 * INTERVAL 1 HOUR AS t, o_custkey, o_orderstatus,
             CASE o_orderstatus WHEN 'F' THEN 'nbm' WHEN 'O' THEN 'hrrr' ELSE 'urma' END AS model,
             CAST(CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN o_custkey % 100 ELSE o_custkey % 169 END AS INTEGER) AS lead
      FROM orders)""",
)
def urls_parsed(spark: SparkSession, folder: str) -> DataFrame:
    """Lead, run date and run hour read back from the names of three models."""
    run, lead = run_and_lead()
    status = F.col("o_orderstatus")
    model = F.when(status == "F", "nbm").when(status == "O", "hrrr").otherwise("urma")
    short = F.pmod("o_custkey", F.lit(100)).cast("int")
    url = (
        F.when(status == "F", manifest.file_url(BASE, "nbm", run, lead))
        .when(status == "O", manifest.file_url(BASE, "hrrr", run, short))
        .otherwise(manifest.file_url(BASE, "urma", run, lead))
    )
    named = table(spark, folder, "orders").select("o_orderkey", model.alias("model"), url.alias("url"))
    run_date, run_hour = names.run_date_and_hour(F.col("url"), F.col("model"))
    return named.select(
        "o_orderkey",
        "model",
        names.forecast_hour(F.col("url")).alias("forecast_hour"),
        run_date.alias("run_date"),
        run_hour.alias("run_hour"),
    )


@query(
    "archive_names",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CASE WHEN o_orderstatus <> 'P' THEN 'nbm' END AS model, CASE WHEN o_orderstatus <> 'P' THEN 'wind' END AS element
FROM (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS o_orderdate FROM orders)""",
)
def archive_names(spark: SparkSession, folder: str) -> DataFrame:
    """Year, month, model and element from archive names; some names are malformed."""
    name = F.concat(
        F.date_format("o_orderdate", "yyyy_MM"),
        F.when(F.col("o_orderstatus") != "P", F.lit("_nbm_wind_archive.parquet")).otherwise(F.lit("_nbm.parquet")),
    )
    named = table(spark, folder, "orders").select("o_orderkey", names.archive_name_parts(name).alias("part"))
    return named.select("o_orderkey", "part.*")


@query(
    "months_covered",
    """SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
                        INTERVAL 1 MONTH)) AS DATE) AS month FROM orders""",
)
def months_covered(spark: SparkSession, folder: str) -> DataFrame:
    """All months from the first order to the last."""
    span = table(spark, folder, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return span.select(F.explode(times.month_starts(F.to_date("a"), F.to_date("b"))).alias("month"))


@query(
    "lookback_days",
    """SELECT start, unnest(generate_series(start - INTERVAL 3 DAYS, start + INTERVAL 12 HOURS, INTERVAL 1 DAY)) AS day
FROM (SELECT DISTINCT o_orderdate AS start FROM orders)""",
)
def lookback(spark: SparkSession, folder: str) -> DataFrame:
    days = times.lookback_days(F.col("start"), F.col("end"))
    return windows(spark, folder).select("start", F.explode(days).alias("day"))


FIRST, LAST = datetime(1992, 1, 31), datetime(2003, 6, 30, 12)


@query(
    "fetch_chunks",
    """WITH RECURSIVE steps(chunk_start) AS (
  SELECT TIMESTAMP '1992-01-31'
  UNION ALL SELECT chunk_start + INTERVAL 1 MONTH FROM steps WHERE chunk_start + INTERVAL 1 MONTH <= TIMESTAMP '2003-06-30 12:00:00'),
chunks AS (SELECT chunk_start, least(chunk_start + INTERVAL 1 MONTH - INTERVAL 1 MINUTE, TIMESTAMP '2003-06-30 12:00:00') AS chunk_end
           FROM steps)
SELECT o_orderkey, o_orderdate, chunk_start, chunk_end, CAST(year(chunk_start) AS INTEGER) AS archive_year,
       CAST(month(chunk_start) AS INTEGER) AS archive_month
FROM orders JOIN chunks ON o_orderdate BETWEEN chunk_start AND chunk_end""",
)
def fetch_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the month-long fetch window they fall in; windows begin on a 31st."""
    chunks = manifest.chunk_table(spark, times.month_chunks(FIRST, LAST))
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    return manifest.assign_chunks(orders, chunks, "o_orderdate")


@query(
    "ten_day_chunks",
    """WITH days AS (SELECT o_orderkey, o_orderdate, date_trunc('month', o_orderdate) AS month, day(o_orderdate) AS d FROM orders),
placed AS (SELECT *, CASE WHEN d <= 10 THEN 0 WHEN d <= 20 THEN 1 WHEN d <= 30 THEN 2 ELSE 3 END AS n FROM days)
SELECT o_orderkey, o_orderdate, month + n * 10 * INTERVAL 1 DAY AS chunk_start,
       least(month + (n + 1) * 10 * INTERVAL 1 DAY, month + INTERVAL 1 MONTH) - INTERVAL 1 MINUTE AS chunk_end,
       CAST(year(month) AS INTEGER) AS archive_year, CAST(month(month) AS INTEGER) AS archive_month FROM placed""",
)
def ten_day_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the ten-day fetch window they fall in."""
    chunks = manifest.chunk_table(spark, times.ten_day_chunks(datetime(1992, 1, 1), datetime(2003, 12, 31, 23, 59)))
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    return manifest.assign_chunks(orders, chunks, "o_orderdate")


@query(
    "overlapping_chunks",
    """WITH span AS (SELECT date_trunc('day', min(ts)) AS a, max(ts) AS b FROM events),
chunks AS (
  SELECT c AS chunk_start, c + INTERVAL 450 MINUTES AS chunk_end FROM (SELECT unnest(generate_series(a, b, INTERVAL 5 HOURS)) AS c FROM span)
  UNION ALL SELECT c, c + INTERVAL 10 DAYS FROM (SELECT unnest(generate_series(a, b, INTERVAL 7 DAYS)) AS c FROM span))
SELECT event_id, ts, chunk_start, chunk_end
FROM events JOIN chunks ON ts >= chunk_start AND ts < chunk_end + INTERVAL 1 MINUTE""",
)
def overlapping_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Events with all windows that they fall in: of some hours and of ten days, from the first event's day to the last."""
    events = table(spark, folder, "events").select("event_id", "ts")
    span = events.agg(F.date_trunc("day", F.min("ts")).cast(events.schema["ts"].dataType).alias("a"), F.max("ts").alias("b"))

    def every(step: str, length: str) -> DataFrame:
        starts = span.select(F.explode(F.sequence("a", "b", F.expr(step))).alias("chunk_start"))
        return starts.withColumn("chunk_end", F.col("chunk_start") + F.expr(length))

    chunks = every("INTERVAL 5 HOURS", "INTERVAL 450 MINUTES").unionByName(every("INTERVAL 7 DAYS", "INTERVAL 10 DAYS"))
    return manifest.assign_chunks(events, written(chunks, "chunks"), "ts")


@query(
    "database_files",
    """SELECT path, component, date_trunc('minute', ts) AS stamp
FROM (SELECT *, CASE event_type WHEN 'view' THEN 'wspd' WHEN 'click' THEN 'wdir' ELSE 'qpf' END AS component,
             's3://bucket/' || CASE event_type WHEN 'view' THEN 'wspd' WHEN 'click' THEN 'wdir' ELSE 'qpf' END
             || strftime(ts, '/%Y/%m/%d/')
             || CASE event_type WHEN 'view' THEN 'YCRZ98' WHEN 'click' THEN 'YBRZ97' ELSE 'YIRZ98' END
             || '_KWBN_' || strftime(ts, '%Y%m%d%H%M') || CASE WHEN value < 2 THEN 'x' ELSE '' END AS path
      FROM events)
WHERE component IN ('wspd', 'wdir') AND value >= 2 AND hour(ts) IN (11, 23)
  AND CAST(ts AS DATE) BETWEEN DATE '2024-01-02' AND DATE '2024-01-20'""",
)
def database_files(spark: SparkSession, folder: str) -> DataFrame:
    """Listed files of an element, from three days before the start on."""
    kind = F.col("event_type")
    component = F.when(kind == "view", "wspd").when(kind == "click", "wdir").otherwise("qpf")
    prefix = F.when(kind == "view", "YCRZ98").when(kind == "click", "YBRZ97").otherwise("YIRZ98")
    path = F.concat(
        F.lit("s3://bucket/"), component, F.date_format("ts", "/yyyy/MM/dd/"), prefix, F.lit("_KWBN_"),
        F.date_format("ts", "yyyyMMddHHmm"), F.when(F.col("value") < 2, "x").otherwise(""),
    )
    listed = table(spark, folder, "events").select(path.alias("path"))
    return manifest.ndfd_files(listed, "Wind", datetime(2024, 1, 5, 6), datetime(2024, 1, 20, 18))


@query(
    "valid_requests",
    """SELECT o_orderkey, model, element FROM (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'nbm' WHEN 'O' THEN 'nbmqmd' ELSE 'urma' END AS model,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Wind' WHEN '2-HIGH' THEN 'maxt' WHEN '3-MEDIUM' THEN 'snow6hr'
              WHEN '5-LOW' THEN 'precip24hr' ELSE 'Fog' END AS element FROM orders)
WHERE (model, element) IN (('nbm', 'Wind'), ('nbm', 'snow6hr'), ('nbmqmd', 'maxt'), ('nbmqmd', 'precip24hr'), ('urma', 'Wind'))""",
)
def valid_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests for elements that the model has."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    requests = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(status == "F", "nbm").when(status == "O", "nbmqmd").otherwise("urma").alias("model"),
        F.when(priority == "1-URGENT", "Wind")
        .when(priority == "2-HIGH", "maxt")
        .when(priority == "3-MEDIUM", "snow6hr")
        .when(priority == "5-LOW", "precip24hr")
        .otherwise("Fog")
        .alias("element"),
    )
    return rules.valid_requests(requests)


@query(
    "valid_run_hours",
    """SELECT event_id, model, element, run_hour FROM (
  SELECT event_id, CAST(hour(ts) AS INTEGER) AS run_hour,
         CASE event_type WHEN 'view' THEN 'nbm' WHEN 'click' THEN 'nbmqmd' WHEN 'purchase' THEN 'hrrr' WHEN 'signup' THEN 'urma' ELSE 'none' END AS model,
         CASE WHEN event_type = 'click' THEN 'maxt' WHEN user_id % 2 = 0 THEN 'Wind' ELSE 'precip6hr' END AS element FROM events)
WHERE (model = 'nbm' AND element = 'Wind' AND run_hour IN (1, 7, 13, 19)) OR (model = 'nbmqmd' AND run_hour IN (0, 6, 12, 18))
   OR model = 'hrrr' OR (model = 'urma' AND element = 'Wind')""",
)
def valid_run_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Requests for elements that the model has, at hours at which it runs."""
    kind = F.col("event_type")
    requests = table(spark, folder, "events").select(
        "event_id",
        F.when(kind == "view", "nbm").when(kind == "click", "nbmqmd").when(kind == "purchase", "hrrr").when(kind == "signup", "urma").otherwise("none").alias("model"),
        F.when(kind == "click", "maxt").when(F.col("user_id") % 2 == 0, "Wind").otherwise("precip6hr").alias("element"),
        F.hour("ts").alias("run_hour"),
    )
    return rules.valid_requests(requests, run_hour="run_hour")


@query(
    "inventory_files",
    """WITH lines AS (
  SELECT doc_id, coalesce(source, 'none') AS source, doc_id // 500 AS part, doc_id || ':' || coalesce(length(text), 0) || ':WIND:' || coalesce(lang, '') AS line FROM documents)
SELECT source, CAST(part AS INTEGER) AS part, CAST(row_number() OVER (PARTITION BY source, part ORDER BY doc_id) AS INTEGER) AS line_no, line FROM lines""",
)
def inventory_files(spark: SparkSession, folder: str) -> DataFrame:
    """Inventories written as files, one per source and 500 documents, and read back line by line."""
    root = scratch_folder(spark, "inventories")
    line = F.concat_ws(":", "doc_id", F.coalesce(F.length("text"), F.lit(0)), F.lit("WIND"), F.coalesce("lang", F.lit("")))
    lines = table(spark, folder, "documents").select(
        F.coalesce("source", F.lit("none")).alias("source"), F.floor(F.col("doc_id") / 500).alias("part"), "doc_id", line.alias("value")
    )
    placed = lines.repartition("source", "part").sortWithinPartitions("source", "part", "doc_id").drop("doc_id")
    placed.write.partitionBy("source", "part").text(root)
    read = files.read_inventories(spark, root, ".txt").select("file", F.posexplode("lines").alias("at", "line"))
    return read.select(
        F.regexp_extract("file", "/source=([^/]*)/", 1).alias("source"),
        F.regexp_extract("file", "/part=([0-9]+)/", 1).cast("int").alias("part"),
        (F.col("at") + 1).cast("int").alias("line_no"),
        "line",
    )
