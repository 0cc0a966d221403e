"""Inventories of gridded files: each document is one, each of its lines a message.

A line's length decides what its message is, so that all of every text matters.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import day_accumulation_label, run_total_label
from ..operators.messages import byte_ranges, complete_files, select_element, select_messages, split_lines
from . import query, table

VARIABLES = ["APCP:surface", "TMP:2 m above ground", "WIND:10 m above ground", "ASNOW:surface", "WDIR:10 m above ground", "GUST:10 m above ground"]
TAILS = ["50% level", "33% level", "95% level", "ens std dev", "", "prob >0.1"]


def pick(options: list[str], i: Column) -> Column:
    return F.get(F.array(*[F.lit(o) for o in options]), F.pmod(i, F.lit(len(options))))


def sql_pick(options: list[str], i: str) -> str:
    return f"([{', '.join(repr(o) for o in options)}])[1 + {i} % {len(options)}]"


def inventories(spark: SparkSession, folder: str, name: str, labels: list[Column]) -> DataFrame:
    """Documents as inventories of files with leads of 6 to 120 hours."""
    hours = (F.pmod("doc_id", F.lit(20)) + 1) * 6
    documents = table(spark, folder, "documents").select(
        F.concat(F.lit("run"), F.col("doc_id").cast("string"), F.lit("/"), F.format_string(name, hours)).alias("file"),
        hours.cast("int").alias("lead"),
        split_lines(F.col("text")).alias("text"),
    )

    def line(content: Column, i: Column) -> Column:
        n = F.length(content)
        return F.concat_ws(
            ":",
            (i + 1).cast("string"),
            (i * 1000 + F.pmod(n, F.lit(1000))).cast("string"),
            F.lit("d=2025010100"),
            pick(VARIABLES, n),
            F.get(F.array(*labels), F.pmod(i, F.lit(len(labels)))),
            pick(TAILS, F.floor(n / 7).cast("int")),
        )

    return documents.select("file", F.transform("text", line).alias("lines"))


def lead() -> Column:
    return F.col("lead").cast("string")


def span() -> Column:
    return F.concat((F.col("lead") - 6).cast("string"), F.lit("-"), lead())


def plain() -> list[Column]:
    days = (F.col("lead") / 24).cast("int").cast("string")
    return [
        F.concat(span(), F.lit(" hour acc fcst")),
        F.concat(lead(), F.lit(" hour fcst")),
        F.concat(F.lit("0-"), lead(), F.lit(" hour acc fcst")),
        F.concat(F.lit("0-"), days, F.lit(" day acc fcst")),
    ]


def annotated() -> list[Column]:
    return [F.concat(span(), F.lit(f" hour acc{text}")) for text in ("@(fcst,dt=6 hour),missing=0", " fcst")]


def lines_sql(name: str, labels: str) -> str:
    """Numbered lines of all files, with the bytes of their messages."""
    return f"""
docs AS (SELECT doc_id, (doc_id % 20 + 1) * 6 AS lead,
                string_split(trim(text, chr(32) || chr(9) || chr(13) || chr(10) || chr(12) || chr(11)), chr(10)) AS text
         FROM documents),
contents AS (SELECT doc_id, lead, unnest(text) AS content, generate_subscripts(text, 1) - 1 AS i FROM docs),
numbered AS (
  SELECT 'run' || doc_id || '/' || printf('{name}', lead) AS file, lead, CAST(i + 1 AS INTEGER) AS line_no,
         concat_ws(':', i + 1, i * 1000 + length(content) % 1000, 'd=2025010100', {sql_pick(VARIABLES, 'length(content)')},
                   ([{labels}])[1 + i % {labels.count(chr(10)) + 1}], {sql_pick(TAILS, '(length(content) // 7)')}) AS line,
         i * 1000 + length(content) % 1000 AS range_start
  FROM contents),
ranged AS (
  SELECT *, lead(range_start) OVER (PARTITION BY file ORDER BY line_no) - 1 AS range_end FROM numbered),
messages AS (
  SELECT *, range_start || '-' || CASE WHEN range_end <> 0 THEN CAST(range_end AS VARCHAR) ELSE '' END AS byte_range
  FROM ranged)
"""


PLAIN_SQL = """(lead - 6) || '-' || lead || ' hour acc fcst',
 lead || ' hour fcst',
 '0-' || lead || ' hour acc fcst',
 '0-' || (lead // 24) || ' day acc fcst'"""
ANNOTATED_SQL = """(lead - 6) || '-' || lead || ' hour acc@(fcst,dt=6 hour),missing=0',
 (lead - 6) || '-' || lead || ' hour acc fcst'"""

BLEND, QMD, HRRR = "blend.t01z.core.f%03d.ak.grib2", "blend.t00z.qmd.f%03d.ak.grib2", "hrrr.t00z.wrfsfcf%02d.ak.grib2"
COLUMNS = "file, byte_range, line_no, line, range_start, range_end"


def contains(*phrases: str) -> str:
    return "(" + " OR ".join(f"contains(line, '{p}')" for p in phrases) + ")"


PERCENTILE_SQL = r"TRY_CAST(regexp_extract(trim(split_part(line, ':', -1)), '^(\d+)% level', 1) AS INTEGER) IN (5, 10, 25, 50, 75, 90, 95)"


@query("message_bytes", f"WITH {lines_sql(BLEND, PLAIN_SQL)} SELECT file, line_no, line, range_start, range_end, byte_range FROM messages")
def message_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every message of every file."""
    return byte_ranges(inventories(spark, folder, BLEND, plain()))


@query(
    "message_filter",
    f"""WITH {lines_sql(BLEND, PLAIN_SQL)} SELECT {COLUMNS} FROM messages
WHERE {contains(':WIND:10 m above', ':APCP:surface')} AND NOT {contains('ens std dev', 'prob')}
  AND contains(line, 'hour') AND contains(line, 'd=2025') AND contains(line, lead || ' hour')""",
)
def message_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Any of some strings, all of others, none of a third kind, and a label."""
    files = inventories(spark, folder, BLEND, plain()).withColumn(
        "lead", F.regexp_extract("file", r"f(\d{3})", 1).cast("int")
    )
    return select_messages(
        files,
        [":WIND:10 m above", ":APCP:surface"],
        exclude=["ens std dev", "prob"],
        require=["hour", "d=2025"],
        label=F.concat(F.col("lead").cast("string"), F.lit(" hour")),
    )


@query(
    "complete_files",
    f"""WITH {lines_sql(BLEND, PLAIN_SQL)}
SELECT file, count(*) AS lines FROM messages GROUP BY file
HAVING bool_or(contains(line, ':WIND:10 m above') AND NOT contains(line, 'ens std dev'))
   AND bool_or(contains(line, ':WDIR:10 m above') AND NOT contains(line, 'ens std dev'))
   AND bool_or(contains(line, ':GUST:10 m above') AND NOT contains(line, 'ens std dev'))""",
)
def complete(spark: SparkSession, folder: str) -> DataFrame:
    """Files in which every wanted variable occurs."""
    search = [":WIND:10 m above", ":WDIR:10 m above", ":GUST:10 m above"]
    files = complete_files(inventories(spark, folder, BLEND, plain()), search, exclude=["ens std dev"])
    return files.select("file", F.size("lines").cast("long").alias("lines"))


@query(
    "messages_wind",
    f"""WITH {lines_sql(BLEND, PLAIN_SQL)}, whole AS (
  SELECT file FROM messages WHERE NOT contains(line, 'ens std dev') GROUP BY file
  HAVING bool_or(contains(line, ':WIND:10 m above')) AND bool_or(contains(line, ':WDIR:10 m above'))
     AND bool_or(contains(line, ':GUST:10 m above')))
SELECT {COLUMNS} FROM messages SEMI JOIN whole USING (file)
WHERE {contains(':WIND:10 m above', ':WDIR:10 m above', ':GUST:10 m above')} AND NOT contains(line, 'ens std dev')""",
)
def messages_wind(spark: SparkSession, folder: str) -> DataFrame:
    return select_element(inventories(spark, folder, BLEND, plain()), "nbm", "Wind")


@query(
    "messages_percentiles",
    f"""WITH {lines_sql(QMD, PLAIN_SQL)} SELECT {COLUMNS} FROM messages
WHERE contains(line, ':APCP:surface:') AND contains(line, (lead - 6) || '-' || lead || ' hour acc fcst')
  AND {PERCENTILE_SQL}""",
)
def messages_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    return select_element(inventories(spark, folder, QMD, plain()), "nbmqmd", "precip6hr")


@query(
    "messages_day_totals",
    f"""WITH {lines_sql(QMD, PLAIN_SQL)} SELECT {COLUMNS} FROM messages
WHERE contains(line, ':APCP:surface:') AND {PERCENTILE_SQL}
  AND contains(line, CASE WHEN lead % 24 = 0 THEN (lead // 24 - 1) || '-' || (lead // 24) || ' day acc fcst'
                          ELSE greatest(0, lead - 24) || '-' || lead || ' hour acc fcst' END)""",
)
def messages_day_totals(spark: SparkSession, folder: str) -> DataFrame:
    return select_element(inventories(spark, folder, QMD, plain()), "nbmqmd", "precip24hr")


@query(
    "messages_run_totals",
    f"""WITH {lines_sql(HRRR, PLAIN_SQL)} SELECT {COLUMNS} FROM messages
WHERE contains(line, ':APCP:surface') AND NOT contains(line, 'ens std dev')
  AND contains(line, CASE WHEN lead IN (24, 48) THEN '0-' || (lead // 24) || ' day acc fcst'
                          ELSE '0-' || lead || ' hour acc fcst' END)""",
)
def messages_run_totals(spark: SparkSession, folder: str) -> DataFrame:
    return select_element(inventories(spark, folder, HRRR, plain()), "hrrr", "precip6hr")


@query(
    "messages_annotated",
    rf"""WITH {lines_sql(BLEND, ANNOTATED_SQL)} SELECT {COLUMNS} FROM messages
WHERE contains(line, ':ASNOW:surface:') AND NOT contains(line, 'prob') AND {PERCENTILE_SQL}
  AND regexp_matches(line, ':' || (lead - 6) || '-' || lead || '\s+hour\s+acc@\(\s*fcst\s*,\s*dt=6\s*hour\s*\),missing=\d+:')""",
)
def messages_annotated(spark: SparkSession, folder: str) -> DataFrame:
    return select_element(inventories(spark, folder, BLEND, annotated()), "nbm", "snow6hr")


@query(
    "accumulation_labels",
    """WITH leads AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity * 6 - 6 AS INTEGER) AS lead FROM lineitem)
SELECT *, CASE WHEN lead = 0 THEN NULL
               WHEN lead % 24 = 0 THEN (lead // 24 - 1) || '-' || (lead // 24) || ' day acc fcst'
               ELSE greatest(0, lead - 24) || '-' || lead || ' hour acc fcst' END AS day_label,
       CASE WHEN lead > 0 AND lead % 24 = 0 AND lead < 72 THEN NULL WHEN lead = 0 THEN NULL
               WHEN lead % 24 = 0 THEN (lead // 24 - 3) || '-' || (lead // 24) || ' day acc fcst'
               ELSE greatest(0, lead - 24) || '-' || lead || ' hour acc fcst' END AS three_day_label,
       CASE WHEN lead IN (0, 24, 48) THEN '0-' || (lead // 24) || ' day acc fcst'
            ELSE '0-' || lead || ' hour acc fcst' END AS run_label FROM leads""",
)
def accumulation_labels(spark: SparkSession, folder: str) -> DataFrame:
    hours = (F.col("l_quantity") * 6 - 6).cast("int")
    return (
        table(spark, folder, "lineitem")
        .select("l_orderkey", "l_linenumber", hours.alias("lead"))
        .withColumns(
            {
                "day_label": day_accumulation_label(F.col("lead")),
                "three_day_label": day_accumulation_label(F.col("lead"), 72),
                "run_label": run_total_label(F.col("lead")),
            }
        )
    )
