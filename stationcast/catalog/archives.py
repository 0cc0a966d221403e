"""Appending without repeats, partitioned writing and reading back."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import archive_name
from ..operators.dedup import append_by_key, append_distinct
from ..plans.verification import within_days
from ..session import scratch_folder
from ..sources.archive import (
    append_archive,
    compact_months,
    in_months,
    month_summary,
    peek,
    read_archive,
    read_between,
    read_months,
    write_partitioned,
)
from . import query, table


def halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders in two batches that share the finished ones."""
    orders = table(spark, folder, "orders")
    return orders.where("o_orderstatus <> 'P'"), orders.where("o_orderstatus <> 'O'")


@query("append_distinct", "SELECT DISTINCT * FROM orders")
def distinct(spark: SparkSession, folder: str) -> DataFrame:
    return append_distinct(*halves(spark, folder))


@query(
    "append_other_columns",
    """SELECT DISTINCT o_orderkey, o_orderstatus, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders
  WHERE o_orderstatus <> 'P'
UNION SELECT o_orderkey, o_orderstatus, NULL, o_orderpriority FROM orders WHERE o_orderstatus <> 'O'""",
)
def other_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Batches that lack each other's columns."""
    old, new = halves(spark, folder)
    return append_distinct(
        old.select("o_orderkey", "o_orderstatus", "o_totalprice"),
        new.select("o_orderkey", "o_orderstatus", "o_orderpriority"),
    )


@query(
    "append_by_key",
    """SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                               ORDER BY (o_orderstatus = 'P'), o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1""",
)
def by_key(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer and priority: an archived one if there is one."""
    columns = ["o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey", "o_totalprice"]
    old, new = halves(spark, folder)
    return append_by_key(
        old.select(*columns), new.select(*columns), ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"]
    )


MONTHS_SQL = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  count(*) AS rows, min(o_orderdate) AS first_time, max(o_orderdate) AS last_time FROM orders GROUP BY 1, 2"""


@query("archive_months", MONTHS_SQL)
def months(spark: SparkSession, folder: str) -> DataFrame:
    """An archive filled by overlapping batches, one of them twice, month by month."""
    path = scratch_folder(spark, "archive")
    old, new = halves(spark, folder)
    for batch in (old, new, old):
        append_archive(batch, path, time="o_orderdate")
    return month_summary(read_archive(spark, path), "o_orderdate")


@query(
    "archive_station",
    """SELECT DISTINCT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
WHERE o_custkey IN (1, 2, 4, 5, 7, 8, 10, 11, 13, 14) AND o_orderdate >= TIMESTAMP '1993-01-01'""",
)
def station(spark: SparkSession, folder: str) -> DataFrame:
    """Some customers of an archive whose months are ordered by customer and time."""
    path = scratch_folder(spark, "archive")
    columns = ["o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"]
    for batch in halves(spark, folder):
        append_archive(batch.select(*columns), path, time="o_orderdate", cluster=["o_custkey", "o_orderdate"])
    compact_months(spark, path, [(1995, m) for m in range(1, 13)])
    customers = [("o_custkey", "in", [1, 2, 4, 5, 7, 8, 10, 11, 13, 14])]
    since = [("o_orderdate", ">=", F.lit("1993-01-01").cast("timestamp_ntz"))]
    return read_archive(spark, path, columns=columns, filters=customers + since)


NARROW = ["o_custkey", "o_orderdate", "o_orderstatus"]
WIDE = [*NARROW, "o_orderpriority"]
OTHER = ["o_custkey", "o_orderdate", "o_totalprice"]

GROWING_SQL = """SELECT DISTINCT * FROM (
  SELECT o_custkey, o_orderdate, o_orderstatus FROM orders
  UNION ALL BY NAME SELECT o_custkey, o_orderdate, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL BY NAME SELECT o_custkey, o_orderdate, o_totalprice FROM orders WHERE o_orderstatus <> 'O')"""


def growing(spark: SparkSession, folder: str, *steps: int) -> DataFrame:
    """An archive after batches whose columns differ, in this order and then once more."""
    path = scratch_folder(spark, "archive")
    orders = table(spark, folder, "orders")
    old, new = halves(spark, folder)
    batches = [orders.select(*NARROW), old.select(*WIDE), new.select(*OTHER)]
    for k in (*steps, steps[0]):
        append_archive(batches[k], path, time="o_orderdate")
    return read_archive(spark, path).drop("year", "month")


@query("archive_columns_added", GROWING_SQL)
def columns_added(spark: SparkSession, folder: str) -> DataFrame:
    """A batch of fewer columns first; rows that differ by a missing value stay apart."""
    return growing(spark, folder, 0, 1, 2)


@query("archive_columns_missing", GROWING_SQL)
def columns_missing(spark: SparkSession, folder: str) -> DataFrame:
    """A batch of more columns first."""
    return growing(spark, folder, 1, 2, 0)


@query(
    "archive_month_files",
    """SELECT o_orderkey, o_orderdate, o_totalprice, CASE WHEN year(o_orderdate) >= 1995 THEN o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1994-11-01' AND o_orderdate < TIMESTAMP '1995-03-01'""",
)
def month_files_read(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly files found by their names, the later ones with a column more; a month
    without a file adds nothing."""
    root = scratch_folder(spark, "months")
    columns = ["o_orderkey", "o_orderdate", "o_totalprice"]
    pattern = "{YYYY}_{MM}_{model}_{element}_archive.parquet"
    wanted = [(1994, 11), (1994, 12), (1995, 1), (1995, 2)]
    for year, month in wanted:
        own = table(spark, folder, "orders").where((F.year("o_orderdate") == year) & (F.month("o_orderdate") == month))
        rows = own.select(*columns, *(["o_orderpriority"] if year >= 1995 else []))
        rows.write.parquet(f"{root}/{archive_name(year, month, 'nbm', 'wind', pattern)}")
    read = read_months(spark, root, [*wanted, (1899, 12)], "nbm", "wind", pattern=pattern)
    return read.select(*columns, "o_orderpriority")


@query("archive_compacted", "SELECT DISTINCT o_orderkey, o_orderdate, o_totalprice FROM orders")
def compacted(spark: SparkSession, folder: str) -> DataFrame:
    """An archive of two appends with some months rewritten."""
    path = scratch_folder(spark, "archive")
    for batch in halves(spark, folder):
        append_archive(batch.select("o_orderkey", "o_orderdate", "o_totalprice"), path, time="o_orderdate")
    compact_months(spark, path, [(1996, 2), (1996, 3), (1899, 1)])
    return read_archive(spark, path).drop("year", "month")


@query(
    "archive_by_key",
    """SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority, date_trunc('month', o_orderdate)
                               ORDER BY (o_orderstatus = 'P'), o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1""",
)
def archive_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer, priority and month; the archived row stays."""
    path = scratch_folder(spark, "archive")
    columns = ["o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey"]
    for batch in halves(spark, folder):
        dated = batch.select(*columns, F.trunc("o_orderdate", "month").alias("o_month"))
        append_archive(
            dated, path, time="o_orderdate", keys=["o_custkey", "o_orderpriority", "o_month"], order=["o_orderdate", "o_orderkey"]
        )
    return read_archive(spark, path, columns=columns)


@query(
    "partitioned_months",
    """SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders WHERE (year(o_orderdate) = 1996 AND month(o_orderdate) IN (2, 3)) OR (year(o_orderdate) = 1997 AND month(o_orderdate) = 1)""",
)
def partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """Three months of a partitioned archive; other folders are not read."""
    path = scratch_folder(spark, "partitioned")
    write_partitioned(table(spark, folder, "orders"), path, time="o_orderdate")
    archive = read_archive(spark, path, columns=["o_orderkey", "o_orderdate", "year", "month"])
    return in_months(archive, [(1996, 2), (1996, 3), (1997, 1)])


@query(
    "archive_days",
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-12-20' AND o_orderdate < TIMESTAMP '1997-02-11'""",
)
def days(spark: SparkSession, folder: str) -> DataFrame:
    """Some weeks of a partitioned archive, across a year's end."""
    path = scratch_folder(spark, "partitioned")
    write_partitioned(table(spark, folder, "orders"), path, time="o_orderdate")
    first, last = date(1996, 12, 20), date(1997, 2, 10)
    months = read_between(spark, path, first, last, columns=["o_orderkey", "o_orderdate", "o_totalprice"])
    return within_days(months, "o_orderdate", first, last)


@query("archive_peek", "SELECT * FROM nation LIMIT 10")
def archive_peek(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows of a file, with all its columns."""
    return peek(spark, f"{folder}/nation.parquet")
