"""Monthly Parquet archives: reading with push-down, appending, partitioning.

A partitioned archive keeps its layout beside its data, below ``_stationcast``: the columns
that any append brought, and the columns its rows are ordered by within a month.  Reads take
the columns from there and open only the files they need.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names
from ..functions.times import months_between
from ..operators.dedup import first_per_key, rows_not_in
from ..session import configure, written

_NO_FILES = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
_MONTH = [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
#: Values of a key that are pushed to the scan one by one (Spark's own limit); more are as a range.
IN_VALUES = 10
#: Rows of a batch whose keys pick the archived rows before these are compared.
PICKING_ROWS = 1_000_000


# -- reading -------------------------------------------------------------------


def project(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """The requested columns that exist; all columns if none of them does."""
    present = [c for c in columns or [] if c in df.columns]
    return df.select(*present) if present else df


def apply_filters(df: DataFrame, filters: Sequence[tuple[str, str, object]] | None) -> DataFrame:
    """Conjunction of (column, operator, value); unknown columns and operators are passed over."""
    compare = {
        "==": lambda c, v: c == v,
        ">=": lambda c, v: c >= v,
        "<=": lambda c, v: c <= v,
        ">": lambda c, v: c > v,
        "<": lambda c, v: c < v,
        "in": lambda c, v: c.isin(list(v)),
    }
    for column, operator, value in filters or []:
        if column in df.columns and operator in compare:
            df = df.where(compare[operator](F.col(column), value))
    return df


def repair_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn nanosecond integers, as some writers leave them, into timestamps."""
    longs = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.LongType)]
    return df.withColumns({c: F.timestamp_micros(F.expr(f"`{c}` div 1000")) for c in longs})


def read_archive(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    columns: Sequence[str] | None = None,
    filters: Sequence[tuple[str, str, object]] | None = None,
    times: Sequence[str] = (),
    schema: T.StructType | None = None,
    base: str | None = None,
) -> DataFrame:
    """Several Parquet files or a partitioned table as one lazy frame.

    Files may differ in their columns: the frame has those of all files, null where a
    file lacks one.  Filters and projection reach the scan.  No paths, or none that
    exist, give an empty frame with ``schema`` (required for that case).
    """
    configure(spark)
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = _read_if_any(spark, paths, base)
    if df is None:
        if schema is None:
            raise FileNotFoundError(f"no archive at {paths} and no schema given")
        df = spark.createDataFrame([], schema)
    filtered = apply_filters(repair_timestamps(df, times), filters)
    return project(filtered, columns)


def month_files(
    root: str, months: Sequence[tuple[int, int]], model: str, element: str, pattern: str, case: str = "lower"
) -> str:
    """Path matching the monthly files that exist under ``root`` for these months."""
    wanted = [names.archive_name(y, m, model, element, pattern, case) for y, m in months]
    return f"{root.rstrip('/')}/{{{','.join(wanted)}}}"


def read_months(
    spark: SparkSession,
    root: str,
    months: Sequence[tuple[int, int]],
    model: str,
    element: str,
    *,
    pattern: str = "{YYYY}_{MM}_{model}_{element}_archive.parquet",
    case: str = "lower",
    **read_options,
) -> DataFrame:
    """The monthly files of a model and element; months without a file add nothing."""
    paths = [month_files(root, months, model, element, pattern, case)] if months else []
    return read_archive(spark, paths, **read_options)


def in_months(df: DataFrame, months: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of the named month partitions; prunes directories on a partitioned table.
    Rows without a time are in the month (None, None)."""
    keep = [F.col("year").eqNullSafe(y) & F.col("month").eqNullSafe(m) for y, m in months]
    return df.where(reduce(lambda a, b: a | b, keep, F.lit(False)))


def read_between(spark: SparkSession, path: str, first: date, last: date, **read_options) -> DataFrame:
    """The months of a partitioned archive that hold the days ``first`` to ``last``;
    other folders are neither listed nor read."""
    months = month_folders(path, months_between(first, last))
    return read_archive(spark, months, base=path, **read_options).drop("year", "month")


def month_folders(path: str, months: Sequence[tuple[int | None, int | None]]) -> str:
    """Path matching the folders of these months that exist in a partitioned archive.
    Rows without a time are in the month (None, None)."""

    def name(value: int | None) -> str:
        return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)

    wanted = ",".join(f"year={name(y)}/month={name(m)}" for y, m in months)
    return f"{path.rstrip('/')}/{{{wanted}}}"


def _read_if_any(spark: SparkSession, paths: Sequence[str], base: str | None = None, layout: Layout | None = None) -> DataFrame | None:
    """The files' rows with the columns of all of them, or None if there are no files.

    The columns come from the archive's layout.  Files without one are all opened for theirs.
    """
    if not paths:
        return None
    root = base or (paths[0] if len(paths) == 1 else None)
    layout = layout or (read_layout(spark, root) if root else None)
    reader = spark.read.schema(layout.schema) if layout else spark.read.option("mergeSchema", "true")
    try:
        return (reader.option("basePath", base) if base else reader).parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() in _NO_FILES:
            return None
        raise


# -- layout --------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Columns of a partitioned archive, and those its rows are ordered by within a month."""

    schema: T.StructType
    cluster: tuple[str, ...] = ()
    notes: int = 0


def read_layout(spark: SparkSession, path: str) -> Layout | None:
    """What appends have noted, in their order; None where there are no notes."""
    if "{" in path or "*" in path:
        return None
    try:
        notes = spark.read.option("wholetext", "true").text(f"{_layout_folder(path)}/*").collect()
    except AnalysisException as error:
        if error.getCondition() in _NO_FILES:
            return None
        raise
    found = None
    for note in sorted((json.loads(n["value"]) for n in notes), key=lambda n: n["number"]):
        found = _extended(found, T.StructType.fromJson(note["schema"]), note["cluster"])
    return found


def _extended(layout: Layout | None, schema: T.StructType, cluster: Sequence[str]) -> Layout:
    fields = {f.name: f for f in [*schema.fields, *(layout.schema.fields if layout else [])]}
    order = [*(f.name for f in (layout.schema.fields if layout else [])), *(f.name for f in schema.fields)]
    month = [f.name for f in _MONTH]
    merged = T.StructType([*(fields[c] for c in dict.fromkeys(order) if c not in month), *_MONTH])
    return Layout(merged, tuple(cluster) or (layout.cluster if layout else ()), 1 + (layout.notes if layout else 0))


def refresh_layout(spark: SparkSession, path: str) -> Layout | None:
    """Note the columns of all files of an archive, opening each: after others wrote to it."""
    df = _merged(spark, path)
    if df is None:
        return read_layout(spark, path)
    return _extend_layout(spark, path, df.schema, (), read_layout(spark, path))


def _layout_folder(path: str) -> str:
    return f"{path.rstrip('/')}/_stationcast/layout"


def _merged(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as error:
        if error.getCondition() in _NO_FILES:
            return None
        raise


def _known_types(layout: Layout | None, schema: T.StructType) -> dict[str, T.DataType]:
    """Types of the archive's columns, which those of the schema must not differ from."""
    known = {f.name: f.dataType for f in layout.schema.fields} if layout else {}
    other = [f for f in schema.fields if f.name in known and known[f.name] != f.dataType]
    if other:
        told = [f"{f.name} is {f.dataType.simpleString()}, archived as {known[f.name].simpleString()}" for f in other]
        raise ValueError(f"types differ from the archive's: {', '.join(told)}")
    return known


def _extend_layout(spark: SparkSession, path: str, schema: T.StructType, cluster: Sequence[str], layout: Layout | None) -> Layout:
    """Note columns and order if they are new.  Notes are added, never rewritten, so a failed run leaves none half done."""
    month = [f.name for f in _MONTH]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields if f.name not in month])
    known = _known_types(layout, schema)
    if layout and all(f.name in known for f in schema.fields) and (not cluster or tuple(cluster) == layout.cluster):
        return layout
    number = layout.notes if layout else 0
    note = json.dumps({"number": number, "schema": json.loads(schema.json()), "cluster": list(cluster)})
    folder = f"{_layout_folder(path)}/{number:06d}-{uuid.uuid4().hex}"
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.text(folder)
    return _extended(layout, schema, cluster)


# -- writing -------------------------------------------------------------------


def archive_path(root: str, source: str, element: str) -> str:
    """Folder of a source's element, the same wherever archives are kept."""
    return f"{root.rstrip('/')}/{source.lower()}/{element.lower()}"


def with_month(df: DataFrame, time: str = "valid_time") -> DataFrame:
    return df.withColumns({"year": F.year(time), "month": F.month(time)})


def write_partitioned(
    df: DataFrame,
    path: str,
    *,
    time: str = "valid_time",
    mode: str = "append",
    cluster: Sequence[str] = (),
    filters: Sequence[str] = (),
    row_group_bytes: int | None = None,
) -> None:
    """Write by month.  Small months end in one file, large ones are split over tasks.

    With ``cluster`` (station, then time), a month's rows are cut into ranges of these columns
    by measured counts, and each file holds one range in order, so that the statistics of
    files, row groups and pages leave out what a filter on them doesn't want.  A hash of the
    row is the last part of the ranges' order, so rows of one station and time are split too.
    ``filters`` get Parquet Bloom filters.
    """
    spark = df.sparkSession
    placed = with_month(df, time)
    if mode == "append":
        layout = read_layout(spark, path) or refresh_layout(spark, path)  # of files that others have written
        _extend_layout(spark, path, df.schema, cluster, layout)
    _write_months(placed, path, mode, cluster, filters, row_group_bytes)
    if mode != "append":
        _extend_layout(spark, path, df.schema, cluster, read_layout(spark, path))


def _write_months(
    placed: DataFrame, path: str, mode: str, cluster: Sequence[str], filters: Sequence[str] = (), row_group_bytes: int | None = None
) -> None:
    month = ["year", "month"]
    if cluster:
        hashable = [f.name for f in placed.schema.fields if not isinstance(f.dataType, T.MapType)]
        ranges = placed.withColumn("_spread", F.xxhash64(*hashable)).repartitionByRange(*month, *cluster, "_spread")
        placed = ranges.drop("_spread").sortWithinPartitions(*month, *cluster)
    else:
        placed = placed.hint("rebalance", *[F.col(c) for c in month])
    writer = placed.write.partitionBy(*month)
    for column in filters:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if mode == "months":  # replaces the folders of these months alone
        mode, writer = "overwrite", writer.option("partitionOverwriteMode", "dynamic")
    writer.mode(mode).parquet(path)


def append_archive(
    df: DataFrame,
    path: str,
    *,
    time: str = "valid_time",
    keys: Sequence[str] | None = None,
    order: Sequence[str] = (),
    cluster: Sequence[str] | None = None,
    row_group_bytes: int | None = None,
) -> None:
    """Add the rows that the archive does not hold yet.

    Whole rows are compared, or ``keys``, where the archived row wins and among new
    rows the first by ``order``.  Running the same batch again adds nothing, so a
    failed run is simply repeated.  The batch is computed once and written to shared
    scratch; nothing in the archive is rewritten.  A column that only one side has is
    null on the other; a column of another type than the archive's is refused.  One
    writer per archive at a time.

    Rows are ordered by ``cluster`` within a month: by default as the archive is, or by
    the keys, which also get Bloom filters.  Of the archive only the folders of the
    batch's months are listed, and of these only what may equal a row of the batch is read:
    the range or the few values of the keys (else of the time and the order's columns) go to
    the scan, and the keys of a batch of moderate size pick the rows that are compared.
    """
    spark = configure(df.sparkSession)
    layout = read_layout(spark, path) or refresh_layout(spark, path)  # of files that others have written
    _known_types(layout, df.schema)
    batch = first_per_key(df, keys, order) if keys else df.distinct()
    batch = written(with_month(batch, time), "append")
    months = [(r.year, r.month) for r in batch.select("year", "month").distinct().collect()]
    if cluster is None:
        cluster = (layout.cluster if layout else ()) or tuple(keys or ())
    held = _held_months(spark, path, months, layout)
    if held is None:
        fresh = batch
    else:
        among = [c for c in (keys or dict.fromkeys([time, *cluster])) if c in held.columns]
        fresh = rows_not_in(batch, possible_rows(held, batch, among, pick=bool(keys)), keys)
    _extend_layout(spark, path, df.schema, cluster, layout)
    _write_months(fresh.select(*df.columns, "year", "month"), path, "append", cluster, keys or (), row_group_bytes)


def possible_rows(held: DataFrame, batch: DataFrame, columns: Sequence[str], pick: bool = True) -> DataFrame:
    """Rows of ``held`` that may agree with a row of the batch on these columns, null with null.

    Each column's range in the batch, or its values where they are few, become filters of the
    scan.  A batch of moderate size may then pick the rows by its distinct values, which Spark
    broadcasts if they are small.
    """
    kinds = {f.name: f.dataType for f in batch.schema.fields}
    columns = [c for c in columns if c in kinds and c in held.columns]
    plain = (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    ranged = [c for c in columns if isinstance(kinds[c], plain) and not isinstance(kinds[c], (T.FloatType, T.DoubleType))]
    # Timestamps travel as whole numbers, which don't depend on the driver's time zone.
    number = {c: isinstance(kinds[c], T.TimestampType) for c in ranged}
    plain_value = lambda c: F.unix_micros(c) if number[c] else F.col(c)
    literal = lambda c, v: F.timestamp_micros(F.lit(v)) if number[c] else F.lit(v).cast(kinds[c])
    facts = [F.count("*").alias("rows")]
    for k, c in enumerate(ranged):
        value = plain_value(c)
        facts += [F.min(value).alias(f"low{k}"), F.max(value).alias(f"high{k}"), F.approx_count_distinct(c).alias(f"many{k}"), F.count_if(F.col(c).isNull()).alias(f"null{k}")]
    known = batch.agg(*facts).first()
    for k, c in enumerate(ranged):
        near = F.lit(False)
        if known[f"low{k}"] is not None:
            near = F.col(c).between(literal(c, known[f"low{k}"]), literal(c, known[f"high{k}"]))
            if known[f"many{k}"] <= IN_VALUES:
                values = [r[0] for r in batch.where(F.col(c).isNotNull()).select(plain_value(c)).distinct().limit(IN_VALUES + 1).collect()]
                if len(values) <= IN_VALUES:
                    near = F.col(c).isin([literal(c, v) for v in values])
        held = held.where(near | F.col(c).isNull() if known[f"null{k}"] else near)
    if pick and columns and known["rows"] <= PICKING_ROWS:
        wanted = batch.select(*[F.col(c).alias(f"_wanted_{c}") for c in columns]).distinct()
        held = held.join(wanted, [F.col(c).eqNullSafe(F.col(f"_wanted_{c}")) for c in columns], "left_semi")
    return held


def compact_months(
    spark: SparkSession, path: str, months: Sequence[tuple[int | None, int | None]], *, cluster: Sequence[str] | None = None, row_group_bytes: int | None = None
) -> None:
    """Rewrite these months of an archive in as few files as their size asks for.

    Rows are ordered by ``cluster``, by default as the archive is.  They are first written
    to shared scratch; then the months' folders, and no others, are replaced.  Months
    without a folder stay without one.  One writer per archive at a time.
    """
    layout = read_layout(configure(spark), path) or refresh_layout(spark, path)
    held = _held_months(spark, path, months, layout)
    if held is not None:
        layout = _extend_layout(spark, path, held.schema, cluster or (), layout)
        order = layout.cluster if cluster is None else cluster
        _write_months(written(held, "compact"), path, "months", order, row_group_bytes=row_group_bytes)


def _held_months(spark: SparkSession, path: str, months: Sequence[tuple[int | None, int | None]], layout: Layout | None) -> DataFrame | None:
    held = _read_if_any(spark, [month_folders(path, months)], path, layout) if months else None
    # Folder names alone don't say the type where all are of rows without a time.
    return None if held is None else held.withColumns({c: F.col(c).cast("int") for c in ("year", "month")})


# -- looking -------------------------------------------------------------------


def peek(spark: SparkSession, path: str, rows: int = 10) -> DataFrame:
    """A few rows of the archive's first file in path order, for a look at its
    contents and schema."""
    archive = read_archive(spark, path)
    first = archive.agg(F.min("_metadata.file_path")).first()[0]
    return read_archive(spark, first).limit(rows) if first else archive


def month_summary(df: DataFrame, time: str = "valid_time") -> DataFrame:
    """Row count and time range per month."""
    dated = df if {"year", "month"} <= set(df.columns) else with_month(df, time)
    return dated.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_time"), F.max(time).alias("last_time")
    )
