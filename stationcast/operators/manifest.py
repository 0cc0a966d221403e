"""Which files should exist, which do, and which fetch window a run belongs to."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions import names
from ..functions.times import micros, run_times

# How published files are named.
DOMAINS = {"ak": "alaska", "co": "conus", "hi": "hawaii"}
BLEND_SUITES = {"nbm": "core", "nbm_exp": "core", "nbmqmd": "qmd", "nbmqmd_exp": "qmd"}


def file_url(base_url: str, model: str, run: Column, lead: Column, domain: str = "ak") -> Column:
    """URL of the gridded file of a run and lead hour."""
    day, hour = F.date_format(run, "yyyyMMdd"), F.date_format(run, "HH")

    def path(*parts: Column | str) -> Column:
        return F.concat(F.lit(base_url.rstrip("/") + "/"), *[F.lit(p) if isinstance(p, str) else p for p in parts])

    if model in BLEND_SUITES:
        suite, fff = BLEND_SUITES[model], names.zero_padded(lead, 3)
        return path("blend.", day, "/", hour, f"/{suite}/blend.t", hour, f"z.{suite}.f", fff, f".{domain}.grib2")
    if model == "hrrr":
        ff = names.zero_padded(lead, 2)
        return path("hrrr.", day, f"/{DOMAINS[domain]}/hrrr.t", hour, "z.wrfsfcf", ff, f".{domain}.grib2")
    if model == "urma":
        return path(f"{domain}urma.", day, f"/{domain}urma.t", hour, "z.2dvaranl_ndfd_3p0.grb2")
    raise NotImplementedError(f"no file naming known for model {model!r}")


def expected_files(
    windows: DataFrame, model: str, element: str, base_url: str, domain: str = "ak"
) -> DataFrame:
    """Files of every run and lead in each window (columns ``start``, ``end``)."""
    leads = F.array(*[F.lit(h) for h in rules.leads(model, element)])
    return (
        windows.withColumn("init_time", F.explode(run_times(F.col("start"), F.col("end"), rules.CYCLE_HOURS[model])))
        .withColumn("forecast_hour", F.explode(leads))
        .withColumn("url", file_url(base_url, model, F.col("init_time"), F.col("forecast_hour"), domain))
    )


def probe_path(url: Column, index_suffix: str | None = None) -> Column:
    """What must be listed for a file to count as there: its index, or the file itself
    for analyses (``.grb2``), which have none.  ``index_suffix`` sets one suffix for all."""
    if index_suffix is not None:
        return F.concat(url, F.lit(index_suffix))
    return F.when(url.endswith(".grb2"), url).otherwise(F.concat(url, F.lit(".idx")))


def _same_path(listing: DataFrame, index_suffix: str | None) -> tuple[DataFrame, Column]:
    """Listed paths, each once, and when an expected file is among them."""
    return listing.select(F.col("path").alias("_listed")).distinct(), probe_path(F.col("url"), index_suffix) == F.col("_listed")


def available_files(expected: DataFrame, listing: DataFrame, index_suffix: str | None = None) -> DataFrame:
    return expected.join(*_same_path(listing, index_suffix), "left_semi")


def missing_files(expected: DataFrame, listing: DataFrame, index_suffix: str | None = None) -> DataFrame:
    return expected.join(*_same_path(listing, index_suffix), "left_anti")


def availability(expected: DataFrame, listing: DataFrame, by: Sequence[str] = (), index_suffix: str | None = None) -> DataFrame:
    """Numbers of files found and missing."""
    found = F.col("_listed").isNotNull()
    return (
        expected.join(*_same_path(listing, index_suffix), "left")
        .groupBy(*by)
        .agg(
            F.count(F.when(found, 1)).alias("found"),
            F.count(F.when(~found, 1)).alias("missing"),
        )
    )


def _searched_days(start: datetime, end: datetime) -> tuple[datetime, datetime]:
    """First and last day whose folders are searched for runs that cover a window."""
    first = start - timedelta(days=3)
    return first, first + timedelta(days=(end - first).days)


def ndfd_glob(root: str, element: str, start: datetime, end: datetime) -> str:
    """Path matching an element's files in the folders of the searched days, and no other folder."""
    first, last = _searched_days(start, end)
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    wanted = [
        f"{component}/{day:%Y/%m/%d}/{prefix}_*"
        for component, many in rules.NDFD_PREFIXES[element].items()
        for prefix in many
        for day in days
    ]
    return f"{root.rstrip('/')}/{{{','.join(wanted)}}}"


def ndfd_files(listing: DataFrame, element: str, start: datetime, end: datetime) -> DataFrame:
    """Listed database files of an element: path, component, stamp.

    Folders are dated; those from three days before ``start`` to ``end`` are searched
    for the element's file prefixes.  Only runs stamped 11Z or 23Z count, and names
    without a proper stamp are passed over.
    """
    first, last = _searched_days(start, end)
    prefixes = [
        (component, prefix) for component, many in rules.NDFD_PREFIXES[element].items() for prefix in many
    ]
    folder = r"/([a-z]+)/(\d{4})/(\d{2})/(\d{2})/([A-Z0-9]+)_[^/]*$"
    parts = [names.first_group(F.col("path"), folder, i) for i in range(1, 6)]
    day = F.try_to_timestamp(F.concat_ws("-", *parts[1:4]), F.lit("yyyy-MM-dd")).cast("date")
    known = F.lit(False)
    for component, prefix in prefixes:
        known = known | ((F.col("component") == component) & (F.col("_prefix") == prefix))
    stamp = F.col("stamp")
    return (
        listing.select(
            "path",
            parts[0].alias("component"),
            parts[4].alias("_prefix"),
            day.alias("_day"),
            names.stamp_in_name(F.col("path")).alias("stamp"),
        )
        .where(known & F.col("_day").between(first.date(), last.date()))
        .where(F.hour(stamp).isin(rules.NDFD_RUN_HOURS))
        .select("path", "component", "stamp")
    )


#: A chunk is cut into about this many tiles; the widths of tiles are powers of the second.
TILES = 8
TILE_STEP = 4


def chunk_table(spark: SparkSession, chunks: Sequence[tuple[datetime, datetime]]) -> DataFrame:
    """Fetch windows as rows, with the archive month each one is filed under."""
    rows = [(s, e, s.year, s.month) for s, e in chunks]
    return spark.createDataFrame(
        rows, "chunk_start timestamp, chunk_end timestamp, archive_year int, archive_month int"
    )


def assign_chunks(df: DataFrame, chunks: DataFrame, time: str) -> DataFrame:
    """Each row with every chunk that holds its time; rows in no chunk are dropped.

    A chunk's last minute belongs to it whole, so that chunks that follow each other leave
    no gap.  Chunks may be of any length, overlap, and be of any number: each lies on about ten
    tiles of a width of its own length's order, and rows meet the chunks on their tile of each
    width in use, so most that they meet hold them.  An equi-join, then the exact bounds.
    Chunks that end before they start, or lack a bound, hold nothing.
    """
    start, end = micros(F.col("chunk_start")), micros(F.col("chunk_end") + F.expr("INTERVAL 1 MINUTE"))
    level = F.ceil(F.log(float(TILE_STEP), (end - start) / TILES)).cast("int")
    held = chunks.where(F.col("chunk_start") <= F.col("chunk_end")).withColumn("_level", F.greatest(level, F.lit(0)))
    widths = sorted(r[0] for r in held.select("_level").distinct().collect())  # at most 32, as micros have 64 bits

    def tile(at: Column, width: Column) -> Column:
        return F.floor(at / F.pow(F.lit(float(TILE_STEP)), width)).cast("long")

    tiles = F.sequence(tile(start, F.col("_level")), tile(end, F.col("_level")))
    on_tiles = held.withColumn("_tile", F.explode(tiles))
    places = F.array(*[F.lit(w) for w in widths]) if widths else F.array().cast("array<int>")
    return (
        df.withColumn("_level", F.explode(places))
        .withColumn("_tile", tile(micros(F.col(time)), F.col("_level")))
        .join(on_tiles, ["_level", "_tile"])
        .where((F.col(time) >= F.col("chunk_start")) & (F.col(time) < F.col("chunk_end") + F.expr("INTERVAL 1 MINUTE")))
        .drop("_level", "_tile")
    )
