"""Station metadata: JSON and CSV in, CSV out, selection, attribute lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATION_SCHEMA = "stid string, name string, latitude double, longitude double, elevation double"

# Every value arrives as text or number; reading it as text accepts both.
METADATA_JSON = (
    "STATION array<struct<STID string, NAME string, LATITUDE string, LONGITUDE string, ELEVATION string, "
    "NWSZONE string, CWA string, STATE string, STATUS string, MNET_ID string>>"
)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """JSON responses, one whole file per row, in the column ``payload``."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def _stations(payloads: DataFrame) -> DataFrame:
    return payloads.select(F.inline(F.from_json("payload", METADATA_JSON)["STATION"]))


def parse_stations(payloads: DataFrame, *extra: str) -> DataFrame:
    """Station table (stid, name, latitude, longitude, elevation) from metadata JSON."""
    return _stations(payloads).select(
        F.col("STID").alias("stid"),
        F.col("NAME").alias("name"),
        *[F.col(c).try_cast("double").alias(c.lower()) for c in ("LATITUDE", "LONGITUDE", "ELEVATION")],
        *[F.col(c).alias(c.lower()) for c in extra],
    )


def parse_attributes(payloads: DataFrame) -> DataFrame:
    """Forecast zone and office per station (stid, zone, cwa); a repeated station
    keeps its greatest values, so that lookups never multiply rows."""
    return (
        _stations(payloads)
        .where("STID is not null")
        .groupBy(F.col("STID").alias("stid"))
        .agg(F.max("NWSZONE").alias("zone"), F.max("CWA").alias("cwa"))
    )


def with_attributes(rows: DataFrame, attributes: DataFrame) -> DataFrame:
    """Add NWSZONE and NWSCWA by station; unknown stations get nulls.

    Pass ``attributes`` as a table on disk: its known size lets Spark broadcast it
    when it is small, and the observations then stay where they are.
    """
    looked_up = attributes.select("stid", F.col("zone").alias("NWSZONE"), F.col("cwa").alias("NWSCWA"))
    return rows.join(looked_up, "stid", "left").select(*rows.columns, "NWSZONE", "NWSCWA")


def select_stations(
    stations: DataFrame,
    *,
    state: str | None = None,
    networks: Sequence[str] | None = None,
    status: str | None = None,
    variables: Sequence[str] | None = None,
) -> DataFrame:
    """Stations of a state, networks or status, or that report any of some variables
    (columns state, mnet_id, status and the array ``reports``)."""
    if state is not None:
        stations = stations.where(F.lower("state") == state.lower())
    if networks is not None:
        stations = stations.where(F.col("mnet_id").isin(list(networks)))
    if status is not None:
        stations = stations.where(F.lower("status") == status.lower())
    if variables is not None:
        stations = stations.where(F.arrays_overlap("reports", F.array(*[F.lit(v) for v in variables])))
    return stations


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATION_SCHEMA).csv(path, header=True)


def write_stations(stations: DataFrame, path: str, mode: str = "errorifexists") -> None:
    stations.write.mode(mode).csv(path, header=True)


def ensure_stations(spark: SparkSession, path: str, payloads: DataFrame) -> DataFrame:
    """The station table at ``path``, written from metadata JSON first if there is none."""
    try:
        return read_stations(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    write_stations(parse_stations(payloads), path)
    return read_stations(spark, path)
