"""Read two archives, align observations to forecasts, score them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import months_between, parse_utc
from ..functions.units import ms_to_knots
from ..operators.asof import asof_nearest
from ..operators.metrics import common_metrics
from ..sources.archive import apply_filters, project, read_months

DEFAULT_TOLERANCE = timedelta(minutes=30)


@dataclass(frozen=True)
class DatasetSpec:
    """Physical column names of an archive: time, station and metric -> column."""

    time: str
    station: str
    values: Mapping[str, str] = field(default_factory=dict)

    def needed(self) -> list[str]:
        """Columns to read, each once, in order."""
        return list(dict.fromkeys([self.time, self.station, *self.values.values()]))


@dataclass(frozen=True)
class MonthlyArchive:
    """Where the monthly files of a dataset lie and what their columns are called."""

    root: str
    token: str
    spec: DatasetSpec
    pattern: str = "{YYYY}_{MM}_{model}_{element}_archive.parquet"
    case: str = "lower"

    def read(self, spark: SparkSession, element: str, first: date, last: date) -> DataFrame:
        """The months from ``first`` to ``last`` that have a file."""
        _check_days(first, last)
        return read_months(
            spark,
            self.root,
            months_between(first, last),
            self.token,
            element,
            pattern=self.pattern,
            case=self.case,
            columns=self.spec.needed(),
            times=[self.spec.time],
        )


@dataclass(frozen=True)
class Units:
    """Units of an element on both sides, and whether to convert observations."""

    observed: str = ""
    forecast: str = ""
    convert: bool = False

    def metres_to_knots(self) -> bool:
        return self.convert and self.observed.lower() in ("mps", "m/s") and self.forecast.lower() == "kt"


def standardise(df: DataFrame, spec: DatasetSpec, role: str, time: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rename physical columns: station_id, ``time``, ``<role>_<metric>``.  Columns
    that are absent are passed over; rows without time or station are dropped."""
    names = {spec.time: time, spec.station: "station_id"}
    names |= {column: f"{role}_{metric}" for metric, column in spec.values.items()}
    renamed = project(df, [*spec.needed(), *keep]).withColumnsRenamed(names)
    if renamed.schema[time].dataType.typeName() == "string":
        renamed = renamed.withColumn(time, parse_utc(F.col(time)))
    return renamed.dropna(subset=[time, "station_id"])


def _check_days(first: date, last: date) -> None:
    if first > last:
        raise ValueError("the first day is after the last")


def within_days(df: DataFrame, time: str, first: date, last: date) -> DataFrame:
    """Times from 00Z of ``first`` up to, not including, 00Z after ``last``."""
    _check_days(first, last)
    start = datetime(first.year, first.month, first.day)
    end = datetime(last.year, last.month, last.day) + timedelta(days=1)
    kind = df.schema[time].dataType
    return df.where((F.col(time) >= F.lit(start).cast(kind)) & (F.col(time) < F.lit(end).cast(kind)))


def convert_observed(df: DataFrame, units: Units | None) -> DataFrame:
    """Speeds and gusts from m/s to knots where the units call for it."""
    if units is None or not units.metres_to_knots():
        return df
    speeds = [c for c in df.columns if c.startswith("observed_") and c.endswith(("_speed", "_gust"))]
    return df.withColumns({c: ms_to_knots(F.col(c)) for c in speeds})


def align(
    forecasts: DataFrame,
    observations: DataFrame,
    forecast_spec: DatasetSpec,
    observed_spec: DatasetSpec,
    *,
    first: date,
    last: date,
    stations: Sequence[str] | None = None,
    tolerance: timedelta | None = DEFAULT_TOLERANCE,
    units: Units | None = None,
    seq: str | None = None,
) -> DataFrame:
    """Wide aligned rows: valid_time, station_id, forecast_<m>…, observed_<m>….

    All stations at once, or the named ones.  Station and time filters stand directly
    on the scans, so partitions, row groups and columns that are not needed are not
    read.  ``seq`` may name an ingest-order column of the observations.
    """

    def side(df: DataFrame, spec: DatasetSpec, role: str, time: str, keep: Sequence[str] = ()) -> DataFrame:
        wanted = apply_filters(df, [(spec.station, "in", stations)] if stations is not None else None)
        return within_days(standardise(wanted, spec, role, time, keep), time, first, last)

    left = side(forecasts, forecast_spec, "forecast", "valid_time")
    right = side(observations, observed_spec, "observed", "observed_time", [seq] if seq else [])
    matched = asof_nearest(
        left,
        right,
        by=["station_id"],
        left_time="valid_time",
        right_time="observed_time",
        tolerance=tolerance,
        seq=seq,
    )
    wide = convert_observed(matched, units)
    values = [c for c in wide.columns if c.startswith(("forecast_", "observed_")) and c != "observed_time"]
    return wide.select("valid_time", "station_id", *values)


def verify(
    spark: SparkSession,
    forecasts: MonthlyArchive,
    observations: MonthlyArchive,
    element: str,
    *,
    first: date,
    last: date,
    **options,
) -> DataFrame:
    """Aligned rows of an element between two days, read from two monthly archives."""
    return align(
        forecasts.read(spark, element, first, last),
        observations.read(spark, element, first, last),
        forecasts.spec,
        observations.spec,
        first=first,
        last=last,
        **options,
    )


def choose_metric(wide: DataFrame, preferred: str | None = None) -> str:
    """The preferred metric if both sides have it, else the first that both have."""
    metrics = common_metrics(wide.columns)
    if not metrics:
        raise ValueError("forecasts and observations have no metric in common")
    return preferred if preferred in metrics else metrics[0]
