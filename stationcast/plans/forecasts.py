"""Decoded grid values to archived forecast rows.

Grid values are the large input: columns file, grid_id, msg_no, step_idx,
forecast_hour, valid_time, var, percentile, flat, value.  They are cut down to the
stations' cells first; everything after that is a few rows per station and file.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import units
from ..operators.accumulate import first_present, interval_from_total
from ..operators.asof import asof_nearest
from ..operators.points import (
    extract_points,
    first_of_file,
    pair_steps,
    percentile_columns,
    select_fields,
    variable_columns,
    with_init_time,
)
from ..session import written

RUN_KEYS = ["station_id", "init_time", "valid_time", "forecast_hour"]


def model_forecast(values: DataFrame, station_cells: DataFrame, model: str, element: str) -> DataFrame:
    """Archive rows of one model and element: station_id, init_time, valid_time,
    forecast_hour and the element's columns."""
    rules.validate(model, element)
    if rules.is_percentile(model, element):
        return _percentile_forecast(values, station_cells, element)
    if model == "urma":
        values = select_fields(values, level_type="heightAboveGround", step_type="instant", level=10)
    columns = rules.COLUMNS[model, element]
    wanted = values.where(F.col("var").isin([r.variable for r in columns]))
    points = with_init_time(extract_points(wanted, station_cells))
    rows = variable_columns(points, columns, ["file", *RUN_KEYS]).drop("file")
    if model == "hrrr" and element == "Wind":
        rows = wind_from_components(rows)
    return with_run_intervals(rows, model, element)


def with_run_intervals(rows: DataFrame, model: str, element: str) -> DataFrame:
    """Add the amounts over an interval to rows with a run total, under whichever of its names
    the rows have; rows of other elements, or without a total, stay as they are."""
    total = first_present(rows, rules.TOTAL_NAMES.get((model, element), []))
    if total is None:
        return rows
    # The difference reads its input twice; the fields must not be.
    interval, span = rules.INTERVALS[model, element]
    return interval_from_total(written(rows, "totals"), total=total, out=interval, interval_hours=span)


def wind_from_components(rows: DataFrame) -> DataFrame:
    """Replace u_wind and v_wind by speed and direction; both null unless both are known."""
    u, v = F.col("u_wind"), F.col("v_wind")
    return rows.withColumns(
        {
            "wind_dir_deg": units.round_half_even(units.wind_direction(u, v), 0),
            "wind_speed_kt": units.round_half_even(units.wind_speed(u, v), 2),
        }
    ).drop("u_wind", "v_wind")


def _percentile_forecast(values: DataFrame, station_cells: DataFrame, element: str) -> DataFrame:
    """One row per station and file, dated by the file's first message.  Every message
    covers every cell, so the first one is among the station's own rows."""
    rule = rules.PERCENTILE_COLUMNS[element]
    rows = percentile_columns(
        extract_points(values, station_cells),
        rule,
        ["station_id", "file"],
        also=[first_of_file("valid_time").alias("valid_time"), first_of_file("forecast_hour").alias("forecast_hour")],
    )
    return with_init_time(rows).select(*RUN_KEYS, *[f"{rule.column}_p{p}" for p in rules.PERCENTILES])


def pair_files(speed: DataFrame, direction: DataFrame, tolerance: timedelta = timedelta(minutes=2)) -> DataFrame:
    """Each speed file with the direction file closest in time (columns path, stamp);
    the later one when two are equally close, null when none is near."""
    return asof_nearest(
        speed.select(F.col("path").alias("file"), "stamp"),
        direction.select(F.col("path").alias("direction_file"), F.col("stamp").alias("direction_stamp")),
        by=[],
        left_time="stamp",
        right_time="direction_stamp",
        tolerance=tolerance,
        seq="direction_file",
        tie="later",
        after_duplicates="last",
        slice_width=timedelta(hours=6),
    ).select("file", "direction_file")


def ndfd_forecast(
    values: DataFrame, station_cells: DataFrame, element: str, pairs: DataFrame | None = None
) -> DataFrame:
    """Archive rows of the gridded forecast database: station_id, valid_time,
    forecast_hour and the element's columns.

    Wind takes its direction from the paired file (``pairs`` from ``pair_files``),
    step by step; speed rows without a paired file keep a null direction.  Both series
    come from one pass over the fields: the stations' values are written to shared
    scratch while the plan is built.
    """
    rules.validate("ndfd", element)
    primary, *secondary = rules.COLUMNS["ndfd", element]
    wanted = values.where(F.col("var").isin([r.variable for r in (primary, *secondary)]))
    points = extract_points(wanted, station_cells)
    if secondary:
        points = written(points, "points")
    keys = ["station_id", "step_idx"]

    def series(rule: rules.ColumnRule) -> DataFrame:
        mine = points.where(F.col("var") == rule.variable)
        return mine.select("file", *keys, "valid_time", "forecast_hour", rule.apply(F.col("value")).alias(rule.column))

    rows = series(primary)
    for rule in secondary:
        if pairs is None:
            raise ValueError(f"{element} needs the file pairs")
        beside = series(rule).withColumnRenamed("file", "direction_file").select("direction_file", *keys, rule.column)
        rows = pair_steps(
            rows.join(pairs, "file", "left"), beside, ["direction_file", *keys], rule.column, "direction_file"
        )
    columns = [r.column for r in (primary, *secondary)]
    return rows.select("station_id", "valid_time", "forecast_hour", *columns)
