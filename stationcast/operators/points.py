"""Field values at stations: extraction, pairing, percentile columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import init_time
from ..rules import PERCENTILES, ColumnRule


def select_fields(
    values: DataFrame, *, level_type: str, step_type: str, level: int
) -> DataFrame:
    """Field values of one kind of level, step and height."""
    return values.where(
        (F.col("level_type") == level_type) & (F.col("step_type") == step_type) & (F.col("level") == level)
    )


def extract_points(values: DataFrame, station_cells: DataFrame) -> DataFrame:
    """Value of each field at each station's grid cell.

    ``values`` (grid_id, flat, …) is the large side and should not move: pass
    ``station_cells`` as a written table (see ``session.written``), whose known size
    lets Spark broadcast it when it is small and shuffle both sides when it is not.
    """
    cells = station_cells.select("grid_id", "flat", "station_id")
    return values.join(cells, ["grid_id", "flat"])


def pair_steps(
    speed: DataFrame, direction: DataFrame, keys: Sequence[str], column: str, pair: str
) -> DataFrame:
    """Put the direction series beside the speed series, step by step.

    ``pair`` names the direction file of a speed row.  Where it is null the row stays
    with a null direction; where it is set, only steps that both files have remain.
    """
    beside = direction.select(*keys, F.col(column), F.lit(True).alias("_paired"))
    return (
        speed.join(beside, list(keys), "left")
        .where(F.col(pair).isNull() | F.col("_paired"))
        .drop("_paired")
        .select(*speed.columns, column)
    )


def variable_columns(
    points: DataFrame, rules: Sequence[ColumnRule], keys: Sequence[str], order: str = "msg_no"
) -> DataFrame:
    """One row per key with a converted column per variable.

    If a file repeats a variable its first message counts.  A column is null where
    the file lacks the variable.
    """
    picks = [
        F.min_by(
            F.when(F.col("var") == r.variable, F.col("value")),
            F.when(F.col("var") == r.variable, F.col(order)),
        ).alias(r.column)
        for r in rules
    ]
    raw = points.where(F.col("var").isin([r.variable for r in rules])).groupBy(*keys).agg(*picks)
    return raw.select(*keys, *[r.apply(F.col(r.column)).alias(r.column) for r in rules])


def percentile_columns(
    points: DataFrame,
    rule: ColumnRule,
    keys: Sequence[str],
    order: str = "msg_no",
    percentiles: Sequence[int] = PERCENTILES,
    also: Sequence[Column] = (),
) -> DataFrame:
    """One row per key with a converted column per percentile, and any ``also`` aggregates.

    Of repeated percentiles the last message counts.  One aggregation over plain
    numbers: it combines map-side and needs neither a second shuffle nor a job to
    find the percentiles.
    """

    def last(p: int) -> Column:
        mine = F.col("percentile") == p
        return F.max_by(F.when(mine, F.col("value")), F.when(mine, F.col(order)))

    columns = [rule.apply(last(p)).alias(f"{rule.column}_p{p}") for p in percentiles]
    return points.groupBy(*keys).agg(*also, *columns)


def first_of_file(column: str, order: str = "msg_no") -> Column:
    """Aggregate: the column's value in the first message that has one."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order)))


def with_init_time(points: DataFrame) -> DataFrame:
    return points.withColumn("init_time", init_time(F.col("valid_time"), F.col("forecast_hour")))
