"""Verification scores over forecast/observation pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.units import to_number


def _scores(error: Column) -> list[Column]:
    return [
        F.count(error).alias("count"),
        F.avg(error).alias("bias"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    ]


def verification_scores(
    pairs: DataFrame, forecast: str, observed: str, by: Sequence[str] = ()
) -> DataFrame:
    """Count, bias, mean absolute error and root mean square error.

    Only pairs with both values count.  A group without any has count 0 and null
    scores.  One partial aggregation, so no group is ever collected.
    """
    error = to_number(F.col(forecast)) - to_number(F.col(observed))
    return pairs.groupBy(*by).agg(*_scores(error))


def common_metrics(columns: Sequence[str]) -> list[str]:
    """Metrics with both a ``forecast_`` and an ``observed_`` column, sorted."""
    forecast = {c.removeprefix("forecast_") for c in columns if c.startswith("forecast_")}
    observed = {c.removeprefix("observed_") for c in columns if c.startswith("observed_")}
    return sorted(forecast & observed)


def metric_pairs(wide: DataFrame) -> DataFrame:
    """One row per aligned row and metric found on both sides: metric, forecast, observed."""
    metrics = common_metrics(wide.columns)
    if not metrics:
        raise ValueError(f"no metric has both a forecast_ and an observed_ column: {wide.columns}")
    values = [c for c in wide.columns if c.startswith(("forecast_", "observed_"))]
    keys = [c for c in wide.columns if c not in values]
    pairs = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                to_number(F.col(f"forecast_{m}")).alias("forecast"),
                to_number(F.col(f"observed_{m}")).alias("observed"),
            )
            for m in metrics
        ]
    )
    return wide.select(*keys, F.inline(pairs))


def score_all_metrics(wide: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Scores of every common metric in one pass."""
    return verification_scores(metric_pairs(wide), "forecast", "observed", ["metric", *by])


def series(wide: DataFrame, metric: str) -> DataFrame:
    """Long form (t, series, value) of one metric, for plotting."""
    return wide.select(
        F.col("valid_time").alias("t"),
        to_number(F.col(f"forecast_{metric}")).alias("forecast"),
        to_number(F.col(f"observed_{metric}")).alias("observed"),
    ).unpivot("t", ["forecast", "observed"], "series", "value")
