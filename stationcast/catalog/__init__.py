"""Queries over the given tables, each with the SQL that states its result.

A query is a function of (spark, folder of Parquet tables).  Events stand in for
forecasts and observations, users for stations, parts for grid cells, line items for
field values, documents for file inventories.  Every query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that gives the same rows."""

    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return naive(build(configure(spark), folder))

        QUERIES[name] = run
        ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as SQL timestamps are."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def load() -> None:
    """Import the modules that register queries."""
    from . import alignment, archives, grids, inventories, manifests, scalars, stations  # noqa: F401
