"""Appending without repeating rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_distinct(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Both frames' rows, whole-row duplicates removed; missing equals missing.

    Columns are matched by name and may be absent from either side.  Copies are
    combined before the shuffle, so a heavily repeated row costs one row per task.
    """
    return existing.unionByName(new, allowMissingColumns=True).distinct()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``, then by content.

    An aggregation rather than a ranking: each task sends on one row per key.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*[F.col(c) for c in [*order, *rest] if c not in keys])
    return df.groupBy(*keys).agg(F.min(row).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def append_by_key(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the existing one if there is one, else the first new one."""
    both = existing.withColumn("_source", F.lit(0)).unionByName(
        new.withColumn("_source", F.lit(1)), allowMissingColumns=True
    )
    return first_per_key(both, keys, ["_source", *order]).drop("_source")


def rows_not_in(new: DataFrame, existing: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct new rows that the existing rows do not hold (by ``keys`` or whole).

    Missing equals missing.  Whole rows are compared on the columns of both frames, of
    which one may lack some; the result has the columns of both.  Pass ``new`` already
    reduced to one row per key.
    """
    if keys is None:
        nothing = existing.where(F.lit(False)).unionByName(new.where(F.lit(False)), allowMissingColumns=True)
        alike = [nothing.unionByName(df, allowMissingColumns=True) for df in (new, existing)]
        return alike[0].distinct().subtract(alike[1])
    held = existing.select(*[F.col(k).alias(f"_held_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys]
    return new.join(held, same, "left_anti")
