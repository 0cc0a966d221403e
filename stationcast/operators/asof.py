"""Nearest-in-time joins with a tolerance."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import as_micros, micros, slice_start


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    tolerance: timedelta | None,
    seq: str | None = None,
    tie: str = "earlier",
    after_duplicates: str = "first",
    slice_width: timedelta = timedelta(days=1),
) -> DataFrame:
    """Every left row with the nearest right row of the same ``by`` key, or nulls.

    The tolerance is inclusive; None matches at any distance.  At equal distance ``tie``
    says whether the "earlier" or the "later" right row wins.  Of right rows at the same
    time, the last by ``seq`` serves left rows at or after it; left rows before it get the
    ``after_duplicates`` one.  Rows without a ``seq`` come before all others.  Among
    equal ones, or without ``seq``, one is picked by its content, always the same.
    All left rows are kept, repeated ones too; a right row may serve many.

    How it scales: which row matches which depends on the key and the time only, so
    that is settled on the distinct (key, time) pairs of the left side, a scan of these
    columns alone, and one right row per (key, time), aggregated map-side; see
    ``nearest_offers``.  No pairs of rows are formed and no row is copied.  The matches,
    unique per (key, time), are then joined to the left rows on (key, time), so a skewed
    left side can be split freely.  The right side is read once.
    """
    if tie not in ("earlier", "later") or after_duplicates not in ("first", "last"):
        raise ValueError("tie is 'earlier' or 'later', after_duplicates is 'first' or 'last'")
    by = list(by)
    carried = [c for c in right.columns if c not in by]
    clash = sorted(set(carried) & set(left.columns))
    if clash:
        raise ValueError(f"columns on both sides: {clash}")

    # One right row per (key, time); first and last differ only where times repeat.
    # Picking column by column lets numbers be aggregated by hash.
    values = [c for c in carried if c != right_time]
    order = _total_order(right, seq, carried)
    picks = [F.max_by(c, "_order").alias(f"_last_{c}") for c in values]
    if after_duplicates == "first":
        picks += [F.min_by(c, "_order").alias(f"_first_{c}") for c in values]
    offers = (
        _present(right, [*by, right_time])
        .select(*by, *carried, micros(F.col(right_time)).alias("_t"), order.alias("_order"))
        .groupBy(*by, "_t")
        .agg(F.max(right_time).alias(right_time), *picks)
    )
    wanted = _present(left, [*by, left_time]).select(*by, micros(F.col(left_time)).alias("_t")).distinct()
    matches = nearest_offers(wanted, offers, by, tolerance=tolerance, tie=tie, slice_width=slice_width)

    def value(c: str) -> Column:
        if c == right_time:
            return F.col(f"_offer.{c}").alias(c)
        last = F.col(f"_offer._last_{c}")
        if after_duplicates == "last":
            return last.alias(c)
        return F.when(F.col("_later"), F.col(f"_offer._first_{c}")).otherwise(last).alias(c)

    found = matches.select(*by, "_t", *[value(c) for c in carried])
    return (
        left.withColumn("_t", micros(F.col(left_time)))
        .join(found, [*by, "_t"], "left")
        .select(*left.columns, *carried)
    )


def nearest_offers(
    wanted: DataFrame,
    offers: DataFrame,
    by: list[str],
    *,
    tolerance: timedelta | None,
    tie: str = "earlier",
    slice_width: timedelta = timedelta(days=1),
) -> DataFrame:
    """For each wanted time of a key the nearest offer within the tolerance, as a struct.

    Wanted are distinct (key, ``_t`` in micros), offers one row per (key, ``_t``).  The
    result has ``_offer`` and whether it is ``_later``; times without a match are left out.

    A carry scan: timelines are cut into slices and sorted per (key, slice), never per key.
    Each slice that holds anything gives its first and last offer.  These carries, one row
    per (key, slice), are scanned over the slices of a key, and every slice gets the last
    offer before it and the first after it, however far away.  So no offer is copied to
    other slices, and any tolerance costs the same.  A slice holds at most its width divided
    by the clock's resolution, twice 86,400 rows for a day of seconds; choose narrower
    slices for finer clocks.  Both scans read the same shuffled timeline.
    """
    time = F.col("_t")
    slice_ = slice_start(time, as_micros(slice_width)).alias("_slice")
    offered = offers.select(*by, "_t", slice_, F.struct(*[c for c in offers.columns if c not in by]).alias("_offer"))
    nothing = F.lit(None).cast(offered.schema["_offer"].dataType)
    timeline = wanted.select(*by, "_t", slice_, nothing.alias("_offer")).unionByName(offered).repartition(*by, "_slice")

    # At equal times the offer comes first.
    order = [time.asc(), F.col("_offer").isNull().asc()]
    so_far = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scan = timeline.withColumns(
        {
            "_before": F.last("_offer", ignorenulls=True).over(so_far),
            "_after": _next_present("_offer", [*by, "_slice"], "_t, _offer IS NULL"),
        }
    ).where("_offer is null")

    offer_time = F.when(F.col("_offer").isNotNull(), time)
    carries = timeline.groupBy(*by, "_slice").agg(
        F.min_by("_offer", offer_time).alias("_first"), F.max_by("_offer", offer_time).alias("_last")
    )
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carries = carries.select(
        *by,
        "_slice",
        F.last("_last", ignorenulls=True).over(earlier).alias("_carried"),
        _next_present("_first", by, "_slice").alias("_coming"),
    )
    # Every slice has carries.  As a left join, it adds no filters to one side, so that both
    # branches keep the same shuffle.
    found = scan.join(carries, [*by, "_slice"], "left").select(
        *by, "_t", F.coalesce("_before", "_carried").alias("_before"), F.coalesce("_after", "_coming").alias("_after")
    )

    none = F.lit(2**63 - 1)
    gap_before = F.coalesce(F.col("_t") - F.col("_before._t"), none)
    gap_after = F.coalesce(F.col("_after._t") - F.col("_t"), none)
    later = gap_after < gap_before if tie == "earlier" else gap_after <= gap_before
    near = F.least(gap_before, gap_after)
    return found.where(near < none if tolerance is None else near <= as_micros(tolerance)).select(
        *by, "_t", F.when(later, F.col("_after")).otherwise(F.col("_before")).alias("_offer"), later.alias("_later")
    )


def _total_order(df: DataFrame, seq: str | None, columns: Sequence[str]) -> Column:
    """Never null: by ``seq``, rows without one first, then by a hash of the content.

    Whole numbers become one decimal, 60 bits of the hash below the number, which keeps
    aggregates by hash; other types are ordered as a struct.
    """
    content = F.xxhash64(*columns)
    if seq is None:
        return content
    kind = df.schema[seq].dataType
    if not isinstance(kind, T.IntegralType):
        return F.struct(F.col(seq).isNotNull(), F.col(seq), content)
    wide, lowest = "decimal(38,0)", F.lit(str(-(2**63) - 1)).cast("decimal(20,0)")
    number = F.coalesce(F.col(seq).cast("decimal(20,0)"), lowest) * F.lit(2**60).cast("decimal(19,0)")
    return (number.cast(wide) + F.shiftrightunsigned(content, 4).cast(wide)).cast(wide)


def _present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def _next_present(column: str, by: Sequence[str], order: str) -> Column:
    """Next non-null value of a column below.  Unlike ``first`` over the following rows,
    which Spark evaluates anew for each row, this is a single pass."""
    partition = f"PARTITION BY {', '.join(f'`{c}`' for c in by)}" if by else ""
    return F.expr(f"lead(`{column}`) IGNORE NULLS OVER ({partition} ORDER BY {order})")
