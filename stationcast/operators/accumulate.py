"""Rolling totals, and interval amounts from running totals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import as_micros, hours, micros, slice_start
from ..functions.units import clip_negative, round_scaled, to_number


# Copies of one report are written out in runs of at most this many.
COPIES_PER_RUN = 100_000


def known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which the columns are not null.  Said in the way joins infer it, so that
    both readers of a shuffle get the same filter and the shuffle is done once."""
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def with_position(
    df: DataFrame,
    *,
    by: Sequence[str],
    time: str,
    tiebreak: Sequence[str] = (),
    places: Column | None = None,
    name: str = "_pos",
    slice_width: timedelta = timedelta(days=1),
) -> DataFrame:
    """Number each key's rows 0, 1, 2, … in time order, without sorting a whole key.

    A row takes one place, or as many as ``places`` says, and gets its first place's
    number.  Rows are numbered per (key, time slice); the totals of the earlier
    slices, one small row each, give the slice its offset.  Rows at the same time are
    ordered by ``tiebreak``, then by their content, so that a task that runs again
    numbers them as before.  Rows without key or time are dropped.
    """
    by = list(by)
    in_slice = [*by, "_slice"]
    sliced = (
        known(df, [*by, time])
        .withColumn("_slice", slice_start(micros(F.col(time)), as_micros(slice_width)))
        .withColumn("_places", (F.lit(1) if places is None else places).cast("long"))
        .where("_slice is not null")
    )

    def before(window: Window, column: str) -> Column:
        rows = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(rows), F.lit(0))

    totals = sliced.groupBy(*in_slice).agg(F.sum("_places").alias("_total"))
    offsets = totals.select(*in_slice, before(Window.partitionBy(*by).orderBy("_slice"), "_total").alias("_offset"))
    ordered = Window.partitionBy(*in_slice).orderBy(time, *tiebreak, F.xxhash64(*df.columns))
    return (
        sliced.withColumn("_rank", before(ordered, "_places"))
        .join(offsets, in_slice)
        .withColumn(name, F.col("_offset") + F.col("_rank"))
        .drop("_rank", "_offset", "_slice", "_places")
    )


def rolling_total(
    intervals: DataFrame,
    *,
    accum_hours: int,
    step_hours: int,
    by: Sequence[str] = ("stid",),
    time: str = "end_time",
    value: str = "interval_precip",
    tiebreak: Sequence[str] = (),
    slice_width: timedelta = timedelta(days=1),
    block_rows: int = 100_000,
) -> DataFrame:
    """Sum over the last ``accum_hours / step_hours`` reports of each key.

    Rows are counted, not hours: gaps in the reports do not break a window, a missing
    value does.  Rows without a total are dropped, repeated reports are kept.  Adds
    ``accum_hours``, ``step_hours``, ``start_time`` and ``precip_total``.

    Keys are cut into blocks of ``block_rows`` consecutive rows; each block also gets
    the few rows that precede it.  So the largest task is a block, not a key.  Copies
    of a report are counted before the shuffle: from the k-th copy on a total is k
    times the value, so only the first k−1 take part in the sums, and the rest are
    written out in runs spread over the tasks.
    """
    if step_hours <= 0 or accum_hours % step_hours:
        raise ValueError("accum_hours must be a multiple of step_hours")
    k = accum_hours // step_hours
    by = list(by)
    numbers = intervals.withColumn(value, to_number(F.col(value)))
    if k == 1:
        totals = known(numbers, [*by, time]).withColumn("precip_total", F.col(value))
    else:
        totals = _sum_of_last(numbers, k, by, time, value, tiebreak, slice_width, max(block_rows, k))
    return totals.where("precip_total is not null").withColumns(
        {
            "accum_hours": F.lit(accum_hours),
            "step_hours": F.lit(step_hours),
            "start_time": F.col(time) - hours(accum_hours),
        }
    )


def _sum_of_last(
    df: DataFrame,
    k: int,
    by: list[str],
    time: str,
    value: str,
    tiebreak: Sequence[str],
    slice_width: timedelta,
    block_rows: int,
) -> DataFrame:
    counted = known(df, [*by, time]).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    summed = F.least(F.col("_n"), F.lit(k - 1))
    placed = with_position(counted, by=by, time=time, tiebreak=tiebreak, places=summed, slice_width=slice_width)

    def row(block: Column, place: Column, own: Column, run: Column) -> Column:
        return F.struct(
            block.alias("_block"), place.alias("_pos"), own.alias("_own"), run.cast("long").alias("_run")
        )

    # Rows that take part in sums go to their block, those near its end to the next too.
    def in_blocks(place: Column) -> Column:
        within = F.pmod(place, F.lit(block_rows))
        home = row(place - within, place, F.lit(True), F.lit(0))
        lent = row(place - within + block_rows, place, F.lit(False), F.lit(0))
        return F.when(within > block_rows - k, F.array(home, lent)).otherwise(F.array(home))

    # The other copies need no sum; their runs get blocks of their own, below zero.
    first, rest = F.col("_pos"), F.col("_n") - summed
    run_block = -1 - F.pmod(F.xxhash64(*by, time, value), F.lit(2**40))
    runs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.floor((rest - 1) / COPIES_PER_RUN)),
        lambda i: row(
            run_block - i, first, F.lit(True), F.least(rest - i * COPIES_PER_RUN, F.lit(COPIES_PER_RUN))
        ),
    )
    copies = F.flatten(F.transform(F.sequence(first, first + summed - 1), in_blocks))
    spread = F.when(F.col("_n") == 1, in_blocks(first)).when(rest > 0, F.concat(copies, runs)).otherwise(copies)
    rows = placed.select(*df.columns, F.inline(spread))

    last_k = Window.partitionBy(*by, "_block").orderBy("_pos").rowsBetween(1 - k, Window.currentRow)
    total = F.when(F.col("_run") > 0, F.col(value) * k).otherwise(
        F.when(F.count(value).over(last_k) == k, F.sum(value).over(last_k))
    )
    return (
        rows.withColumn("precip_total", total)
        .where("_own and precip_total is not null")
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.greatest("_run", F.lit(1)).cast("int"))))
        .select(*df.columns, "precip_total")
    )


def with_exact_lag(
    df: DataFrame,
    *,
    by: Sequence[str],
    time: str,
    value: str,
    lag_hours: int,
    out: str,
    fan_out: bool = False,
) -> DataFrame:
    """Add the value the same key had exactly ``lag_hours`` before; null if none.

    An equi-join on (key, time), so a large key spreads over its times.  Where a key
    has several rows at the earlier time, the largest value is taken; ``fan_out``
    returns a row for each of them instead.
    """
    keys = [*by, time]
    earlier = df.select(*by, (F.col(time) + hours(lag_hours)).alias(time), F.col(value).alias(out))
    if not fan_out:
        earlier = earlier.groupBy(*keys).agg(F.max(out).alias(out))
    return df.join(earlier, keys, "left").select(*df.columns, out)


def interval_from_total(
    df: DataFrame,
    *,
    total: str = "precip_accum",
    out: str = "precip_6h",
    interval_hours: int = 6,
    by: Sequence[str] = ("station_id", "init_time"),
    time: str = "valid_time",
    clip: bool = True,
    missing_as_zero: bool = False,
    fan_out: bool = False,
) -> DataFrame:
    """Amount over an interval as the difference of two running totals.

    Rows without a total exactly ``interval_hours`` before get NULL, or zero with
    ``missing_as_zero`` (what older archives hold).  Decreases are clipped to zero.
    """
    if total not in df.columns:
        raise KeyError(f"no column {total!r}")
    lagged = with_exact_lag(
        df, by=by, time=time, value=total, lag_hours=interval_hours, out="_earlier", fan_out=fan_out
    )
    amount = round_scaled(F.col(total) - F.col("_earlier"), 2)
    if clip:
        amount = clip_negative(amount, missing_as_zero)
    return lagged.withColumn(out, amount).drop("_earlier")


def first_present(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First of the candidate column names that the frame has."""
    return next((c for c in candidates if c in df.columns), None)
