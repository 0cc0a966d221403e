"""Grid values kept in the order of their cells, so that points are extracted without reading whole fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cells import unravel

#: Column that stored fields add: cells that are close to each other have close keys.
CELL_KEY = "cell_key"
#: Ranges of keys that a reader asks the files for, at most.
RANGES = 64

# Masks that leave 8, 4, 2 and 1 bits together.
SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def cell_key(flat: Column, nx: int) -> Column:
    """Z-order of a row-major cell index: the bits of row and column, of 16 each, in turn."""

    def spread(x: Column) -> Column:
        return reduce(lambda y, step: y.bitwiseOR(F.shiftleft(y, step[0])).bitwiseAND(F.lit(step[1])), SPREAD, x.cast("long"))

    row, column = unravel(flat, F.lit(nx))
    return F.shiftleft(spread(row), 1).bitwiseOR(spread(column))


def write_fields(values: DataFrame, path: str, nx: int, mode: str = "append") -> None:
    """Write grid values (grid_id, flat, …) in ranges of their cells, ordered within each file.

    Ranges are split by sampled sizes, and a cell of very many values over several files, since rows
    of one cell are ordered by their content's hash.  Each append adds files of its own ranges.
    """
    order = ["grid_id", CELL_KEY, "_content"]
    keyed = values.withColumns({CELL_KEY: cell_key(F.col("flat"), nx), "_content": F.xxhash64(*values.columns)})
    keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_content").write.mode(mode).parquet(path)


def key_ranges(keys: DataFrame, ranges: int = RANGES) -> list[tuple[int, int]]:
    """At most ``ranges`` ranges that cover all keys (one column), and few others."""
    low, high = keys.agg(F.min(CELL_KEY), F.max(CELL_KEY)).first()
    if low is None:
        return []
    width = (high - low) // ranges + 1
    part = F.floor((F.col(CELL_KEY) - low) / width)
    found = keys.groupBy(part.alias("part")).agg(F.min(CELL_KEY).alias("low"), F.max(CELL_KEY).alias("high"))
    return sorted((r.low, r.high) for r in found.collect())


def fields_near(spark: SparkSession, path: str, station_cells: DataFrame, nx: int) -> DataFrame:
    """The stored values of the key ranges that hold the stations' cells; statistics leave out the rest."""
    ranges = key_ranges(station_cells.select(cell_key(F.col("flat"), nx).alias(CELL_KEY)))
    key = F.col(CELL_KEY)
    wanted = reduce(lambda x, y: x | y, [key.between(a, b) for a, b in ranges], F.lit(False))
    return spark.read.parquet(path).where(wanted)


def extract_stored(spark: SparkSession, path: str, station_cells: DataFrame, nx: int) -> DataFrame:
    """Stored values at each station's cell, as ``extract_points`` gives them.

    Pass ``station_cells`` as a written table: it is read twice, once for its ranges of cells.
    """
    cells = station_cells.select("grid_id", "flat", "station_id", cell_key(F.col("flat"), nx).alias(CELL_KEY))
    return fields_near(spark, path, station_cells, nx).join(cells, ["grid_id", CELL_KEY, "flat"]).drop(CELL_KEY)
