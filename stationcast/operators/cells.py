"""Nearest grid cell of each station."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.units import normalise_grid_longitude, wrap_longitude

# Tile widths in powers of two degrees, coarse to fine: 64°, 8°, 1°, 1/8°.  A grid of
# 3 km has about ten cells in the finest; add -6 for grids much finer than 1 km.
LEVELS = (6, 3, 0, -3)


def unravel(flat: Column, nx: Column) -> tuple[Column, Column]:
    """Row and column of a row-major cell index."""
    column = F.pmod(flat, nx)
    return ((flat - column) / nx).cast("int"), column.cast("int")


def ravel(iy: Column, ix: Column, nx: Column) -> Column:
    return iy * nx + ix


@dataclass(frozen=True)
class CellIndex:
    """Cells with their finest tile, and per level the occupied tiles with the extent of their cells."""

    cells: DataFrame
    tiles: dict[int, DataFrame]


def write_index(grid: DataFrame, path: str, levels: tuple[int, ...] = LEVELS) -> CellIndex:
    """Write the tile pyramid of grids, once, for any number of lookups.

    Cells lie in ranges of (grid, tile), in order, so that a lookup joins sorted files whose
    statistics tell which tiles they hold.  Each level is aggregated from the next finer one as
    written, so the grid is read once.  ``path`` must not exist.
    """
    order = ["grid_id", "ty", "tx"]
    placed = _candidates(grid).select("grid_id", "flat", "lat", "lon", *_tile_of(levels[-1]))
    placed.repartitionByRange(*order).sortWithinPartitions(*order, "flat").write.parquet(f"{path}/cells")
    spark = grid.sparkSession
    cells = spark.read.schema(placed.schema).parquet(f"{path}/cells")
    finer = None
    for level in levels[::-1]:
        tiles = _finest(cells) if finer is None else _merged(spark.read.parquet(f"{path}/tiles/{finer}"), level - finer)
        tiles.write.parquet(f"{path}/tiles/{level}")
        finer = level
    return read_index(spark, path, levels)


def read_index(spark: SparkSession, path: str, levels: tuple[int, ...] = LEVELS) -> CellIndex:
    """The pyramid that ``write_index`` wrote with these levels."""
    return CellIndex(spark.read.parquet(f"{path}/cells"), {x: spark.read.parquet(f"{path}/tiles/{x}") for x in levels})


def nearest_cells(
    grid: DataFrame,
    stations: DataFrame,
    *,
    metric: str = "chebyshev",
    wrap_dateline: bool = False,
    levels: tuple[int, ...] = LEVELS,
) -> DataFrame:
    """(grid_id, station_id, flat, distance): the cell nearest to each station.

    ``grid`` has grid_id, flat, lat, lon; ``stations`` has station_id, latitude,
    longitude.  Distances are in degrees, the larger of the two differences by
    default or "euclidean"; ties go to the lowest ``flat``.  Distances do not cross
    the dateline unless ``wrap_dateline`` is set.

    Stations meet tiles, not cells.  Starting from the 64° tiles, each round keeps
    the tiles that can still hold the nearest cell (their near edge is no farther
    than the best far edge) and descends into their occupied sub-tiles; only the
    last round looks at cells.  The bounds use each tile's actual cell extent, so the
    answer is exact for stations inside and outside the grid.

    Where a grid serves several lookups, write its tiles with ``write_index`` and use ``locate``.
    """
    cells = _candidates(grid)
    placed = cells.select("grid_id", "flat", "lat", "lon", *_tile_of(levels[-1]))
    return locate(CellIndex(placed, _tiles(cells, levels)), stations, metric=metric, wrap_dateline=wrap_dateline)


def _candidates(grid: DataFrame) -> DataFrame:
    """Cells by place; those at one place are one, the lowest index."""
    return (
        grid.select(
            "grid_id",
            "flat",
            F.col("lat").cast("double").alias("lat"),
            normalise_grid_longitude(F.col("lon").cast("double")).alias("lon"),
        )
        .dropna()
        .groupBy("grid_id", "lat", "lon")
        .agg(F.min("flat").alias("flat"))
    )


def locate(index: CellIndex, stations: DataFrame, *, metric: str = "chebyshev", wrap_dateline: bool = False) -> DataFrame:
    """(grid_id, station_id, flat, distance): ``nearest_cells`` from an index.

    Every level of the index is read once.  Stations stay where their first comparison puts them, as
    long as the tiles of a level are few enough to be broadcast by Spark's own check.
    """
    if metric not in ("chebyshev", "euclidean"):
        raise ValueError(f"unknown metric {metric!r}")
    tiles, levels = index.tiles, tuple(sorted(index.tiles, reverse=True))
    longitude = wrap_longitude(F.col("longitude").cast("double"))
    images = [longitude - 360.0, longitude, longitude + 360.0] if wrap_dateline else [longitude]
    here = (
        stations.select(
            "station_id",
            F.col("latitude").cast("double").alias("y"),
            F.explode(F.array(*images)).alias("x"),
        )
        .dropna()
        .distinct()
    )

    # Every station looks at all of the (few) coarsest tiles.
    top = levels[0]
    span_x, span_y = _span(360.0, top), _span(180.0, top)
    found = here.withColumn("ty", F.explode(F.sequence(F.lit(-span_y), F.lit(span_y - 1)))).withColumn(
        "tx", F.explode(F.sequence(F.lit(-span_x), F.lit(span_x - 1)))
    )
    found = _closest(found.join(tiles[top], ["ty", "tx"]), metric)
    for coarse, fine in zip(levels, levels[1:]):
        shrink = 2 ** (coarse - fine)
        children = tiles[fine].withColumns(
            {"py": _coarser(F.col("ty"), shrink), "px": _coarser(F.col("tx"), shrink)}
        )
        parents = found.select("station_id", "y", "x", "grid_id", F.col("ty").alias("py"), F.col("tx").alias("px"))
        found = _closest(parents.join(children, ["grid_id", "py", "px"]), metric)

    distance = _combine(F.abs(F.col("lat") - F.col("y")), F.abs(F.col("lon") - F.col("x")), metric)
    return (
        found.select("station_id", "y", "x", "grid_id", "ty", "tx")
        .join(index.cells, ["grid_id", "ty", "tx"])
        .groupBy("grid_id", "station_id")
        .agg(F.min(F.struct(distance.alias("distance"), "flat")).alias("best"))
        .select("grid_id", "station_id", "best.flat", "best.distance")
    )


def _span(extent: float, level: int) -> int:
    """Tiles from the origin to the edge of the globe."""
    return max(1, int(-(-extent // 2 // 2.0**level)))


def _tile_of(level: int) -> list[Column]:
    width = F.lit(2.0**level)
    return [F.floor(F.col("lat") / width).alias("ty"), F.floor(F.col("lon") / width).alias("tx")]


def _coarser(index: Column, shrink: int) -> Column:
    return F.floor(index / F.lit(float(shrink)))


def _finest(cells: DataFrame) -> DataFrame:
    """Occupied tiles of cells with their tile, and the extent of their cells."""
    extent = [F.min("lat").alias("y0"), F.max("lat").alias("y1"), F.min("lon").alias("x0"), F.max("lon").alias("x1")]
    return cells.groupBy("grid_id", "ty", "tx").agg(*extent)


def _merged(tiles: DataFrame, steps: int) -> DataFrame:
    """Tiles of a coarser level, ``steps`` powers of two wider."""
    merged = [F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.min("x0").alias("x0"), F.max("x1").alias("x1")]
    up = [_coarser(F.col(c), 2**steps).alias(c) for c in ("ty", "tx")]
    return tiles.groupBy("grid_id", *up).agg(*merged)


def _tiles(cells: DataFrame, levels: tuple[int, ...]) -> dict[int, DataFrame]:
    """Occupied tiles per level, each aggregated from the next finer one."""
    tiles = {levels[-1]: _finest(cells.select("grid_id", "lat", "lon", *_tile_of(levels[-1])))}
    for fine, coarse in zip(levels[::-1], levels[-2::-1]):
        tiles[coarse] = _merged(tiles[fine], coarse - fine)
    return tiles


def _closest(candidates: DataFrame, metric: str) -> DataFrame:
    """Keep the tiles that can hold a station's nearest cell."""

    def near(position: str, low: str, high: str) -> Column:
        return F.greatest(F.col(low) - F.col(position), F.col(position) - F.col(high), F.lit(0.0))

    def far(position: str, low: str, high: str) -> Column:
        return F.greatest(F.abs(F.col(position) - F.col(low)), F.abs(F.col(high) - F.col(position)))

    per_station = Window.partitionBy("grid_id", "station_id")
    return (
        candidates.withColumns(
            {
                "_near": _combine(near("y", "y0", "y1"), near("x", "x0", "x1"), metric),
                "_far": _combine(far("y", "y0", "y1"), far("x", "x0", "x1"), metric),
            }
        )
        .withColumn("_best", F.min("_far").over(per_station))
        .where(F.col("_near") <= F.col("_best"))
        .drop("_near", "_far", "_best")
    )


def _combine(dy: Column, dx: Column, metric: str) -> Column:
    return F.greatest(dy, dx) if metric == "chebyshev" else F.sqrt(dy * dy + dx * dx)
