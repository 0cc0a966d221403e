"""Stored tiles and fields: the same results as without them, from less."""

import random
import re

from pyspark.sql import functions as F

from stationcast.operators.cells import locate, nearest_cells, read_index, write_index
from stationcast.operators.points import extract_points
from stationcast.sources.fields import cell_key, extract_stored, fields_near, key_ranges, write_fields


def some_grid(spark, n=40, grids=("a", "b")):
    rng = random.Random(3)
    rows = [(g, i * n + j, 30 + i * 0.25 + rng.random() / 9, 230 + j * 0.3) for g in grids for i in range(n) for j in range(n)]
    return spark.createDataFrame(rows, "grid_id string, flat long, lat double, lon double")


def some_stations(spark, n=60, low=20.0, wide=40.0):
    rng = random.Random(4)
    rows = [(f"s{i}", low + wide * rng.random(), -140 + wide * rng.random()) for i in range(n)] + [("none", None, 1.0)]
    return spark.createDataFrame(rows, "station_id string, latitude double, longitude double")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_lookup_in_stored_tiles(spark, tmp_path):
    grid, stations = some_grid(spark), some_stations(spark)
    write_index(grid, str(tmp_path / "index"))
    index = read_index(spark, str(tmp_path / "index"))
    for metric in ("chebyshev", "euclidean"):
        got = locate(index, stations, metric=metric)
        assert rows(got) == rows(nearest_cells(grid, stations, metric=metric)) and got.count() == 2 * 60
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert len(re.findall(r"(?<!Broadcast)Exchange (?:hash|single|range)", plan)) <= 6
        assert len(re.findall(r"FileScan parquet", plan)) <= 5
    assert locate(write_index(grid.where("false"), str(tmp_path / "empty")), stations).count() == 0


def test_cell_keys(spark):
    nx, ny = 37, 29
    df = spark.range(nx * ny).withColumn("cell_key", cell_key(F.col("id"), nx))
    want = {}
    for flat in range(nx * ny):
        y, x = divmod(flat, nx)
        want[flat] = sum((y >> b & 1) << 2 * b + 1 | (x >> b & 1) << 2 * b for b in range(16))
    assert {r.id: r.cell_key for r in df.collect()} == want
    for n in (1, 5, 64):
        ranges = key_ranges(df.select("cell_key"), n)
        assert len(ranges) <= n and all(any(a <= k <= b for a, b in ranges) for k in want.values())
    assert key_ranges(df.select("cell_key").where("false")) == []


def test_points_of_stored_fields(spark, tmp_path):
    grid = some_grid(spark, 64)
    values = grid.join(spark.range(20).withColumnRenamed("id", "lead")).select("grid_id", "flat", "lead", (F.col("flat") * 100 + F.col("lead")).alias("value"))
    hot = spark.range(30_000).select(F.lit("a").alias("grid_id"), F.lit(5).cast("long").alias("flat"), F.col("id").alias("lead"), F.lit(1).cast("long").alias("value"))
    cells = nearest_cells(grid, some_stations(spark, 6, 32.0, 2.0)).select("grid_id", "flat", "station_id")
    path = str(tmp_path / "fields")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 5000)
    try:
        write_fields(values, path, 64)
        write_fields(hot, path, 64)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    want = extract_points(values.unionByName(hot), cells).select("grid_id", "flat", "lead", "value", "station_id")
    assert rows(extract_stored(spark, path, cells, 64).select(*want.columns)) == rows(want)
    near = fields_near(spark, path, cells, 64)
    near.collect()
    scan = near._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert 0 < scan.metrics().apply("numOutputRows").value() < 0.3 * (values.count() + 30_000)
    assert extract_stored(spark, path, cells.where("false"), 64).count() == 0
