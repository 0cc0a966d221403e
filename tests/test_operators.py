"""Hand-made frames with known results."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationcast.functions import units
from stationcast.operators import accumulate, cells, extremes, metrics, points
from stationcast.rules import PERCENTILE_COLUMNS, ColumnRule

DAY = datetime(2025, 1, 1)


def hour(n):
    return DAY + timedelta(hours=n)


def test_wind_components(spark):
    rows = [(0.0, -1.0), (-1.0, 0.0), (1.0, 0.0), (0.0, 1.0)]
    df = spark.createDataFrame(rows, "u double, v double")
    got = df.select(units.wind_direction(F.col("u"), F.col("v"))).collect()
    assert [round(r[0], 6) for r in got] == [0, 90, 270, 180]


def test_rounding(spark):
    df = spark.createDataFrame([(2.5, 0.125, 1.005, 2.675)], "a double, b double, c double, d double")
    a, b, c, d = df.select(
        units.round_half_even(F.col("a"), 0), *[units.round_half_even(F.col(x), 2) for x in "bcd"]
    ).first()
    assert (a, b, c, d) == (2.0, 0.12, 1.0, 2.68)


def test_scores(spark):
    df = spark.createDataFrame(
        [("a", 2.0, 1.0), ("a", 1.0, 4.0), ("a", None, 4.0), ("a", float("nan"), 4.0), ("b", 1.0, None)],
        "g string, f double, o double",
    )
    one = metrics.verification_scores(df.where("g = 'a'"), "f", "o").first()
    assert (one["count"], one.bias, one.mae) == (2, -1.0, 2.0) and one.rmse == pytest.approx(5**0.5)
    by = {r.g: r for r in metrics.verification_scores(df, "f", "o", ["g"]).collect()}
    assert (by["b"]["count"], by["b"].bias, by["b"].rmse) == (0, None, None)
    empty = metrics.verification_scores(df.where("false"), "f", "o").first()
    assert (empty["count"], empty.bias) == (0, None)


def test_common_metrics_are_scored_together(spark):
    df = spark.createDataFrame(
        [(DAY, "A", 1.0, 2.0, 3.0, 5.0)],
        "valid_time timestamp, station_id string, forecast_speed double, observed_speed double, "
        "forecast_gust double, observed_dir double",
    )
    assert [(r.metric, r.bias) for r in metrics.score_all_metrics(df).collect()] == [("speed", -1.0)]
    assert sorted((r.series, r.value) for r in metrics.series(df, "speed").collect()) == [
        ("forecast", 1.0),
        ("observed", 2.0),
    ]


def rolling(spark, values, k, **kw):
    df = spark.createDataFrame(
        [("A", hour(6 * i), v) for i, v in enumerate(values)],
        "stid string, end_time timestamp, interval_precip string",
    )
    out = accumulate.rolling_total(df, accum_hours=6 * k, step_hours=6, **kw).orderBy("end_time").collect()
    return [(r.end_time.day, r.end_time.hour, r.precip_total) for r in out]


def test_rolling_total_needs_all_values(spark):
    assert rolling(spark, ["1", "2", None, "3", "4"], 2) == [(1, 6, 3.0), (2, 0, 7.0)]
    assert rolling(spark, ["1", "x", "3"], 1) == [(1, 0, 1.0), (1, 12, 3.0)]


def test_rolling_total_needs_whole_steps(spark):
    with pytest.raises(ValueError):
        accumulate.rolling_total(spark.range(1), accum_hours=24, step_hours=7)


@pytest.mark.parametrize("block_rows, slice_hours", [(3, 5), (5, 1), (100_000, 24), (4, 10_000)])
def test_rolling_total_is_the_same_for_any_block(spark, block_rows, slice_hours):
    rng = np.random.default_rng(3)
    df = pd.DataFrame(
        {
            "stid": rng.choice(["A", "B"], 60, p=[0.9, 0.1]),
            "end_time": (pd.Timestamp(DAY) + pd.to_timedelta(rng.permutation(400)[:60], "h")).astype("datetime64[us]"),
            "interval_precip": np.where(rng.random(60) < 0.1, np.nan, rng.integers(0, 9, 60)),
        }
    )
    out = accumulate.rolling_total(
        spark.createDataFrame(df),
        accum_hours=18,
        step_hours=6,
        block_rows=block_rows,
        slice_width=timedelta(hours=slice_hours),
    ).toPandas()
    df = df.sort_values(["stid", "end_time"])
    df["total"] = df.groupby("stid")["interval_precip"].transform(lambda s: s.rolling(3, min_periods=3).sum())
    expected = df.dropna(subset=["total"])
    assert sorted(zip(out.stid, out.end_time, out.precip_total)) == sorted(
        zip(expected.stid, expected.end_time, expected.total)
    )
    assert (out.end_time - out.start_time == pd.Timedelta(hours=18)).all()


@pytest.mark.parametrize("k, block_rows", [(1, 9), (2, 3), (4, 5), (4, 1000)])
def test_rolling_total_over_copies(spark, monkeypatch, k, block_rows):
    monkeypatch.setattr(accumulate, "COPIES_PER_RUN", 4)
    rng = np.random.default_rng(11)
    df = pd.DataFrame(
        {
            "stid": rng.choice(["A", "B"], 40),
            "end_time": (pd.Timestamp(DAY) + pd.to_timedelta(rng.integers(0, 30, 40), "h")).astype("datetime64[us]"),
            "interval_precip": np.where(rng.random(40) < 0.1, np.nan, rng.integers(0, 3, 40)),
        }
    )
    df = df.loc[df.index.repeat(rng.integers(1, 14, 40))]
    out = accumulate.rolling_total(
        spark.createDataFrame(df), accum_hours=6 * k, step_hours=6, tiebreak=["interval_precip"], block_rows=block_rows
    ).toPandas()
    df = df.sort_values(["stid", "end_time", "interval_precip"], na_position="first")
    df["total"] = df.groupby("stid")["interval_precip"].transform(lambda s: s.rolling(k, min_periods=k).sum())
    expected = df.dropna(subset=["total"])
    assert sorted(zip(out.stid, out.end_time, out.precip_total)) == sorted(
        zip(expected.stid, expected.end_time, expected.total)
    )


def intervals(spark, rows, **kw):
    df = spark.createDataFrame(
        [("A", DAY, hour(h), t) for h, t in rows],
        "station_id string, init_time timestamp, valid_time timestamp, precip_accum double",
    )
    out = accumulate.interval_from_total(df, **kw).orderBy("valid_time", "precip_accum").collect()
    return [r.precip_6h for r in out]


def test_interval_from_total(spark):
    rows = [(0, 1.0), (6, 3.0), (12, 4.0), (13, 9.0)]
    assert intervals(spark, rows) == [None, 2.0, 1.0, None]
    assert intervals(spark, rows, missing_as_zero=True) == [0.0, 2.0, 1.0, 0.0]
    assert intervals(spark, [(0, 3.0), (6, 1.0)]) == [None, 0.0]
    assert intervals(spark, [(0, 3.0), (6, 1.0)], clip=False) == [None, -2.0]
    twice = [(0, 1.0), (0, 2.0), (6, 5.0)]
    assert intervals(spark, twice) == [None, None, 3.0]
    assert sorted(intervals(spark, twice, fan_out=True), key=str) == [3.0, 4.0, None, None]


def temps(spark, rows):
    return spark.createDataFrame(
        [("A", lat, 1.0, 2.0, "Z", None, hour(h), v) for h, v, lat in rows],
        "stid string, lat double, lon double, elev double, NWSZONE string, NWSCWA string, "
        "valid_time timestamp, temp double",
    )


def test_daily_maximum(spark):
    rows = [(11, 99.0, 61.0), (12, 5.0, None), (24, 9.0, 61.0), (29.99, 7.0, 62.0), (30, 98.0, 61.0), (35, 97.0, 61.0)]
    out = extremes.daily_extreme(temps(spark, rows), extremes.TMAX_12_TO_06)
    assert out.columns == [
        "stid", "lat", "lon", "elev", "date", "window_start", "window_end", "tmax", "temp_units", "NWSZONE", "NWSCWA",
    ]
    (row,) = out.collect()
    assert (row.tmax, row.lat, row.date, row.window_start, row.window_end) == (9.0, 61.0, DAY, hour(12), hour(30))


def test_daily_minimum_and_missing_groups(spark):
    rows = [(0, 5.0, 61.0), (17.98, 4.0, 61.0), (18, 1.0, 61.0), (24, None, 61.0), (25, float("nan"), 61.0)]
    out = extremes.daily_extreme(temps(spark, rows), extremes.TMIN_00_TO_18, units="metric").orderBy("date")
    assert [(r.date.day, r.tmin, r.temp_units) for r in out.collect()] == [(1, 4.0, "C"), (2, None, "C")]
    only = extremes.daily_extreme(temps(spark, rows), extremes.TMIN_00_TO_18, first_day=hour(24), last_day=hour(24))
    assert [r.date.day for r in only.collect()] == [2]
    with pytest.raises(ValueError):
        extremes.daily_extreme(temps(spark, rows), extremes.TMIN_00_TO_18, first_day=hour(24), last_day=DAY)


def grid_frame(spark, coordinates, grid_id="g"):
    rows = [(grid_id, i, float(lat), float(lon)) for i, (lat, lon) in enumerate(coordinates)]
    return spark.createDataFrame(rows, "grid_id string, flat long, lat double, lon double")


def station_frame(spark, places):
    rows = [(f"s{i}", float(lat), float(lon)) for i, (lat, lon) in enumerate(places)]
    return spark.createDataFrame(rows, "station_id string, latitude double, longitude double")


def nearest(spark, coordinates, places, **kw):
    out = cells.nearest_cells(grid_frame(spark, coordinates), station_frame(spark, places), **kw).collect()
    return [r.flat for r in sorted(out, key=lambda r: int(r.station_id[1:]))]


def test_nearest_cell_ties_and_longitudes(spark):
    row = [(60.0, -150.0 + i) for i in range(10)]
    assert nearest(spark, row, [(60.0, -142.5)]) == [7]
    turned = [(60.0, float(lon)) for lon in range(0, 360, 10)]
    assert nearest(spark, turned, [(60.0, -150.0), (60.0, 210.0)]) == [21, 21]
    ends = [(60.0, -179.0), (60.0, 170.0)]
    assert nearest(spark, ends, [(60.0, 179.0)]) == [1]
    assert nearest(spark, ends, [(60.0, 179.0)], wrap_dateline=True) == [0]
    assert nearest(spark, [(60.0, -150.0), (60.0, -150.0), (float("nan"), 1.0)], [(1.0, 1.0)]) == [0]


@pytest.mark.parametrize("metric", ["chebyshev", "euclidean"])
def test_nearest_cell_equals_brute_force(spark, metric):
    rng = random.Random(5)
    grid = [
        (50 + 0.3 * y + 0.05 * x + rng.random() * 0.01, -170 + 0.4 * x - 0.07 * y) for y in range(30) for x in range(40)
    ]
    inside = [(rng.uniform(50, 60), rng.uniform(-170, -155)) for _ in range(25)]
    outside = [(-80.0, 10.0), (55.0, 179.9), (89.0, -10.0), (45.0, -163.0), (55.0, -171.5)]
    expected = []
    for lat, lon in inside + outside:
        lon = ((lon + 180.0) % 360.0) - 180.0
        dy, dx = np.abs(np.array(grid) - (lat, lon)).T
        expected.append(int(np.argmin(np.maximum(dy, dx) if metric == "chebyshev" else np.hypot(dy, dx))))
    assert nearest(spark, grid, inside + outside, metric=metric) == expected


def test_cell_indices(spark):
    df = spark.range(12).select(*cells.unravel(F.col("id"), F.lit(5)), "id")
    assert [(r[0], r[1]) for r in df.collect()] == [(i // 5, i % 5) for i in range(12)]
    assert [r[0] for r in spark.range(3).select(cells.ravel(F.col("id"), F.lit(1), F.lit(5))).collect()] == [1, 6, 11]


def test_percentile_columns_take_the_last_message(spark):
    df = spark.createDataFrame(
        [("A", 5, 1, 10.0), ("A", 5, 3, 20.0), ("A", 50, 2, 100.0), ("A", 33, 4, 1.0)],
        "station_id string, percentile int, msg_no int, value double",
    )
    row = points.percentile_columns(df, PERCENTILE_COLUMNS["precip6hr"], ["station_id"]).first()
    assert (row.qpf_p5, row.qpf_p50, row.qpf_p95) == (0.79, 3.94, None)
    assert len(row) == 8


def test_variable_columns_take_the_first_message(spark):
    df = spark.createDataFrame(
        [("A", "t", 1, 273.0), ("A", "t", 2, 0.0), ("A", "x", 3, 5.0)],
        "station_id string, var string, msg_no int, value double",
    )
    rules = [ColumnRule("t", "temp", "fahrenheit"), ColumnRule("w", "wind")]
    assert points.variable_columns(df, rules, ["station_id"]).collect() == [("A", 32.0, None)]


def test_pairing_steps(spark):
    speed = spark.createDataFrame([("d", 0, 1.0), ("d", 1, 2.0), (None, 0, 3.0)], "pair string, step int, spd double")
    direction = spark.createDataFrame([("d", 0, 90.0), ("d", 5, 10.0)], "pair string, step int, dir double")
    out = points.pair_steps(speed, direction, ["pair", "step"], "dir", "pair").collect()
    assert sorted((r.spd, r.dir or 0) for r in out) == [(1.0, 90.0), (3.0, 0)]
