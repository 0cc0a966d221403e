from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from stationcast.operators.asof import asof_nearest

HALF_HOUR = timedelta(minutes=30)


def at(text):
    day, clock = text.split(" ") if " " in text else ("2025-01-01", text)
    return datetime.fromisoformat(f"{day} {clock}")


def match(spark, left, right, tolerance=HALF_HOUR, **kw):
    l = spark.createDataFrame([("A", at(t)) for t in left], "stid string, valid timestamp")
    r = spark.createDataFrame(
        [("A", at(t), v, i) for i, (t, v) in enumerate(right)], "stid string, seen timestamp, v int, n int"
    )
    out = asof_nearest(l, r, by=["stid"], left_time="valid", right_time="seen", tolerance=tolerance, seq="n", **kw)
    return {row.valid.strftime("%H:%M"): row.v for row in out.collect()}


def test_tie_takes_earlier_by_default(spark):
    assert match(spark, ["01:00"], [("00:30", 1), ("01:30", 2)]) == {"01:00": 1}


def test_tie_can_take_later(spark):
    got = match(spark, ["00:02"], [("00:01", 1), ("00:03", 3)], timedelta(minutes=2), tie="later")
    assert got == {"00:02": 3}


def test_tolerance_is_inclusive_and_left_rows_stay(spark):
    got = match(spark, ["04:00", "05:00"], [("04:30", 1), ("05:31", 2)])
    assert got == {"04:00": 1, "05:00": 1}
    assert match(spark, ["05:00"], [("05:31", 2)]) == {"05:00": None}


def test_duplicates_at_or_before_take_the_last(spark):
    assert match(spark, ["03:00"], [("03:00", 3), ("03:00", 4)]) == {"03:00": 4}
    assert match(spark, ["01:00"], [("00:50", 1), ("00:50", 2)]) == {"01:00": 2}


def test_duplicates_after_take_the_first_or_last(spark):
    assert match(spark, ["01:00"], [("01:10", 1), ("01:10", 2)]) == {"01:00": 1}
    assert match(spark, ["01:00"], [("01:10", 1), ("01:10", 2)], after_duplicates="last") == {"01:00": 2}


def test_repeated_left_rows_and_null_keys_are_kept(spark):
    l = spark.createDataFrame(
        [("A", at("01:00")), ("A", at("01:00")), (None, at("01:00")), ("A", None)], "stid string, valid timestamp"
    )
    r = spark.createDataFrame([("A", at("01:05"), 1)], "stid string, seen timestamp, v int")
    out = asof_nearest(l, r, by=["stid"], left_time="valid", right_time="seen", tolerance=HALF_HOUR)
    assert sorted((x.stid or "", x.v or 0) for x in out.collect()) == [("", 0), ("A", 0), ("A", 1), ("A", 1)]


def test_column_clash_is_refused(spark):
    l = spark.createDataFrame([("A", at("01:00"))], "stid string, valid timestamp")
    with pytest.raises(ValueError, match="both sides"):
        asof_nearest(l, l, by=["stid"], left_time="valid", right_time="valid", tolerance=HALF_HOUR)


@pytest.mark.parametrize(
    "slice_minutes, tolerance_minutes",
    [(1, 3), (7, 45), (60, 45), (45, 45), (60, 600), (100_000, 600), (7, 600), (7, None), (100_000, None)],
)
def test_equals_pandas_for_any_slice_width(spark, slice_minutes, tolerance_minutes):
    rng = np.random.default_rng(7)
    start = pd.Timestamp("2025-01-01")

    def frame(n, time, value):
        minutes = rng.integers(0, 4000, n)
        return pd.DataFrame(
            {
                "stid": rng.choice(["A", "B", "C"], n, p=[0.8, 0.15, 0.05]),
                time: (start + pd.to_timedelta(minutes, "min")).astype("datetime64[us]"),
                value: np.arange(n),
            }
        )

    left, right = frame(300, "valid", "i"), frame(200, "seen", "j")
    tolerance = None if tolerance_minutes is None else timedelta(minutes=tolerance_minutes)
    out = asof_nearest(
        spark.createDataFrame(left),
        spark.createDataFrame(right),
        by=["stid"],
        left_time="valid",
        right_time="seen",
        tolerance=tolerance,
        seq="j",
        slice_width=timedelta(minutes=slice_minutes),
    ).toPandas()
    expected = pd.merge_asof(
        left.sort_values("valid", kind="stable"),
        right.sort_values("seen", kind="stable"),
        left_on="valid",
        right_on="seen",
        by="stid",
        direction="nearest",
        tolerance=None if tolerance is None else pd.Timedelta(tolerance),
    )
    assert dict(zip(out.i, out.j.fillna(-1))) == dict(zip(expected.i, expected.j.fillna(-1)))


def test_without_keys(spark):
    l = spark.createDataFrame([(at("01:00"),), (at("09:00"),)], "valid timestamp")
    r = spark.createDataFrame([(at("01:02"), 5)], "seen timestamp, v int")
    out = asof_nearest(l, r, by=[], left_time="valid", right_time="seen", tolerance=timedelta(minutes=2))
    assert sorted((x.valid.hour, x.v) for x in out.collect()) == [(1, 5), (9, None)]


def test_any_distance_crosses_empty_slices(spark):
    l = spark.createDataFrame([("A", at(f"{d} 00:00")) for d in ("2024-06-01", "2025-01-20", "2025-02-05", "2025-03-01")] + [("B", at("2025-01-01 00:00"))], "stid string, valid timestamp")
    r = spark.createDataFrame([("A", at("2025-01-01 00:00"), 1), ("A", at("2025-02-20 00:00"), 2)], "stid string, seen timestamp, v int")
    out = asof_nearest(l, r, by=["stid"], left_time="valid", right_time="seen", tolerance=None, slice_width=timedelta(hours=1))
    assert [(x.stid, x.v) for x in out.orderBy("stid", "valid").collect()] == [("A", 1), ("A", 1), ("A", 2), ("A", 2), ("B", None)]


def test_right_side_is_read_once_and_left_rows_once(spark, tmp_path):
    l = spark.createDataFrame([("A", at("01:00"), k) for k in range(50)], "stid string, valid timestamp, n int")
    r = spark.createDataFrame([("A", at("01:10"), k) for k in range(50)], "stid string, seen timestamp, v int")
    l.write.parquet(str(tmp_path / "left"))
    r.write.parquet(str(tmp_path / "right"))
    l, r = spark.read.parquet(str(tmp_path / "left")), spark.read.parquet(str(tmp_path / "right"))
    out = asof_nearest(l, r, by=["stid"], left_time="valid", right_time="seen", tolerance=None, seq="v")
    assert {x.v for x in out.collect()} == {0}
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert sum("/right" in s for s in scans) == 1
    # The left side's keys and times come first, its rows later.
    assert sorted("n:int" in s for s in scans if "/left" in s) == [False, True]
