"""The data flows from end to end, names, calendars and rules."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stationcast import rules
from stationcast.functions import names, times
from stationcast.operators import accumulate, manifest
from stationcast.operators.metrics import score_all_metrics
from stationcast.plans import forecasts, observations, verification
from stationcast.plans.verification import DatasetSpec, MonthlyArchive, Units

DAY = datetime(2025, 1, 1)


def hour(n):
    return DAY + timedelta(hours=n)


def values(spark, rows):
    """(file, msg_no, step, lead, var, percentile, flat, value)"""
    return spark.createDataFrame(
        [(f, "g", m, s, h, hour(h), v, p, c, x) for f, m, s, h, v, p, c, x in rows],
        "file string, grid_id string, msg_no long, step_idx int, forecast_hour int, valid_time timestamp, "
        "var string, percentile int, flat long, value double",
    )


@pytest.fixture
def cells(spark):
    return spark.createDataFrame([("g", "A", 7, 0.0), ("g", "B", 7, 0.0), ("g", "C", 9, 0.0)], "grid_id string, station_id string, flat long, distance double")


def test_wind_of_a_blend(spark, cells):
    df = values(
        spark,
        [("f5", 1, 0, 5, "si10", None, 7, 10.0), ("f5", 2, 0, 5, "wdir10", None, 7, 123.5), ("f5", 1, 0, 5, "si10", None, 8, 1.0)],
    )
    out = forecasts.model_forecast(df, cells, "nbm", "Wind").orderBy("station_id").collect()
    assert [r.station_id for r in out] == ["A", "B"]
    a = out[0]
    assert (a.init_time, a.valid_time, a.forecast_hour) == (DAY, hour(5), 5)
    assert (a.wind_speed_kt, a.wind_dir_deg, a.wind_gust_kt) == (19.44, 124.0, None)


def test_wind_needs_both_components(spark, cells):
    df = values(
        spark,
        [
            ("f12", 1, 0, 12, "u10", None, 7, 0.0), ("f12", 2, 0, 12, "v10", None, 7, -10.0),
            ("f12", 3, 0, 12, "gust", None, 7, 10.0), ("f12", 1, 0, 12, "u10", None, 9, 1.0),
        ],
    )
    out = {r.station_id: r for r in forecasts.model_forecast(df, cells, "hrrr", "Wind").collect()}
    assert (out["A"].wind_speed_kt, out["A"].wind_dir_deg, out["A"].wind_gust_kt) == (19.44, 0.0, 19.48)
    assert (out["C"].wind_speed_kt, out["C"].wind_dir_deg) == (None, None)


def test_run_totals_become_intervals(spark, cells):
    df = values(spark, [(f"f{h}", 1, 0, h, "tp", None, 9, mm) for h, mm in ((0, 0.0), (6, 25.4), (12, 50.8), (24, 50.8))])
    out = forecasts.model_forecast(df, cells, "hrrr", "precip6hr").orderBy("forecast_hour").collect()
    assert [(r.precip_accum, r.precip_6h) for r in out] == [(0.0, None), (1.0, 1.0), (2.0, 1.0), (2.0, None)]


def test_percentiles(spark, cells):
    df = values(
        spark,
        [("f24", 1, 0, 24, "x", None, 9, 0.0), ("f24", 2, 0, 24, "apcp", 5, 9, 25.4), ("f24", 3, 0, 24, "apcp", 95, 9, 50.8)],
    )
    (row,) = forecasts.model_forecast(df, cells, "nbmqmd", "precip24hr").collect()
    assert (row.station_id, row.init_time, row.qpf_p5, row.qpf_p50, row.qpf_p95) == ("C", DAY, 1.0, None, 2.0)


def test_analysis_uses_ten_metre_instants(spark, cells):
    df = values(spark, [("u", 1, 0, 0, "si10", None, 9, 10.0), ("u", 2, 0, 0, "i10fg", None, 9, 20.0)]).withColumns(
        {"level_type": F.lit("heightAboveGround"), "step_type": F.when(F.col("var") == "si10", "instant").otherwise("max"), "level": F.lit(10)}
    )
    (row,) = forecasts.model_forecast(df, cells, "urma", "Wind").collect()
    assert (row.wind_speed_kt, row.wind_gust_kt, row.forecast_hour) == (19.44, None, 0)


def test_database_wind_with_and_without_direction(spark, cells):
    df = values(
        spark,
        [
            ("wspd/1", 1, 0, 6, "si10", None, 9, 10.0), ("wspd/1", 1, 1, 12, "si10", None, 9, 20.0),
            ("wspd/2", 1, 0, 6, "si10", None, 9, 30.0), ("wdir/1", 1, 0, 6, "wdir10", None, 9, 270.4),
        ],
    )
    pairs = spark.createDataFrame([("wspd/1", "wdir/1"), ("wspd/2", None)], "file string, direction_file string")
    out = forecasts.ndfd_forecast(df, cells, "Wind", pairs).collect()
    assert sorted((r.forecast_hour, r.wind_speed_kt, r.wind_dir_deg) for r in out) == [(6, 19.44, 270.0), (6, 58.32, None)]


def test_direction_file_is_the_later_of_two(spark):
    def files(*minutes):
        return spark.createDataFrame([(f"f{m}", DAY + timedelta(minutes=m)) for m in minutes], "path string, stamp timestamp")

    out = forecasts.pair_files(files(2, 60, 100), files(1, 3, 62, 103)).collect()
    assert {r.file: r.direction_file for r in out} == {"f2": "f3", "f60": "f62", "f100": None}


def test_verification_from_monthly_files(spark, tmp_path):
    fspec = DatasetSpec("valid_time", "station_id", {"speed": "wind_speed_kt", "gust": "wind_gust_kt"})
    ospec = DatasetSpec("seen", "stid", {"speed": "spd"})
    f = [("A", hour(h), float(h), 0.0) for h in (0, 6, 12, 800)] + [("B", hour(6), 1.0, 0.0), (None, hour(6), 1.0, 0.0)]
    o = [("A", hour(6) + timedelta(minutes=20), 10.0), ("A", hour(12) + timedelta(minutes=31), 1.0), ("B", hour(6), 2.0)]
    for name, rows, schema in (
        ("nbm", f, "station_id string, valid_time timestamp, wind_speed_kt double, wind_gust_kt double"),
        ("obs", o, "stid string, seen timestamp, spd double"),
    ):
        path = tmp_path / f"2025_01_{name}_wind_archive.parquet"
        spark.createDataFrame(rows, schema).write.parquet(str(path))
    both = MonthlyArchive(str(tmp_path), "NBM", fspec), MonthlyArchive(str(tmp_path), "obs", ospec)
    days = {"first": date(2025, 1, 1), "last": date(2025, 2, 28)}
    wide = verification.verify(spark, *both, "Wind", **days, units=Units("m/s", "kt", True))
    assert wide.columns == ["valid_time", "station_id", "forecast_speed", "forecast_gust", "observed_speed"]
    got = {(r.station_id, r.valid_time): r.observed_speed for r in wide.collect()}
    assert got == {
        ("A", DAY): None, ("A", hour(6)): 19.4384, ("A", hour(12)): None, ("A", hour(800)): None,
        ("B", hour(6)): 2 * 1.94384,
    }
    (score,) = score_all_metrics(wide).collect()
    assert score["count"] == 2 and score.rmse >= abs(score.bias) and score.rmse >= score.mae
    assert verification.choose_metric(wide, "gust") == "speed"
    one = verification.verify(spark, *both, "Wind", **days, stations=["B"])
    assert one.count() == 1
    with pytest.raises(ValueError):
        verification.verify(spark, *both, "Wind", first=date(2025, 2, 1), last=date(2025, 1, 1))


def test_observation_elements(spark):
    nothing = spark.createDataFrame([], "payload string")
    attributes = spark.createDataFrame([], "stid string, zone string, cwa string")
    assert observations.observations(nothing, attributes, "Wind").columns[-3:] == [
        "obs_wind_dir_deg",
        "obs_wind_speed_kts",
        "obs_wind_gust_kts",
    ]
    assert observations.observations(nothing, attributes, "precip6hr").count() == 0
    assert "tmin" in observations.observations(nothing, attributes, "mint").columns
    with pytest.raises(ValueError):
        observations.observations(nothing, attributes, "snow6hr")


# -- names, calendars, rules -------------------------------------------------------


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "name, lead",
    [
        ("x/blend.t01z.core.f005.ak.grib2", 5),
        ("hrrr.t00z.wrfsfcf18.ak.grib2", 18),
        ("hrrr.t00z.wrfsfcf18", 18),
        ("model_f7_x", 7),
        ("f1234", None),
        ("nothing", None),
    ],
)
def test_lead_in_a_name(spark, name, lead):
    assert one(spark, names.forecast_hour(F.lit(name))) == lead


@pytest.mark.parametrize("lead, label", [(30, "6-30 hour acc fcst"), (48, "1-2 day acc fcst"), (0, None), (6, "0-6 hour acc fcst")])
def test_day_labels(spark, lead, label):
    assert one(spark, names.day_accumulation_label(F.lit(lead))) == label


def test_three_day_labels_begin_with_the_run(spark):
    assert one(spark, names.day_accumulation_label(F.lit(48), 72)) is None
    assert one(spark, names.day_accumulation_label(F.lit(96), 72)) == "1-4 day acc fcst"


def test_annotated_accumulations(spark):
    line = ":ASNOW:surface:23-29 hour acc@( fcst, dt=6 hour ),missing=0:50% level"
    matches = F.regexp_like(F.lit(line), names.annotated_accumulation_pattern(F.lit(29), 6))
    assert one(spark, matches) is True
    assert one(spark, names.annotated_accumulation_pattern(F.lit(5), 6)) is None


def test_urls_there_and_back(spark):
    run = F.lit(datetime(2025, 1, 1, 7))
    blend = manifest.file_url("https://x", "nbm", run, F.lit(5))
    assert one(spark, blend) == "https://x/blend.20250101/07/core/blend.t07z.core.f005.ak.grib2"
    assert list(one(spark, F.array(*names.run_date_and_hour(blend, F.lit("nbm"))))) == ["blend.20250101", "07"]
    hrrr = manifest.file_url("https://x", "hrrr", run, F.lit(6))
    assert one(spark, hrrr) == "https://x/hrrr.20250101/alaska/hrrr.t07z.wrfsfcf06.ak.grib2"
    assert list(one(spark, F.array(*names.run_date_and_hour(hrrr, F.lit("hrrr"))))) == ["20250101", "07"]
    urma = manifest.file_url("https://x", "urma", run, F.lit(0))
    assert list(one(spark, F.array(*names.run_date_and_hour(urma, F.lit("urma"))))) == ["20250101", "07"]
    with pytest.raises(NotImplementedError):
        manifest.file_url("https://x", "gfs", run, F.lit(0))


def test_archive_names(spark):
    name = names.archive_name(2025, 3, "NBM", "Wind", "{YYYY}_{MM}_{model}_{element}_archive.parquet")
    assert name == "2025_03_nbm_wind_archive.parquet"
    assert tuple(one(spark, names.archive_name_parts(F.lit(f"s3://b/{name}")))) == (2025, 3, "nbm", "wind")
    assert names.archive_name(2025, 3, "nbm", "Wind", "{model}-{element}", "upper") == "NBM-WIND"
    assert names.archive_name(2025, 3, "nBm", "Wind", "{model}-{element}", "asis") == "nBm-Wind"


def test_compact_times(spark):
    parsed = [one(spark, times.parse_compact(F.lit(t))) for t in ("20250102", "2025010203", "202501020304", "2025", "2025010x")]
    assert parsed == [datetime(2025, 1, 2), datetime(2025, 1, 2, 3), datetime(2025, 1, 2, 3, 4), None, None]
    assert one(spark, times.parse_day(F.lit("202501020304"))) == datetime(2025, 1, 2)


def test_months_and_chunks():
    assert times.months_between(date(2024, 11, 30), date(2025, 2, 1)) == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]
    chunks = times.month_chunks(datetime(2025, 1, 31), datetime(2025, 4, 1))
    assert [c[0].day for c in chunks] == [31, 28, 28]
    assert chunks[0][1] == datetime(2025, 2, 27, 23, 59) and chunks[-1][1] == datetime(2025, 4, 1)
    tens = times.ten_day_chunks(datetime(2025, 2, 1, 6), datetime(2025, 3, 2))
    assert [(s.day, s.hour, e.day, e.hour) for s, e in tens] == [
        (1, 6, 11, 5), (11, 6, 21, 5), (21, 6, 28, 23), (1, 0, 2, 0),
    ]


def test_rules():
    rules.validate("nbm", "Wind", 1, 19)
    for wrong in (("gfs", "Wind"), ("nbm", "Gust"), ("nbm", "Wind", 2)):
        with pytest.raises(ValueError):
            rules.validate(*wrong)
    counts = {k: len(rules.leads(*k)) for k in (("nbm", "Wind"), ("nbmqmd", "precip24hr"), ("nbmqmd", "precip6hr"), ("hrrr", "Wind"), ("urma", "Wind"), ("nbm", "snow6hr"), ("nbmqmd_exp", "Gust"))}
    assert list(counts.values()) == [20, 14, 20, 7, 1, 25, 19]
    assert 77 not in rules.leads("nbm", "snow24hr") and rules.leads("nbm_exp", "snow72hr")[:2] == [83, 89]


def test_first_present_column(spark):
    df = spark.createDataFrame([(1, 2)], "tp_total int, other int")
    assert accumulate.first_present(df, ["precip_accum", "tp_total"]) == "tp_total"
    assert accumulate.first_present(df, ["precip_accum"]) is None


def test_expected_files_are_checked_against_a_listing(spark):
    windows = spark.createDataFrame([(DAY, hour(6))], "start timestamp, end timestamp")
    expected = manifest.expected_files(windows, "hrrr", "Wind", "https://x")
    assert expected.count() == 14
    listing = expected.where("forecast_hour < 24").select(F.concat("url", F.lit(".idx")).alias("path"))
    listing = listing.union(expected.where("forecast_hour = 48").select("url"))
    assert manifest.available_files(expected, listing).count() == 4
    assert manifest.missing_files(expected, listing).count() == 10
    assert manifest.availability(expected, listing).first()[:] == (4, 10)


def test_analyses_are_probed_themselves(spark):
    windows = spark.createDataFrame([(DAY, hour(6))], "start timestamp, end timestamp")
    expected = manifest.expected_files(windows, "urma", "Wind", "https://x")
    listing = expected.where("hour(init_time) = 3").select(F.col("url").alias("path"))
    assert manifest.available_files(expected, listing).count() == 1
    assert manifest.availability(expected, listing).first()[:] == (1, expected.count() - 1)


def test_database_listing(spark):
    def listed(folder, component, prefix, stamp):
        return (f"s3://b/{component}/{folder}/{prefix}_KWBN_{stamp}",)

    rows = [
        listed("2025/01/02", "wspd", "YCRZ98", "202501021147"),
        listed("2025/01/02", "wdir", "YBRZ97", "202501022347"),
        listed("2025/01/01", "wspd", "YCRZ98", "202501011147"),  # before the look-back
        listed("2025/01/03", "wspd", "YCRZ98", "202501031247"),  # another hour
        listed("2025/01/03", "wspd", "YBRZ98", "202501031147"),  # another component's prefix
        listed("2025/01/03", "wspd", "YCRZ98", "2025010311"),  # malformed
        listed("2025/13/03", "wspd", "YCRZ98", "202501031147"),  # no such month
    ]
    out = manifest.ndfd_files(spark.createDataFrame(rows, "path string"), "Wind", datetime(2025, 1, 5), datetime(2025, 1, 6))
    assert sorted(r.component for r in out.collect()) == ["wdir", "wspd"]


def test_chunk_assignment(spark):
    chunks = manifest.chunk_table(spark, times.month_chunks(datetime(2025, 1, 15), datetime(2025, 3, 1)))
    rows = spark.createDataFrame([(datetime(2025, 1, 1),), (datetime(2025, 2, 1),), (datetime(2025, 2, 15),)], "t timestamp")
    out = manifest.assign_chunks(rows, chunks, "t").orderBy("t").collect()
    assert [(r.t.day, r.archive_month) for r in out] == [(1, 1), (15, 2)]


def test_run_intervals_under_any_name_of_the_total(spark):
    start = datetime(2025, 1, 1)
    rows = [("A", start, start + timedelta(hours=h), h, v) for h, v in ((0, 0.0), (6, 1.5), (12, 1.25))]
    for name in ("precip_accum", "APCP_total"):
        df = spark.createDataFrame(rows, f"station_id string, init_time timestamp, valid_time timestamp, forecast_hour int, {name} double")
        found = forecasts.with_run_intervals(df, "hrrr", "precip6hr").orderBy("forecast_hour").collect()
        assert [r.precip_6h for r in found] == [None, 1.5, 0.0]
    assert forecasts.with_run_intervals(df.withColumnRenamed("APCP_total", "amount"), "hrrr", "precip6hr").columns[-1] == "amount"
    assert forecasts.with_run_intervals(df, "nbm", "Wind").columns == df.columns


def test_requests_at_hours_at_which_the_model_runs(spark):
    rows = [("nbm", "Wind", 1), ("nbm", "Wind", 2), ("nbm", "Fog", 1), ("hrrr", "Wind", 2), ("urma", "Wind", None), ("other", "Wind", 1)]
    requests = spark.createDataFrame(rows, "model string, element string, hour int")
    assert sorted((r.model, r.hour) for r in rules.valid_requests(requests, run_hour="hour").collect()) == [("hrrr", 2), ("nbm", 1)]
    assert rules.valid_requests(requests).count() == 4


def test_chunks_of_any_length(spark):
    rng = random.Random(8)
    start = datetime(2025, 3, 1)

    def at(seconds):
        return start + timedelta(seconds=seconds)

    chunks = [(at(a), at(a + int(10 ** rng.uniform(0, 7)))) for a in (rng.randrange(10**6) for _ in range(80))]
    chunks += [(at(5), at(5)), (at(9), at(1)), (None, at(1)), (at(1), None), (datetime(1970, 1, 1), datetime(2100, 1, 1))]
    times_ = [at(rng.randrange(-(10**5), 2 * 10**6)) for _ in range(400)] + [None]
    frame = spark.createDataFrame(chunks, "chunk_start timestamp, chunk_end timestamp")
    got = manifest.assign_chunks(spark.createDataFrame(list(enumerate(times_)), "id long, t timestamp"), frame, "t")
    want = [
        (i, t, a, b) for i, t in enumerate(times_) for a, b in chunks
        if t and a and b and a <= b and a <= t < b + timedelta(minutes=1)
    ]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert manifest.assign_chunks(got.select("id", "t"), frame.where("false"), "t").count() == 0
