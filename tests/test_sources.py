"""Readers and the archive sink, on small files."""

import json
from datetime import date, datetime, timedelta

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stationcast.operators import dedup
from stationcast.operators.messages import byte_ranges, select_element, select_messages
from stationcast.sources import archive, files, observations, stations

DAY = datetime(2025, 1, 1)


def payloads(spark, *documents):
    return spark.createDataFrame([(json.dumps(d),) for d in documents], "payload string")


# -- observation JSON ------------------------------------------------------------


def test_series_shorter_and_longer_than_the_times(spark):
    raw = {
        "STATION": [
            {
                "STID": "PAJN",
                "LATITUDE": "58.3",
                "OBSERVATIONS": {
                    "date_time": ["2025-01-01T00:00:00Z", "2025-01-01T01:00:00Z"],
                    "wind_speed_set_1": [4.5],
                    "wind_direction_set_1": [10, None, 30],
                },
            },
            {"STID": "NONE", "OBSERVATIONS": {"date_time": []}},
            {"STID": "NULL", "OBSERVATIONS": {}},
            {"STID": "BARE"},
        ]
    }
    names = {"wind_speed_set_1": "s", "wind_direction_set_1": "d", "wind_gust_set_1": "g"}
    rows = observations.parse_timeseries(payloads(spark, raw, {"STATION": []}, {}), names).collect()
    assert [(r.stid, r.lat, r.elev, r.s, r.d, r.g) for r in rows] == [
        ("PAJN", 58.3, None, 4.5, 10.0, None),
        ("PAJN", 58.3, None, None, None, None),
    ]


def test_temperature_series_is_chosen_by_name_and_order(spark):
    def station(stid, **series):
        return {"STID": stid, "OBSERVATIONS": {"date_time": ["2025-01-01T00:00:00Z"], **series}}

    raw = {
        "STATION": [
            station("A", air_temp_b=[1], air_temp_a=[2]),
            station("B", air_temp_b=[1], air_temp_set_1=[3]),
            station("C", dew_point=[1]),
            station("D", air_temp_set_1=["M"]),
        ]
    }
    rows = observations.parse_temperatures(payloads(spark, raw)).collect()
    assert {r.stid: r.temp for r in rows} == {"A": 1.0, "B": 3.0, "D": None}


def test_precipitation_reports(spark):
    raw = {
        "UNITS": {"precipitation": "Inches"},
        "STATION": [
            {
                "STID": "A",
                "OBSERVATIONS": {
                    "precipitation": [
                        {"last_report": "2025-01-01T06:00:00Z", "total": 0.25},
                        {"last_report": "2025-01-01T12:00:00Z", "total": None},
                    ]
                },
            },
            {"STID": "B", "OBSERVATIONS": {}},
        ],
    }
    rows = observations.parse_precipitation(payloads(spark, raw)).collect()
    assert [(r.stid, r.end_time.hour, r.interval_precip, r.precip_units) for r in rows] == [
        ("A", 6, 0.25, "Inches"),
        ("A", 12, None, "Inches"),
    ]


# -- stations ----------------------------------------------------------------------


METADATA = {
    "STATION": [
        {"STID": "A", "NAME": "Ay", "LATITUDE": "60.5", "LONGITUDE": -150, "ELEVATION": "x", "NWSZONE": "Z1", "CWA": "AFC"},
        {"STID": "B", "NAME": "Be", "LATITUDE": 61, "LONGITUDE": "-151"},
    ]
}


def test_station_table_is_created_once(spark, tmp_path):
    path = str(tmp_path / "stations")
    first = stations.ensure_stations(spark, path, payloads(spark, METADATA)).collect()
    assert sorted(first) == [("A", "Ay", 60.5, -150.0, None), ("B", "Be", 61.0, -151.0, None)]
    again = stations.ensure_stations(spark, path, payloads(spark, {"STATION": []})).collect()
    assert sorted(again) == sorted(first)


def test_attribute_lookup_keeps_unknown_stations(spark):
    attributes = stations.parse_attributes(payloads(spark, METADATA, METADATA))
    rows = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3), (None, 4)], "stid string, n int")
    got = {r.n: (r.NWSZONE, r.NWSCWA) for r in stations.with_attributes(rows, attributes).collect()}
    assert got == {1: ("Z1", "AFC"), 2: (None, None), 3: (None, None), 4: (None, None)}


def test_payload_files(spark, tmp_path):
    (tmp_path / "meta.json").write_text(json.dumps(METADATA, indent=1))
    assert stations.parse_stations(stations.read_payloads(spark, str(tmp_path))).count() == 2


# -- archive -----------------------------------------------------------------------


def test_projection_guard(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert archive.project(df, ["a", "z"]).columns == ["a"]
    assert archive.project(df, ["z"]).columns == ["a", "b"]
    assert archive.project(df, None).columns == ["a", "b"]


def test_filters_pass_over_the_unknown(spark):
    df = spark.range(6)
    assert archive.apply_filters(df, [("nope", "==", 1), ("id", "~", 1)]).count() == 6
    assert archive.apply_filters(df, [("id", ">", 1), ("id", "<=", 4), ("id", "in", (2, 3, 5))]).count() == 2
    assert archive.apply_filters(df, None).count() == 6


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.lit("x").alias("s"), F.lit(1.0).alias("unused")).write.parquet(path)
    plan = archive.read_archive(spark, path, columns=["id"], filters=[("s", "==", "x")])._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "EqualTo(s,x)" in text and "unused" not in text


def test_month_files_that_exist(spark, tmp_path):
    for month, n in ((1, 3), (3, 5)):
        table = pa.table({"station_id": ["A"] * n, "t": pa.array([pd.Timestamp("2025-01-01 00:00:01")] * n, pa.timestamp("ns"))})
        pq.write_table(table, tmp_path / f"2025_{month:02d}_nbm_wind_archive.parquet")
    months = [(2025, 1), (2025, 2), (2025, 3)]
    df = archive.read_months(spark, str(tmp_path), months, "NBM", "Wind", times=["t"])
    assert df.count() == 8
    assert df.first().t == datetime(2025, 1, 1, 0, 0, 1)
    assert archive.read_months(spark, str(tmp_path), [(2025, 2)], "NBM", "Wind", schema=df.schema).count() == 0
    assert archive.read_months(spark, str(tmp_path), [], "NBM", "Wind", schema=df.schema).columns == df.columns
    with pytest.raises(FileNotFoundError):
        archive.read_months(spark, str(tmp_path), [(2025, 2)], "NBM", "Wind")


def rows(spark, *values):
    return spark.createDataFrame(list(values), "stid string, valid_time timestamp, v double")


def stored(spark, path):
    return sorted((r.stid, r.valid_time, r.v or -1.0) for r in archive.read_archive(spark, path).collect())


def test_appending_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "a")
    first = rows(spark, ("A", DAY, 1.0), ("A", DAY, None), ("A", DAY, 1.0), ("B", DAY + timedelta(days=40), 2.0))
    for _ in range(2):
        archive.append_archive(first, path)
    assert len(stored(spark, path)) == 3
    # A later window that overlaps the archive adds only what is new; revised values
    # stay beside the old ones.
    archive.append_archive(rows(spark, ("A", DAY, 1.0), ("A", DAY, 5.0), ("C", DAY, None)), path)
    assert len(stored(spark, path)) == 5
    summary = archive.month_summary(archive.read_archive(spark, path)).collect()
    assert sorted((r.year, r.month, r["rows"]) for r in summary) == [(2025, 1, 4), (2025, 2, 1)]


def test_rows_without_a_time_are_kept_once(spark, tmp_path):
    path = str(tmp_path / "a")
    for _ in range(3):
        archive.append_archive(rows(spark, ("A", None, 1.0), ("A", DAY, 1.0)), path)
    assert archive.read_archive(spark, path).count() == 2


def test_appending_by_key_keeps_the_archived_row(spark, tmp_path):
    path = str(tmp_path / "a")
    keys = ["stid", "valid_time"]
    archive.append_archive(rows(spark, ("A", DAY, 1.0)), path, keys=keys)
    archive.append_archive(rows(spark, ("A", DAY, 9.0), ("B", DAY, 3.0), ("B", DAY, 2.0)), path, keys=keys, order=["v"])
    assert stored(spark, path) == [("A", DAY, 1.0), ("B", DAY, 2.0)]


def test_appending_other_columns(spark, tmp_path):
    path = str(tmp_path / "a")
    archive.append_archive(rows(spark, ("A", DAY, 1.0)), path)
    more = spark.createDataFrame([("A", DAY, 7.0)], "stid string, valid_time timestamp, gust double")
    archive.append_archive(more, path)
    archive.append_archive(more, path)
    both = spark.read.option("mergeSchema", "true").parquet(path)
    assert sorted((r.v or 0, r.gust or 0) for r in both.collect()) == [(0, 7.0), (1.0, 0)]


@pytest.mark.parametrize("fewer_first", [True, False])
def test_archive_keeps_columns_and_rows_that_differ_by_month(spark, tmp_path, fewer_first):
    path = str(tmp_path / "a")
    january = rows(spark, ("A", datetime(2025, 1, 5), 1.0))
    wide = "stid string, valid_time timestamp, v double, gust double"
    february = spark.createDataFrame([("A", datetime(2025, 2, 5), 2.0, 9.0)], wide)
    for batch in (january, february) if fewer_first else (february, january):
        archive.append_archive(batch, path)
    archive.append_archive(rows(spark, ("A", datetime(2025, 2, 5), 2.0)), path)
    held = archive.read_archive(spark, path)
    assert sorted((r.v, r.gust or 0) for r in held.collect()) == [(1.0, 0), (2.0, 0), (2.0, 9.0)]
    between = archive.read_between(spark, path, date(2025, 2, 1), date(2025, 2, 28), columns=["stid", "gust"])
    assert between.columns == ["stid", "gust"] and between.count() == 2


def test_compaction_keeps_rows_and_lowers_files(spark, tmp_path):
    path = str(tmp_path / "a")
    for value in (1.0, 2.0, 3.0):
        archive.append_archive(rows(spark, ("A", DAY, value), ("B", None, value)), path)
    before = sorted(map(str, archive.read_archive(spark, path).collect()))
    many = len(archive.read_archive(spark, path).inputFiles())
    archive.compact_months(spark, path, [(DAY.year, DAY.month), (1999, 1)])
    assert sorted(map(str, archive.read_archive(spark, path).collect())) == before
    assert len(archive.read_archive(spark, path).inputFiles()) == many - 2
    archive.compact_months(spark, path, [(None, None)])
    assert sorted(map(str, archive.read_archive(spark, path).collect())) == before


def scanned(df):
    """Rows that come out of the scan."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    plans = [leaves.apply(k) for k in range(leaves.size())]
    while any(p.nodeName().startswith(("AdaptiveSparkPlan", "ResultQueryStage", "ShuffleQueryStage")) for p in plans):
        plans = [q for p in plans for q in unfolded(p)]
    return sum(p.metrics().apply("numOutputRows").value() for p in plans if "Scan" in p.nodeName())


def unfolded(plan):
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        inner = plan.executedPlan().collectLeaves()
    elif "QueryStage" in plan.nodeName():
        inner = plan.plan().collectLeaves()
    else:
        return [plan]
    return [inner.apply(k) for k in range(inner.size())]


def many_rows(spark, n=20_000, stations=400):
    cells = spark.range(n).select(
        F.format_string("S%04d", F.col("id") % stations).alias("stid"),
        (F.lit(DAY).cast("timestamp") + F.make_dt_interval(mins=(F.col("id") / stations).cast("int") * 30)).alias("valid_time"),
        (F.col("id") * 37 % 1000).cast("double").alias("v"),
    )
    return cells


@pytest.mark.parametrize("compact", [False, True])
def test_one_station_is_read_from_few_row_groups(spark, tmp_path, compact):
    path = str(tmp_path / "a")
    batch = many_rows(spark).repartition(5)
    if compact:
        archive.append_archive(batch, path)
        archive.compact_months(spark, path, [(2025, 1), (2025, 2)], cluster=["stid", "valid_time"], row_group_bytes=1 << 14)
    else:
        archive.append_archive(batch, path, cluster=["stid", "valid_time"], row_group_bytes=1 << 14)
    files = sorted((tmp_path / "a").glob("year=*/month=*/*.parquet"))
    groups = [g for f in files for g in (pq.ParquetFile(f).metadata.row_group(k) for k in range(pq.ParquetFile(f).metadata.num_row_groups))]
    bounds = [(g.column(0).statistics.min, g.column(0).statistics.max) for g in groups]
    assert len(groups) > 20 and sum(a <= "S0123" <= b for a, b in bounds) <= 2
    one = archive.read_archive(spark, path, filters=[("stid", "==", "S0123")])
    assert scanned(one) < 2_000 and one.count() == 50
    assert archive.read_layout(spark, path).cluster == ("stid", "valid_time")
    assert archive.read_archive(spark, path).count() == 20_000


def test_rows_of_one_station_and_time_are_split_over_files(spark, tmp_path):
    path = str(tmp_path / "a")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        archive.append_archive(rows(spark, *[("A", DAY, float(k)) for k in range(900)]), path, cluster=["stid", "valid_time"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "a").glob("year=*/month=*/*.parquet")]
    assert sum(sizes) == 900 and len(sizes) == 3 and max(sizes) < 600


def test_key_appends_read_what_may_be_repeated(spark, tmp_path):
    path, keys = str(tmp_path / "a"), ["stid", "valid_time"]
    archive.append_archive(many_rows(spark), path, keys=keys, row_group_bytes=1 << 14)
    held = archive.read_archive(spark, path)
    some = many_rows(spark).where("stid IN ('S0007', 'S0300')").withColumn("v", F.lit(-1.0))
    late = many_rows(spark).where("stid > 'S0390'").withColumn("v", F.lit(-1.0))
    read = [scanned(archive.possible_rows(held, batch, keys)) for batch in (some, late)]
    assert all(n < 6_000 for n in read)
    for batch in (some, late, some.unionByName(rows(spark, ("S0007", DAY + timedelta(days=3, minutes=1), -2.0)))):
        archive.append_archive(batch, path, keys=keys)
    stored_rows = archive.read_archive(spark, path)
    assert stored_rows.count() == 20_001 and stored_rows.where("v < 0").count() == 1


def test_keys_without_value_or_order_are_compared_too(spark, tmp_path):
    path, keys = str(tmp_path / "a"), ["stid", "valid_time", "tags"]
    kind = "stid string, valid_time timestamp, tags array<int>, v double"
    first = spark.createDataFrame([(None, DAY, [1], 1.0), ("A", None, [1], 1.0), ("A", DAY, None, 1.0)], kind)
    second = spark.createDataFrame([(None, DAY, [1], 2.0), ("A", None, [1], 2.0), ("A", DAY, None, 2.0), ("A", DAY, [2], 2.0), (None, None, None, 2.0)], kind)
    for batch in (first, second, second):
        archive.append_archive(batch, path, keys=keys, cluster=["stid", "valid_time"])
    assert sorted(r.v for r in archive.read_archive(spark, path).collect()) == [1.0, 1.0, 1.0, 2.0, 2.0]


def test_reads_take_the_columns_from_the_layout(spark, tmp_path):
    path = str(tmp_path / "a")
    archive.append_archive(rows(spark, ("A", DAY, 1.0)), path)
    more = spark.createDataFrame([("A", datetime(2025, 3, 1), 7.0)], "stid string, valid_time timestamp, gust double")
    archive.append_archive(more, path)
    # A file that can't be opened, in a month that isn't asked for.
    (tmp_path / "a" / "year=2025" / "month=2").mkdir()
    (tmp_path / "a" / "year=2025" / "month=2" / "part-broken.parquet").write_bytes(b"nothing")
    held = archive.read_archive(spark, path)
    assert held.columns == ["stid", "valid_time", "v", "gust", "year", "month"]
    assert [(r.v, r.gust) for r in held.where("month = 3").collect()] == [(None, 7.0)]


def test_files_of_others_are_merged(spark, tmp_path):
    path = str(tmp_path / "a")
    rows(spark, ("A", DAY, 1.0)).withColumns({"year": F.lit(2025), "month": F.lit(1)}).write.partitionBy("year", "month").parquet(path)
    other = spark.createDataFrame([("B", DAY, 3)], "stid string, valid_time timestamp, n int")
    assert archive.read_archive(spark, path).count() == 1 and archive.read_layout(spark, path) is None
    archive.append_archive(other, path)
    assert archive.read_archive(spark, path).columns == ["stid", "valid_time", "v", "n", "year", "month"]
    late = spark.createDataFrame([("C", DAY, "x")], "stid string, valid_time timestamp, kind string")
    late.withColumns({"year": F.lit(2025), "month": F.lit(1)}).write.mode("append").partitionBy("year", "month").parquet(path)
    assert "kind" not in archive.read_archive(spark, path).columns
    archive.refresh_layout(spark, path)
    assert sorted((r.stid, r.v, r.n, r.kind) for r in archive.read_archive(spark, path).collect()) == [("A", 1.0, None, None), ("B", None, 3, None), ("C", None, None, "x")]


def test_other_types_are_refused(spark, tmp_path):
    path = str(tmp_path / "a")
    archive.append_archive(rows(spark, ("A", DAY, 1.0)), path)
    with pytest.raises(ValueError, match="v is string, archived as double"):
        archive.append_archive(spark.createDataFrame([("A", DAY, "x")], "stid string, valid_time timestamp, v string"), path)
    assert archive.read_archive(spark, path).count() == 1


def test_missing_equals_missing_when_appending(spark):
    old = spark.createDataFrame([("A", None, 1), (None, "x", 2)], "a string, b string, n int")
    new = spark.createDataFrame([("A", None, 1), (None, "x", 5)], "a string, b string, n int")
    assert dedup.append_distinct(old, new).count() == 3
    assert sorted(r.n for r in dedup.append_by_key(old, new, ["a", "b"]).collect()) == [1, 2]
    assert dedup.rows_not_in(new, old).count() == 1
    assert dedup.rows_not_in(new, old, ["a", "b"]).count() == 0


def test_peek_reads_the_first_file(spark, tmp_path):
    for name, n in (("b", 4), ("a", 3)):
        pq.write_table(pa.table({"n": list(range(n))}), tmp_path / f"{name}.parquet")
    assert archive.peek(spark, str(tmp_path)).count() == 3
    assert archive.peek(spark, str(tmp_path), rows=2).count() == 2


# -- gridded files -----------------------------------------------------------------


INDEX = """
1:0:d=2025010101:WIND:10 m above ground:5 hour fcst:
2:100:d=2025010101:WIND:10 m above ground:5 hour fcst:ens std dev
3:250:d=2025010101:WDIR:10 m above ground:5 hour fcst:
4:300:d=2025010101:GUST:10 m above ground:5 hour fcst:
"""


def test_inventories_on_disk(spark, tmp_path):
    (tmp_path / "blend.20250101").mkdir()
    (tmp_path / "blend.20250101" / "blend.t01z.core.f005.ak.grib2.idx").write_text(INDEX)
    (tmp_path / "blend.20250101" / "blend.t01z.core.f011.ak.grib2.idx").write_text(INDEX.split("3:250")[0])
    (tmp_path / "blend.20250101" / "other.txt").write_text("no inventory")
    inventories = files.read_inventories(spark, str(tmp_path))
    assert byte_ranges(inventories).count() == 6
    chosen = select_element(inventories, "nbm", "Wind").orderBy("line_no").collect()
    assert [r.byte_range for r in chosen] == ["0-99", "250-299", "300-"]
    assert {r.file.rsplit("/", 1)[-1] for r in chosen} == {"blend.t01z.core.f005.ak.grib2"}
    listed = files.list_files(spark, str(tmp_path), "*.idx")
    assert listed.count() == 2 and listed.where("length > 0").count() == 2


def test_byte_ranges_follow_the_whole_file(spark):
    lines = ["1:0:a", "2:100:b", "3:250:a"]
    df = spark.createDataFrame([("f", lines)], "file string, lines array<string>")
    chosen = select_messages(df, [":a"]).orderBy("line_no").collect()
    assert [(r.byte_range, r.line_no) for r in chosen] == [("0-99", 1), ("250-", 3)]


def test_required_phrases_are_optional(spark):
    lines = ["1:0:x:UGRD:10 m above ground:", "2:9:x:VGRD:10 m above ground:", "3:20:x:GUST:surface:"]
    df = spark.createDataFrame([("hrrr.t00z.wrfsfcf12.ak.grib2", lines)], "file string, lines array<string>")
    assert select_element(df, "hrrr", "Wind").count() == 3
    # The gust lies at the surface, so asking for ten metres leaves the file incomplete.
    assert select_element(df, "hrrr", "Wind", required=True).count() == 0


def test_lines_that_share_a_range_count_once(spark):
    lines = ["1.1:0:a", "1.2:0:a", "1.3:0:a", "2:9:b"]
    df = spark.createDataFrame([("f", lines)], "file string, lines array<string>")
    chosen = select_messages(df, [":a"]).orderBy("line_no").collect()
    assert [(r.byte_range, r.line_no) for r in chosen] == [("0--1", 2), ("0-8", 3)]


def test_lines_without_bytes_do_not_break_the_file(spark):
    df = spark.createDataFrame([("f", ["1:0:a", "", "x:y:a"])], "file string, lines array<string>")
    assert [r.range_start for r in byte_ranges(df).orderBy("line_no").collect()] == [0, None, None]


def test_only_dated_folders_are_listed(spark, tmp_path):
    names = ["wspd/2025/01/02/YCRZ98_KWBN_202501021147", "wdir/2025/01/03/YBRZ97_KWBN_202501032347",
             "wspd/2025/01/01/YCRZ98_KWBN_202501011147", "wspd/2025/01/02/YSRZ98_KWBN_202501021147"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    window = datetime(2025, 1, 5), datetime(2025, 1, 6)
    found = files.list_ndfd(spark, str(tmp_path), "Wind", *window)
    assert sorted((r.component, r.stamp.day) for r in found.collect()) == [("wdir", 3), ("wspd", 2)]
    assert files.list_ndfd(spark, str(tmp_path), "maxt", *window).count() == 0


def test_all_messages_of_an_analysis_are_taken(spark):
    lines = ["1:0:d=2025010100:UGRD:10 m above ground:anl:", "2:100:d=2025010100:TMP:2 m above ground:anl:"]
    inventory = spark.createDataFrame([("akurma.t00z.2dvaranl_ndfd_3p0.grb2", lines)], "file string, lines array<string>")
    assert sorted(r.byte_range for r in select_element(inventory, "urma", "Wind").collect()) == ["0-99", "100-"]
