"""Grid cells, point extraction, field conversion: parts are cells, suppliers stations."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cells import locate, nearest_cells, ravel, unravel, write_index
from ..operators.points import extract_points, select_fields, with_init_time
from ..plans.forecasts import model_forecast, ndfd_forecast, pair_files, with_run_intervals
from ..rules import PERCENTILES
from ..session import scratch_folder, written
from ..sources import fields
from . import query, table


def grid_of(part: Column) -> Column:
    """Cells lie on two grids."""
    return F.when(F.pmod(part, F.lit(2)) == 0, "g0").otherwise("g1")


def grid(spark: SparkSession, folder: str) -> DataFrame:
    """Parts scattered over 40…80° N, 170…230° E (longitudes counted from 0 to 360)."""
    part = F.col("p_partkey")
    return table(spark, folder, "part").select(
        grid_of(part).alias("grid_id"),
        part.alias("flat"),
        (F.pmod(part * 7919, F.lit(40009)) / 1000 + 40).alias("lat"),
        (F.pmod(part * 104729, F.lit(60013)) / 1000 + 170).alias("lon"),
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers all around the northern half, many of them off the grids."""
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        F.col("s_name").alias("station_id"),
        (F.pmod(key * 7, F.lit(600)) / 10 + 30).alias("latitude"),
        (F.pmod(key * 131, F.lit(3600)) / 10 - 180).alias("longitude"),
    )


CELLS_SQL = """
grid AS (SELECT 'g' || (p_partkey % 2) AS grid_id, p_partkey AS flat,
                (p_partkey * 7919 % 40009) / 1000.0::DOUBLE + 40 AS lat,
                (p_partkey * 104729 % 60013) / 1000.0::DOUBLE + 170 AS lon FROM part),
wrapped AS (SELECT grid_id, flat, lat,
                   CASE WHEN lon < 180 THEN lon ELSE (lon + 180.0::DOUBLE) % 360.0::DOUBLE - 180 END AS lon FROM grid),
stations AS (SELECT s_name AS station_id, (s_suppkey * 7 % 600) / 10.0::DOUBLE + 30 AS latitude,
                    ((s_suppkey * 131 % 3600) / 10.0::DOUBLE - 180 + 180.0::DOUBLE) % 360.0::DOUBLE - 180 AS longitude
             FROM supplier),
ranked AS (
  SELECT grid_id, station_id, flat, {distance} AS distance,
         row_number() OVER (PARTITION BY grid_id, station_id ORDER BY {distance}, flat) AS rn
  FROM wrapped CROSS JOIN stations),
cells AS (SELECT grid_id, station_id, flat, distance FROM ranked WHERE rn = 1)
"""
CHEBYSHEV = "greatest(abs(lat - latitude), abs(lon - longitude))"
EUCLIDEAN = "sqrt((lat - latitude) * (lat - latitude) + (lon - longitude) * (lon - longitude))"


@query("nearest_cells", f"WITH {CELLS_SQL.format(distance=CHEBYSHEV)} SELECT * FROM cells")
def chebyshev(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_cells(grid(spark, folder), stations(spark, folder))


@query(
    "nearest_cells_euclidean",
    f"WITH {CELLS_SQL.format(distance=EUCLIDEAN)} SELECT grid_id, station_id, flat, round(distance, 9) AS distance FROM cells",
)
def euclidean(spark: SparkSession, folder: str) -> DataFrame:
    cells = nearest_cells(grid(spark, folder), stations(spark, folder), metric="euclidean")
    return cells.withColumn("distance", F.round("distance", 9))


@query(
    "cells_from_index",
    f"""WITH {CELLS_SQL.format(distance=CHEBYSHEV)}
SELECT 'chebyshev' AS metric, * FROM cells
UNION ALL SELECT 'euclidean', * FROM (WITH {CELLS_SQL.format(distance=EUCLIDEAN)} SELECT grid_id, station_id, flat, round(distance, 9) FROM cells)""",
)
def from_index(spark: SparkSession, folder: str) -> DataFrame:
    """Two lookups in the stored tiles of one grid."""
    index = write_index(grid(spark, folder), scratch_folder(spark, "tiles"))
    found = [locate(index, stations(spark, folder), metric=m).withColumn("metric", F.lit(m)) for m in ("chebyshev", "euclidean")]
    return found[0].unionByName(found[1].withColumn("distance", F.round("distance", 9)))


def station_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest cells as a written table, as an archive run keeps them."""
    return written(nearest_cells(grid(spark, folder), stations(spark, folder)), "cells")


CELLS = CELLS_SQL.format(distance=CHEBYSHEV)


@query(
    "extract_points",
    f"""WITH {CELLS}
SELECT l_orderkey, l_linenumber, c.station_id, c.grid_id, c.flat, l_extendedprice AS value
FROM lineitem JOIN cells c ON c.flat = l_partkey""",
)
def points(spark: SparkSession, folder: str) -> DataFrame:
    """Field values (line items) at the stations' cells."""
    return extract_points(line_values(spark, folder), station_cells(spark, folder)).select(*POINT_COLUMNS)


POINT_COLUMNS = ["l_orderkey", "l_linenumber", "station_id", "grid_id", "flat", "value"]


def line_values(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        grid_of(F.col("l_partkey")).alias("grid_id"),
        F.col("l_partkey").alias("flat"),
        F.col("l_extendedprice").alias("value"),
    )


@query(
    "extract_points_stored",
    f"""WITH {CELLS}
SELECT l_orderkey, l_linenumber, c.station_id, c.grid_id, c.flat, l_extendedprice AS value
FROM lineitem JOIN cells c ON c.flat = l_partkey""",
)
def stored_points(spark: SparkSession, folder: str) -> DataFrame:
    """The same from fields that are stored in the order of their cells, 64 to a row of the grid."""
    path = scratch_folder(spark, "fields")
    fields.write_fields(line_values(spark, folder), path, nx=64)
    return fields.extract_stored(spark, path, station_cells(spark, folder), nx=64).select(*POINT_COLUMNS)


def field_values(spark: SparkSession, folder: str, *fields: Column, lead: Column, file: Column) -> DataFrame:
    """Grid values from line items: each gives one message per field."""
    lines = table(spark, folder, "lineitem")
    base = F.date_trunc("day", "l_shipdate")
    return lines.select(
        file.alias("file"),
        grid_of(F.col("l_partkey")).alias("grid_id"),
        F.col("l_partkey").alias("flat"),
        lead.cast("int").alias("forecast_hour"),
        (base + F.make_dt_interval(F.lit(0), lead.cast("int"))).alias("valid_time"),
        F.inline(F.array(*fields)),
    )


def message(number: Column, variable: str, value: Column, percentile: Column | None = None) -> Column:
    return F.struct(
        number.cast("long").alias("msg_no"),
        F.lit(variable).alias("var"),
        (percentile if percentile is not None else F.lit(None)).cast("int").alias("percentile"),
        value.cast("double").alias("value"),
    )


def line_file() -> Column:
    """A file per order and line number."""
    return F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


def message_number(i: int) -> Column:
    """Distinct within a file: parts may repeat a line number of an order."""
    return (F.col("l_suppkey") * 1000000 + F.col("l_partkey")) * 10 + i


@query(
    "model_wind_components",
    f"""WITH {CELLS}, lines AS (
  SELECT *, date_trunc('day', l_shipdate) AS init_time, 6 * l_linenumber AS fh,
         (l_quantity - 25) * 1.94384::DOUBLE AS u, (l_extendedprice / 1000 - 50) * 1.94384::DOUBLE AS v,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, date_trunc('day', l_shipdate)
                            ORDER BY l_suppkey) AS rn FROM lineitem)
SELECT c.station_id, init_time, init_time + fh * INTERVAL 1 HOUR AS valid_time, fh AS forecast_hour,
       round_even(l_quantity * 1.9484::DOUBLE, 2) AS wind_gust_kt,
       round_even((270.0::DOUBLE - degrees(atan2(v, u)) + 360.0::DOUBLE) % 360.0::DOUBLE, 0) AS wind_dir_deg,
       round_even(sqrt(u * u + v * v), 2) AS wind_speed_kt
FROM lines JOIN cells c ON c.flat = l_partkey WHERE rn = 1""",
)
def wind_components(spark: SparkSession, folder: str) -> DataFrame:
    """Speed and direction from wind components at the stations."""
    values = field_values(
        spark,
        folder,
        message(message_number(0), "u10", F.col("l_quantity") - 25),
        message(message_number(1), "v10", F.col("l_extendedprice") / 1000 - 50),
        message(message_number(2), "gust", F.col("l_quantity")),
        lead=F.col("l_linenumber") * 6,
        file=line_file(),
    )
    return model_forecast(values, station_cells(spark, folder), "hrrr", "Wind")


@query(
    "model_wind",
    f"""WITH {CELLS}, lines AS (
  SELECT *, date_trunc('day', l_shipdate) AS init_time, 6 * l_linenumber - 1 AS fh,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, date_trunc('day', l_shipdate)
                            ORDER BY l_suppkey) AS rn FROM lineitem)
SELECT c.station_id, init_time, init_time + fh * INTERVAL 1 HOUR AS valid_time, fh AS forecast_hour,
       round_even(l_quantity * 1.94384::DOUBLE, 2) AS wind_speed_kt,
       round_even(l_extendedprice / 7 % 360, 0) AS wind_dir_deg, CAST(NULL AS DOUBLE) AS wind_gust_kt
FROM lines JOIN cells c ON c.flat = l_partkey WHERE rn = 1""",
)
def wind(spark: SparkSession, folder: str) -> DataFrame:
    """Speed and direction as delivered; the files hold no gusts."""
    values = field_values(
        spark,
        folder,
        message(message_number(0), "si10", F.col("l_quantity")),
        message(message_number(1), "wdir10", F.pmod(F.col("l_extendedprice") / 7, F.lit(360.0))),
        message(message_number(2), "t2m", F.col("l_tax")),
        lead=F.col("l_linenumber") * 6 - 1,
        file=line_file(),
    )
    return model_forecast(values, station_cells(spark, folder), "nbm", "Wind")


@query(
    "model_precip_intervals",
    f"""WITH {CELLS}, fields AS (
  SELECT l_partkey, date_trunc('year', l_shipdate) AS init_time, CAST(6 * l_linenumber AS INTEGER) AS fh,
         arg_min(l_extendedprice / 100, l_suppkey * 1000000000 + l_orderkey) AS value
  FROM lineitem GROUP BY 1, 2, 3),
totals AS (
  SELECT c.station_id, init_time, init_time + fh * INTERVAL 1 HOUR AS valid_time, fh AS forecast_hour,
         round_even(value * 0.0393701::DOUBLE, 2) AS precip_accum
  FROM fields JOIN cells c ON c.flat = l_partkey),
earlier AS (SELECT station_id, init_time, valid_time + INTERVAL 6 HOURS AS valid_time, max(precip_accum) AS before
            FROM totals GROUP BY ALL)
SELECT t.*, CASE WHEN precip_accum - before < 0 THEN 0.0
                 ELSE round_even((precip_accum - before) * 100.0::DOUBLE, 0) / 100.0::DOUBLE END AS precip_6h
FROM totals t LEFT JOIN earlier e USING (station_id, init_time, valid_time)""",
)
def precip_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Six-hour amounts from run totals; one run per year of ship dates."""
    values = run_values(spark, folder, "tp", F.col("l_extendedprice") / 100)
    return model_forecast(values, station_cells(spark, folder), "hrrr", "precip6hr")


RUNS_SQL = """
fields AS (
  SELECT l_partkey, date_trunc('year', l_shipdate) AS init_time, CAST(6 * l_linenumber AS INTEGER) AS fh,
         arg_min({value}, l_suppkey * 1000000000 + l_orderkey) AS value
  FROM lineitem GROUP BY 1, 2, 3),
totals AS (
  SELECT c.station_id, init_time, init_time + fh * INTERVAL 1 HOUR AS valid_time, fh AS forecast_hour, {total} AS {name}
  FROM fields JOIN cells c ON c.flat = l_partkey),
earlier AS (SELECT station_id, init_time, valid_time + INTERVAL 6 HOURS AS valid_time, max({name}) AS before
            FROM totals GROUP BY ALL)
SELECT t.*, CASE WHEN {name} - before < 0 THEN 0.0
                 ELSE round_even(({name} - before) * 100.0::DOUBLE, 0) / 100.0::DOUBLE END AS {out}
FROM totals t LEFT JOIN earlier e USING (station_id, init_time, valid_time)"""


def run_values(spark: SparkSession, folder: str, variable: str, value: Column) -> DataFrame:
    """One field per year of ship dates and lead."""
    lead = F.col("l_linenumber") * 6
    year = F.date_trunc("year", "l_shipdate")
    return table(spark, folder, "lineitem").select(
        F.concat_ws("f", grid_of(F.col("l_partkey")), F.date_format(year, "yyyy"), lead.cast("string")).alias("file"),
        grid_of(F.col("l_partkey")).alias("grid_id"),
        F.col("l_partkey").alias("flat"),
        lead.cast("int").alias("forecast_hour"),
        (year + F.make_dt_interval(F.lit(0), lead.cast("int"))).alias("valid_time"),
        F.inline(F.array(message(F.col("l_suppkey") * 1000000000 + F.col("l_orderkey"), variable, value))),
    )


@query(
    "model_snow_intervals",
    f"WITH {CELLS}, "
    + RUNS_SQL.format(value="l_quantity / 100", total="round_even(value * 39.3701::DOUBLE, 1)", name="snow_accum", out="snow_6h"),
)
def snow_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Six-hour snow from run totals."""
    values = run_values(spark, folder, "unknown", F.col("l_quantity") / 100)
    return model_forecast(values, station_cells(spark, folder), "hrrr", "snow6hr")


@query(
    "run_totals_other_name",
    f"WITH {CELLS}, " + RUNS_SQL.format(value="l_extendedprice / 100", total="value", name="tp_total", out="precip_6h"),
)
def totals_other_name(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts from a run total that goes by another of its names."""
    values = run_values(spark, folder, "tp", F.col("l_extendedprice") / 100)
    points = with_init_time(extract_points(values, station_cells(spark, folder)))
    keys = ["station_id", "init_time", "valid_time", "forecast_hour"]
    rows = points.groupBy("file", *keys).agg(F.min_by("value", "msg_no").alias("tp_total")).drop("file")
    return with_run_intervals(rows, "hrrr", "precip6hr")


@query(
    "model_urma_wind",
    f"""WITH {CELLS}, lines AS (
  SELECT *, date_trunc('day', l_shipdate) AS init_time,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, date_trunc('day', l_shipdate)
                            ORDER BY l_suppkey) AS rn FROM lineitem WHERE l_returnflag <> 'A')
SELECT c.station_id, init_time, init_time AS valid_time, 0 AS forecast_hour,
       round_even(l_quantity * 1.94384::DOUBLE, 2) AS wind_speed_kt, round_even(l_extendedprice / 7 % 360, 0) AS wind_dir_deg,
       round_even(l_quantity * 2 * 1.94384::DOUBLE, 2) AS wind_gust_kt
FROM lines JOIN cells c ON c.flat = l_partkey WHERE rn = 1""",
)
def urma_wind(spark: SparkSession, folder: str) -> DataFrame:
    """Analyses: fields 10 m above ground at an instant; others of the same variables are left out."""
    values = field_values(
        spark,
        folder,
        message(message_number(0), "si10", F.col("l_quantity")),
        message(message_number(1), "wdir10", F.pmod(F.col("l_extendedprice") / 7, F.lit(360.0))),
        message(message_number(2), "i10fg", F.col("l_quantity") * 2),
        lead=F.lit(0),
        file=F.concat_ws("/", line_file(), "l_returnflag"),
    )
    high = F.endswith("file", F.lit("/A"))
    values = values.withColumns(
        {"level_type": F.lit("heightAboveGround"), "step_type": F.lit("instant"), "level": F.when(high, 80).otherwise(10)}
    )
    return model_forecast(values, station_cells(spark, folder), "urma", "Wind")


def percentile_sql(value: str, prefix: str, digits: int) -> str:
    return ",\n  ".join(
        f"round_even(max_by({value}, msg) FILTER (WHERE percentile = {p}), {digits}) AS {prefix}_p{p}"
        for p in PERCENTILES
    )


# Line number to percentile; the last stands for one that is not archived.
LINE_PERCENTILES = [5, 10, 25, 50, 75, 90, 33]


def percentile_values(spark: SparkSession, folder: str) -> DataFrame:
    """Percentile messages; a file is a year, its leads are all 24 hours."""
    year = F.date_trunc("year", "l_shipdate")
    percentile = F.get(F.array(*[F.lit(p) for p in LINE_PERCENTILES]), F.col("l_linenumber") - 1)
    return table(spark, folder, "lineitem").select(
        F.date_format(year, "yyyy").alias("file"),
        grid_of(F.col("l_partkey")).alias("grid_id"),
        F.col("l_partkey").alias("flat"),
        F.lit(24).alias("forecast_hour"),
        (year + F.expr("INTERVAL 24 HOURS")).alias("valid_time"),
        F.inline(
            F.array(
                message(
                    F.col("l_suppkey") * 1000000000 + F.col("l_orderkey"),
                    "percentile",
                    F.col("l_quantity") + 250,
                    percentile,
                )
            )
        ),
    )


def model_percentile_sql(value: str, prefix: str, digits: int = 2) -> str:
    return f"""WITH {CELLS}, lines AS (
  SELECT l_partkey, date_trunc('year', l_shipdate) AS init_time, l_quantity + 250 AS value,
         l_suppkey * 1000000000 + l_orderkey AS msg,
         ([{', '.join(map(str, LINE_PERCENTILES))}])[l_linenumber] AS percentile
  FROM lineitem)
SELECT c.station_id, init_time, init_time + INTERVAL 24 HOURS AS valid_time, CAST(24 AS INTEGER) AS forecast_hour,
  {percentile_sql(value, prefix, digits)}
FROM lines JOIN cells c ON c.flat = l_partkey GROUP BY ALL"""


@query("model_percentiles_precip", model_percentile_sql("value * 0.0393701::DOUBLE", "qpf"))
def percentiles_precip(spark: SparkSession, folder: str) -> DataFrame:
    return model_forecast(percentile_values(spark, folder), station_cells(spark, folder), "nbmqmd", "precip24hr")


@query("model_percentiles_maxt", model_percentile_sql("1.8::DOUBLE * (value - 273) + 32", "maxt"))
def percentiles_maxt(spark: SparkSession, folder: str) -> DataFrame:
    return model_forecast(percentile_values(spark, folder), station_cells(spark, folder), "nbmqmd", "maxt")


@query("model_percentiles_snow", model_percentile_sql("value * 39.3701::DOUBLE", "snow", 1))
def percentiles_snow(spark: SparkSession, folder: str) -> DataFrame:
    return model_forecast(percentile_values(spark, folder), station_cells(spark, folder), "nbm", "snow24hr")


@query("model_percentiles_mint", model_percentile_sql("1.8::DOUBLE * (value - 273) + 32", "mint"))
def percentiles_mint(spark: SparkSession, folder: str) -> DataFrame:
    return model_forecast(percentile_values(spark, folder), station_cells(spark, folder), "nbmqmd", "mint")


@query("model_percentiles_precip6hr", model_percentile_sql("value * 0.0393701::DOUBLE", "qpf"))
def percentiles_precip6hr(spark: SparkSession, folder: str) -> DataFrame:
    return model_forecast(percentile_values(spark, folder), station_cells(spark, folder), "nbmqmd", "precip6hr")


@query("model_percentiles_wind", model_percentile_sql("value * 1.94384::DOUBLE", "wind"))
def percentiles_wind(spark: SparkSession, folder: str) -> DataFrame:
    return model_forecast(percentile_values(spark, folder), station_cells(spark, folder), "nbmqmd_exp", "Wind")


@query("model_percentiles_gust", model_percentile_sql("value * 1.94384::DOUBLE", "gust"))
def percentiles_gust(spark: SparkSession, folder: str) -> DataFrame:
    return model_forecast(percentile_values(spark, folder), station_cells(spark, folder), "nbmqmd_exp", "Gust")


def database_values(spark: SparkSession, folder: str) -> DataFrame:
    """Speed messages from accepted lines, direction messages from returned ones, gusts
    from the others; a file is a component and an order, a step is a line number."""
    flag = F.col("l_returnflag")
    component = F.when(flag == "A", "wspd/").when(flag == "R", "wdir/").otherwise("wgust/")
    return table(spark, folder, "lineitem").select(
        F.concat(component, F.col("l_orderkey").cast("string")).alias("file"),
        grid_of(F.col("l_partkey")).alias("grid_id"),
        F.col("l_partkey").alias("flat"),
        F.col("l_linenumber").alias("step_idx"),
        (F.col("l_linenumber") * 6).alias("forecast_hour"),
        F.col("l_shipdate").alias("valid_time"),
        F.when(flag == "A", "si10").when(flag == "R", "wdir10").otherwise("i10fg").alias("var"),
        F.col("l_quantity").alias("value"),
    )


DATABASE_SQL = f"""{CELLS}, points AS (
  SELECT l_orderkey, l_returnflag, l_linenumber, l_shipdate, l_quantity, c.station_id
  FROM lineitem JOIN cells c ON c.flat = l_partkey),
gusts AS (SELECT * FROM points WHERE l_returnflag NOT IN ('A', 'R')),
spd AS (SELECT * FROM points WHERE l_returnflag = 'A'),
dir AS (SELECT l_orderkey, l_linenumber, station_id, round_even(l_quantity, 0) AS wind_dir_deg
        FROM points WHERE l_returnflag = 'R')"""


@query(
    "database_wind",
    f"""WITH {DATABASE_SQL},
orders_of AS (SELECT o_orderkey, o_orderdate + o_custkey % 1440 * INTERVAL 1 MINUTE AS stamp FROM orders),
pairs AS (
  SELECT s.o_orderkey AS speed_order, d.o_orderkey AS direction_order,
         row_number() OVER (PARTITION BY s.o_orderkey
           ORDER BY abs(epoch_us(s.stamp) - epoch_us(d.stamp)), d.stamp DESC, 'wdir/' || d.o_orderkey DESC) AS rn
  FROM orders_of s JOIN orders_of d
    ON d.stamp BETWEEN s.stamp - INTERVAL 2 MINUTES AND s.stamp + INTERVAL 2 MINUTES
  WHERE s.o_orderkey % 2 = 0 AND d.o_orderkey % 2 = 1)
SELECT s.station_id, s.l_shipdate AS valid_time,
       CAST(6 * s.l_linenumber AS INTEGER) AS forecast_hour,
       round_even(s.l_quantity * 1.94384::DOUBLE, 2) AS wind_speed_kt, d.wind_dir_deg
FROM spd s LEFT JOIN pairs p ON p.speed_order = s.l_orderkey AND p.rn = 1
LEFT JOIN dir d ON d.l_orderkey = p.direction_order AND d.l_linenumber = s.l_linenumber AND d.station_id = s.station_id
WHERE p.direction_order IS NULL OR d.station_id IS NOT NULL""",
)
def database_wind(spark: SparkSession, folder: str) -> DataFrame:
    """Speed series beside the direction series of the file paired by time."""
    key = F.col("o_orderkey")
    stamp = F.col("o_orderdate") + F.make_dt_interval(mins=F.pmod("o_custkey", F.lit(1440)).cast("int"))
    files = table(spark, folder, "orders").select(
        F.when(F.pmod(key, F.lit(2)) == 0, "wspd").otherwise("wdir").alias("component"),
        key.cast("string").alias("name"),
        stamp.alias("stamp"),
    )

    def of(component: str) -> DataFrame:
        mine = files.where(F.col("component") == component)
        return mine.select(F.concat_ws("/", "component", "name").alias("path"), "stamp")

    pairs = pair_files(of("wspd"), of("wdir"))
    return ndfd_forecast(database_values(spark, folder), station_cells(spark, folder), "Wind", pairs)


@query(
    "database_gust",
    f"""WITH {DATABASE_SQL}
SELECT station_id, l_shipdate AS valid_time,
       CAST(6 * l_linenumber AS INTEGER) AS forecast_hour, round_even(l_quantity * 1.94384::DOUBLE, 2) AS wind_gust_kt
FROM gusts""",
)
def database_gust(spark: SparkSession, folder: str) -> DataFrame:
    return ndfd_forecast(database_values(spark, folder), station_cells(spark, folder), "Gust")


def database_series(spark: SparkSession, folder: str, element: str, variable: str) -> DataFrame:
    """A database element of one variable, every line item a step of it."""
    values = database_values(spark, folder).withColumns({"var": F.lit(variable), "value": F.col("value") + 250})
    return ndfd_forecast(values, station_cells(spark, folder), element)


def database_series_sql(value: str, column: str, digits: int = 2) -> str:
    return f"""WITH {CELLS}, points AS (
  SELECT c.station_id, l_shipdate, l_linenumber, l_quantity + 250 AS value FROM lineitem JOIN cells c ON c.flat = l_partkey)
SELECT station_id, l_shipdate AS valid_time, CAST(6 * l_linenumber AS INTEGER) AS forecast_hour,
       round_even({value}, {digits}) AS {column} FROM points"""


@query("database_maxt", database_series_sql("1.8::DOUBLE * (value - 273) + 32", "maxt"))
def database_maxt(spark: SparkSession, folder: str) -> DataFrame:
    return database_series(spark, folder, "maxt", "tmax")


@query("database_mint", database_series_sql("1.8::DOUBLE * (value - 273) + 32", "mint"))
def database_mint(spark: SparkSession, folder: str) -> DataFrame:
    return database_series(spark, folder, "mint", "tmin")


@query("database_precip", database_series_sql("value * 0.0393701::DOUBLE", "precip6hr"))
def database_precip(spark: SparkSession, folder: str) -> DataFrame:
    return database_series(spark, folder, "precip6hr", "unknown")


@query("database_snow", database_series_sql("value * 39.3701::DOUBLE", "snow6hr", 1))
def database_snow(spark: SparkSession, folder: str) -> DataFrame:
    return database_series(spark, folder, "snow6hr", "unknown")


@query(
    "field_selection",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS value FROM lineitem
WHERE l_returnflag = 'A' AND l_linestatus = 'F' AND l_quantity = 10""",
)
def field_selection(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of one level type, step type and height."""
    fields = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").alias("value"),
        F.col("l_returnflag").alias("level_type"),
        F.col("l_linestatus").alias("step_type"),
        F.col("l_quantity").alias("level"),
    )
    chosen = select_fields(fields, level_type="A", step_type="F", level=10)
    return chosen.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "value")


@query(
    "cell_indices",
    """SELECT p_partkey AS flat, CAST(p_partkey // 41 AS INTEGER) AS iy, CAST(p_partkey % 41 AS INTEGER) AS ix,
       p_partkey AS back FROM part""",
)
def cell_indices(spark: SparkSession, folder: str) -> DataFrame:
    """Row and column of row-major cell numbers, and back."""
    nx = F.lit(41)
    iy, ix = unravel(F.col("p_partkey"), nx)
    split = table(spark, folder, "part").select(F.col("p_partkey").alias("flat"), iy.alias("iy"), ix.alias("ix"))
    return split.withColumn("back", ravel(F.col("iy").cast("long"), F.col("ix").cast("long"), nx))
