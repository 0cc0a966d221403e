"""What each source and element means: columns, units, leads, inventory selection.

Everything an archive's contents depend on is stated here as data.  Adding a source
means adding rows here and a reader that yields the grid-value schema.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import units

# ---------------------------------------------------------------------------
# Fixed values.
# ---------------------------------------------------------------------------

PERCENTILES = [5, 10, 25, 50, 75, 90, 95]

# Hours between runs, and the hours at which runs may start.
CYCLE_HOURS = {"nbm": 6, "nbm_exp": 6, "nbmqmd": 12, "nbmqmd_exp": 12, "hrrr": 6, "urma": 3}
RUN_HOURS = {
    "nbm": [1, 7, 13, 19],
    "nbm_exp": [1, 7, 13, 19],
    "nbmqmd": [0, 6, 12, 18],
    "nbmqmd_exp": [0, 6, 12, 18],
}

ELEMENTS = {
    "nbm": ["Wind", "snow6hr", "snow24hr", "snow48hr", "snow72hr"],
    "nbm_exp": ["snow6hr", "snow24hr", "snow48hr", "snow72hr", "Wind"],
    "nbmqmd": ["precip24hr", "precip6hr", "maxt", "mint"],
    "nbmqmd_exp": ["precip24hr", "precip6hr", "maxt", "mint", "Wind", "Gust"],
    "hrrr": ["Wind", "precip6hr", "snow6hr"],
    "urma": ["Wind"],
    "ndfd": ["Wind", "Gust", "precip6hr", "maxt", "mint", "snow6hr"],
}

# Sub-folder and file prefixes of the gridded forecast database, by element.
NDFD_PREFIXES = {
    "Wind": {"wspd": ["YCRZ98", "YCRZ97"], "wdir": ["YBRZ98", "YBRZ97"]},
    "Gust": {"wgust": ["YWRZ98"]},
    "precip6hr": {"qpf": ["YIRZ98"]},
    "maxt": {"maxt": ["YGRZ98", "YGRZ97"]},
    "mint": {"mint": ["YHRZ98", "YHRZ97"]},
    "snow6hr": {"snow": ["YSRZ98"]},
}
NDFD_RUN_HOURS = [11, 23]

# Inventory text that marks the wanted messages, by model and element.
SEARCH = {
    ("nbm", "Wind"): [":WIND:10 m above", ":WDIR:10 m above", ":GUST:10 m above"],
    ("nbm", "snow6hr"): [":ASNOW:surface:"],
    ("nbm", "snow24hr"): [":ASNOW:surface:"],
    ("nbm", "snow48hr"): [":ASNOW:surface:"],
    ("nbm", "snow72hr"): [":ASNOW:surface:"],
    ("nbm_exp", "Wind"): [":WIND:10 m above", ":WDIR:10 m above", ":GUST:10 m above"],
    ("nbm_exp", "snow6hr"): [":ASNOW:surface:"],
    ("nbm_exp", "snow24hr"): [":ASNOW:surface:"],
    ("nbm_exp", "snow48hr"): [":ASNOW:surface:"],
    ("nbm_exp", "snow72hr"): [":ASNOW:surface:"],
    ("nbmqmd", "precip24hr"): [":APCP:surface:"],
    ("nbmqmd", "precip6hr"): [":APCP:surface:"],
    ("nbmqmd", "maxt"): [":TMP:2 m above ground:"],
    ("nbmqmd", "mint"): [":TMP:2 m above ground:"],
    ("nbmqmd_exp", "Wind"): [":WIND:10 m above"],
    ("nbmqmd_exp", "Gust"): [":GUST:10 m above"],
    ("nbmqmd_exp", "precip24hr"): [":APCP:surface:"],
    ("nbmqmd_exp", "precip6hr"): [":APCP:surface:"],
    ("nbmqmd_exp", "maxt"): [":TMP:2 m above ground:"],
    ("nbmqmd_exp", "mint"): [":TMP:2 m above ground:"],
    ("hrrr", "Wind"): [":UGRD:10 m above", ":VGRD:10 m above", ":GUST:surface"],
    ("hrrr", "precip6hr"): [":APCP:surface"],
    ("hrrr", "snow6hr"): [":ASNOW:surface"],
    ("urma", "Wind"): [],
}

# Inventory text that rules a message out.
EXCLUDE = {
    ("nbm", "Wind"): ["ens std dev"],
    ("nbm", "snow6hr"): ["prob"],
    ("nbm", "snow24hr"): ["prob"],
    ("nbm", "snow48hr"): ["prob"],
    ("nbm", "snow72hr"): ["prob"],
    ("nbm_exp", "Wind"): ["ens std dev"],
    ("nbm_exp", "snow6hr"): ["prob"],
    ("nbm_exp", "snow24hr"): ["prob"],
    ("nbm_exp", "snow48hr"): ["prob"],
    ("nbm_exp", "snow72hr"): ["prob"],
    ("hrrr", "Wind"): ["ens std dev"],
    ("hrrr", "precip6hr"): ["ens std dev"],
    ("hrrr", "snow6hr"): ["ens std dev"],
}

# Inventory text that all messages must carry.
REQUIRE = {
    ("nbm", "Wind"): ["10 m above ground"],
    ("nbm_exp", "Wind"): ["10 m above ground"],
    ("hrrr", "Wind"): ["10 m above ground"],
}

# Factors applied per source.  The gust factor of the hrrr rows differs in the
# third decimal from the wind factor; archived gusts were made with it.
HRRR_GUST_FACTOR = 1.9484

# fmt: off
# Lead hours archived for each model and element.
LEADS = {
    ("nbm", "Wind"): [5, 11, 17, 23, 29, 35, 41, 47, 53, 59, 65, 71, 83, 95, 107, 119, 131, 143, 155, 167],
    ("nbm", "snow6hr"): [11, 17, 23, 29, 35, 41, 47, 53, 59, 65, 71, 83, 89, 95, 101, 107, 113, 119, 125, 131, 137, 143, 149, 155, 161],
    ("nbm", "snow24hr"): [29, 35, 41, 47, 53, 59, 65, 71, 83, 89, 95, 101, 107, 113, 119, 125, 131, 137, 143, 149, 155, 161],
    ("nbm", "snow48hr"): [53, 59, 65, 71, 83, 89, 95, 101, 107, 113, 119, 125, 131, 137, 143, 149, 155, 161],
    ("nbm", "snow72hr"): [83, 89, 95, 101, 107, 113, 119, 125, 131, 137, 143, 149, 155, 161],
    ("nbm_exp", "Wind"): [5, 11, 17, 23, 29, 35, 41, 47, 53, 59, 65, 71, 83, 95, 107, 119, 131, 143, 155, 167],
    ("nbm_exp", "snow6hr"): [11, 17, 23, 29, 35, 41, 47, 53, 59, 65, 71, 83, 89, 95, 101, 107, 113, 119, 125, 131, 137, 143, 149, 155, 161],
    ("nbm_exp", "snow24hr"): [29, 35, 41, 47, 53, 59, 65, 71, 83, 89, 95, 101, 107, 113, 119, 125, 131, 137, 143, 149, 155, 161],
    ("nbm_exp", "snow48hr"): [53, 59, 65, 71, 83, 89, 95, 101, 107, 113, 119, 125, 131, 137, 143, 149, 155, 161],
    ("nbm_exp", "snow72hr"): [83, 89, 95, 101, 107, 113, 119, 125, 131, 137, 143, 149, 155, 161],
    ("nbmqmd", "precip24hr"): [24, 30, 36, 48, 60, 72, 84, 96, 108, 120, 132, 144, 156, 168],
    ("nbmqmd", "precip6hr"): [6, 12, 18, 24, 30, 36, 42, 48, 54, 60, 66, 72, 78, 84, 90, 96, 102, 108, 114, 120],
    ("nbmqmd", "maxt"): [18, 30, 42, 54, 66, 78, 90, 102, 114, 126, 138, 150, 162, 174],
    ("nbmqmd", "mint"): [18, 30, 42, 54, 66, 78, 90, 102, 114, 126, 138, 150, 162, 174],
    ("nbmqmd_exp", "precip24hr"): [24, 30, 36, 48, 60, 72, 84, 96, 108, 120, 132, 144, 156, 168],
    ("nbmqmd_exp", "precip6hr"): [6, 12, 18, 24, 30, 36, 42, 48, 54, 60, 66, 72, 78, 84, 90, 96, 102, 108, 114, 120],
    ("nbmqmd_exp", "maxt"): [18, 30, 42, 54, 66, 78, 90, 102, 114, 126, 138, 150, 162, 174],
    ("nbmqmd_exp", "mint"): [18, 30, 42, 54, 66, 78, 90, 102, 114, 126, 138, 150, 162, 174],
    ("nbmqmd_exp", "Wind"): [12, 18, 24, 30, 36, 42, 48, 54, 60, 66, 72, 84, 96, 108, 120, 132, 144, 156, 168],
    ("nbmqmd_exp", "Gust"): [12, 18, 24, 30, 36, 42, 48, 54, 60, 66, 72, 84, 96, 108, 120, 132, 144, 156, 168],
    ("hrrr", "Wind"): [12, 18, 24, 30, 36, 42, 48],
    ("hrrr", "precip6hr"): [0, 6, 12, 18, 24, 30, 36, 42, 48],
    ("hrrr", "snow6hr"): [0, 6, 12, 18, 24, 30, 36, 42, 48],
    ("urma", "Wind"): [0],
}
# fmt: on


def leads(model: str, element: str) -> list[int]:
    """Lead hours archived for a model and element."""
    return LEADS[model, element]


# ---------------------------------------------------------------------------
# Columns.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ColumnRule:
    """One output column: input variable, conversion and digits kept."""

    variable: str
    column: str
    convert: str = "scale"  # scale | fahrenheit
    factor: float = 1.0
    digits: int | None = 2

    def apply(self, value: Column) -> Column:
        out = units.kelvin_to_fahrenheit(value) if self.convert == "fahrenheit" else value * F.lit(self.factor)
        return out if self.digits is None else units.round_half_even(out, self.digits)


_KT, _MM, _M = units.KNOTS_PER_MS, units.INCHES_PER_MM, units.INCHES_PER_M

_SPEED_DIRECTION_GUST = [
    ColumnRule("si10", "wind_speed_kt", factor=_KT),
    ColumnRule("wdir10", "wind_dir_deg", digits=0),
    ColumnRule("i10fg", "wind_gust_kt", factor=_KT),
]

# Columns read straight from one variable each.
COLUMNS: dict[tuple[str, str], list[ColumnRule]] = {
    ("ndfd", "Wind"): _SPEED_DIRECTION_GUST[:2],
    ("ndfd", "Gust"): _SPEED_DIRECTION_GUST[2:],
    ("ndfd", "precip6hr"): [ColumnRule("unknown", "precip6hr", factor=_MM)],
    ("ndfd", "maxt"): [ColumnRule("tmax", "maxt", "fahrenheit")],
    ("ndfd", "mint"): [ColumnRule("tmin", "mint", "fahrenheit")],
    ("ndfd", "snow6hr"): [ColumnRule("unknown", "snow6hr", factor=_M, digits=1)],
    ("nbm", "Wind"): _SPEED_DIRECTION_GUST,
    ("nbm_exp", "Wind"): _SPEED_DIRECTION_GUST,
    ("urma", "Wind"): _SPEED_DIRECTION_GUST,
    # u and v are only scaled here; speed and direction are derived from them.
    ("hrrr", "Wind"): [
        ColumnRule("u10", "u_wind", factor=_KT, digits=None),
        ColumnRule("v10", "v_wind", factor=_KT, digits=None),
        ColumnRule("gust", "wind_gust_kt", factor=HRRR_GUST_FACTOR),
    ],
    ("hrrr", "precip6hr"): [ColumnRule("tp", "precip_accum", factor=_MM)],
    ("hrrr", "snow6hr"): [ColumnRule("unknown", "snow_accum", factor=_M, digits=1)],
}

# Run totals that are also differenced into interval amounts: (interval, hours).
INTERVALS = {
    ("hrrr", "precip6hr"): ("precip_6h", 6),
    ("hrrr", "snow6hr"): ("snow_6h", 6),
}

# Names that a run total may have, in the order in which they are looked for.
TOTAL_NAMES = {
    ("hrrr", "precip6hr"): ["precip_accum", "total_precip", "precip_total", "tp_total", "APCP_total"],
    ("hrrr", "snow6hr"): ["snow_accum", "total_snow", "snow_total", "tp_total", "ASNOW_total"],
}

# Percentile elements, column prefix and conversion; one column per percentile.
PERCENTILE_COLUMNS = {
    "precip24hr": ColumnRule("percentile", "qpf", factor=_MM),
    "precip6hr": ColumnRule("percentile", "qpf", factor=_MM),
    "maxt": ColumnRule("percentile", "maxt", "fahrenheit"),
    "mint": ColumnRule("percentile", "mint", "fahrenheit"),
    "Wind": ColumnRule("percentile", "wind", factor=_KT),
    "Gust": ColumnRule("percentile", "gust", factor=_KT),
    "snow6hr": ColumnRule("percentile", "snow", factor=_M, digits=1),
    "snow24hr": ColumnRule("percentile", "snow", factor=_M, digits=1),
    "snow48hr": ColumnRule("percentile", "snow", factor=_M, digits=1),
    "snow72hr": ColumnRule("percentile", "snow", factor=_M, digits=1),
}

# Observation elements, reported variable to archived column, and precipitation spans
# as (hours accumulated, hours per report).
OBSERVATION_COLUMNS = {
    "wind_direction_set_1": "obs_wind_dir_deg",
    "wind_speed_set_1": "obs_wind_speed_kts",
    "wind_gust_set_1": "obs_wind_gust_kts",
}
PRECIP_SPANS = {"precip24hr": (24, 12), "precip6hr": (6, 6)}


def is_percentile(model: str, element: str) -> bool:
    """Whether a model delivers an element as percentile fields."""
    return model in ("nbmqmd", "nbmqmd_exp") or (model in ("nbm", "nbm_exp") and element != "Wind")


def validate(model: str, element: str, *run_hours: int) -> None:
    """Raise ValueError unless the model has the element and may run at these hours."""
    if model not in ELEMENTS:
        raise ValueError(f"unknown model {model!r}; known: {sorted(ELEMENTS)}")
    if element not in ELEMENTS[model]:
        raise ValueError(f"{model} has no element {element!r}; it has {ELEMENTS[model]}")
    wrong = [h for h in run_hours if h not in RUN_HOURS.get(model, range(24))]
    if wrong:
        raise ValueError(f"{model} does not run at hours {wrong}; it runs at {RUN_HOURS[model]}")


def element_table(spark: SparkSession) -> DataFrame:
    """The allowed (model, element) pairs as rows, to check requests by a semi-join."""
    return spark.createDataFrame(
        [(model, element) for model, elements in ELEMENTS.items() for element in elements],
        "model string, element string",
    )


def run_hour_table(spark: SparkSession) -> DataFrame:
    """The allowed (model, run_hour) pairs as rows; models without fixed hours may run at any."""
    return spark.createDataFrame(
        [(model, hour) for model in ELEMENTS for hour in RUN_HOURS.get(model, range(24))], "model string, run_hour int"
    )


def valid_requests(requests: DataFrame, *, run_hour: str | None = None) -> DataFrame:
    """The requests (model, element, …) for elements that the model has, at hours at which it runs."""
    spark = requests.sparkSession
    found = requests.join(element_table(spark), ["model", "element"], "left_semi")
    if run_hour is None:
        return found
    hours = run_hour_table(spark).withColumnRenamed("model", "_model")
    same = (found["model"] == hours["_model"]) & (found[run_hour] == hours["run_hour"])
    return found.join(hours, same, "left_semi")
