"""Unit conversion, rounding and wind expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Conversion constants that archived values were made with.
# The kelvin offset really is 273 (not 273.15); archives depend on it.
KELVIN_OFFSET = 273.0
KNOTS_PER_MS = 1.94384
MPH_PER_MS = 2.23694
INCHES_PER_MM = 0.0393701
INCHES_PER_M = 39.3701


def kelvin_to_fahrenheit(c: Column, offset: float = KELVIN_OFFSET) -> Column:
    return F.lit(1.8) * (c - F.lit(offset)) + F.lit(32.0)


def ms_to_knots(c: Column) -> Column:
    return c * F.lit(KNOTS_PER_MS)


def ms_to_mph(c: Column) -> Column:
    return c * F.lit(MPH_PER_MS)


def mm_to_inches(c: Column) -> Column:
    return c * F.lit(INCHES_PER_MM)


def m_to_inches(c: Column) -> Column:
    return c * F.lit(INCHES_PER_M)


def scale_by_key(key: Column, value: Column, factors: dict[str, float], default: float = 1.0) -> Column:
    """``value`` times the factor listed for ``key``; unlisted keys use ``default``."""
    if not factors:
        return value * F.lit(default)
    table = F.create_map(*[F.lit(x) for pair in factors.items() for x in pair])
    return value * F.coalesce(F.try_element_at(table, key), F.lit(default))


def missing(c: Column) -> Column:
    """NaN becomes NULL, so that Spark's ordering and averages skip it."""
    return F.when(~F.isnan(c), c)


def to_number(c: Column) -> Column:
    """Text or number to double; whatever does not parse becomes NULL."""
    return missing(c.try_cast("double"))


def round_half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def round_scaled(c: Column, digits: int = 2) -> Column:
    """Vector-style rounding: scale, round to nearest even, scale back."""
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column, v: Column) -> Column:
    """Direction the wind blows from, degrees in [0, 360)."""
    return F.pmod(F.lit(270.0) - F.degrees(F.atan2(v, u)), F.lit(360.0))


def clip_negative(c: Column, missing_as_zero: bool = False) -> Column:
    """Negative values to zero.  ``missing_as_zero`` also turns NULL into zero,
    which is what older archives contain."""
    clipped = F.when(c < 0, F.lit(0.0)).otherwise(c)
    return F.coalesce(clipped, F.lit(0.0)) if missing_as_zero else clipped


def wrap_longitude(c: Column) -> Column:
    """Longitude into [-180, 180)."""
    return F.pmod(c + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def normalise_grid_longitude(c: Column) -> Column:
    """As ``wrap_longitude``, leaving the bits of in-range values alone."""
    return F.when((c >= -180.0) & (c < 180.0), c).otherwise(wrap_longitude(c))
