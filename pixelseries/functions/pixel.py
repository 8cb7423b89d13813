"""Column expressions on pixel values: fill, zenith, quality bits, index and sort keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stored form of a missing value.
MISSING = -10001
#: Zenith angles from here on are too low a sun; such values read as CLAMPED.
ZENITH_LIMIT, CLAMPED = 72, 16000


def normalize_nodata(value: Column, fill: int) -> Column:
    return F.nullif(value, F.lit(fill))


def sun_is_high(zenith: Column, missing_passes: bool = True) -> Column:
    """A missing zenith stands for the missing value, which is below the limit, and passes, unless it is told to fail."""
    return F.coalesce(zenith, F.lit(MISSING if missing_passes else ZENITH_LIMIT)) < ZENITH_LIMIT


def zenith_clamp(value: Column, zenith: Column, missing_passes: bool = True) -> Column:
    """The clamp follows the fill: a missing value under a low sun reads as the clamp too."""
    return F.when(sun_is_high(zenith, missing_passes), value).otherwise(F.lit(CLAMPED))


def cloud(state: Column) -> Column:
    return state.bitwiseAND(F.lit(3))


def shadow(state: Column) -> Column:
    return state.bitwiseAND(F.lit(4))


def adjacency(state: Column) -> Column:
    return state.bitwiseAND(F.lit(8192))


def aerosol(state: Column) -> Column:
    return F.shiftright(state.bitwiseAND(F.lit(192)), 6)


def qa_ok(state: Column, zenith: Column, missing_passes: bool = True) -> Column:
    """No cloud, shadow, adjacent cloud or high aerosol, and a high sun; a missing state is not ok."""
    clear = (cloud(state) == 0) & (shadow(state) == 0) & (aerosol(state) != 3) & (adjacency(state) == 0)
    return F.coalesce(clear & sun_is_high(zenith, missing_passes), F.lit(False))


def apply_qa(value: Column, ok: Column) -> Column:
    return F.when(ok, value)


def to_stored(value: Column) -> Column:
    return F.coalesce(value, F.lit(MISSING))


def from_stored(value: Column) -> Column:
    return F.nullif(value, F.lit(MISSING))


def ndvi(b1: Column, b2: Column, missing: str = "zero") -> Column:
    """(b2 - b1) / (b2 + b1) in thousandths, truncated; 0 where the sum is 0, and for missing input unless ``missing`` is "null"."""
    index = F.when(b1 + b2 != 0, ((b2 - b1) / (b2 + b1) * 1000).cast("int")).otherwise(0)
    return F.when(b1.isNull() | b2.isNull(), F.lit(None if missing == "null" else 0).cast("int")).otherwise(index)


def thermal_key(b31: Column) -> Column:
    """Truncated temperature; a missing one sorts coldest."""
    return F.coalesce(b31.cast("int"), F.lit(MISSING))


def bit(place: Column) -> Column:
    """A number with one bit set."""
    return F.call_function("shiftleft", F.lit(1), place)
