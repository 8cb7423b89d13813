"""Periods of consecutive dates and their mean per pixel and band."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelseries.functions import pixel as px
from pixelseries.operators.bands import TILE_YEAR, cleaned_rows, tile_calendar
from pixelseries.sources.adapter import ALL_BANDS, DATES, PIXEL
from pixelseries.sources.storage import bounded, staged

#: A calendar of so many rows (23 for a tile-year) is sent to all tasks; a larger one is joined by a shuffle.
MAX_BROADCAST_DATES = 500_000
#: So many chosen pixels are sent to all tasks; more are joined by a shuffle.
MAX_BROADCAST_PIXELS = 1_000_000


def periods_in(per_period: int = 2) -> list[list[int]]:
    """The calendar's dates (by index) of each period: ceil(n / p) balanced groups, larger ones first."""
    count, out = ceil(DATES / per_period), []
    for k in range(count):
        start = sum(map(len, out))
        out.append(list(range(start, start + DATES // count + (k < DATES % count))))
    return out


def period_of(idx: Column, per_period: int = 2) -> Column:
    """The period of a date of the calendar, in closed form."""
    return F.get(F.lit([k for k, days in enumerate(periods_in(per_period)) for _ in days]), idx)


def period_map(dates: DataFrame, per_period: int = 2) -> DataFrame:
    """(tile-year, day, period, first_day): dates in order, cut into ceil(n / p) balanced groups, larger ones first.

    Only the 23 dates of each tile-year are sorted, never the observations.
    """
    order = Window.partitionBy(*TILE_YEAR).orderBy("day")
    ranked = dates.withColumn("period", F.ntile(ceil(DATES / per_period)).over(order) - 1)
    first = F.min("day").over(Window.partitionBy(*TILE_YEAR, "period"))
    return ranked.select(*TILE_YEAR, "day", "period", first.alias("first_day"))


def composite_mean(values: DataFrame, periods: DataFrame, dealt: bool = False) -> DataFrame:
    """Mean of the values that are there, per pixel, band and period; none gives null.

    ``values`` may lack dates: a row without values for every pixel and period stands in for them, so every
    pixel of a complete tile-year gets all its periods without a join of the observations to a dense grid. ``dealt`` is that of ``composites``.
    """
    spans = periods.groupBy(*TILE_YEAR, "period").agg(F.min("first_day").alias("first_day"))
    rows = values.join(bounded(periods, MAX_BROADCAST_DATES), [*TILE_YEAR, "day"]).select(*PIXEL, "period", "first_day", *ALL_BANDS)
    empty = values.select(*PIXEL).distinct().join(bounded(spans, MAX_BROADCAST_DATES), TILE_YEAR)
    empty = empty.select(*PIXEL, "period", "first_day", *[F.lit(None).cast("int").alias(b) for b in ALL_BANDS])
    both = rows.unionByName(empty)
    # Dealt by pixel, so that metrics over the composites need no exchange of their own.
    by_pixel = both if dealt else both.repartition(*PIXEL)
    return by_pixel.groupBy(*PIXEL, "period").agg(F.min("first_day").alias("first_day"), *[F.avg(b).alias(b) for b in ALL_BANDS])


def with_index(composites: DataFrame, ndvi_missing: str = "zero", as_int16: bool = False) -> DataFrame:
    """Add ``ndvi`` and ``therm`` of the composites; ``as_int16`` first truncates them as stored files would."""
    if as_int16:
        composites = composites.withColumns({b: F.col(b).cast("int").cast("double") for b in ALL_BANDS})
    return composites.withColumns(
        {"ndvi": px.ndvi(F.col("b1"), F.col("b2"), ndvi_missing), "therm": px.thermal_key(F.col("b31"))}
    )


def composites(
    obs: DataFrame,
    per_period: int = 2,
    apply_qa: bool = True,
    ndvi_missing: str = "zero",
    as_int16: bool = False,
    missing_zenith_passes: bool = True,
    pixels: DataFrame | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Observations to composites with their index: one exchange by pixel, which metrics use too, and one of distinct pixels.

    The calendar is written once, as it is small and read three times; observations meet it without an exchange.
    ``ndvi_missing`` and ``as_int16`` are those of ``with_index``; with ``missing_zenith_passes`` false, a missing zenith fails QA.
    Of ``pixels``, if given, only those (pixel keys) get composites: other observations count for the calendar and go before any exchange.
    ``dealt`` says that ``obs`` are dealt by pixel already, as those of the adapter are: then neither exchange is made.
    """
    periods = staged(period_map(tile_calendar(obs), per_period), "periods")
    if pixels is not None:
        obs = obs.join(bounded(pixels.select(*PIXEL).distinct(), MAX_BROADCAST_PIXELS), PIXEL, "left_semi")
    values = cleaned_rows(obs, apply_qa, missing_zenith_passes)
    return with_index(composite_mean(values, periods, dealt), ndvi_missing, as_int16)


def composites_of_bands(bands: DataFrame, per_period: int = 2, ndvi_missing: str = "zero", as_int16: bool = False) -> DataFrame:
    """Composites of stored dense bands (rows of ``clean``), whose tile-years have all dates of the calendar for every pixel.

    Periods follow from the dates' indexes, so there is nothing to join; of a table stored by pixel there is no exchange either.
    """
    rows = bands.withColumn("period", period_of(F.col("idx"), per_period))
    means = rows.groupBy(*PIXEL, "period").agg(F.min("day").alias("first_day"), *[F.avg(b).alias(b) for b in ALL_BANDS])
    return with_index(means, ndvi_missing, as_int16)
