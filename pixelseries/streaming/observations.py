"""Observations that arrive as a stream: row-wise steps as they are, composites with state until their periods close."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pixelseries.functions.pixel import bit
from pixelseries.operators.bands import cleaned_rows
from pixelseries.operators.catalog import WHOLE, calendar_day, on_calendar
from pixelseries.operators.composite import MAX_BROADCAST_DATES, period_of, periods_in, with_index
from pixelseries.sources.adapter import ALL_BANDS, DATES, PIXEL
from pixelseries.sources.storage import bounded
from pixelseries.sources.tilestore import TILE_YEAR


def clean_stream(obs: DataFrame, apply_qa: bool = True) -> DataFrame:
    """Fill, clamp and mask each observation of a stream (or of a table)."""
    return cleaned_rows(obs, apply_qa)


def write_clean_stream(obs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there to a Parquet table, then stop; the next run goes on from the checkpoint."""
    out = clean_stream(obs).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return out.outputMode("append").trigger(availableNow=True).start()


def _timestamp(day: Column) -> Column:
    year, doy = F.floor(day / 1000).cast("int"), (day % 1000).cast("int")
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), doy - 1).cast("timestamp")


def composite_stream(obs: DataFrame, late: str, per_period: int = 2, apply_qa: bool = True) -> DataFrame:
    """(pixel key, period, first_day, bits, bands): means of the observations of a stream, per pixel and period.

    A pixel's period is a row of state, sums and counts, into which dates fold in any order. It closes, is appended once and leaves
    the state when dates that are ``late`` after its last one have come. Days off the calendar are passed over; ``bits`` has the
    dates that were folded.
    """
    year, idx = F.col("season_year"), F.col("idx")
    period = period_of(idx, per_period)
    first, last = (F.get(F.lit([f(days) for days in periods_in(per_period)]), period) for f in (min, max))
    rows = cleaned_rows(obs.filter(on_calendar(F.col("day"), year, idx)), apply_qa).select(
        *PIXEL, "idx", period.alias("period"), calendar_day(year, first).alias("first_day"), _timestamp(calendar_day(year, last)).alias("closes"), *ALL_BANDS
    )
    grouped = rows.withWatermark("closes", late).groupBy(*PIXEL, "period", "first_day", "closes")
    return grouped.agg(F.bit_or(bit(idx)).alias("bits"), *[F.avg(b).alias(b) for b in ALL_BANDS]).drop("closes")


def write_composite_stream(obs: DataFrame, path: str, checkpoint: str, late: str = "365 days", **options) -> StreamingQuery:
    """Append periods that close to a Parquet table, then stop; the next run goes on from the checkpoint with the state it left."""
    out = composite_stream(obs, late, **options).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return out.outputMode("append").trigger(availableNow=True).start()


def read_composites(spark: SparkSession, path: str, per_period: int = 2, **options) -> DataFrame:
    """What ``composites`` makes of the same observations: all periods of the pixels of tile-years whose dates have all closed."""
    rows = spark.read.parquet(path)
    complete = rows.groupBy(*TILE_YEAR).agg(F.bit_or("bits").alias("held")).filter(F.col("held") == WHOLE).select(*TILE_YEAR)
    rows = rows.join(bounded(complete, MAX_BROADCAST_DATES // DATES), TILE_YEAR, "left_semi")
    starts = [min(days) for days in periods_in(per_period)]
    cells = F.array(*[F.struct(F.lit(k).alias("period"), calendar_day(F.col("season_year"), F.lit(d)).alias("first_day")) for k, d in enumerate(starts)])
    empty = rows.select(*PIXEL).distinct().select(*PIXEL, F.inline(cells), *[F.lit(None).cast("double").alias(b) for b in ALL_BANDS])
    both = rows.select(*empty.columns).unionByName(empty)
    means = both.groupBy(*PIXEL, "period").agg(F.min("first_day").alias("first_day"), *[F.max(b).alias(b) for b in ALL_BANDS])
    return with_index(means, **options)
