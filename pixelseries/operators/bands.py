"""Bands of observations: routing, slices, stacks, the dense grid, and band tables on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelseries.functions import pixel as px
from pixelseries.operators.catalog import WHOLE, calendar, calendar_day, date_bits, on_calendar
from pixelseries.sources.adapter import ALL_BANDS, DATES, FILL, PIXEL, season_columns
from pixelseries.sources import tilestore
from pixelseries.sources.storage import bounded, replace_partitions, staged
from pixelseries.sources.tilestore import FILE_PIXELS, MAX_BROADCAST_ENTRIES, TILE_YEAR

#: The layer name of whole band tables in a store.
BANDS_LAYER = "bands"
#: Product and layer that hold each band.
LAYERS = {
    "b1": ("CQ", 4), "b2": ("CQ", 5), "b3": ("CH", 0), "b4": ("CH", 1), "b5": ("CH", 2), "b6": ("CH", 3), "b7": ("CH", 4),
    "b31": ("CH", 9),
}


def by_file(df: DataFrame, *further: str) -> DataFrame:
    """Deal rows to the tasks that write them: one for each tile-year, value of ``further`` and block of neighbouring pixels."""
    return df.repartition(*TILE_YEAR, *further, F.floor(F.col("pixel") / FILE_PIXELS))


def known_band(name: str) -> str:
    if name not in LAYERS:
        raise ValueError(f"unknown band {name!r}")
    return name


def normalized(obs: DataFrame) -> DataFrame:
    """Native fill of every layer to null; the state keeps its bits."""
    return obs.withColumns({c: px.normalize_nodata(F.col(c), fill) for c, fill in FILL.items()})


def band_long(obs: DataFrame, bands: list[str] = ALL_BANDS) -> DataFrame:
    """One named band per row, with the product and layer it is read from."""
    route = F.create_map(*[x for b in bands for x in (F.lit(known_band(b)), F.struct(*map(F.lit, LAYERS[b])))])
    long = obs.unpivot([*PIXEL, "day"], bands, "band", "value")
    return long.withColumn("_to", route[F.col("band")]).select(
        *PIXEL, "day", "band", F.col("_to.col1").alias("product"), F.col("_to.col2").alias("layer"), "value"
    )


def day_slice(obs: DataFrame, band: str, days: list[int]) -> DataFrame:
    return obs.filter(F.col("day").isin(days)).select(*PIXEL, "day", F.col(known_band(band)).alias("value"))


def read_values(obs: DataFrame, band: str, apply_qa: bool, missing_zenith_passes: bool = True) -> DataFrame:
    """Values of a band as they are read: fill to null, clamp by zenith, then QA if asked."""
    value = px.zenith_clamp(F.col(known_band(band)), F.col("zenith"), missing_zenith_passes)
    if apply_qa:
        value = px.apply_qa(value, px.qa_ok(F.col("state"), F.col("zenith"), missing_zenith_passes))
    return normalized(obs).select(*PIXEL, "day", value.alias("value"))


def stack_band(obs: DataFrame, band: str, apply_qa: bool) -> DataFrame:
    """(pixel key, series): all days of a band in order."""
    values = read_values(obs, band, apply_qa)
    return values.groupBy(*PIXEL).agg(F.sort_array(F.collect_list(F.struct("day", "value"))).alias("series"))


def stack_bands(obs: DataFrame, bands: list[str] = ALL_BANDS) -> DataFrame:
    """(pixel key, series): all days in order, each with every band as read without QA and whether QA lets it pass.

    One aggregate holds all bands of both kinds; ``stacked_values`` lays them out.
    """
    raw = px.zenith_clamp
    clamped = [raw(F.col(known_band(b)), F.col("zenith")).alias(b) for b in bands]
    item = F.struct("day", px.qa_ok(F.col("state"), F.col("zenith")).alias("ok"), *clamped)
    return normalized(obs).groupBy(*PIXEL).agg(F.sort_array(F.collect_list(item)).alias("series"))


def stacked_values(stacks: DataFrame, bands: list[str] = ALL_BANDS) -> DataFrame:
    """(pixel key, pos, day, band, qa, value) of ``stack_bands``, with QA (``qa`` true) and without."""
    days = stacks.select(*PIXEL, F.posexplode("series").alias("pos", "x"))
    values = {(b, qa): px.apply_qa(F.col("x")[b], F.col("x.ok")) if qa else F.col("x")[b] for b in bands for qa in (True, False)}
    cells = F.array(*[F.struct(F.lit(b).alias("band"), F.lit(qa).alias("qa"), v.alias("value")) for (b, qa), v in values.items()])
    return days.select(*PIXEL, "pos", F.col("x.day").alias("day"), F.inline(cells))


def dates_held(obs: DataFrame, *more: Column) -> DataFrame:
    """(tile-year, bits, dates, off_calendar): the calendar's dates that a tile-year holds, as bits and their number.

    One hash aggregate, whose states are numbers. Observations of other days count as ``off_calendar``, and as nothing else.
    ``more`` are further aggregates of a tile-year.
    """
    year, day, idx = F.col("season_year"), F.col("day"), F.col("idx")
    held = obs.groupBy(*TILE_YEAR).agg(date_bits(day, year, idx).alias("bits"), F.count_if(~on_calendar(day, year, idx)).alias("off_calendar"), *more)
    return held.withColumn("dates", F.bit_count("bits").cast("long"))


def complete_tile_years(obs: DataFrame) -> DataFrame:
    return dates_held(obs).filter(F.col("bits") == WHOLE).select(*TILE_YEAR)


def tile_calendar(obs: DataFrame) -> DataFrame:
    """The dates of every complete tile-year: the 23 of the calendar."""
    return calendar(complete_tile_years(obs), TILE_YEAR).select(*TILE_YEAR, "day", "idx")


def dense_grid(obs: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """Every pixel of a complete tile-year has all 23 dates; an absent observation is a row of nulls.

    Observations stay as they are. One aggregate by pixel finds a pixel's dates as bits, and those that are not set get rows of their
    own: no grid is made to be joined, and of observations that are dealt by pixel there is no exchange. ``whole`` are the complete tile-years, if known;
    else they are found and written once, as both sides read them.
    """
    whole = bounded(staged(complete_tile_years(obs), "whole") if whole is None else whole.select(*TILE_YEAR), MAX_BROADCAST_ENTRIES)
    day, year = F.col("day"), F.col("season_year")
    idx = season_columns(F.expr("day div 1000"), day % 1000)["idx"]
    rows = obs.join(whole, TILE_YEAR, "left_semi").withColumn("idx", idx)
    pixels = rows.groupBy(*PIXEL).agg(date_bits(day, year, F.col("idx")).alias("bits"))
    dates = F.sequence(F.lit(0), F.lit(DATES - 1))
    gone = pixels.select(*PIXEL, F.explode(F.filter(dates, lambda i: F.getbit("bits", i) == 0)).alias("idx"))
    layers = [c for c in obs.columns if c not in (*PIXEL, "day", "idx")]
    empty = gone.select(*PIXEL, calendar_day(year, F.col("idx")).alias("day"), "idx", *[F.lit(None).cast(obs.schema[c].dataType).alias(c) for c in layers])
    return rows.filter(on_calendar(day, year, F.col("idx"))).select(*PIXEL, "day", "idx", *layers).unionByName(empty)


def cleaned_rows(obs: DataFrame, apply_qa: bool = True, missing_zenith_passes: bool = True) -> DataFrame:
    """Each observation with its bands filled, clamped and masked: row by row, no exchange."""
    ok = px.qa_ok(F.col("state"), F.col("zenith"), missing_zenith_passes)

    def value(band: str):
        read = px.zenith_clamp(F.col(band), F.col("zenith"), missing_zenith_passes)
        return px.apply_qa(read, ok) if apply_qa else read

    return normalized(obs).select(*PIXEL, "day", "idx", *[value(b).cast("int").alias(b) for b in ALL_BANDS])


def clean(obs: DataFrame, apply_qa: bool = True, whole: DataFrame | None = None) -> DataFrame:
    """The dense grid of cleaned observations; ``whole`` is that of ``dense_grid``."""
    return cleaned_rows(dense_grid(obs, whole), apply_qa)


def write_bands(df: DataFrame, path: str) -> None:
    """Add the tile-years of ``df`` to ``path``: those that are there with the same rows stay as they are, others are replaced."""
    todo = tilestore.pending(tilestore.inputs_of(df), path, [BANDS_LAYER])
    tilestore.put(tilestore.only(df, todo), path, constant=BANDS_LAYER, inputs=todo.drop("layer"))


def read_bands(spark: SparkSession, path: str) -> DataFrame:
    return tilestore.read(spark, path, constant=BANDS_LAYER).drop("run")


def collate_batch(obs: DataFrame, path: str, apply_qa: bool = True) -> DataFrame:
    """Write the bands of all tile-years that can be collated; incomplete ones are skipped, and the batch goes on.

    The report has a row for each tile-year: its dates of the calendar, its observations of other days (which are left out), and whether
    it was ``written``, was ``stored`` before, is ``redone`` because its observations have changed, or is ``incomplete``.
    """
    dates = staged(dates_held(obs, *tilestore.digest(obs)), "tile-years")
    complete = dates.filter(F.col("bits") == WHOLE)
    before = staged(tilestore.entries(obs.sparkSession, path).select(*TILE_YEAR, F.lit(True).alias("_there")), "entries")
    todo = tilestore.pending(complete, path, [BANDS_LAYER])
    tilestore.put(clean(obs, apply_qa, whole=todo), path, constant=BANDS_LAYER, inputs=todo.drop("layer"))
    status = F.when(F.col("bits") != WHOLE, "incomplete").when(F.col("_todo").isNull(), "stored").when(F.col("_there"), "redone").otherwise("written")
    marked = dates.join(before, TILE_YEAR, "left").join(todo.select(*TILE_YEAR, F.lit(True).alias("_todo")), TILE_YEAR, "left")
    return marked.select(*TILE_YEAR, "dates", "off_calendar", status.alias("status"))


def write_bucketed_bands(df: DataFrame, table: str, path: str, buckets: int = 64) -> None:
    """Append dense bands (of ``clean``) to a table that is stored by pixel: what is computed of it by pixel needs no exchange.

    ``buckets`` must be that of earlier appends. A pixel's dates lie in one bucket, in order.
    """
    dealt = df.repartition(buckets, *PIXEL)
    dealt.write.mode("append").bucketBy(buckets, *PIXEL).sortBy(*PIXEL, "day").option("path", path).format("parquet").saveAsTable(table)


def write_mask(obs: DataFrame, path: str) -> None:
    """The QA mask of every date as 1 (good) or the missing value (bad); tile-years that ``obs`` holds are replaced, others stay."""
    ok = px.qa_ok(F.col("state"), px.normalize_nodata(F.col("zenith"), FILL["zenith"]))
    mask = F.when(ok, F.lit(1)).otherwise(F.lit(px.MISSING))
    replace_partitions(by_file(obs.select(*PIXEL, "day", mask.alias("mask"))), path, TILE_YEAR)
