"""The file catalog: names, calendar, versions, pairs, completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelseries.functions.pixel import bit
from pixelseries.sources.adapter import DATES, season_columns

PRODUCTS = ("CH", "CQ")
FIRST_DAY, STEP = 65, 16
#: Bits of a tile-year that has all dates of the calendar.
WHOLE = (1 << DATES) - 1


def tile_is_valid(tile: Column) -> Column:
    """Position 0 is an h, position 3 a v, and two digits follow each."""
    low = F.lower(tile)
    shape = (F.substring(low, 1, 1) == "h") & (F.substring(low, 4, 1) == "v")
    return F.coalesce(shape & F.rlike(low, F.lit(r"^h\d\dv\d\d$")), F.lit(False))


def parse_tile_id(df: DataFrame, tile: str = "tile") -> DataFrame:
    """Add ``valid``, and ``h`` and ``v`` where the tile id is valid."""
    number = lambda at: F.when(F.col("valid"), F.substring(tile, at, 2).try_cast("int"))
    return df.withColumn("valid", tile_is_valid(F.col(tile))).withColumns({"h": number(2), "v": number(5)})


def granule_catalog(names: DataFrame, path: str = "path") -> DataFrame:
    """Split file names; ``valid`` is false where the product or the tile is not known."""
    part = F.split(F.col(path), r"\.")
    at = lambda k: F.get(part, F.lit(k))
    named = names.select(
        F.upper(F.substring(at(0), 6, 2)).alias("product"),
        at(2).alias("tile"),
        F.regexp_replace(at(1), "A", "").try_cast("int").alias("day"),
        at(3).alias("collection"),
        at(4).alias("stamp"),
        F.col(path).alias("path"),
    )
    named = named.withColumns({"year": F.expr("day div 1000").cast("int"), "doy": (F.col("day") % 1000).cast("int")})
    split = parse_tile_id(named).withColumnRenamed("valid", "_tile")
    known = F.col("product").isin(*PRODUCTS) & F.col("day").isNotNull()
    return split.withColumn("valid", F.coalesce(known, F.lit(False)) & F.col("_tile")).drop("_tile")


def calendar(years: DataFrame, keep: Sequence[str] = ("season_year",)) -> DataFrame:
    """(keep, idx, day): 23 dates for each row of ``years`` (season_year among ``keep``), the last four of them in the next year."""
    rows = years.select(*keep, F.explode(F.sequence(F.lit(0), F.lit(DATES - 1))).alias("idx"))
    return rows.withColumn("day", calendar_day(F.col("season_year"), F.col("idx")))


def calendar_day(year: Column, idx: Column) -> Column:
    """The day (year and day of it) of a season year's date."""
    first = year * 1000 + FIRST_DAY + idx * STEP
    later = (year + 1) * 1000 + 1 + (idx - 19) * STEP
    return F.when(idx < 19, first).otherwise(later).cast("int")


def on_calendar(day: Column, year: Column, idx: Column) -> Column:
    """Whether a day is one of the 23 dates of its season year; days between dates share the ``idx`` of the date before."""
    return F.coalesce((day == calendar_day(year, idx)) & idx.between(0, DATES - 1), F.lit(False))


def date_bits(day: Column, year: Column, idx: Column, where: Column | None = None) -> Column:
    """Aggregate: a bit for each date of the calendar that is there; days off the calendar set none."""
    there = on_calendar(day, year, idx) if where is None else on_calendar(day, year, idx) & where
    return F.coalesce(F.bit_or(F.when(there, bit(idx))), F.lit(0))


def latest_granule(granules: DataFrame) -> DataFrame:
    """One file for each product, tile and day: the latest stamp, then the last path.

    Stamps are compared as numbers, whatever their length; one that is no number comes before all others.
    """
    digits = F.when(F.rlike("stamp", F.lit("^[0-9]+$")), F.ltrim("stamp", F.lit("0")))
    order = Window.partitionBy("product", "tile", "day").orderBy(
        F.length(digits).desc_nulls_last(), digits.desc_nulls_last(), F.desc("stamp"), F.desc("path")
    )
    return granules.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def pair(ch: DataFrame, cq: DataFrame, on: list[str]) -> DataFrame:
    """CH with CQ of the same place and date."""
    return ch.join(cq, on, "inner")


def pair_granules(granules: DataFrame) -> DataFrame:
    """(tile, day, ch_path, cq_path); the stamps of the two may differ."""
    latest = latest_granule(granules)
    side = lambda p, name: latest.filter(F.col("product") == p).select("tile", "day", F.col("path").alias(name))
    return pair(side("CH", "ch_path"), side("CQ", "cq_path"), ["tile", "day"])


def tile_years(granules: DataFrame, years: list[int] | None = None, tiles: list[str] | None = None) -> DataFrame:
    """(season_year, tile) that own a file of day 65."""
    found = granules.filter(F.col("doy") == FIRST_DAY)
    if years:
        found = found.filter(F.col("year").isin(years))
    if tiles:
        found = found.filter(F.col("tile").isin(tiles))
    return found.select(F.col("year").alias("season_year"), "tile").distinct()


def dates_of_files(granules: DataFrame) -> DataFrame:
    """(season_year, tile, ch, cq): for tile-years that own a file of day 65, the calendar's dates of each product, as bits."""
    season = season_columns(F.col("year"), F.col("doy"))
    bits = [date_bits(F.col("day"), season["season_year"], season["idx"], F.col("product") == p).alias(p.lower()) for p in PRODUCTS]
    held = granules.groupBy(season["season_year"].alias("season_year"), "tile").agg(*bits)
    return tile_years(granules).join(held, ["season_year", "tile"], "left").fillna(0, [p.lower() for p in PRODUCTS])


def missing_granules(granules: DataFrame) -> DataFrame:
    """(season_year, tile, day, product) that the calendar asks for and no file holds: the bits that are not set."""
    cells = [F.struct(F.lit(p).alias("product"), F.col(p.lower()).alias("bits")) for p in PRODUCTS]
    rows = dates_of_files(granules).select("season_year", "tile", F.inline(F.array(*cells)))
    rows = rows.filter(F.col("bits") != WHOLE).withColumn("idx", F.explode(F.sequence(F.lit(0), F.lit(DATES - 1))))
    gone = rows.filter(F.expr("shiftright(bits, idx) & 1") == 0)
    return gone.select("season_year", "tile", calendar_day(F.col("season_year"), F.col("idx")).alias("day"), "product")


def incomplete_tiles(granules: DataFrame) -> DataFrame:
    """(season_year, tile, days): tile-years of which fewer than the calendar's 23 dates have both files."""
    days = F.bit_count(F.col("ch").bitwiseAND(F.col("cq"))).cast("long")
    return dates_of_files(granules).select("season_year", "tile", days.alias("days")).filter(F.col("days") < DATES)


def off_calendar(granules: DataFrame) -> DataFrame:
    """The files whose day is no date of the calendar: nothing asks for them."""
    season = season_columns(F.col("year"), F.col("doy"))
    return granules.filter(~on_calendar(F.col("day"), season["season_year"], season["idx"]))
