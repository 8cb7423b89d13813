"""Reports on quality bits and on the stages a value passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelseries.functions import pixel as px
from pixelseries.operators.bands import known_band, normalized
from pixelseries.sources import tilestore
from pixelseries.sources.adapter import ALL_BANDS, PIXEL
from pixelseries.sources.storage import bounded
from pixelseries.sources.tilestore import TILE_YEAR

#: So many tile-years are sent to all tasks; more are joined by a shuffle.
MAX_BROADCAST_TILE_YEARS = 500_000
COMPONENTS = {"cloud": px.cloud, "shadow": px.shadow, "adjacency": px.adjacency, "aerosol": px.aerosol}


def qa_bits(obs: DataFrame) -> DataFrame:
    return obs.select(*PIXEL, "day", "state", *[f(F.col("state")).alias(k) for k, f in COMPONENTS.items()])


def qa_component_counts(obs: DataFrame) -> DataFrame:
    """(day, component, value, pixels).

    Observations are counted by state word first; only the distinct words of a day are taken apart.
    """
    words = obs.groupBy("day", "state").agg(F.count("*").alias("n"))
    parts = [F.struct(F.lit(k).alias("component"), f(F.col("state")).alias("value")) for k, f in COMPONENTS.items()]
    long = words.select("day", "n", F.inline(F.array(*parts)))
    return long.groupBy("day", "component", "value").agg(F.sum("n").alias("pixels"))


def qa_component_layers(obs: DataFrame) -> DataFrame:
    """Raw bits of cloud, shadow and adjacency, and a 0/1 flag of high aerosol."""
    return qa_bits(obs).withColumn("aerosol", (F.col("aerosol") == 3).cast("int")).drop("state")


def stages(obs: DataFrame, bands: list[str] = ALL_BANDS) -> DataFrame:
    """(pixel key, day, band, state, zenith, ok, raw, clamped, masked): a row per band."""
    ok = px.qa_ok(F.col("state"), F.col("zenith"))
    long = normalized(obs).withColumn("ok", ok).unpivot([*PIXEL, "day", "state", "zenith", "ok"], bands, "band", "raw")
    clamped = px.zenith_clamp(F.col("raw"), F.col("zenith"))
    return long.withColumn("clamped", clamped).withColumn("masked", px.apply_qa(F.col("clamped"), F.col("ok")))


def band_day_report(obs: DataFrame, bands: list[str] = ALL_BANDS) -> DataFrame:
    """Per day and band: what is missing at each stage, clamps expected and found, distinct mask values.

    One aggregate of a day counts for all bands side by side; its few rows are laid out by band afterwards.
    """
    ok, zenith, state = px.qa_ok(F.col("state"), F.col("zenith")), F.col("zenith"), F.col("state")
    shared = {
        "missing_zenith": F.count_if(zenith.isNull()),
        "missing_state": F.count_if(F.coalesce(state, F.lit(px.MISSING)) == px.MISSING),
        "clamps_expected": F.count_if(zenith >= px.ZENITH_LIMIT),
        "good": F.count_if(ok),
        "n": F.count("*"),
    }
    counts = dict(shared)
    for b in map(known_band, bands):
        clamped = px.zenith_clamp(F.col(b), zenith)
        masked = px.apply_qa(clamped, ok)
        counts |= {
            f"missing_raw {b}": F.count_if(F.col(b).isNull()),
            f"missing_without_qa {b}": F.count_if(clamped.isNull()),
            f"missing_with_qa {b}": F.count_if(masked.isNull()),
            f"clamps_without_qa {b}": F.count_if(clamped == px.CLAMPED),
            f"clamps_with_qa {b}": F.count_if(masked == px.CLAMPED),
        }
    days = normalized(obs).groupBy("day").agg(*[c.alias(name) for name, c in counts.items()])
    own = ("missing_raw", "missing_without_qa", "missing_with_qa", "clamps_without_qa", "clamps_with_qa")
    cells = [F.struct(F.lit(b).alias("band"), *[F.col(f"{name} {b}").alias(name) for name in own]) for b in bands]
    mask = F.concat_ws(",", F.when(F.col("good") < F.col("n"), "0"), F.when(F.col("good") > 0, "1"))
    return days.select("day", "missing_zenith", "missing_state", "clamps_expected", mask.alias("mask_values"), F.inline(F.array(*cells)))


def stage_dump(obs: DataFrame, comp: DataFrame, periods: DataFrame, band: str, day: int) -> DataFrame:
    """One band on one day at every stage, next to the composite that the day went into."""
    one = stages(obs.filter(F.col("day") == day), [known_band(band)])
    periods = periods.filter(F.col("day") == day).select(*TILE_YEAR, "day", "period")
    placed = one.join(periods, [*TILE_YEAR, "day"], "left")
    # Spark moves the semi-join below the composites' aggregate: those of tile-years without the day are never made.
    whole = comp.join(bounded(periods.select(*TILE_YEAR), MAX_BROADCAST_TILE_YEARS), TILE_YEAR, "left_semi")
    whole = whole.select(*PIXEL, "period", F.col(band).alias("composite"))
    return placed.join(whole, [*PIXEL, "period"], "left").select(
        *PIXEL, "day", "period", "raw", "clamped", "masked", F.col("ok").cast("int").alias("mask"), "zenith", "state", "composite"
    )


def write_dump(df: DataFrame, path: str) -> None:
    """Store quality layers or a stage dump (rows with a pixel key and a day) in place of the tile-years and days that ``df`` holds.

    Days are sorted inside the files of their tile-year, so a reader of few days skips the row groups and pages of others.
    """
    tilestore.put(df, path, "day")


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    return tilestore.read(spark, path, "day").drop("run")
