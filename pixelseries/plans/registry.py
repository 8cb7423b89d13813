"""The registered pixel queries: each applies one operator to the adapter's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelseries.functions import pixel as px
from pixelseries.operators import bands as bd
from pixelseries.operators import catalog as cat
from pixelseries.operators import composite as cp
from pixelseries.operators import diagnostics as dg
from pixelseries.operators import features as ft
from pixelseries.operators import metrics as mt
from pixelseries.plans import oracle
from pixelseries.sources import adapter as ad
from pixelseries.sources.adapter import PIXEL, once
from pixelseries.sources.storage import new_folder

#: Dates and band that single-slice queries show.
SLICE_DAYS = [1995065, 1996241]
DUMP_DAY, DUMP_BAND = 1995065, "b5"


def obs(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "obs", lambda: ad.observations(spark, sf))


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "clean", lambda: bd.clean(obs(spark, sf)))


def comp(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "comp", lambda: cp.composites(obs(spark, sf), dealt=True))


def granules(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "granules", lambda: cat.granule_catalog(ad.granules(spark, sf)))


def valid_granules(spark: SparkSession, sf: str) -> DataFrame:
    return granules(spark, sf).filter("valid")


def periods(spark: SparkSession, sf: str) -> DataFrame:
    return cp.period_map(bd.tile_calendar(obs(spark, sf)))


def on_obs(make):
    return lambda spark, sf: make(bd.normalized(obs(spark, sf)))


def metric(name: str):
    return lambda spark, sf: mt.metric_long(comp(spark, sf), name)


def granule_catalog(spark, sf):
    names = ad.granules(spark, sf)
    found = cat.granule_catalog(names.unionByName(ad.bad_names(names)))
    return found.select("product", "tile", "day", "year", "doy", "collection", "stamp", "path", "valid")


def parse_tile_id(spark, sf):
    names = ad.granules(spark, sf)
    tiles = names.unionByName(ad.bad_names(names)).select(F.split("path", r"\.")[2].alias("tile")).distinct()
    return cat.parse_tile_id(tiles)


def season_calendar(spark, sf):
    return cat.calendar(valid_granules(spark, sf).select(F.col("year").alias("season_year")).distinct())


def stack_band(spark, sf):
    return bd.stacked_values(bd.stack_bands(obs(spark, sf)))


def write_read_bands(spark, sf):
    path = new_folder(spark, "bands")
    bd.write_bands(clean(spark, sf), path)
    bd.write_bands(clean(spark, sf).limit(0), path)  # what is there stays
    return bd.read_bands(spark, path).select(*PIXEL, "day", *ad.ALL_BANDS)


def stored_composites(spark, sf):
    """Bands go to a table stored by pixel, and composites come from it."""
    path = new_folder(spark, "pixel-bands")
    name = "pixel_bands_" + path[-32:]
    bd.write_bucketed_bands(clean(spark, sf), name, path)
    return cp.composites_of_bands(spark.table(name)).select(*PIXEL, "period", "first_day", *ad.ALL_BANDS, "ndvi", "therm")


def write_metrics(spark, sf):
    path = new_folder(spark, "metrics")
    ft.write_metrics(ft.run_metrics(comp(spark, sf)), path)
    return ft.stored_metrics(spark, path, described=True).select(*PIXEL, "metric", "band", "value", "description")


def reuse_or_compute(spark, sf):
    path = new_folder(spark, "metrics")
    first = comp(spark, sf).filter("season_year % 2 = 0")  # what an earlier run has left
    ft.reuse_or_compute(first, "band_min", path)
    return ft.reuse_or_compute(comp(spark, sf), "band_min", path)


def reuse_or_compute_band(spark, sf):
    path = new_folder(spark, "layers")
    make = lambda o: bd.read_values(o, DUMP_BAND, True).withColumnRenamed("day", "step")
    ft.reuse_or_compute_band(obs(spark, sf).filter("season_year % 2 = 0"), make, DUMP_BAND, path)
    return ft.reuse_or_compute_band(obs(spark, sf), make, DUMP_BAND, path)


def reuse_or_compute_bands(spark, sf):
    """Earlier runs have left all bands of some tile-years, and two bands of others."""
    path = new_folder(spark, "layers")
    make = lambda o: bd.cleaned_rows(o).withColumnRenamed("day", "step").unpivot([*PIXEL, "step"], ad.ALL_BANDS, "band", "value")
    two = lambda o: make(o).filter(F.col("band").isin("b1", "b2"))
    ft.reuse_or_compute_bands(obs(spark, sf).filter("season_year % 2 = 0"), make, ad.ALL_BANDS, path)
    ft.reuse_or_compute_bands(obs(spark, sf).filter("season_year % 3 = 0"), two, ["b1", "b2"], path)
    return ft.reuse_or_compute_bands(obs(spark, sf), make, ad.ALL_BANDS, path)


def collate_batch(spark, sf):
    path = new_folder(spark, "bands")
    bd.collate_batch(obs(spark, sf).filter("season_year % 2 = 0"), path)
    return bd.collate_batch(obs(spark, sf), path)


def write_dump(spark, sf):
    path = new_folder(spark, "dump")
    dg.write_dump(dg.qa_component_layers(obs(spark, sf)), path)
    return dg.read_dump(spark, path)


def write_mask(spark, sf):
    path = new_folder(spark, "masks")
    bd.write_mask(obs(spark, sf), path)
    return spark.read.parquet(path).select(*PIXEL, "day", "mask")


def ok():
    return px.qa_ok(F.col("state"), F.col("zenith"))


def long_of(value, name: str = "value"):
    """All bands of the filled observations, one row each, with a value from (band value, row)."""

    def make(o: DataFrame) -> DataFrame:
        long = o.unpivot([*PIXEL, "day", "state", "zenith"], ad.ALL_BANDS, "band", "raw")
        return long.select(*PIXEL, "day", "band", value(F.col("raw")).alias(name))

    return on_obs(make)


def missing_to_null(spark, sf):
    long = bd.normalized(obs(spark, sf)).unpivot([*PIXEL, "day"], ad.ALL_BANDS, "band", "raw")
    stored = long.select(*PIXEL, "day", "band", px.to_stored(F.col("raw")).alias("stored"))
    return stored.withColumn("value", px.from_stored(F.col("stored")))


def k_means(prefix: str):
    def make(spark, sf):
        known = {k: mt.registry()[f"{prefix}_{k}_mean"] for k in (3, 6, 8)}
        wide = mt.slots(comp(spark, sf), mt.needs_of(known.values()))
        return mt.to_long_by(wide, {(b, k): m.value(b) for k, m in known.items() for b in m.bands}, ["band", "k"])

    return make


def temp_mean_greenest3(spark, sf):
    wide = mt.slots(comp(spark, sf), {"green": ["b31"]})
    return mt.to_long_by(wide, {(k,): mt.top_mean("green", "b31", k) for k in (1, 3)}, ["k"])


def amplitudes(key: str):
    def make(spark, sf):
        plain = {(b, False): mt.amplitude(b) for b in mt.B8}
        ranked = {(b, True): mt.ranked_amplitude(key, b) for b in mt.B8}
        return mt.to_long_by(mt.slots(comp(spark, sf), {"own": mt.B8, key: mt.B8}), plain | ranked, ["band", "ranked"])

    return make


def training_table(spark, sf):
    features = ft.feature_table(comp(spark, sf))
    return ft.training_table(ad.samples(spark, sf), features)


def queries() -> dict:
    found = {
        "granule_catalog": granule_catalog,
        "parse_tile_id": parse_tile_id,
        "season_calendar": season_calendar,
        "latest_granule": lambda s, d: cat.latest_granule(valid_granules(s, d)).select("product", "tile", "day", "stamp", "path"),
        "pair_granules": lambda s, d: cat.pair_granules(valid_granules(s, d)),
        "discover_tile_years": lambda s, d: cat.tile_years(valid_granules(s, d)),
        "missing_granules": lambda s, d: cat.missing_granules(valid_granules(s, d)),
        "incomplete_tiles": lambda s, d: cat.incomplete_tiles(valid_granules(s, d)),
        "band_long": lambda s, d: bd.band_long(obs(s, d)),
        "day_slice": lambda s, d: bd.day_slice(obs(s, d), DUMP_BAND, SLICE_DAYS),
        "stack_band": stack_band,
        "write_read_bands": write_read_bands,
        "stored_composites": stored_composites,
        "write_metrics": write_metrics,
        "reuse_or_compute": reuse_or_compute,
        "reuse_or_compute_band": reuse_or_compute_band,
        "reuse_or_compute_bands": reuse_or_compute_bands,
        "collate_batch": collate_batch,
        "write_dump": write_dump,
        "write_mask": write_mask,
        "normalize_nodata": lambda s, d: bd.normalized(obs(s, d)).select(*PIXEL, "day", *ad.ALL_BANDS, "zenith"),
        "zenith_clamp": long_of(lambda v: px.zenith_clamp(v, F.col("zenith"))),
        "qa_bits": lambda s, d: dg.qa_bits(obs(s, d)),
        "qa_mask": on_obs(lambda o: o.select(*PIXEL, "day", ok().alias("ok"))),
        "apply_qa": long_of(lambda v: px.apply_qa(v, ok())),
        "missing_to_null": missing_to_null,
        "ndvi": on_obs(lambda o: o.select(*PIXEL, "day", px.ndvi(F.col("b1"), F.col("b2")).alias("ndvi"))),
        "thermal_key": on_obs(lambda o: o.select(*PIXEL, "day", px.thermal_key(F.col("b31")).alias("therm"))),
        "period_map": periods,
        "composite_mean": lambda s, d: comp(s, d).select(*PIXEL, "period", "first_day", *ad.ALL_BANDS),
        "composite_ndvi": lambda s, d: comp(s, d).select(*PIXEL, "period", "ndvi", "therm"),
        "dense_grid": lambda s, d: bd.dense_grid(obs(s, d)).select(*PIXEL, "day", "idx", *ad.ALL_BANDS, "state", "zenith"),
        "unsorted_monthly": lambda s, d: mt.unsorted_monthly(comp(s, d)),
        "sort_by_self": lambda s, d: mt.sorted_by_self(comp(s, d)),
        "lowest_k_mean": k_means("lowest"),
        "greenest_k_mean": k_means("greenest"),
        "warmest_k_mean": k_means("warmest"),
        "temp_mean_warmest3": metric("temp_mean_warmest3"),
        "temp_mean_greenest3": temp_mean_greenest3,
        "amp_greenest": amplitudes("green"),
        "amp_warmest": amplitudes("temp"),
        "metric_catalog": lambda s, d: ft.catalog_report(comp(s, d)),
        "run_metrics": lambda s, d: ft.run_metrics(comp(s, d)),
        "feature_table": lambda s, d: ft.feature_table(comp(s, d)),
        "training_table": training_table,
        "qa_component_counts": lambda s, d: dg.qa_component_counts(obs(s, d)),
        "qa_component_layers": lambda s, d: dg.qa_component_layers(obs(s, d)),
        "band_day_report": lambda s, d: dg.band_day_report(obs(s, d)),
        "stage_dump": lambda s, d: dg.stage_dump(obs(s, d), comp(s, d), periods(s, d), DUMP_BAND, DUMP_DAY),
    }
    for name in ("band_min", "band_median", "band_max", "band_amplitude"):
        found[name] = metric(name)
    for name in ("green", "temp"):
        found |= {f"{name}_{at}": metric(f"{name}_{at}") for at in ("max", "median", "min")}
    return found


def oracle_sql() -> dict[str, str]:
    return oracle.statements(SLICE_DAYS, DUMP_DAY, DUMP_BAND)
