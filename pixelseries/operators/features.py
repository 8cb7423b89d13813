"""The metric catalog, chosen metrics in one pass, feature and training tables, stored metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from pixelseries.functions.pixel import to_stored
from pixelseries.operators import metrics as mt
from pixelseries.operators.composite import composites
from pixelseries.sources import tilestore
from pixelseries.sources.adapter import PIXEL
from pixelseries.sources.storage import staged
from pixelseries.sources.tilestore import TILE_YEAR


def metric_catalog(spark: SparkSession) -> DataFrame:
    """(metric, band, layer, description): one row per feature."""
    rows = [(name, b, f"{name}-{b}", m.says) for name, m in mt.registry().items() for b in m.bands]
    return spark.createDataFrame(rows, "metric string, band string, layer string, description string")


def _chosen(names: list[str] | None) -> dict[str, mt.Metric]:
    known = mt.registry()
    unknown = sorted(set(names or ()) - known.keys())
    if unknown:
        raise ValueError(f"unknown metrics {unknown}")
    return {n: known[n] for n in (names or known)}


def feature_table(comp: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One wide row per pixel, columns ``<metric>__<band>``, from one aggregate over ``comp`` that holds what the chosen metrics read.

    Composites are laid out by pixel, so the aggregate needs no further exchange.
    """
    chosen = _chosen(names)
    wide = mt.slots(comp, mt.needs_of(chosen.values()))
    known = mt.built_in()  # whose values are doubles
    value = lambda name, m, b: m.value(b) if name in known else m.value(b).cast("double")
    return wide.select(*PIXEL, *[value(name, m, b).alias(f"{name}__{b}".replace("-", "_")) for name, m in chosen.items() for b in m.bands])


def run_metrics(comp: DataFrame, names: list[str] | None = None) -> DataFrame:
    """(pixel key, metric, band, value) of the chosen metrics, or of all.

    A pixel's features become an array that is laid out at once: an unpivot would go over its columns again for each row.
    """
    cell = "named_struct('metric', '{0}', 'band', '{1}', 'value', `{2}`)"
    cells = [cell.format(n, b, f"{n}__{b}".replace("-", "_")) for n, m in _chosen(names).items() for b in m.bands]
    return feature_table(comp, names).selectExpr(*PIXEL, f"inline(array({', '.join(cells)}))")


def catalog_report(comp: DataFrame) -> DataFrame:
    """The catalog with, per feature, the pixels it was computed for and those where it is present: one aggregate over all."""
    wide = feature_table(comp)
    features = [c for c in wide.columns if c not in PIXEL]
    counts = wide.agg(F.count("*").alias("pixels"), *[F.count(c).alias(c) for c in features])
    long = counts.unpivot(["pixels"], features, "feature", "present")
    catalog = metric_catalog(comp.sparkSession)
    column = F.regexp_replace(F.concat_ws("__", "metric", "band"), "-", "_")
    return catalog.withColumn("feature", column).join(long, "feature").drop("feature")


def training_table(samples: DataFrame, features: DataFrame) -> DataFrame:
    """Every sample with its features; ``matched`` tells whether the pixel has any."""
    marked = features.withColumn("matched", F.lit(True))
    joined = samples.join(marked, PIXEL, "left")
    return joined.withColumn("matched", F.coalesce("matched", F.lit(False)))


def sampled_training_table(samples: DataFrame, obs: DataFrame, names: list[str] | None = None, **options) -> DataFrame:
    """``training_table`` from observations: composites and features are made of the samples' pixels alone."""
    return training_table(samples, feature_table(composites(obs, pixels=samples, **options), names))


def write_metrics(long: DataFrame, path: str, stored_missing: bool = True, source: DataFrame | None = None) -> None:
    """Store the tile-years and metrics that ``long`` holds in place of older ones; missing values take their stored form if asked.

    ``source`` are the composites they were made of, by which ``reuse_or_compute`` knows whether they still hold. The
    catalog with the descriptions of all layers is stored beside them, in a folder that readers of the table pass over.
    """
    value = to_stored(F.col("value")).cast("double") if stored_missing else F.col("value")
    made = long.select(*PIXEL, "metric", "band", value.alias("value"))
    tilestore.put(made, path, "metric", inputs=None if source is None else tilestore.inputs_of(source))
    metric_catalog(long.sparkSession).coalesce(1).write.mode("overwrite").parquet(f"{path}/_catalog")


def stored_metrics(spark: SparkSession, path: str, described: bool = False) -> DataFrame:
    """The stored rows, each with the description of its layer if asked."""
    rows = tilestore.read(spark, path, "metric").drop("run")
    if not described:
        return rows
    says = spark.read.parquet(f"{path}/_catalog").select("metric", "band", "description")  # a row for each layer
    return rows.join(F.broadcast(says), ["metric", "band"], "left")


_KEY = [StructField(c, IntegerType()) for c in TILE_YEAR] + [StructField("pixel", LongType())]
_VALUE = [StructField("band", StringType()), StructField("value", DoubleType())]
LAYER = StructType([*_KEY, StructField("metric", StringType()), *_VALUE])
STEP = StructType([*_KEY, StructField("step", IntegerType()), *_VALUE])


def _reused(spark: SparkSession, path: str, layer: str, schema: StructType, names: list[str], run: int, wanted: DataFrame) -> DataFrame:
    rows = tilestore.read(spark, path, layer, schema=schema).filter(F.col(layer).isin(names))
    return rows.join(wanted.select(*TILE_YEAR), TILE_YEAR, "left_semi").select(*schema.names, (F.col("run") != run).alias("reused"))


def reuse_or_compute(comp: DataFrame, name: str, path: str) -> DataFrame:
    """Rows of metric ``name`` for all tile-years of ``comp``: those stored in ``path`` that were made of the same composites, else computed.

    What is computed is added to ``path``. Late pixels, changed values and writes that were cut off make a tile-year computed again.
    """
    inputs = staged(tilestore.inputs_of(comp), "inputs")
    todo = tilestore.pending(inputs, path, [name])
    made = mt.metric_long(tilestore.only(comp, todo), name).withColumn("metric", F.lit(name))
    run = tilestore.put(made.select(*LAYER.names), path, "metric", inputs=inputs)
    return _reused(comp.sparkSession, path, "metric", LAYER, [name], run, inputs)


def reuse_or_compute_bands(source: DataFrame, make: Callable[[DataFrame], DataFrame], bands: list[str], path: str) -> DataFrame:
    """Layers of all ``bands`` for all tile-years of ``source``: those in ``path`` that were made of the same rows, else made and added.

    ``make`` turns rows of ``source`` into (pixel key, step, band, value), with a day or a period as the step. It sees, in one
    pass, the tile-years that miss any of the bands, and of what it makes only missing bands are written.
    """
    inputs = staged(tilestore.inputs_of(source), "inputs")
    todo = tilestore.pending(inputs, path, bands)
    made = make(tilestore.only(source, todo)).select(*PIXEL, F.col("step").cast("int"), "band", F.col("value").cast("double").alias("value"))
    run = tilestore.put(tilestore.only(made, todo, "band").select(*STEP.names), path, "band", inputs=inputs)
    return _reused(source.sparkSession, path, "band", STEP, bands, run, inputs)


def reuse_or_compute_band(source: DataFrame, make: Callable[[DataFrame], DataFrame], band: str, path: str) -> DataFrame:
    """``reuse_or_compute_bands`` for one band: ``make`` gives (pixel key, step, value)."""
    return reuse_or_compute_bands(source, lambda s: make(s).withColumn("band", F.lit(band)), [band], path)
