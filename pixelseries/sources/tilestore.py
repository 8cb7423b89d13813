"""Tables that grow by tile-year, with a log of what is in them.

A write appends a run: its rows go to ``run=<number>`` in folders of tile-years, sorted inside the files by layer and
pixel, so that row groups and pages of other layers are skipped. Once they are there, the log (``_log`` beside them) gets
an entry for each tile-year and layer: the run, its rows, and the digest of the input that they were made of. Readers
join the log and see the newest run of each tile-year and layer. So a write that is killed leaves rows that nobody reads and is
done again; an input with other rows than at the last time is pending again; and what is complete stays as it is.

A digest is the number of rows and the sum of their hashes: one hash aggregate, the same in any order.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructType

from pixelseries.sources.storage import bounded, staged, stored

TILE_YEAR = ["h", "v", "season_year"]
LOG = StructType()
for _name in TILE_YEAR:
    LOG.add(_name, IntegerType())
LOG.add("layer", StringType()).add("run", LongType()).add("rows", LongType()).add("input_rows", LongType()).add("digest", DecimalType(38, 0))
#: Neighbouring pixels that one task writes, about; a tile-year of 4800 x 4800 pixels is written by 22 tasks.
FILE_PIXELS = 1 << 20
#: A log of so many entries is sent to all tasks; a larger one is joined by a shuffle.
MAX_BROADCAST_ENTRIES = 500_000


def digest(df: DataFrame) -> list[Column]:
    """Aggregates ``input_rows`` and ``digest`` over all columns of ``df``."""
    return [F.count("*").alias("input_rows"), F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")).cast("decimal(38,0)").alias("digest")]


def inputs_of(df: DataFrame) -> DataFrame:
    """(tile-year, input_rows, digest)."""
    return df.groupBy(*TILE_YEAR).agg(*digest(df))


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The newest entry of each tile-year and layer."""
    newest = stored(spark, f"{path}/_log", LOG).groupBy(*TILE_YEAR, "layer")
    held = ("rows", "input_rows", "digest")
    return newest.agg(F.max("run").alias("run"), *[F.max_by(c, "run").alias(c) for c in held])


def pending(inputs: DataFrame, path: str, layers: list[str]) -> DataFrame:
    """(tile-year, layer, input_rows, digest) of ``inputs`` that the log does not hold with the same digest."""
    wanted = inputs.select(*TILE_YEAR, "input_rows", "digest", F.explode(F.array(*map(F.lit, layers))).alias("layer"))
    done = entries(inputs.sparkSession, path)
    return staged(wanted.join(done, [*TILE_YEAR, "layer", "input_rows", "digest"], "left_anti"), "pending")


def only(df: DataFrame, todo: DataFrame, layer: str | None = None) -> DataFrame:
    """Rows of ``df`` whose tile-year (and layer) is in ``todo``."""
    by = TILE_YEAR if layer is None else [*TILE_YEAR, layer]
    keys = todo.select(*TILE_YEAR, *([] if layer is None else [F.col("layer").alias(layer)])).distinct()
    return df.join(bounded(keys, MAX_BROADCAST_ENTRIES), by, "left_semi")


def _layer(layer: str | None, constant: str) -> Column:
    return F.lit(constant) if layer is None else F.col(layer).cast("string")


def put(df: DataFrame, path: str, layer: str | None = None, constant: str = "", inputs: DataFrame | None = None) -> int:
    """Append the rows of ``df`` as a run, then log what was written; returns the run's number.

    ``layer`` is the column that names layers; without it all rows are of the layer ``constant``. The digests of
    ``inputs`` are logged; without it those of the rows themselves are.
    """
    spark, run = df.sparkSession, time.time_ns()
    layers = [] if layer is None else [layer]
    within = [c for c in (*layers, "pixel") if c in df.columns]
    dealt = df.repartition(*TILE_YEAR, F.floor(F.col("pixel") / FILE_PIXELS)).sortWithinPartitions(*TILE_YEAR, *within)
    dealt.write.partitionBy(*TILE_YEAR).parquet(f"{path}/run={run}")
    made = spark.read.schema(df.schema).parquet(f"{path}/run={run}")
    own = [] if inputs is not None else digest(made)[1:]
    written = made.groupBy(*TILE_YEAR, _layer(layer, constant).alias("layer")).agg(F.count("*").alias("rows"), *own)
    if inputs is None:
        written = written.withColumn("input_rows", F.col("rows"))
    else:
        written = written.join(inputs, TILE_YEAR)
    log = written.withColumn("run", F.lit(run)).select(*[F.col(f.name).cast(f.dataType) for f in LOG])
    log.coalesce(1).write.mode("append").parquet(f"{path}/_log")
    return run


def read(spark: SparkSession, path: str, layer: str | None = None, constant: str = "", schema: StructType | None = None) -> DataFrame:
    """The rows of the newest run of each tile-year and layer, with their ``run``.

    ``schema`` is that of the rows; it may be left out where there are some.
    """
    if schema is None:
        rows = spark.read.parquet(path)
        names = [c for c in rows.columns if c not in (*TILE_YEAR, "run")]
        whole = rows.select(*[F.col(c).cast("int") for c in TILE_YEAR], F.col("run").cast("long"), *names)
    else:
        whole = stored(spark, path, StructType(schema.fields).add("run", LongType()))
    now = entries(spark, path).select(*TILE_YEAR, "run", F.col("layer").alias("_layer"))
    named = whole.withColumn("_layer", _layer(layer, constant))
    return named.join(bounded(now, MAX_BROADCAST_ENTRIES), [*TILE_YEAR, "run", "_layer"]).drop("_layer")


def stale_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run): runs whose rows nobody reads any more, or never did; once no reader holds them, their folders can go."""
    return spark.read.parquet(path).select(F.col("run").cast("long")).distinct().join(entries(spark, path), "run", "left_anti")
