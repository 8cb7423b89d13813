"""Where jobs put their tables, and how tables that grow by tile-year are read and added to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``, which all executors share; a session of one machine may use its own folder."""
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder and read it back, so that what follows reads it in place of computing it again."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows; else leave the join to a shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table in ``path`` as it is now; no rows if nothing is there yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Write ``df`` partitioned by ``by``; of what is there, only the partitions that ``df`` holds are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
