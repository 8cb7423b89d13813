"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The six ASCII white-space characters, as a character class and as a string.
WS_CLASS = r"[\x20\x09-\x0D]"
WS_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_OWN: dict[str, str] = {}

_KINDS = {"int": T.IntegerType(), "long": T.LongType(), "string": T.StringType(), "binary": T.BinaryType(), "strings": T.ArrayType(T.StringType())}


def struct(**columns) -> T.StructType:
    """A schema from names of types, or types; unlike a DDL string it needs no session, so that tasks can make it too."""
    return T.StructType([T.StructField(name, _KINDS.get(kind, kind)) for name, kind in columns.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see (``spark.checkpoint.dir``).

    Only a local session may go without that setting; it then gets a folder of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", "")
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        found = _OWN[app]
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The key of a row, for tables whose ids can be null or repeat.
ROW = "_row_key"


def unused(name: str, columns) -> str:
    """``name``, with as many underscores as it takes to be none of ``columns`` in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def apart(columns, prefix: str = "_x") -> str:
    """A prefix that none of ``columns`` has: names made of it meet no other."""
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def is_scan(df: DataFrame) -> bool:
    """Whether ``df`` is files as they were read, so that every pass over it finds the same rows in the same places.

    Columns may be dropped or added by expressions of the row, and rows filtered.
    """
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter") and plan.deterministic():
        plan = plan.child()
    # A relation of other kinds (JDBC) may come in another order each time.
    return plan.getClass().getSimpleName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation"


def keyed(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a key of each row on which all later reads agree.

    Rows of a plain Parquet scan have their file and place in it; all others are written once with a number.
    """
    if is_scan(df):
        try:
            return df.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias(ROW))
        except AnalysisException:
            pass  # no Parquet
    return staged(df.withColumn(ROW, F.struct(F.monotonically_increasing_id().alias("row_index"))), name)


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns of these names (in any case) renamed, and the way back for ``withColumnsRenamed``."""
    back, columns = {}, list(df.columns)
    for c in df.columns:
        if c.lower() in names:
            back[unused("_aside", columns)] = c
            columns.append(list(back)[-1])
    return df.withColumnsRenamed({c: name for name, c in back.items()}), back


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows; else leave the join to a shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


#: So many bitmaps of row places (4 KB each) are sent to all tasks; beyond, rows are dropped by a join that shuffles.
MAX_BITMAPS = 8192


def dropped(rows: DataFrame, losers: DataFrame) -> DataFrame:
    """``rows`` (of ``keyed``) without those whose key is in ``losers``.

    Keys are places in files, so losers become bitmaps of 32,768 places: a bit for each row of the files at most. While those are few
    they are broadcast, and rows, with their texts, stay where they are read.
    """
    fields = rows.schema[ROW].dataType.names
    file = F.col(f"{ROW}.file_path") if "file_path" in fields else F.lit("")
    place = F.col(f"{ROW}.row_index") + 1  # Spark counts bits from 1
    p = apart(rows.columns)
    maps = losers.groupBy(file.alias(f"{p}file"), F.bitmap_bucket_number(place).alias(f"{p}bucket"))
    maps = staged(maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(f"{p}bits")), "dropped")
    if maps.limit(MAX_BITMAPS + 1).count() > MAX_BITMAPS:
        return rows.join(losers, ROW, "left_anti").select(*rows.columns)
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(f"{p}bits", (F.floor(at / 8) + 1).cast("int"), 1)), 16, 10).cast("int")
    lost = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    met = rows.join(F.broadcast(maps), (file == F.col(f"{p}file")) & (F.bitmap_bucket_number(place) == F.col(f"{p}bucket")), "left")
    return met.filter(~lost).select(*rows.columns)


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space; none for an empty text."""
    bare = F.btrim(text, F.lit(WS_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WS_CLASS + "+"))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: So many chosen documents are sent to all tasks; more are joined by a shuffle.
MAX_CHOSEN = 100_000


def training_texts(documents: DataFrame, chosen: DataFrame, max_bytes: int, text_col: str = "text") -> DataFrame:
    """(text, label) of the ``chosen`` documents (doc_id, label, place): whole texts of ``max_bytes`` in all at most.

    ``chosen`` has few rows, by its maker's parameter; it is broadcast only if they are. Rows that share an id give one text, that with the least hash.
    Documents are taken by place as long as they fit; one that does not is passed over.
    """
    texts = documents.select("doc_id", whole_text(text_col).alias("text")).join(bounded(staged(chosen, "chosen"), MAX_CHOSEN), "doc_id")
    one = F.min_by(F.struct("text", "label", "place"), F.xxhash64("text")).alias("x")
    texts = staged(texts.groupBy("doc_id").agg(one).select("doc_id", "x.*"), "training")
    held, ids = 0, []
    for r in sorted(texts.select("place", "doc_id", F.octet_length("text").alias("n")).collect()):
        if held + r["n"] <= max_bytes:
            held += r["n"]
            ids.append((r["doc_id"],))
    fits = documents.sparkSession.createDataFrame(ids, texts.select("doc_id").schema)
    return texts.join(bounded(fits, MAX_CHOSEN), "doc_id", "left_semi").select("text", "label")
