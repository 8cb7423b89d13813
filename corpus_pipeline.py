"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

1. quality rules: documents that a rule rejects go;
2. exact dedup: of equal texts one document stays;
3. SimHash near-dedup: of each group of near copies the smallest id stays;
4. source mix: documents leave, stay or repeat as the mix takes them, in training order;
5. BPE: each row that is left becomes its token ids and their digests, in training order.

Stages 1 to 4 return the columns of ``documents``, and decide row by row: rows that share a
``doc_id`` or have none get verdicts of their own, by a key of the rows of a stage's
input. A null ``doc_id`` comes after all others: such a row stays unless an equal text or a
near copy stays instead. A document whose words the mix takes only in part is kept whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelseries.llm import bpe_words, exact_dedup, near_dedup, quality_rules, source_mix
from pixelseries.llm.common import ROW, apart, keyed, new_path, staged, table

#: XXH64 fingerprints and BPE have no SQL form, so the pipeline as a whole has none.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.one_per_text(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_per_component(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, p = keyed(docs, "rows"), apart(docs.columns)
    tie = f"{p}tie"
    mixed = source_mix.source_mix(rows.withColumn(tie, F.xxhash64(*docs.columns)), carry=(tie, ROW))
    takes = mixed.select(ROW, tie, F.explode("positions").alias(f"{p}at"))
    return rows.join(takes, ROW).orderBy(f"{p}at", "doc_id", tie).select(*docs.columns)


def in_file_order(rows: DataFrame) -> list[Column]:
    """The order in which rows were written: part names are numbers of five digits, or of more beyond 99,999."""
    names = [f"{ROW}.{f}" for f in rows.schema[ROW].dataType.names]
    return [F.length(c) for c in names if c.endswith("file_path")] + [F.col(c) for c in names]


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each row of ``docs``, in their order: the mix wrote them by training position, file after file."""
    rows = keyed(docs, "rows")
    coded = bpe_words.encode_decode(rows, public_tokenizers.path("word_bpe_49k.json"), keep=("doc_id", ROW))
    made = coded.select(
        ROW,
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
    # A range sort reads its input twice, so the digests are written first: they are small, the encoding is not.
    made = staged(made, "tokens")
    return made.orderBy(*in_file_order(made)).drop(ROW)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("source_mix", mix),
    ("bpe_tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each writes its rows to the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
