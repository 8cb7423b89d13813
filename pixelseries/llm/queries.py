"""The registered corpus queries: each applies its operator to its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_words as bw
from . import disclosure as dc
from . import exact_dedup as xd
from . import language_id as li
from . import license_scan as ls
from . import merkle as mk
from . import near_dedup as nd
from . import phrase_mining as pm
from . import quality_model as qm
from . import quality_rules as qr
from . import source_mix as sm
from . import sql
from . import url_filter as uf
from . import warc
from .common import table


def op1_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return qm.quality_scores(documents, labels).select("doc_id", "held_out", "score", "predicted")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = sm.by_position(sm.source_mix(table(spark, sf_dir, "documents")))
    first, second = (F.get("positions", F.lit(k)) for k in (0, 1))
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken", first.alias("position"), second.alias("second_position")
    )


def with_digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids (decimal, joined by spaces) and of the decoded text."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return with_digests(bw.encode_decode(table(spark, sf_dir, "documents"), path))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nd.near_dedup(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = qr.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ls.license_scan(documents).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uf.url_filter(table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "block_score"
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return xd.exact_dedup(documents).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return li.languages(documents).select("doc_id", "held_out", "lang_pred", "score")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mk.manifest(table(spark, sf_dir, "documents"))


def op12_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dc.found(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(dc.of_kinds(F.col("spans"), (k,))).cast("long").alias(f"n_{k}") for k in dc.BASE]
    base = F.sha2(dc.as_text(dc.of_kinds(F.col("spans"), dc.BASE)).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, dc.as_text(F.col("spans")).alias("spans"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pm.phrases(table(spark, sf_dir, "documents").select("lang", "text"))


def queries() -> dict:
    return {
        "op1_quality_attention": op1_quality_attention,
        "op2_source_mix": op2_source_mix,
        "op3_bpe_words": op3_bpe_words,
        "op4_simhash_near_dedup": op4_simhash_near_dedup,
        "op5_quality_rules": op5_quality_rules,
        "op6_license_scan": op6_license_scan,
        "op7_url_filter": op7_url_filter,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_language_id": op9_language_id,
        "op10_warc": op10_warc,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_disclosure": op12_disclosure,
        "op13_phrase_mining": op13_phrase_mining,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_source_mix": sql.op2(),
        "op5_quality_rules": sql.op5(),
        "op6_license_scan": sql.op6(),
        "op8_exact_dedup": sql.op8(),
        "op10_warc": sql.op10(),
        "op11_merkle_manifest": sql.op11(),
        "op13_phrase_mining": sql.op13(),
    }
