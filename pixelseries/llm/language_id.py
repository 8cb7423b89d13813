"""Language of every document by a bidirectional GRU over its bytes.

Before the network, Spark lower-cases a text and turns every run of other characters than
letters into one space, so shouting, digits and symbols tell nothing. The UTF-8 bytes of
the whole rest are read.

A document whose crc32(doc_id as text) mod ``folds`` is ``held`` is held out and never
learned from. Of the others with a known language, those with the least hashes of their ids
train the network: ``max_docs`` shared out evenly over the languages, but ``MIN_DOCS`` of each
at least, so that every language is a class, as long as their whole texts have ``max_bytes`` in all.

Odd rows: a null text, or one without a letter, is ``und`` with score 1; a null ``doc_id``
hashes as an empty text and trains nothing; several texts of one id train as one; of languages
with equal probabilities the first by name is told; texts of any length are read window by
window in bounded memory; with one language to learn, everything gets it with score 1; with
none, everything is ``und``. Repeated rows get equal results; other columns pass through whatever
their names; columns named like a result are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bigru
from .common import apart, bounded, staged, training_texts, whole_text
from .quality_model import fold

#: At most about so many documents, with so many bytes of text in all, train the network; at least so many of each language.
MAX_DOCS = 1200
MAX_BYTES = 32_000_000
MIN_DOCS = 20
#: Above so many languages the table of their counts is joined by a shuffle instead of a broadcast.
MAX_BROADCAST_LANGUAGES = 10_000


def letters(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))


def training_sample(documents: DataFrame, folds: int, held: int, max_docs: int, max_bytes: int) -> DataFrame:
    """(text, label): about as many documents of each language, the label being its name."""
    ids = documents.select("doc_id", F.col("lang").alias("label"))
    known = ids.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held))
    held_by = staged(known.groupBy("label").agg(F.approx_count_distinct("doc_id").alias("n")), "languages")
    each = max(MIN_DOCS, max_docs // max(1, held_by.count()))
    # A draw by the hash leaves about four times as many as are wanted, of a language with any number of rows: those are ranked.
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) * F.col("n")
    drawn = known.join(bounded(held_by, MAX_BROADCAST_LANGUAGES), "label").filter(mark < 4.0 * each * 1_000_003)
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = drawn.select("doc_id", "label").distinct().withColumn("place", F.row_number().over(order))
    chosen = ranked.filter(F.col("place") <= each).groupBy("doc_id").agg(F.min("label").alias("label"), F.min("place").alias("place"))
    return training_texts(documents, chosen, max_bytes)


def train(
    documents: DataFrame, folds: int = 4, held: int = 2, max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES
) -> tuple[list[str], dict | None]:
    """The languages, in order, and the network (None if there are fewer than two)."""
    sample = training_sample(documents, folds, held, max_docs, max_bytes)
    sample = sample.select(F.encode(letters(F.col("text")), "UTF-8").alias("x"), "label").filter(F.octet_length("x") > 0)
    rows = sorted((r["label"], bytes(r["x"])) for r in sample.collect())
    names = sorted({lang for lang, _ in rows})
    if len(names) < 2:
        return names, None
    return names, bigru.fit([x for _, x in rows], np.array([names.index(lang) for lang, _ in rows]), len(names))


def languages(documents: DataFrame, folds: int = 4, held: int = 2, max_docs: int = MAX_DOCS) -> DataFrame:
    """All rows and columns of ``documents`` with ``held_out``, ``lang_pred`` and ``score``."""
    names, model = train(documents, folds, held, max_docs)

    @F.pandas_udf("struct<lang:string,score:double>")
    def told(texts: pd.Series) -> pd.DataFrame:
        q = bigru.document_probabilities(model, list(texts))
        best = q.argmax(axis=1)
        return pd.DataFrame({"lang": [names[k] for k in best], "score": q[np.arange(len(q)), best].astype(float)})

    bare, p = letters(whole_text()), apart(documents.columns)
    fixed = F.struct(F.lit(names[0] if names else "und").alias("lang"), F.lit(1.0).alias("score"))
    made = fixed if model is None else told(F.encode(bare, "UTF-8"))
    out = documents.withColumns({f"{p}held": fold(F.col("doc_id"), folds) == held, f"{p}bare": bare, f"{p}told": made})
    none = F.col(f"{p}bare") == ""
    return out.select(
        *[c for c in documents.columns if c.lower() not in ("held_out", "lang_pred", "score")],
        F.col(f"{p}held").alias("held_out"),
        F.when(none, "und").otherwise(F.col(f"{p}told.lang")).alias("lang_pred"),
        F.when(none, 1.0).otherwise(F.least(F.lit(1.0), F.col(f"{p}told.score"))).alias("score"),
    )
