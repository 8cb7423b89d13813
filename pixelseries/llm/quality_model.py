"""Quality scores from a multiple-instance model of labelled documents.

A document whose crc32(doc_id as text) mod ``folds`` is 0 is held out and never learned
from. Of the other labelled documents at most ``max_docs`` (about) train the model, in the
order of a hash of the id and as long as their whole texts have ``max_bytes`` in all; every
document is scored from its whole text. Labels, language, source and id are not inputs of a
score.

Odd rows: a null text counts as empty, and an empty text is scored as one empty passage; texts of
any length are scored in runs of bounded size, over the same passages as in one piece; a null
``doc_id`` hashes as an empty text and trains nothing; several labels of one document count by
their majority (ties: 1), several texts of one id as one. Without two classes to learn from,
every score is the labelled share of 1, or 0.5 without any label. Repeated rows get equal
scores. Other columns pass through whatever their names; columns named like a result are
replaced. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import attention_mil as mil
from . import passage_encoder as enc
from .common import training_texts, whole_text

#: At most about so many labelled documents, with so many bytes of text in all, train the model.
MAX_DOCS = 2000
MAX_BYTES = 64_000_000


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, mod ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def training_sample(documents: DataFrame, labels: DataFrame, folds: int, max_docs: int, max_bytes: int) -> DataFrame:
    """(text, label): about ``max_docs`` labelled documents that are not held out."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    share = min(1.0, max_docs / max(1, known.count()))
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    chosen = known.filter(mark < F.lit(share * 1_000_003)).withColumn("place", F.xxhash64("doc_id"))
    # Ids are told apart, so their hashes spread: about max_docs of them, whatever the size of the labels.
    return training_texts(documents, chosen, max_bytes)


def _bags(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passage features, bag numbers and labels, measured in tasks; the sample is bounded."""

    def run(batches):
        for batch in batches:
            parts = list(enc.passages(batch["text"]))
            of, x = np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])
            for k, label in enumerate(batch["label"]):
                yield pd.DataFrame({"x": [x[of == k].tobytes()], "label": [label]})

    rows = sample.select(whole_text().cast("binary").alias("text"), "label").mapInPandas(run, "x binary, label int")
    found = sorted((r["x"], r["label"]) for r in rows.collect())
    each = [np.frombuffer(x, np.float32).reshape(-1, enc.N_FEATURES) for x, _ in found]
    if not each:
        return np.empty((0, enc.N_FEATURES)), np.empty(0, int), np.empty(0)
    bag = np.repeat(np.arange(len(each)), [len(x) for x in each])
    return np.concatenate(each).astype(float), bag, np.array([y for _, y in found], float)


def train(
    documents: DataFrame, labels: DataFrame, folds: int = 5, max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES
) -> dict | float:
    """The fitted weights, or the one score that all documents get if there is nothing to tell apart."""
    x, bag, y = _bags(training_sample(documents, labels, folds, max_docs, max_bytes))
    if len(np.unique(y)) < 2:
        return float(y[0]) if len(y) else 0.5
    return mil.fit(x, bag, y)


def quality_scores(
    documents: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3, max_docs: int = MAX_DOCS
) -> DataFrame:
    """All rows and columns of ``documents`` with ``held_out``, ``score`` and ``predicted``."""
    model = train(documents, labels, folds, max_docs)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(mil.score(model, enc.passages(texts), len(texts)).astype(float))

    made = F.lit(model) if isinstance(model, float) else scored(whole_text().cast("binary"))
    return documents.withColumns({"held_out": fold(F.col("doc_id"), folds) == 0, "score": made}).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
