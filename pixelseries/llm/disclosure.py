"""Personal data, and the terms beside it that give it away: information-theoretic sanitisation.

Base spans are e-mail addresses, IP addresses, payment cards and phone numbers, by their patterns. Each
distinct value is a protected entity. Terms are words; those that stand within ``REACH`` words of a mention of an
entity co-occur with it. Over the whole corpus, with documents as the unit,

    information(e) = log2(N / df(e)),    disclosure(e, t) = log2(N * df(e, t) / (df(e) * df(t))) / information(e)

so a term that never occurs without the entity discloses all of it (1), and one that is independent of it
nothing (0). In documents that mention the entity, occurrences of a term near it are ``removed`` from ``REMOVE_AT`` on, and
``general`` (put in general words) from ``GENERALISE_AT`` on. Fewer than ``SUPPORT`` documents prove nothing.

One pass over the texts finds spans and neighbours and counts the documents of each word with numpy, batch by batch. The
rest is aggregation and joins of (entity, term) pairs. Words of too many documents to disclose anything go before pairs
are joined, so frequent words make no hot key.

Odd rows: a null text counts as empty, and has no span; an entity of all documents has no information to protect;
copies of a document count as documents; repeated rows each get their spans; overlapping spans of
different kinds are all given, and in a rewritten text the first one wins. Very long texts are searched whole, in linear
time. Kept columns pass through; those named like a result are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import LOWER, ROW, UPPER, bounded, keyed, staged, struct, unused, whole_text

KINDS = ("email", "ip", "card", "phone", "removed", "general")
BASE = KINDS[:4]
REACH = 8
SUPPORT = 3
GENERALISE_AT, REMOVE_AT = 0.9, 0.97
#: Tables of so many rows are sent to all tasks; larger ones are joined by a shuffle.
MAX_BROADCAST = 200_000

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Runs are possessive and begin where a run of digits begins: equal to the plain patterns, and linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
OTHER = re.compile(r"[^0-9]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWERED = str.maketrans(UPPER, LOWER)

LOW = np.arange(256, dtype=np.uint8)
LOW[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: from each ``@`` back over the local part and on over the domain."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def luhn(digits: str) -> bool:
    twice = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in twice)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, in that order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = OTHER.sub("", m[0]) if m.end() - m.start() < 40 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 10 <= len(OTHER.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def entity(kind: int, value: str) -> str:
    """A digest stands for the value, so that no table holds it: e-mail in lower case, of numbers the digits."""
    value = value.lower() if kind == 0 else value if kind == 1 else OTHER.sub("", value)
    return blake2b(f"{BASE[kind]}:{value}".encode(), digest_size=12).hexdigest()


def neighbours(text: str, spans: Sequence[tuple[int, int, int]], reach: int) -> dict[str, dict[str, set[tuple[int, int]]]]:
    """Entity to term to the occurrences of the term within ``reach`` words of a mention; words in spans are no terms."""
    lower, words, k, most = text.translate(LOWERED), [], 0, 0
    for m in WORD.finditer(lower):
        while k < len(spans) and spans[k][0] < m.end():
            most, k = max(most, spans[k][2]), k + 1
        if m.start() >= most:
            words.append(m.span())
    starts, out = [a for a, _ in words], defaultdict(lambda: defaultdict(set))
    for start, kind, end in spans:
        near = out[entity(kind, text[start:end])]
        at, after = bisect_left(starts, start), bisect_left(starts, end)
        for a, b in words[max(0, at - reach) : at] + words[after : after + reach]:
            near[lower[a:b]].add((a, b))
    return out


def document_counts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of a batch and the number of its texts that hold each."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), "\n")
    size = pc.binary_length(joined)[0].as_py()
    raw = LOW[np.frombuffer(joined.buffers()[2], np.uint8, size)] if size else np.empty(0, np.uint8)
    inside = IN_WORD[raw]
    edge = np.diff(inside.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[inside])).dictionary_encode()
    row = np.searchsorted(np.cumsum(sizes + 1), starts, "right")
    n = max(1, len(words.dictionary))
    pairs = np.unique(row * n + words.indices.to_numpy(zero_copy_only=False))
    return words.dictionary, np.bincount(pairs % n, minlength=len(words.dictionary))


NEAR = T.ArrayType(struct(entity="string", term="string", spans=T.ArrayType(struct(start="int", end="int"))))
SPANS = T.ArrayType(struct(start="int", kind="int", end="int"))
#: Texts that are counted together have so many bytes, about.
COUNTED_BYTES = 16 << 20


def _searched(kept: T.StructType, schema: T.StructType, reach: int):
    """Two kinds of rows: a document with spans and neighbours, and a word with the number of a batch's texts that hold it."""
    arrow, inner = to_arrow_schema(schema), to_arrow_schema(kept)
    none = len(inner.names)

    def words(texts: pa.Array) -> pa.RecordBatch:
        found, counts = document_counts(texts)
        empty = [pa.nulls(len(found), t) for t in arrow.types[:-2]]
        return pa.RecordBatch.from_arrays([*empty, found.cast(arrow.types[-2]), pa.array(counts.astype(np.int64))], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(none)
            spans, near = [], []
            for text in texts:
                text = text.as_py()
                found = base_spans(text)
                spans.append([{"start": a, "kind": k, "end": b} for a, k, b in found])
                pairs = neighbours(text, found, reach) if found else {}
                near.append([
                    {"entity": e, "term": t, "spans": [{"start": a, "end": b} for a, b in sorted(at)]} for e, terms in pairs.items() for t, at in terms.items()
                ] + [{"entity": e, "term": None, "spans": []} for e in pairs])
            n = batch.num_rows
            columns = [pa.array(np.arange(number, number + n)), pa.array(spans, arrow.types[none + 1]), pa.array(near, arrow.types[none + 2])]
            number += n
            yield pa.RecordBatch.from_arrays(
                [*[c.cast(t) for c, t in zip(batch.columns[:none], inner.types)], *columns, *[pa.nulls(n, t) for t in arrow.types[-2:]]], schema=arrow
            )
            upto, start = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
            while start < n:
                end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + COUNTED_BYTES, "right")))
                yield words(texts.slice(start, end - start))
                start = end

    return run


def revealing(pairs: DataFrame, words: DataFrame, documents: int, support: int = SUPPORT, least: float = GENERALISE_AT) -> DataFrame:
    """(entity, term, disclosure) of the terms that disclose ``least`` of an entity.

    ``pairs`` (entity, term) has a row for each document of a pair, and one without term for each document of an entity;
    ``words`` is (term, n), the documents of each word.
    """
    entities = pairs.filter(F.col("term").isNull()).groupBy("entity").agg(F.count("*").alias("df_e")).filter(F.col("df_e") >= support)
    both = pairs.filter(F.col("term").isNotNull()).groupBy("entity", "term").agg(F.count("*").alias("df_et"))
    both = staged(both.filter(F.col("df_et") >= support), "disclosure-pairs")
    # Whatever the entity: a word of more documents than this discloses less than ``least``.
    most = both.groupBy("term").agg((F.max("df_et") * F.lit(float(max(documents, 1)) ** (1 - least))).alias("most"))
    rare = words.join(bounded(most, MAX_BROADCAST), "term").groupBy("term").agg(F.sum("n").alias("df_t"), F.first("most").alias("most"))
    rare = staged(rare.filter(F.col("df_t") <= F.col("most") * 1.000001).drop("most"), "disclosure-terms")
    met = both.join(bounded(rare, MAX_BROADCAST), "term").join(bounded(entities, MAX_BROADCAST), "entity")
    n = F.lit(float(documents))
    shared = F.log2(n * F.col("df_et") / (F.col("df_e").cast("double") * F.col("df_t")))
    told = met.filter(F.col("df_e") < documents).withColumn("disclosure", shared / F.log2(n / F.col("df_e")))
    return told.filter(F.col("disclosure") >= least).select("entity", "term", "disclosure")


def found(
    df: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",), reach: int = REACH, support: int = SUPPORT,
    generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT,
) -> DataFrame:
    """The columns ``keep`` of each row with ``spans``: an array of (start, kind, end), kinds by their place in ``KINDS``."""
    keep = [c for c in keep if c.lower() != "spans"]
    inner = [f"k{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(c).alias(i) for c, i in zip(keep, inner)], whole_text(text_col).alias("text"))
    kept = T.StructType([T.StructField(i, df.schema[c].dataType) for c, i in zip(keep, inner)])
    more = {"row": T.LongType(), "base": SPANS, "near": NEAR, "term": T.StringType(), "n": T.LongType()}
    schema = T.StructType(kept.fields + [T.StructField(c, t) for c, t in more.items()])
    searched = staged(rows.mapInArrow(_searched(kept, schema, reach), schema), "disclosure")
    documents = searched.filter(F.col("row").isNotNull()).select(*inner, "row", "base", "near")
    near = documents.select("row", F.inline("near"))
    told = revealing(near.select("entity", "term"), searched.filter(F.col("term").isNotNull()).select("term", "n"), documents.count(), support, generalise_at)
    told = staged(told, "disclosing")
    hits = near.filter(F.col("term").isNotNull()).join(bounded(told, MAX_BROADCAST), ["entity", "term"])
    # A term that several entities share takes the highest disclosure in a document.
    hits = hits.groupBy("row", "term").agg(F.max("disclosure").alias("d"), F.array_distinct(F.flatten(F.collect_list("spans"))).alias("at"))
    kind = F.when(F.col("d") >= remove_at, KINDS.index("removed")).otherwise(KINDS.index("general"))
    added = F.transform("at", lambda x: F.struct(x["start"].alias("start"), kind.alias("kind"), x["end"].alias("end")))
    hits = hits.groupBy("row").agg(F.flatten(F.collect_list(added)).alias("added"))
    spans = F.sort_array(F.concat("base", F.coalesce("added", F.array().cast(SPANS))))
    return documents.drop("near").join(hits, "row", "left").select(*[F.col(i).alias(c) for c, i in zip(keep, inner)], spans.alias("spans"))


def of_kinds(spans: Column, kinds: Sequence[str] = KINDS) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin([KINDS.index(k) for k in kinds]))


def as_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, in order."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def rewritten(text: str, spans: Sequence) -> str:
    """The text with its personal data named by kind, general terms by their form, and removed ones gone."""
    out, last = [], 0
    for start, kind, end in spans:
        if start < last:
            continue
        term = text[start:end]
        form = "[number]" if term.isdecimal() else "[name]" if term[0].isupper() else "[term]"
        out += [text[last:start], "" if KINDS[kind] == "removed" else form if KINDS[kind] == "general" else f"[{KINDS[kind]}]"]
        last = end
    return "".join([*out, text[last:]])


def sanitised(df: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of ``df`` with ``spans`` and ``sanitised``, the rewritten text."""
    rows = keyed(df, "rows")
    made = found(rows, text_col, keep=(ROW,), **options)
    name = unused("_spans", rows.columns)

    @F.pandas_udf("string")
    def apply(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([rewritten(t, [(x["start"], x["kind"], x["end"]) for x in s]) for t, s in zip(text, spans)], dtype=object)

    met = rows.join(made.withColumnRenamed("spans", name), ROW).withColumn(name + "x", apply(whole_text(text_col), F.col(name)))
    others = [F.col(c) for c in df.columns if c.lower() not in ("spans", "sanitised")]
    return met.select(*others, F.col(name).alias("spans"), F.col(name + "x").alias("sanitised"))
