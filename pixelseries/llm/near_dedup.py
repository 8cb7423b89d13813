"""Near-duplicate documents: SimHash fingerprints, Golay-code keys, join, verify, components.

Odd rows: a null or empty text has no words and the fingerprint zero, which links like any
other; a null ``doc_id`` counts as a row but never names a component (a component of null
ids alone has a null name); repeated rows and copies share a fingerprint, hence a component.
Texts of any length are hashed whole, a slice of the hashes at a time. Other columns are
not read. An empty table gives no rows. ``one_per_component`` goes by rows in place of ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import ROW, dropped, keyed, staged, whole_text
from .components import components


def fingerprint(text_col: str = "text") -> Column:
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash.fingerprint(t) for t in texts], np.uint64).view(np.int64))

    return prints(whole_text(text_col).cast("binary"))


def fingerprints(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row, written once: all later steps read only this."""
    return staged(df.select("doc_id", fingerprint(text_col).alias("fp")), "prints")


def _keyed(prints: DataFrame, near: bool, name: str) -> DataFrame:
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            row, key = simhash.keys(fps, near)
            yield pd.DataFrame({name: fps[row], "key": key})

    return prints.select("fp").mapInPandas(make, f"{name} long, key long")


def links(classes: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints that differ in ``MAX_BITS`` bits or fewer."""
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    probes, index = _keyed(classes, False, "a"), _keyed(classes, True, "b")
    return probes.join(index, (probes["key"] == index["key"]) & (F.col("a") < F.col("b")) & (far <= simhash.MAX_BITS)).select(
        "a", "b"
    )


def rooted(prints: DataFrame) -> DataFrame:
    """(fp, first_id, root) of every fingerprint; fingerprints of one component have one root."""
    classes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(links(classes))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return staged(named.select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "named")


def near_dedup(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``df``."""
    prints = fingerprints(df, text_col)
    named = rooted(prints)
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    final = staged(named.join(staged(least, "least"), "root").select("fp", "component_id"), "components")
    return prints.join(final, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_component(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row of ``df`` for each component: the smallest id (null last); of rows that tie, the least hash of all columns."""
    rows = keyed(df, "rows")
    tie = F.xxhash64(*df.columns).alias("_tie")
    prints = staged(rows.select("doc_id", fingerprint(text_col).alias("fp"), tie, ROW), "prints")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_tie", ROW))
    winners = (
        prints.join(rooted(prints).select("fp", "root"), "fp")
        .groupBy("root")
        .agg(best.alias("_best"))
        .select(F.col(f"_best.{ROW}").alias(ROW))
    )
    return dropped(rows, prints.select(ROW).join(winners, ROW, "left_anti")).select(*df.columns)
