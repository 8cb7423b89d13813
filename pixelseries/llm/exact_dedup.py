"""Exact dedup by normalised text, with frequent digests split off.

Texts are equal when they are identical once every ASCII white-space character is
deleted. Of equal texts the row with the most code points stays, then the smallest
``doc_id`` (a null id comes last). Exactly one row of each group stays: of rows that tie in
both, the one that comes first in the input's files.

A frequent-items sketch (Misra-Gries counters, as in ``DataFrame.freqItems``) names every
digest that can hold more than ``support`` of the rows. One pass counts those exactly and
picks their winners: at most ``1 / support`` rows, broadcast so that the many rows of hot
groups are settled where they are read. All other digests go through an ordinary
aggregation and join on the digest. Winners are found by three aggregates (of equal rows,
of equal lengths, of the group) whose states are plain numbers, so all are hash aggregates.

Odd rows: a null text counts as empty, and all empty texts are one group. Other columns
pass through; columns named like a result are replaced. Very long texts are hashed whole. An
empty table gives no rows. In ``one_per_text`` of rows that tie the one with the least hash
of all columns stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, WS_CLASS, dropped, keyed, set_aside, staged, whole_text

VERDICT = ("keep_id", "group_size", "kept")


def digest(text_col: str = "text") -> Column:
    return F.sha2(F.regexp_replace(whole_text(text_col), WS_CLASS + "+", "").cast("binary"), 256)


def _winners(digests: DataFrame) -> DataFrame:
    """(text_sha256, keep_id, keep_row, group_size); states are numbers where ids and rows are.

    ``min`` and ``min_by`` pass over null ids, so a null id wins only among nulls.
    """
    same = digests.groupBy("text_sha256", "points", "doc_id").agg(F.min(ROW).alias("row"), F.count("*").alias("n"))
    long = same.groupBy("text_sha256", "points").agg(
        F.min("doc_id").alias("id"), F.coalesce(F.min_by("row", "doc_id"), F.min("row")).alias("row"), F.sum("n").alias("n")
    )
    return long.groupBy("text_sha256").agg(
        F.max_by("id", "points").alias("keep_id"), F.max_by("row", "points").alias("keep_row"), F.sum("n").alias("group_size")
    )


def frequent(digests: DataFrame, support: float) -> list[str]:
    """Digests that may hold over ``support`` of the rows: at most ``1 / support`` candidates."""
    found = digests.freqItems(["text_sha256"], support).first()
    return [x for x in (found[0] or []) if x is not None] if found else []


def settle(digests: DataFrame, support: float = 0.005) -> DataFrame:
    """The rows of ``digests`` (doc_id, points, text_sha256, row key) with their verdicts."""
    hot = frequent(digests, support)
    is_hot = F.col("text_sha256").isin(hot)
    cold = digests.filter(~is_hot)
    # One layout by digest serves all three aggregates; hot groups, which have too many rows for that, combine where they are read.
    joined = cold.join(_winners(cold.repartition("text_sha256")), "text_sha256")
    if hot:
        verified = staged(_winners(digests.filter(is_hot)).coalesce(1), "hot-digests")
        joined = digests.filter(is_hot).join(F.broadcast(verified), "text_sha256").unionByName(joined)
    return joined.withColumn("kept", F.col(ROW) == F.col("keep_row")).drop("keep_row")


def exact_dedup(df: DataFrame, text_col: str = "text", support: float = 0.005) -> DataFrame:
    """All rows and columns of ``df`` with ``text_sha256``, ``keep_id``, ``group_size`` and ``kept``."""
    df, back = set_aside(df, ROW)
    narrow = set(df.columns) <= {"doc_id", text_col}
    # Digests are written once, so a number given there stays with its row.
    rows = df.withColumn(ROW, F.monotonically_increasing_id()) if narrow else keyed(df, "rows")
    made = {"points": F.length(whole_text(text_col)), "text_sha256": digest(text_col)}
    digests = staged(rows.select("doc_id", ROW, *[c.alias(n) for n, c in made.items()]), "digests")
    told = settle(digests, support).select("doc_id", ROW, "text_sha256", *VERDICT)
    if narrow:
        return told.drop(ROW)
    return rows.drop(*VERDICT, "text_sha256").join(told.drop("doc_id"), ROW).drop(ROW).withColumnsRenamed(back)


def one_per_text(df: DataFrame, text_col: str = "text", support: float = 0.005) -> DataFrame:
    """One row of ``df`` for each text: the winner as above; of rows that tie, the least hash of all columns.

    Losers go where they are read, by bitmaps of their places.
    """
    df, back = set_aside(df, ROW)
    rows = keyed(df, "rows")
    made = {"points": F.length(whole_text(text_col)), "text_sha256": digest(text_col)}
    tied = F.struct(F.xxhash64(*df.columns).alias("tie"), ROW).alias(ROW)
    digests = staged(rows.select("doc_id", tied, *[c.alias(n) for n, c in made.items()]), "digests")
    lost = settle(digests, support).filter("NOT kept").select(F.col(f"{ROW}.{ROW}").alias(ROW))
    return dropped(rows, lost).select(*df.columns).withColumnsRenamed(back)
