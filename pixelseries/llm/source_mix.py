"""Mixing sources to target weights with a time-varying curriculum.

Each source has a weight schedule: a line through weights at evenly spaced times of the
run. Its integral is the source's weight; weights share the budget, and no source gets
more than ``max_epochs`` times its size (the excess is reshared by weight until none is
above). Every source lays its documents out in a fixed pseudo-random order, as often as
its target asks; a document whose demand starts at token c of the source's stream goes to
the training position t at which the integrated schedule has asked for c tokens. Documents
are range-sorted by that position.

Order within a source comes from the MD5 of ``doc_id``, size and what else is carried along, so
reruns agree. Running sums are taken in two levels (buckets of the order within a source, then
rows within a bucket), so a source with most of the rows is spread over many tasks, as are the
rows of an id that repeats, or of none: equal rows that are many are dealt over parts of their bucket. Sources
themselves are ordered in one task, which holds a few numbers for each.

Odd rows: a null or empty text has size 0 and takes nothing, and its position is null; a null source is a
source of its own and comes last; a null ``doc_id`` comes last within its source; repeated
rows count each time; texts of any length are counted whole. Columns that are not carried are not
read, whatever their names; carried ones pass through, those named like a result are replaced. A corpus without words gives targets of 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, bounded, staged, whole_text, words

#: Weights at the start, middle and end of the run; sources take them in turn. Their integrals are 5, 2 and 1.
SCHEDULES = ((7.5, 5.0, 2.5), (2.0, 2.0, 2.0), (0.5, 1.0, 1.5))
#: Above so many sources their table is joined by a shuffle instead of a broadcast.
MAX_BROADCAST_SOURCES = 50_000


def integrals(schedule: Sequence[float]) -> list[float]:
    """Integral of the schedule from the start to each knot."""
    out, step = [0.0], 1.0 / (len(schedule) - 1)
    for a, b in zip(schedule, schedule[1:]):
        out.append(out[-1] + (a + b) / 2 * step)
    return out


def position(share: Column, turn: Column, schedules: Sequence[Sequence[float]]) -> Column:
    """The time at which a source has met ``share`` (0 to 1) of its demand: the integral, inverted by segment."""
    out = F.lit(None).cast("double")
    for k, schedule in enumerate(schedules):
        done, step = integrals(schedule), 1.0 / (len(schedule) - 1)
        asked, at = share * done[-1], F.lit(1.0)
        for j in reversed(range(len(schedule) - 1)):
            a, slope = schedule[j], (schedule[j + 1] - schedule[j]) / step
            rest = asked - done[j]
            if slope:
                t = (F.sqrt(F.greatest(F.lit(a * a) + 2 * slope * rest, F.lit(0.0))) - a) / slope
            else:
                t = rest / a if a else F.lit(0.0)
            at = F.when(asked < done[j + 1], j * step + t if j else t).otherwise(at)
        out = F.when(turn == k, at).otherwise(out)
    return out


def sized(df: DataFrame, text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    more = [c for c in carry if c.lower() not in ("doc_id", "source", "size")]
    return df.select("doc_id", "source", F.size(words(whole_text(text_col))).cast("long").alias("size"), *more)


def source_targets(sizes: DataFrame, schedules=SCHEDULES, budget: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """One row per source: size, rows, place in the order, target.

    The fixed point of resharing is a common level v with target = min(weight * v, cap). With
    sources ordered by cap / weight, those before the first that v leaves uncapped are capped;
    capping more than those only lowers the level, so v is the largest level that fits.
    """
    weights = F.array(*[F.lit(integrals(s)[-1]) for s in schedules])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    stats = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs"))
        .withColumn("_place", F.row_number().over(by_name) - 1)
        .withColumn("_turn", F.col("_place") % len(schedules))
        .withColumn("_weight", F.get(weights, F.col("_turn")))
        .withColumn("_cap", max_epochs * F.col("source_size"))
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("_cap") / F.col("_weight"), "_place").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.col("_cap") / F.col("_weight"), "_place").rowsBetween(0, Window.unboundedFollowing)
    level = (budget * F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum(
        "_weight"
    ).over(after)
    stats = stats.withColumn("_level", level)
    uncapped = F.when(F.col("_level") <= F.col("_cap") / F.col("_weight"), F.col("_level"))
    return stats.withColumn("_level", F.max(uncapped).over(everything)).select(
        "source",
        "source_size",
        "_docs",
        "_place",
        "_turn",
        F.least(F.col("_cap"), F.coalesce(F.col("_weight") * F.col("_level"), F.col("_cap"))).alias("target"),
    )


def mix(sizes: DataFrame, schedules=SCHEDULES, budget: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """One row per document of ``sizes`` (doc_id, source, size): targets, words taken and training positions.

    Further columns of ``sizes`` pass through, and order rows that tie; those named like a result are replaced.
    ``taken`` counts repeats. ``positions`` holds the position of each pass that takes words of it.
    """
    carried = [c for c in sizes.columns if c.lower() not in ("doc_id", "source", "size", "source_size", "target", "taken", "positions")]
    own = {c: f"_c{k}" for k, c in enumerate(carried)}
    sizes = sizes.select("doc_id", "source", "size", *[F.col(c).alias(n) for c, n in own.items()])
    named = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")]
    spread = [n for c, n in own.items() if c != ROW]  # a row's key may differ from run to run
    named += [F.xxhash64(*spread).cast("string")] if spread else []
    order = F.conv(F.substring(F.md5(F.concat_ws(" ", *named)), 1, 15), 16, 10).cast("long")
    sources = staged(source_targets(sizes, schedules, budget, max_epochs), "sources").withColumnRenamed("source", "_src")
    most = F.greatest(F.lit(256.0), F.ceil(F.sqrt(F.col("_docs").cast("double"))))
    rows = (
        sizes.join(bounded(sources, MAX_BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("_src")))
        .drop("_src")
        .withColumn("_order", order)
        .withColumn("_bucket", F.floor(F.col("_order") / F.lit(float(1 << 60)) * F.greatest(F.lit(1.0), F.ceil(F.col("_docs") / most))))
    )
    rows = parted(rows, F.col(own[ROW]) if ROW in own else F.monotonically_increasing_id())
    bucket = ["_bucket", "_part", "_sub"]
    before = Window.partitionBy("_place").orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_place", *bucket)
        .agg(F.sum("size").alias("_sum"))
        .select("_place", *bucket, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    inside = (
        Window.partitionBy("_place", *bucket)
        .orderBy("_order", F.col("doc_id").asc_nulls_last(), "size", *own.values())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumn("_upto", F.sum("size").over(inside)).join(offsets, ["_place", *bucket])
    wanted = F.floor(F.col("target")).cast("long")
    rows = rows.withColumn("_start", F.col("_offset") + F.col("_upto") - F.col("size"))
    taken, at = F.lit(0).cast("long"), []
    for k in range(ceil(max_epochs)):
        begun = k * F.col("source_size") + F.col("_start")
        part = F.greatest(F.lit(0), F.least(F.col("size"), wanted - begun))
        share = F.try_divide(begun.cast("double"), F.col("target"))
        taken = taken + part
        at.append(F.when(part > 0, position(share, F.col("_turn"), schedules)))
    positions = F.array_compact(F.array(*at)).alias("positions")
    back = [F.col(n).alias(c) for c, n in own.items()]
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), positions, *back)


def parted(rows: DataFrame, key: Column, support: float = 0.002, per_part: int = 4096) -> DataFrame:
    """``rows`` with ``_part`` and ``_sub``: rows that share a frequent order are dealt, by a key of theirs, to parts of their bucket.

    Rows of one order are equal in all that is ordered by, so whichever of them comes first gets the same
    place. A frequent-items sketch names at most ``1 / support`` orders; one count verifies them.
    """
    hot = (rows.freqItems(["_order"], support).first() or [[]])[0] or []
    counts = rows.filter(F.col("_order").isin(hot)).groupBy("_order").count().collect() if hot else []
    hot = {r["_order"]: -(-r["count"] // per_part) for r in counts if r["count"] > per_part}
    if not hot:
        return rows.withColumns({"_part": F.lit(0), "_sub": F.lit(0).cast("long")})
    part, sub = F.lit(0), F.lit(0).cast("long")
    for k, order in enumerate(sorted(hot)):
        equal = F.col("_order") == order
        part = F.when(equal, 2 * k + 1).when(F.col("_order") > order, 2 * k + 2).otherwise(part)
        sub = F.when(equal, F.pmod(F.xxhash64(key), F.lit(hot[order]))).otherwise(sub)
    return rows.withColumns({"_part": part, "_sub": sub})


def by_position(mixed: DataFrame) -> DataFrame:
    """Range-sort by the first training position; documents that are not taken come last."""
    return mixed.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")


def source_mix(df: DataFrame, text_col: str = "text", carry: Sequence[str] = (), **options) -> DataFrame:
    """Mix all documents of ``df``; sizes are staged once, as several passes read them."""
    return mix(staged(sized(df, text_col, carry), "sizes"), **options)
