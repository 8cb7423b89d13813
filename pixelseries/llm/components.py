"""Connected components of an edge table, by joins and minima only.

Each round lets every node look at its neighbours' grandparents, hooks nodes and their
parents to the smallest one seen, and shortcuts; parents only ever fall, so an unchanged
sum of parents means the end. Rounds grow as the logarithm of the longest chain. Tables
between rounds are written to the shared folder, so joins start from plain tables (whose
hot keys adaptive execution can split) and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: bigint); ``root`` is the smallest node it reaches.

    No edges give no rows. Repeated edges and loops change nothing.
    """
    edges = staged(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    parents = staged(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node"), "roots")
    weight = None
    for _ in range(max_rounds):
        total = parents.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
        if total == weight:
            return parents
        weight = total
        above = parents.select(F.col("node").alias("root"), F.col("root").alias("grand"))
        jumped = staged(parents.join(above, "root", "left").select("node", "root", F.coalesce("grand", "root").alias("grand")), "grand")
        seen = (
            edges.join(jumped.select(F.col("node").alias("b"), "grand"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("grand").alias("best"))
        )
        seen = staged(seen, "seen")
        told = jumped.join(seen, "node")
        offers = (
            jumped.select("node", F.least("root", "grand").alias("root"))
            .union(seen.select("node", F.col("best").alias("root")))
            .union(told.select(F.col("root").alias("node"), F.col("best").alias("root")))
        )
        parents = staged(offers.groupBy("node").agg(F.min("root").alias("root")), "roots")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
