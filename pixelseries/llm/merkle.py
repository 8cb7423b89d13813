"""Merkle manifest of a table: a tree for each source, a tree over their roots, proofs, and versions of tampered rows.

A leaf is the SHA-256 of a row's fields. Leaves of a source stand in order of id; every ``FAN`` neighbours become
their hash until one node remains. Trees are cut into aligned blocks of ``height`` levels: a task builds a block from its
nodes in order, and the blocks' roots are the nodes of the next layer of blocks. On the way down each block gets the siblings of its
root's path from the layer above and adds its own.

Trees are persistent: a tampered leaf makes a version of its tree that copies the leaf's ancestors and shares
every other node. A version begins in the block of its leaf, which copies ancestors up to the block's root; the upper
ones are copied from the path of that block, in the same task, since all versions of a block share it. No task
holds more than a block, and versions of a large source are spread as its blocks are.

Ranks come from a range sort by (source, id) and one count for each source and task, so a source may hold any
share of the rows.

Odd rows: null fields hash as ``-``; null sources are a source of their own, before all others; null ids come
first in their source and are not tampered; rows that share an id stand in order of their leaves, and equal rows are
leaves of their own; texts of any length are hashed whole. Other columns are not read, whatever their names. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import bounded, staged, struct

FAN = 3
#: Levels of a block, which has FAN ** HEIGHT nodes at most.
HEIGHT = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Tables of so many rows are sent to all tasks; larger ones are joined by a shuffle.
MAX_BROADCAST = 100_000


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)).cast("binary"), 256)


def is_tampered(doc_id: Column) -> Column:
    """Ids whose decimal text has an even CRC-32."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path (left, right siblings, level by level) lead to, with built-in functions alone."""
    levels = F.sequence(F.lit(0), (F.floor(F.size(path) / 2) - 1).cast("int"))
    pairs = F.transform(levels, lambda k: F.struct(F.get(path, 2 * k).alias("l"), F.get(path, 2 * k + 1).alias("r")))
    steps = F.when(F.size(path) > 0, pairs).otherwise(F.array().cast("array<struct<l:string,r:string>>"))
    return F.aggregate(steps, start, lambda node, s: F.sha2(F.concat(s["l"], node, s["r"]).cast("binary"), 256))


def joined(nodes: Sequence[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def grown(nodes: list[str], size: int, height: int) -> list[list[str]]:
    """The levels of a block: to the only node of a tree of ``size`` nodes that fits into it, else ``height`` levels up."""
    levels = [nodes]
    while len(levels[-1]) > 1 if size <= FAN**height else len(levels) <= height:
        last = levels[-1]
        levels.append([joined(last[k : k + FAN]) for k in range(0, len(last), FAN)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """Left and right siblings of a node's path within its block, level by level."""
    out = []
    for level in levels[:-1]:
        first = at - at % FAN
        out += ["".join(level[first:at]), "".join(level[at + 1 : first + FAN])]
        at //= FAN
    return out


def copied(node: str, path: Sequence[str]) -> list[str]:
    """The ancestors that a version with another leaf copies, lowest first; all other nodes are shared."""
    out = [node]
    for left, right in zip(path[::2], path[1::2]):
        out.append(joined((left, out[-1], right)))
    return out[1:]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of each (tree, block), which come one after the other."""
    key, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row[2:])
    if held:
        yield key, held


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made()
            held = []
    if held:
        yield made()


def _dealt(nodes: DataFrame) -> DataFrame:
    """Nodes by aligned blocks, in order; rows without a place, which hold a block's path, come first."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", F.col("pos").asc_nulls_first())


def _block(pos: Column, height: int) -> Column:
    return F.floor(pos / FAN**height).cast("long")


NODE = struct(tree="string", pos="long", size="long", hash="string")


def _roots(height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (tree, block), nodes in _blocks(batches):
                size = nodes[0][1]
                yield tree, block, -(-size // FAN**height), grown([n[2] for n in nodes], size, height)[-1][0]

        return _batched(rows(), to_arrow_schema(NODE))

    return run


def rise(nodes: DataFrame, height: int) -> list[DataFrame]:
    """Layers of (tree, pos, size, hash) from ``nodes`` up to the root of each tree; there are always two at least."""
    layers, most = [nodes], None
    while most is None or most > 1:
        most = (nodes.agg(F.max("size")).first()[0] or 1) if most is None else most
        dealt = _dealt(nodes.select("tree", _block(F.col("pos"), height).alias("block"), "pos", "size", "hash"))
        nodes = staged(dealt.mapInArrow(_roots(height), NODE), "merkle-nodes")
        layers.append(nodes)
        most = -(-most // FAN**height)
    return layers


PATH = struct(tree="string", pos="long", path="strings")


def _paths(height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (tree, _), (above, *nodes) in _blocks(batches):
                levels = grown([n[2] for n in nodes], nodes[0][1], height)
                for at, node in enumerate(nodes):
                    yield tree, node[0], siblings(levels, at) + above[3]

        return _batched(rows(), to_arrow_schema(PATH))

    return run


def _with_paths(nodes: DataFrame, above: DataFrame, height: int, *own: str) -> DataFrame:
    """Nodes of a layer by blocks, and before them the path (tree, pos, path) of their block's root; columns that one side lacks are null."""
    nodes = nodes.select("tree", _block(F.col("pos"), height).alias("block"), "pos", "size", "hash", *own)
    paths = above.withColumnRenamed("pos", "block")
    both = nodes.unionByName(paths, allowMissingColumns=True)
    return _dealt(both.select("tree", "block", "pos", "size", "hash", "path", *own, *[c for c in above.columns if c not in PATH.names]))


def descend(layers: list[DataFrame], top: DataFrame, height: int) -> DataFrame:
    """(tree, pos, path) of the lowest layer but the first; ``top`` has those of the trees' roots."""
    for nodes in reversed(layers[1:-1]):
        top = staged(_with_paths(nodes, top, height).mapInArrow(_paths(height), PATH), "merkle-paths")
    return top


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, their place in their ``tree``, and its ``size``."""
    by = ["tree", *order]
    placed = staged(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_m", F.monotonically_increasing_id()), name)
    task = F.shiftright("_m", 33)
    tree = Window.partitionBy("_tree")
    before = tree.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(F.col("tree").alias("_tree"), task.alias("_task")).agg(F.count("*").alias("n"), F.min("_m").alias("_first"))
    starts = counts.select("_tree", "_task", "_first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"), F.sum("n").over(tree).alias("size"))
    met = placed.join(bounded(starts, MAX_BROADCAST), (F.col("tree") == F.col("_tree")) & (task == F.col("_task")))
    return met.withColumn("pos", F.col("_start") + F.col("_m") - F.col("_first")).drop("_m", "_tree", "_task", "_first", "_start")


def _told(schema: pa.Schema, root: str, height: int, detail: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The verdict on each leaf of a block, and the versions of its tampered leaves up to the root."""

        def rows() -> Iterator[tuple]:
            for _, (above, *leaves) in _blocks(batches):
                levels = grown([x[2] for x in leaves], leaves[0][1], height)
                upper, subroot = above[3], above[6]
                untouched = copied(levels[-1][0], upper) or levels[-1]
                for at, (_, _, own, _, doc_id, tampered, _) in enumerate(leaves):
                    path = siblings(levels, at) + upper
                    version = None if tampered is None else copied(tampered, path)
                    end = untouched[-1] if tampered is None else (version or [tampered])[-1]
                    yield doc_id, own, subroot, root, joined(path), end, end == root, *((path, version) if detail else ())

        return _batched(rows(), schema)

    return run


def manifest(
    df: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", source_col: str = "source", detail: bool = False,
    height: int = HEIGHT,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row.

    Rows whose id has an even CRC-32 are tampered with: their line breaks are deleted. ``detail`` adds ``path``, the left and
    right siblings level by level, and ``copied``, the ancestors that the version of a tampered leaf copies.
    """
    own = leaf([F.col(c) for c in fields])
    other = leaf([F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in fields])
    changed = F.when(is_tampered(F.col(id_col)), other)
    tree = F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit(""))  # null first, then by bytes
    leaves = staged(df.select(tree.alias("tree"), F.col(id_col).alias("doc_id"), own.alias("hash"), changed.alias("tampered")), "merkle-leaves")
    leaves = staged(numbered(leaves, ["doc_id", "hash"], "merkle-sorted"), "merkle-numbered")
    layers = rise(leaves, height)
    subroots = layers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("key"), "hash")
    sources = staged(numbered(subroots, ["key"], "merkle-sources"), "merkle-subroots")
    upper = rise(sources, height)
    root = upper[-1].first()
    root = root["hash"] if root else ""
    start = descend(upper, upper[-1].select("tree", "pos", F.array().cast("array<string>").alias("path")), height)
    found = staged(_with_paths(sources, start, height).mapInArrow(_paths(height), PATH), "merkle-paths")
    tops = sources.withColumnRenamed("pos", "_at").join(bounded(found.select(F.col("pos").alias("_at"), "path"), MAX_BROADCAST), "_at")
    tops = staged(tops.select(F.col("key").alias("tree"), F.lit(0).cast("long").alias("pos"), "path"), "merkle-tops")
    above = descend(layers, tops, height)
    above = above.join(bounded(sources.select(F.col("key").alias("tree"), F.col("hash").alias("subroot")), MAX_BROADCAST), "tree")
    schema = T.StructType(
        [T.StructField("doc_id", df.schema[id_col].dataType)]
        + [T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
        + [T.StructField("verified", T.BooleanType())]
        + [T.StructField(c, T.ArrayType(T.StringType())) for c in ("path", "copied") if detail]
    )
    met = _with_paths(leaves, above, height, "doc_id", "tampered")
    return met.mapInArrow(_told(to_arrow_schema(schema), root, height, detail), schema)
