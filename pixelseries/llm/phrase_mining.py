"""Phrases (collocations) of two to five words, mined exactly with counting quotient filters.

Texts are split at punctuation and line breaks into pieces, pieces at blanks into words; a phrase lies
within a piece. Everything is counted for each language by itself.

1. Blocks of texts become codes of their distinct words (Arrow kernels); words are counted over the corpus.
2. Words that occur ``min_count`` times get dense ids; ids go back to the blocks, 0 stands for all other words and
   for the ends of pieces. Ids differ between languages, so an n-gram of ids knows its language.
3. For n = 2 to 5 each task counts its n-grams in quotient filters (``quotient_filter``), one for each range of the
   permuted keys; filters of a range are merged and n-grams of ``min_count`` and more stay. An n-gram
   can only be that frequent if both of its (n-1)-grams are, so tasks first ask a bitmap of those: of at most
   ``2 ** MAX_MARK_BITS`` bits however many there are. A bit may be shared, which costs candidates and loses none.
4. Frequent n-grams hold all parts of the cuts of longer ones, so scores are joins of that table with itself.

Ranges grow in number with the corpus; a task holds the filters of one range, or one block of texts. Scores are exact:
products are decimals of 38 digits.

Odd rows: a null or empty text has no words; a null language is ``und``, as is a language of that name; texts of any
length are one run of pieces each, never cut; repeated rows count each time; phrases that tie in score and
count rank by their UTF-8 bytes. Other columns are not read, whatever their names. A table without words gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import quotient_filter as qf
from .common import bounded, staged, whole_text

#: Bytes of text that a block holds, about; a text is never cut.
BLOCK_BYTES = 6 << 20
#: A task sums its n-grams up when it has so many; a range of filters is meant to have at most so many words.
HELD = 1 << 20
#: The distinct words of a block travel in so many lists, by a hash.
BUCKETS = 512
#: A bitmap of frequent n-grams has at most so many bits (32 MB).
MAX_MARK_BITS = 28
#: Tables of so many rows are sent to all tasks; larger ones are joined by a shuffle.
MAX_BROADCAST = 500_000

KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def split_pieces(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of ``texts``, A-Z lower-cased, and for each whether a piece begins with it."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), "\n")
    size = pc.binary_length(joined)[0].as_py()
    raw = np.frombuffer(joined.buffers()[2], np.uint8, size) if size else np.empty(0, np.uint8)
    kind = KIND[raw]
    inside = kind == 0
    edge = np.diff(inside.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(LOWER[raw[inside]]))
    return words.dictionary_encode(), np.diff(piece, prepend=-1) != 0


def _planes(x: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T))


def _from_planes(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


BLOCKS = "block long, lang string, codes binary, bucket int, words array<string>, code array<int>, n array<long>"


def _blocks(most: int, buckets: int):
    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Runs of rows whose texts have ``most`` bytes, or one row."""
        upto = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, base + most, "right")))
            yield batch.slice(start, end - start)
            start = end

    def coded(texts: pa.Array, lang: str, block: int) -> Iterator[pa.RecordBatch]:
        words, new = split_pieces(texts)
        if not len(words):
            return
        codes, n = words.indices.to_numpy(zero_copy_only=False), len(words.dictionary)
        counts = np.bincount(codes, minlength=n)
        by_rank = np.argsort(-counts, kind="stable")
        rank = np.empty(n, np.uint32)
        rank[by_rank] = np.arange(n)
        bucket = (pd.util.hash_array(words.dictionary.to_numpy(zero_copy_only=False), categorize=False) % buckets).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        heads = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        bounds = pa.array(np.r_[heads, n].astype(np.int32))
        lists = [words.dictionary.take(pa.array(order)), pa.array(rank[order].astype(np.int32)), pa.array(counts[order])]
        # The lowest bit of a position says whether a piece begins there.
        rows = [[None] * len(heads) + [_planes(rank[codes] * 2 + new)], [*bucket[order][heads].tolist(), None]]
        columns = [pa.array([block] * (len(heads) + 1), pa.int64()), pa.array([lang] * (len(heads) + 1), pa.string()), pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.int32())]
        columns += [pa.concat_arrays([pa.ListArray.from_arrays(bounds, x), pa.nulls(1, pa.list_(x.type))]) for x in lists]
        yield pa.record_batch(columns, ["block", "lang", "codes", "bucket", "words", "code", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block without its texts: places of words with the starts of pieces, and its distinct words with counts, in lists by bucket."""
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in cut(batch):
                for lang in pc.unique(part["lang"]).to_pylist():
                    block += 1
                    yield from coded(part["text"].filter(pc.equal(part["lang"], lang)), lang, block)

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of a block's words that have one. Rows come by bucket, its words with ids before the lists of blocks."""
    bucket, known = None, {}
    for whole in batches:
        # Few rows at a time become Python objects: a list may have hundreds of words.
        for start in range(0, whole.num_rows, 200):
            batch = whole.slice(start, 200)
            blocks, codes, ids = [], [], []
            for at, lang, word, number, block, words, code in zip(*[c.to_pylist() for c in batch.columns[:-1]], batch.columns[-1]):
                if at != bucket:
                    bucket, known = at, {}
                if word is not None:
                    known.setdefault(lang, {})[word] = number
                    continue
                of = known.get(lang)
                found = np.fromiter((of.get(w, 0) for w in words), np.int32, len(words)) if of else np.empty(0, np.int32)
                if found.any():
                    blocks.append(block)
                    codes.append(code.values.to_numpy()[found > 0].astype(np.uint32).tobytes())
                    ids.append(found[found > 0].tobytes())
            yield pa.record_batch([pa.array(blocks, pa.int64()), pa.array(codes, pa.binary()), pa.array(ids, pa.binary())], ["block", "codes", "ids"])


def _with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a block's positions; runs of words without id, and ends of pieces, are a single 0. Rows come by block, answers first."""
    block, answers = None, []
    for batch in batches:
        for name, codes, ids in zip(*[c.to_pylist() for c in batch.columns]):
            if name != block:
                block, answers = name, []
            if ids is not None:
                answers.append((np.frombuffer(codes, np.uint32), np.frombuffer(ids, np.int32)))
                continue
            packed = _from_planes(codes)
            place, new = packed >> 1, packed & 1
            of = np.zeros(int(place.max()) + 1, np.int32)
            for at, found in answers:
                of[at] = found
            spread = np.zeros((len(place), 2), np.int32)
            spread[:, 1] = of[place]
            keep = np.ones((len(place), 2), bool)
            keep[:, 0] = new == 1
            flat = np.r_[spread.ravel()[keep.ravel()], 0]
            flat = flat[np.r_[True, (flat[1:] != 0) | (flat[:-1] != 0)]]
            yield pa.record_batch([pa.array([_planes(flat)], pa.binary())], ["ids"])


def ids_of_blocks(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """The blocks' positions as ids: lists of words meet the ids of their bucket, and the answers their block, both as streams of sorted rows."""
    none = lambda kind: F.lit(None).cast(kind)
    asked = blocks.filter(F.col("words").isNotNull()).select("bucket", "lang", none("string").alias("word"), none("int").alias("id"), "block", "words", "code")
    known = words.select("bucket", "lang", "word", "id", none("long").alias("block"), none("array<string>").alias("words"), none("array<int>").alias("code"))
    met = known.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", F.col("block").asc_nulls_first())
    answers = met.mapInArrow(_answered, "block long, codes binary, ids binary")
    codes = blocks.filter(F.col("codes").isNotNull()).select("block", "codes", none("binary").alias("ids"))
    back = answers.unionByName(codes).repartition("block").sortWithinPartitions("block", F.col("ids").isNull())
    return back.mapInArrow(_with_ids, "ids binary")


def _counted(layout: qf.Layout, shorter: qf.Layout | None, mark_bits: int, marks: Broadcast | None):
    def lanes_of(ids: np.ndarray) -> list[np.ndarray] | None:
        """Permuted n-grams of one run of ids that may be frequent."""
        k, n = layout.k, len(ids) - layout.k + 1
        if n <= 0:
            return None
        whole = np.ones(n, bool)
        for j in range(k):
            whole &= ids[j : j + n] != 0
        if shorter is not None:
            at = np.flatnonzero(whole)
            both = np.union1d(at, at + 1)
            windows = np.stack([ids[both + j] for j in range(k - 1)]) if len(both) else np.empty((k - 1, 0), np.int64)
            marked = np.zeros(n + 1, bool)
            place = shorter.mark(shorter.permute(_packed(shorter, windows)), mark_bits)
            marked[both] = (marks.value[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
            whole &= marked[:-1] & marked[1:]
        at = np.flatnonzero(whole)
        return layout.permute(_packed(layout, np.stack([ids[at + j] for j in range(k)]))) if len(at) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Filters of this task's n-grams: a row for each range, more often only where a task has very many."""
        parts: list[qf.Entries] = []

        def summed() -> qf.Entries:
            return qf.summed([np.concatenate(x) for x in zip(*[p[0] for p in parts])], np.concatenate([p[1] for p in parts]))

        def out(entries: qf.Entries) -> pa.RecordBatch:
            made = qf.filters(layout, entries)
            return pa.record_batch([pa.array([r for r, _ in made], pa.int32()), pa.array([x for _, x in made], pa.binary())], ["at", "filter"])

        for batch in batches:
            for raw in batch["ids"]:
                lanes = lanes_of(_from_planes(raw.as_py()).astype(np.int64))
                if lanes is None:
                    continue
                parts.append(qf.summed(lanes))
                if sum(len(n) for _, n in parts) > HELD and len(parts) > 1:
                    parts[:] = [summed()]
                if len(parts) == 1 and len(parts[0][1]) > HELD:
                    yield out(parts.pop())
        if parts:
            yield out(summed())

    return run


def _packed(layout: qf.Layout, windows: np.ndarray) -> list[np.ndarray]:
    """Lanes of n-grams given as columns of ids."""
    out, at = [], 0
    for held in layout.lanes:
        lane = np.zeros(windows.shape[1], np.uint64)
        for j in range(at, at + held):
            lane = (lane << np.uint64(layout.bits)) | windows[j].astype(np.uint64)
        out.append(lane)
        at += held
    return out


def _frequent(layout: qf.Layout, least: int, mark_bits: int):
    def run(rows: pa.Table) -> pa.Table:
        """The n-grams of one range that are frequent, with their places in the bitmap."""
        lanes, counts = qf.merged(layout, rows["at"][0].as_py(), rows["filter"].to_pylist())
        lanes, counts = [x[counts >= least] for x in lanes], counts[counts >= least]
        ids = layout.unpack(layout.restore(lanes))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1, dtype=np.int32) * layout.k), pa.array(ids.ravel().astype(np.int32)))
        return pa.table({"ids": lists, "f": pa.array(counts), "mark": pa.array(layout.mark(lanes, mark_bits).astype(np.int64))})

    return run


def bitmap(spark, frequent: DataFrame, mark_bits: int) -> Broadcast:
    """The marks of ``frequent`` as a bitmap: its size is that of ``mark_bits``, whatever the number of rows."""
    out = np.zeros(max(1, (1 << mark_bits) // 8), np.uint8)
    bit = F.col("mark") + 1  # Spark counts buckets and bits from 1
    slices = frequent.groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
    for bucket, raw in slices.agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit))).collect():
        part = np.frombuffer(raw, np.uint8)[: len(out)]
        start = (bucket - 1) * 4096
        out[start : start + len(part)] = part
    return spark.sparkContext.broadcast(out)


def dense_ids(words: DataFrame) -> DataFrame:
    """``words`` with ids from 1 on: rows are numbered within the tasks that write them, and tasks by their first number."""
    numbered = staged(words.withColumn("_m", F.monotonically_increasing_id()), "words")
    task, row = F.shiftright("_m", 33), F.col("_m").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    starts = numbered.groupBy(task.alias("_t")).count().select("_t", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    joined = numbered.join(bounded(starts, MAX_BROADCAST), F.col("_t") == task)
    return staged(joined.select(*words.columns, (F.col("_first") + row + 1).cast("int").alias("id")), "word-ids")


def mined(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 100, longest: int = 5, block_bytes: int = BLOCK_BYTES):
    """(words: lang, word, f, id; n-grams: ids, f, of one word too; totals: lang, n), each whole and exact."""
    spark = df.sparkSession
    texts = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), whole_text(text_col).alias("text"))
    blocks = staged(texts.mapInArrow(_blocks(block_bytes, BUCKETS), BLOCKS), "phrase-blocks")
    named = blocks.filter(F.col("words").isNotNull()).select("bucket", "lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("n").alias("n"))))
    counts = named.groupBy("bucket", "lang", "word").agg(F.sum("n").alias("f"))
    totals = staged(named.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    words = dense_ids(counts.filter(F.col("f") >= min_count))
    ids = staged(ids_of_blocks(blocks, words), "phrase-ids")
    every = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = max(1, (words.count() + 1).bit_length())
    range_bits = max(6, (every // HELD).bit_length())
    mark_bits = min(MAX_MARK_BITS, max(16, (16 * every // min_count).bit_length()))
    grams, shorter, marks = [words.select(F.array("id").alias("ids"), "f")], None, None
    for k in range(2, longest + 1):
        layout = qf.Layout(k, bits, range_bits)
        counted = ids.mapInArrow(_counted(layout, shorter, mark_bits, marks), "at int, filter binary")
        frequent = counted.groupBy("at").applyInArrow(_frequent(layout, min_count, mark_bits), "ids array<int>, f long, mark long")
        frequent = staged(frequent, f"phrases-{k}")
        grams.append(frequent.select("ids", "f"))
        if k < longest:
            shorter, marks = layout, bitmap(spark, frequent, mark_bits)
    whole = grams[0]
    for x in grams[1:]:
        whole = whole.unionByName(x)
    return words, staged(whole, "phrases"), totals


def _exact(value: Column, digits: int) -> Column:
    return value.cast(f"decimal({digits},0)")


def scored(grams: DataFrame, first_words: DataFrame, absorb: int = 100) -> DataFrame:
    """(ids, lang, n, a, l, r, score) of phrases that no longer one absorbs, by their lowest-scoring cut."""
    phrases = grams.filter(F.size("ids") > 1)
    k = F.size("ids")
    # Whatever holds a phrase holds a phrase one word longer that holds it, and is no more frequent than that.
    longer = grams.filter(k > 2).select(F.explode(F.array(F.expr("slice(ids, 1, size(ids) - 1)"), F.expr("slice(ids, 2, size(ids) - 1)"))).alias("ids"), "f")
    longer = longer.groupBy("ids").agg(F.max("f").alias("most"))
    left = phrases.join(longer, "ids", "left").filter(F.col("most").isNull() | (100 * F.col("most") < absorb * F.col("f"))).drop("most")
    cuts = left.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), k - 1)).alias("cut"))
    cuts = cuts.withColumns({"head": F.expr("slice(ids, 1, cut)"), "tail": F.expr("slice(ids, cut + 1, size(ids) - cut)")})
    parts = bounded(grams, MAX_BROADCAST)
    cuts = cuts.join(parts.select(F.col("ids").alias("head"), F.col("f").alias("l")), "head").drop("head")
    cuts = cuts.join(parts.select(F.col("ids").alias("tail"), F.col("f").alias("r")), "tail").drop("tail")
    cuts = cuts.withColumn("first", F.get("ids", F.lit(0))).join(bounded(first_words, MAX_BROADCAST), "first")
    top = _exact(F.col("a"), 17) * _exact(F.col("n"), 17) * F.lit(1000).cast("decimal(4,0)")
    cuts = cuts.withColumns({"_top": top, "_under": _exact(F.col("l"), 19) * _exact(F.col("r"), 19)}).withColumn("score", F.expr("_top div _under"))
    best = F.min(F.struct("score", "cut", "l", "r")).alias("best")
    return cuts.groupBy("ids", "lang", "n", "a").agg(best).select("ids", "lang", "n", "a", "best.l", "best.r", "best.score")


def with_text(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """``phrases`` with ``phrase``: words joined back by id and put together by place."""
    placed = phrases.select("ids", F.posexplode("ids").alias("at", "id"))
    named = placed.join(bounded(words.select("id", "word"), MAX_BROADCAST), "id")
    spelt = named.groupBy("ids").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
    return phrases.join(spelt.select("ids", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase")), "ids")


def phrases(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 100, top: int = 2000, longest: int = 5, absorb: int = 100,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Ranks are taken in two steps, so that no task sorts all phrases of a language: first within parts of it, by a hash.
    """
    words, grams, totals = mined(df, text_col, lang_col, min_count, longest, block_bytes)
    firsts = words.select(F.col("id").alias("first"), "lang").join(bounded(totals, MAX_BROADCAST), "lang")
    found = staged(with_text(scored(grams, firsts, absorb), words), "phrase-scores")
    parts = max(8, found.count() // 20_000)
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    some = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts))).withColumn("rank", rank("lang", "part")).filter(F.col("rank") <= top)
    best = some.withColumn("rank", rank("lang")).filter(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
