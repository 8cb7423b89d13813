"""BPE encoding and decoding over a distinct-word table.

Tokens never cross white space, so a text's ids are its words' ids in order. Documents are
cut into blocks of bounded size. Each block splits its texts into words once with Arrow and
names its distinct words, dealt to buckets by the hash of the word; a bucket gathers the
words of all blocks, and the tokenizer encodes each distinct word of the corpus once. The
ids of a block's words return to it in the order of the words, and are joined to the word
positions of its documents by a vectorised take. Decoding takes each id's piece from the
id-to-piece table, which has the vocabulary's fixed size and so may sit in every task;
``decode_ids`` is the same join for any table of ids.

Both passes over the input must cut the same blocks, which a scan of files does. Any other
input is written to the shared folder first. Blocks are named by a hash of their rows, so a
block that does not find its words stops the job; it never loses any.

Odd rows: a null or empty text, or one of white space alone, has no ids and decodes to an
empty text; repeated rows each give a row; a text longer than a block is a block of its
own; an empty table gives no rows. Only the columns of ``keep`` and the text are read, and a
kept column may have any name but ``ids`` and ``decoded``.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import is_scan, staged, unused, whole_text

#: Bytes of text in a block, about; what a Python worker holds grows with this alone.
BLOCK_BYTES = 32_000_000
#: Bytes of text that are split at a time, about: what splitting takes beside a block's words and places grows with this.
SPLIT_BYTES = 4_000_000
#: Buckets of the distinct-word table; a worker holds the distinct words of one at a time.
BUCKETS = 4096
#: Word positions in each batch that a worker hands back, about.
OUT_WORDS = 1_000_000


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


@cache
def pieces(path: str) -> list[str]:
    """The id-to-piece table."""
    made = tokenizer(path)
    return [made.id_to_token(k) or "" for k in range(made.get_vocab_size())]


def id_type(path: str) -> np.dtype:
    return np.dtype("u2" if len(pieces(path)) <= 1 << 16 else "u4")


def cut_blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, pa.Table]]:
    """Rows in order, cut where the bytes of the last column, the text, reach ``most``; each block with its name.

    The column before the text is the number of the input's partition.
    """
    held, size = [], 0

    def cut(count: int) -> tuple[int, pa.Table]:
        whole = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        # The place in the input keeps blocks of equal rows apart, so that no block is hot.
        digest = xxhash.xxh64(f"{whole.columns[-2][0]} {count} {whole.num_rows}")
        text = whole.columns[-1].chunk(0)
        lengths = pc.binary_length(text).to_numpy(zero_copy_only=False)
        digest.update(lengths.tobytes())
        first = int(np.frombuffer(text.buffers()[1], np.int32, 1, text.offset * 4)[0])
        if text.buffers()[2] is not None:
            digest.update(memoryview(text.buffers()[2])[first : first + int(lengths.sum(dtype=np.int64))])
        return digest.intdigest() - (1 << 63), whole

    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.binary_length(batch.columns[-1]).to_numpy(zero_copy_only=False).astype(np.int64))
        start, base = 0, 0
        while start < batch.num_rows:
            end = min(batch.num_rows, int(np.searchsorted(sizes, base + most - size)) + 1)
            held.append(batch.slice(start, end - start))
            size += int(sizes[end - 1]) - base
            start, base = end, int(sizes[end - 1])
            if size >= most:
                yield cut(count)
                size, count = 0, count + 1
    if held:
        yield cut(count)


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The number of words of each text, and all words in order, as places in the array of distinct ones."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    counts, parts, start = [np.empty(0, np.int64)], [], 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + SPLIT_BYTES, "right")))
        bare = pc.ascii_trim_whitespace(texts.slice(start, end - start))
        lists = pc.ascii_split_whitespace(pc.if_else(pc.equal(bare, ""), pa.scalar(None, texts.type), bare))
        counts.append(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        parts.append(lists.flatten().dictionary_encode())
        start = end
    words = pa.chunked_array(parts, pa.dictionary(pa.int32(), texts.type)).unify_dictionaries()
    return np.concatenate(counts), words.combine_chunks()


def dealt(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(order, bucket of each word in that order): distinct words by the bucket of their hash, then by appearance."""
    bucket = (pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False) % BUCKETS).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


def _thrifty(run):
    """``run``; memory that a batch has needed goes back before the next, and before the worker waits for other tasks, as Spark keeps it."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in run(batches):
            yield made
            pa.default_memory_pool().release_unused()
        pa.default_memory_pool().release_unused()

    return wrapped


def _named_words(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The distinct words of each block and bucket, joined by spaces."""
        for name, rows in cut_blocks(batches, most):
            words = split_words(rows.columns[-1].chunk(0))[1].dictionary
            if not len(words):
                continue
            order, bucket = dealt(words)
            heads = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[heads, len(order)].astype(np.int32)), words.take(pa.array(order)))
            columns = [pa.array(bucket[heads]), pa.array(np.full(len(heads), name)), pc.binary_join(lists, " ")]
            del rows, words, lists
            yield pa.record_batch(columns, ["bucket", "block", "words"])

    return _thrifty(run)


def _packed(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block without its texts: kept columns, word counts, and for each word position the place of its word.

        Places are ranked by frequency and cut into byte planes, which compress well; ``at`` leads from ranks to the
        order in which the words were sent off.
        """
        press = zstandard.ZstdCompressor(level=1)
        for name, rows in cut_blocks(batches, most):
            counts, words = split_words(rows.columns[-1].chunk(0))
            n = len(words.dictionary)
            order = dealt(words.dictionary)[0] if n else np.empty(0, np.int64)
            sent = np.empty(n, np.int64)
            sent[order] = np.arange(n)
            codes = words.indices.to_numpy(zero_copy_only=False)
            by_rank = np.argsort(-np.bincount(codes, minlength=n), kind="stable")
            rank = np.empty(n, "<u4")
            rank[by_rank] = np.arange(n)
            planes = np.ascontiguousarray(rank[codes].view(np.uint8).reshape(-1, 4).T)
            sink = pa.BufferOutputStream()
            kept = rows.select(rows.column_names[:-2]).append_column("_words", pa.array(counts))
            with pa.ipc.new_stream(sink, kept.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(kept)
            columns = {
                "block": pa.array([name], pa.int64()),
                "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                "codes": pa.array([press.compress(planes)], pa.binary()),
                "at": pa.array([press.compress(sent[by_rank].astype("<u4"))], pa.binary()),
            }
            del rows, kept, words, codes, planes
            yield pa.record_batch(columns)

    return _thrifty(run)


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket, and a word has one bucket: what it holds is kept until the next bucket begins."""
        made, kind, last = tokenizer(path), id_type(path).char, None
        known: dict[str, bytes] = {}
        for batch in batches:
            at = batch["bucket"].to_numpy(zero_copy_only=False)
            named = [x.split(" ") for x in batch["words"].to_pylist()]
            sizes, ids = [], []
            heads = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else []
            for a, b in zip(heads, [*heads[1:], len(at)]):
                if at[a] != last:
                    known, last = {}, at[a]
                fresh = [w for w in dict.fromkeys(w for words in named[a:b] for w in words) if w not in known]
                coded = made.encode_batch_fast(fresh, add_special_tokens=False)
                known.update((w, array(kind, c.ids).tobytes()) for w, c in zip(fresh, coded))
                for words in named[a:b]:
                    found = [known[w] for w in words]
                    sizes.append(array("I", map(len, found)).tobytes())
                    ids.append(b"".join(found))
            columns = {"block": batch["block"], "bucket": batch["bucket"], "sizes": pa.array(sizes, pa.binary()), "ids": pa.array(ids, pa.binary())}
            yield pa.record_batch(columns)

    return _thrifty(run)


def _joined(path: str, out_schema: pa.Schema):
    def texts(answers: dict[int, tuple[bytes, bytes]], rows: bytes, codes: bytes, at: bytes) -> Iterator[pa.RecordBatch]:
        kind, names = id_type(path), pa.array(pieces(path))
        unpress = zstandard.ZstdDecompressor().decompress
        sent = [answers[k] for k in sorted(answers)]
        size = np.frombuffer(b"".join(x for x, _ in sent), "u4").astype(np.int64) // kind.itemsize
        flat = np.frombuffer(b"".join(x for _, x in sent), kind)
        to = np.frombuffer(unpress(at), "<u4")
        if len(to) != len(size):
            raise ValueError("a block did not find its words: the input came in another order on its second reading")
        first = (np.cumsum(size) - size)[to]
        size = size[to]
        code = np.ascontiguousarray(np.frombuffer(unpress(codes), np.uint8).reshape(4, -1).T).view("<u4").ravel()
        kept = pa.ipc.open_stream(rows).read_all().combine_chunks()
        ends = np.cumsum(kept.columns[-1].to_numpy())
        kept, start, word = kept.remove_column(kept.num_columns - 1), 0, 0
        while start < len(ends):
            end = max(start + 1, int(np.searchsorted(ends, word + OUT_WORDS, "right")))
            c = code[word : ends[end - 1]]
            n = size[c]
            upto = np.cumsum(n)
            ids = flat[np.repeat(first[c] - (upto - n), n) + np.arange(upto[-1] if len(upto) else 0)].astype(np.int32)
            inner = np.r_[0, upto][np.r_[0, ends[start:end] - word]].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(inner), pa.array(ids))
            decoded = pc.binary_join(pa.ListArray.from_arrays(pa.array(inner), names.take(pa.array(ids))), " ")
            part = kept.slice(start, end - start).combine_chunks()
            columns = [x.chunk(0) if x.num_chunks else pa.array([], x.type) for x in part.columns] + [lists, decoded]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, out_schema)], schema=out_schema)
            start, word = end, int(ends[end - 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block, the answers of its buckets before its rows."""
        block, answers = None, {}
        for batch in batches:
            for name, bucket, sizes, ids, rows, at in zip(*(batch[c].to_pylist() for c in ("block", "bucket", "sizes", "ids", "rows", "at"))):
                if name != block:
                    block, answers = name, {}
                if bucket < BUCKETS:
                    answers[bucket] = sizes, ids
                else:
                    yield from texts(answers, rows, ids, at)

    return _thrifty(run)


def encode_decode(
    df: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The columns ``keep`` of each row with ``ids`` (array of int) and ``decoded`` (those ids as text)."""
    text = unused("_text", keep)
    rows = df.select(*keep, whole_text(text_col).alias(text))
    if not is_scan(df):
        rows = staged(rows, "texts")
    rows = rows.select(*keep, F.spark_partition_id().alias(unused("_place", keep)), text)
    words = rows.mapInArrow(_named_words(block_bytes), "bucket int, block long, words string")
    coded = words.repartition("bucket").sortWithinPartitions("bucket")
    coded = coded.mapInArrow(_encoded(path), "block long, bucket int, sizes binary, ids binary")
    packed = rows.mapInArrow(_packed(block_bytes), "block long, rows binary, codes binary, at binary")
    packed = packed.select("block", F.lit(BUCKETS).alias("bucket"), F.lit(None).cast("binary").alias("sizes"), F.col("codes").alias("ids"), "rows", "at")
    none = F.lit(None).cast("binary")
    met = coded.select("*", none.alias("rows"), none.alias("at")).unionByName(packed).repartition("block").sortWithinPartitions("block", "bucket")
    schema = T.StructType(
        [rows.schema[c] for c in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    )
    return met.mapInArrow(_joined(path, to_arrow_schema(schema)), schema)


def piece_table(spark, path: str) -> DataFrame:
    """(id, piece): as many rows as the vocabulary, whatever the input."""
    return spark.createDataFrame(list(enumerate(pieces(path))), "id int, piece string")


def decode_ids(df: DataFrame, path: str, key: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(key, decoded) of any table of id arrays: explode, join the piece table, put pieces back by position.

    ``key`` must be unique. Unknown ids are an error; an empty or null array decodes to an empty text.
    """
    tokens = df.select(key, F.posexplode_outer(ids_col).alias("pos", "id"))
    named = tokens.join(F.broadcast(piece_table(df.sparkSession, path)), "id", "left")
    known = F.when(F.col("id").isNotNull() & F.col("piece").isNull(), F.raise_error(F.lit("unknown id"))).otherwise(F.col("piece"))
    back = named.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", known.alias("piece")))).alias("t"))
    return back.select(key, F.array_join(F.transform("t", lambda x: x["piece"]), " ").alias("decoded"))
