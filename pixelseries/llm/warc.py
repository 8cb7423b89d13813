"""WARC archives: write pages as records, read them back by boundary-chain verification.

Writing uses Spark's text sink: a row is a record (headers and block) and the line
separator is the blank line pair that ends every record, so a part file is an archive. Of
pages with equal payloads of at least ``min_bytes`` bytes, the one with the smallest
``page_id`` is stored as a response; the others become revisit records that refer to it.

Reading: Spark's text source cuts archives into byte ranges and lines, so the tasks of one
archive are as many as its size asks for. A line of record magic begins a segment, which is
a candidate: its task emits the offset at which its successor must start. What is left at the
edges of ranges (two segments a range) is put together by joins first. Pointer jumping from
offset 0 doubles the distance each round and marks the candidates that are reached; magic
inside a payload is never the successor of a record, so it drops out. A chain that does not
end at the end of its file is reported as an error. A task digests the payload of a segment
that ends where its record does: each byte once. Where magic inside a payload cuts a record
into several segments, those of records that are reached are put together afterwards.

Odd rows: a null page counts as an empty payload; a page may be as long as Spark's strings
(its task holds it, and a few copies); ids that are no integers are refused: a null ``page_id`` is always a response
and reads back as null; rows that repeat a ``page_id`` with an equal payload are all
responses if that page is the first, else all revisits; line breaks in a URL are
percent-encoded, a null URL is empty. Other columns, whatever their names, are not stored. An
empty table writes no archive and reads as no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import bounded, new_path, staged, whole_text

MAGIC = b"WARC/1.0\r\n"
END = "\r\n\r\n"
#: Records in a file; files of any size are read by ranges of ``spark.sql.files.maxPartitionBytes``.
RECORDS_PER_FILE = 2000
#: Above so many revisits their table is joined by a shuffle instead of a broadcast.
MAX_BROADCAST_REVISITS = 100_000

#: Above so many byte ranges their table is joined by a shuffle instead of a broadcast.
MAX_BROADCAST_RANGES = 200_000

TOLD = "length long, record_type string, page_id long, payload_bytes long, payload_digest string, refers_to long, bytes binary"
SEGMENT = "path string, file_bytes long, range long, at long, used long, edge boolean, magic boolean, " + TOLD
PLACED = "path string, file_bytes long, range long, at long, offset long, " + TOLD
PIECE = "path string, range long, at long, bytes binary"
MEASURED = "path string, offset long, payload_bytes long, payload_digest string"


def revisits(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that repeat an earlier payload; narrow, staged."""
    body = whole_text("html").cast("binary")
    digests = staged(
        pages.filter(F.octet_length(body) >= min_bytes).select("page_id", F.sha2(body, 256).alias("digest")), "payloads"
    )
    first = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    first = staged(first, "first-pages")
    return staged(digests.join(first, "digest").filter("page_id <> refers_to").distinct(), "revisits")


def records(pages: DataFrame, min_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One column ``record``: the WARC record of each page, without the separator after it."""
    kind = pages.schema["page_id"].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"page_id must be an integer to be read back from an archive; it is {kind.simpleString()}")
    again = bounded(revisits(pages, min_bytes), MAX_BROADCAST_REVISITS)
    html = whole_text("html")
    rows = pages.select(
        "page_id",
        F.regexp_replace(F.regexp_replace(whole_text("url"), "\r", "%0D"), "\n", "%0A").alias("url"),
        html.alias("html"),
        F.sha2(html.cast("binary"), 256).alias("digest"),
        F.octet_length(html).alias("bytes"),
    ).join(again, ["page_id", "digest"], "left")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    repeat = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), "bytes", F.lit(END)
    )
    block = F.concat(http, F.when(repeat, "").otherwise(F.col("html")))
    lines = [
        F.lit("WARC/1.0"),
        F.concat(F.lit("WARC-Type: "), F.when(repeat, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name("page_id")),
        F.concat(F.lit("WARC-Target-URI: "), "url"),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest"),
        F.when(repeat, F.concat(F.lit("WARC-Refers-To: "), name("refers_to"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block")),
    ]
    return rows.withColumn("block", block).select(
        F.concat(F.concat_ws("\r\n", *lines), F.lit(END), "block").alias("record")
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = 100, records_per_file: int = RECORDS_PER_FILE) -> None:
    out = records(pages, min_bytes).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file)
    out.text(path)


def _field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


def _page(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def payload(block: bytes, kind: str | None, head: bytes) -> tuple[int | None, str]:
    """(payload bytes, payload digest) of a whole block: measured, or for a revisit as its headers state them."""
    http_end = block.find(b"\r\n\r\n")
    body = http_end + 4 if http_end >= 0 else 0
    if kind == "revisit":
        size = _field(block[:body], "Content-Length") or ""
        return int(size) if size.isdigit() else None, (_field(head, "WARC-Payload-Digest") or "").rpartition(":")[2]
    return len(block) - body, hashlib.sha256(memoryview(block)[body:]).hexdigest()


def candidate(row: bytes) -> tuple:
    """What a record that begins with ``row`` would be: (bytes up to the next, type, page, payload bytes, digest, refers to).

    All are null where the headers do not make a record; payload and digest are null where it does not end with ``row``.
    """
    head_end = row.find(b"\r\n\r\n") if row.startswith(MAGIC) else -1
    head = row[: head_end + 2] if head_end >= 0 else b""
    length = _field(head, "Content-Length") or ""
    if not (length.isascii() and length.isdigit()) or len(length) > 15:
        return (None,) * 6
    end, kind = head_end + 4 + int(length), _field(head, "WARC-Type")
    whole = len(row) == end + 4 and row.endswith(b"\r\n\r\n")
    size, digest = payload(row[head_end + 4 : end], kind, head) if whole else (None, None)
    return end + 4, kind, _page(_field(head, "WARC-Record-ID")), size, digest, _page(_field(head, "WARC-Refers-To"))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, bool, bytes]]:
    """(path, bytes of the file, range, place in the range, whether it lies at an edge, bytes) of each segment.

    Lines come in the order of the file. A segment lies at an edge if it does not begin with magic or if its range ends first.
    """
    here, held, at, past = None, [], 0, 0

    def flush(ends: bool) -> Iterator[tuple]:
        if held:
            data = b"".join(held)
            # The last line of a file need not end with a line break.
            yield *here, at, ends or not data.startswith(MAGIC), data

    for batch in batches:
        lines, n = batch["value"], batch.num_rows
        if not n:
            continue
        new = np.zeros(n, bool)
        for c in ("path", "range"):
            new[1:] |= pc.not_equal(batch[c].slice(1), batch[c].slice(0, n - 1)).to_numpy(zero_copy_only=False)
        magic = pc.equal(lines, pa.scalar(MAGIC[:-1], lines.type)).to_numpy(zero_copy_only=False)
        bounds = np.union1d(np.flatnonzero(new | magic), [0])
        lists = pa.ListArray.from_arrays(pa.array(np.append(bounds, n).astype(np.int32)), lines)
        for k, data in zip(bounds.tolist(), pc.binary_join(lists, pa.scalar(b"\n", lines.type))):
            place = (batch["path"][k].as_py(), batch["file_bytes"][k].as_py(), batch["range"][k].as_py()) if k == 0 or new[k] else here
            data = data.as_py() + b"\n"
            if place != here:
                yield from flush(True)
                here, held, at, past = place, [], 0, 0
            elif magic[k]:
                yield from flush(False)
                held, at = [], past
            held.append(data)
            past += len(data)
    yield from flush(True)


def _batches(rows: Iterator[tuple], schema: str, most: int = 500) -> Iterator[pa.RecordBatch]:
    fields = [x.strip().split(" ") for x in schema.split(",")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    while part := list(islice(rows, most)):
        yield pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*part), fields)], [n for n, _ in fields])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found():
        for path, size, start, at, edge, data in _segments(batches):
            told = (None,) * 6 if edge else candidate(data)
            # Bytes are kept where they may be needed: at edges, and where a record does not end with its segment.
            yield path, size, start, at, len(data), edge, data.startswith(MAGIC), *told, data if edge or told[4] is None else None

    return _batches(found(), SEGMENT)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of a segment that ranges cut, put together: a segment like all others."""

    def found():
        for batch in batches:
            for path, size, parts in zip(*(batch[c].to_pylist() for c in ("path", "file_bytes", "parts"))):
                data = b"".join(x["bytes"] for x in parts)
                first = parts[0]
                data = data[: size - first["offset"]]
                yield path, size, first["range"], first["at"], first["offset"], *candidate(data), data

    return _batches(found(), PLACED)


def archive_lines(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("file_bytes"),
        F.col("_metadata.file_block_start").alias("range"),
        F.col("value").cast("binary").alias("value"),
    )


def segments(lines: DataFrame) -> DataFrame:
    """All segments of the archives at their offsets, those cut by ranges put together; staged."""
    found = staged(lines.mapInArrow(_scan, SEGMENT), "segments")
    held = found.groupBy("path", "range").agg(F.sum("used").alias("used"))
    before = Window.partitionBy("path").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # Ranges of a file, of 128 MB each as a rule: what those before a range hold is its offset.
    starts = staged(held.select("path", "range", F.coalesce(F.sum("used").over(before), F.lit(0)).alias("base")), "ranges")
    found = found.join(bounded(starts, MAX_BROADCAST_RANGES), ["path", "range"]).withColumn("offset", F.col("base") + F.col("at"))
    names = [x.strip().split(" ")[0] for x in PLACED.split(",")]
    order = Window.partitionBy("path").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    edges = found.filter("edge").withColumn("of", F.sum(F.col("magic").cast("int")).over(order))
    parts = edges.groupBy("path", "file_bytes", "of").agg(
        F.sort_array(F.collect_list(F.struct("offset", "range", "at", "bytes"))).alias("parts")
    )
    return staged(found.filter("NOT edge").select(*names).unionByName(parts.mapInArrow(_whole, PLACED)), "candidates")


def reachable(found: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(path, offset) of the candidates on the chain from offset 0, by pointer jumping."""
    chain = found.select("path", "offset", F.col("next").alias("jump"), (F.col("offset") == 0).alias("reached"))
    for _ in range(max_rounds):
        chain = staged(chain, "chain")
        if chain.filter("reached AND jump IS NOT NULL").isEmpty():
            return chain.filter("reached").select("path", "offset")
        ahead = chain.select("path", F.col("offset").alias("jump"), F.col("jump").alias("_further"))
        hit = chain.filter("reached AND jump IS NOT NULL").select("path", F.col("jump").alias("offset"), F.lit(True).alias("_hit"))
        chain = (
            chain.join(ahead, ["path", "jump"], "left")
            .join(hit, ["path", "offset"], "left")
            .select("path", "offset", F.col("_further").alias("jump"), (F.col("reached") | F.col("_hit").isNotNull()).alias("reached"))
        )
    raise RuntimeError(f"a chain has over 2^{max_rounds} records")


def put_together(lines: DataFrame, found: DataFrame, kept: DataFrame) -> DataFrame:
    """(path, offset, payload_bytes, payload_digest) of the kept records that magic in their payload cuts into several segments.

    The segments of a record meet in one task, as its page did when it was written. Those whose bytes were let go are read again.
    """
    cut = kept.filter("payload_digest IS NULL").select("path").distinct()
    heads = kept.select("path", "offset", F.col("offset").alias("head"), F.col("payload_digest").isNull().alias("cut"))
    order = Window.partitionBy("path").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owned = found.select("path", "range", "at", "offset", "bytes").join(cut, "path", "left_semi").join(heads, ["path", "offset"], "left")
    owned = owned.withColumns({"head": F.last("head", True).over(order), "cut": F.last("cut", True).over(order)})
    pieces = staged(owned.filter("cut").select("path", "range", "at", "offset", "head", "bytes"), "pieces")
    gone = pieces.filter("bytes IS NULL").drop("bytes")
    have = pieces.filter("bytes IS NOT NULL").select("path", "offset", "head", "bytes")
    if not gone.isEmpty():
        again = lines.mapInArrow(lambda batches: _batches(((p, r, a, x) for p, _, r, a, _, x in _segments(batches)), PIECE), PIECE)
        have = have.unionByName(again.join(gone, ["path", "range", "at"]).select("path", "offset", "head", "bytes"))
    parts = have.groupBy("path", "head").agg(F.sort_array(F.collect_list(F.struct("offset", "bytes"))).alias("parts"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for path, head, parts in zip(*(batch[c].to_pylist() for c in ("path", "head", "parts"))):
                    data = b"".join(x["bytes"] for x in parts)
                    size, digest = candidate(data[: candidate(data)[0]])[3:5]
                    yield path, head, size, digest

        return _batches(rows(), MEASURED)

    return staged(parts.mapInArrow(measured, MEASURED), "put-together")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``: candidates that the chain from the file's start reaches."""
    lines = archive_lines(spark, path)
    found = segments(lines).withColumn("next", F.col("offset") + F.col("length"))
    kept = found.join(reachable(found), ["path", "offset"])
    ends = found.groupBy("path", "file_bytes").agg(F.lit(0).alias("_")).join(
        kept.groupBy("path").agg(F.max("next").alias("end")), "path", "left"
    )
    broken = ends.filter(~F.col("end").eqNullSafe(F.col("file_bytes"))).limit(5).collect()
    if broken:
        raise ValueError(f"archives whose record chain breaks off: {[r['path'] for r in broken]}")
    if not kept.filter("payload_digest IS NULL").isEmpty():
        whole = put_together(lines, found, kept).withColumnsRenamed({"payload_bytes": "_bytes", "payload_digest": "_digest"})
        kept = kept.join(whole, ["path", "offset"], "left").withColumns(
            {"payload_bytes": F.coalesce("payload_bytes", "_bytes"), "payload_digest": F.coalesce("payload_digest", "_digest")}
        )
    return kept.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def round_trip(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Write the pages to new archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = new_path(spark, "archives")
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path)
