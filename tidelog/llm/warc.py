"""WARC archives of gzip members, one per record, with a splittable reader and payload deduplication.

**Writing.** Payload digests are computed in Spark; of records with equal payloads of at least ``min_revisit_bytes``
the one with the smallest id is a response and the others revisit it. Each task writes archives of its own
under a temporary name and renames them, so a repeated task replaces its file. Records end one gzip member each.

**Reading.** A file is cut into byte ranges, one row each, dealt to tasks. A task scans its range for the gzip magic,
validates a candidate by decoding its first bytes up to a WARC version line, and owns the records that start inside the
range, reading past its end where the last one needs it. No index is needed and no task reads a whole file.

The folder may be anywhere ``pyarrow.fs`` reaches and all executors share (file, hdfs, s3, gs); by default it is below
``spark.checkpoint.dir``.

Defined cases: a null payload is empty, and empty payloads equal each other. A null url is an empty one. Line breaks and
percent signs in urls are percent-encoded and decoded again. Rows that repeat id and payload are all responses if
their id is the group's smallest. A null id is never the smallest, unless all are null. An empty table gives an
empty folder and no records. Other columns are not stored. Payloads are decoded in pieces of a megabyte.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import ready, text_of, written
from tidelog.sources.scratch import scratch_dir

# Fixed values of the format.
VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"
RANGE = 8 << 20
READ = 1 << 20
ARCHIVE_BYTES = 256 << 20
# Records carry no time of their own, so that reruns write the same bytes.
DATE = "1970-01-01T00:00:00Z"

COLUMNS = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<{ID}{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member. A revisit has the HTTP head (with the payload's length) and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url, safe="".join(map(chr, range(33, 127))).replace("%", ""))),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(refers_to))]
    lines = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(lines + block + b"\r\n\r\n") + packer.flush()


def _target(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root if ":" in root.split("/")[0] else f"file://{root}")


def write_archives(
    spark: SparkSession, pages: DataFrame, folder: str | None = None, *, min_revisit_bytes: int = 0
) -> DataFrame:
    """Write the pages (``page_id``, ``url``, ``html``) and return the archives: ``path``, ``bytes``, ``records``."""
    folder = folder or scratch_dir(spark, "warc")
    payload = text_of("html")
    keyed = pages.select(
        F.col("page_id").cast("bigint"), text_of("url").alias("url"), payload.alias("html"), F.sha1(payload).alias("digest")
    )
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id")).alias("first")
    groups = keyed.where(F.octet_length("html") >= min_revisit_bytes).groupBy("digest").agg(first, F.count("*").alias("n"))
    shared = written(groups.where("n > 1").select("digest", F.col("first.page_id").alias("first"), F.lit(True).alias("many")), "payloads")
    rows = keyed.join(shared, "digest", "left").select(
        "page_id", "url", "html",
        F.when(F.col("many") & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
        F.coalesce(F.col("many") & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False)).alias("revisit"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, base = _target(folder)
        store.create_dir(base, recursive=True)
        done: list[tuple[str, int, int]] = []
        out, size, count, temporary = None, 0, 0, ""

        def close() -> None:
            path = f"{base}/part-{context.partitionId():06d}-{len(done):04d}.warc.gz"
            out.close()
            store.move(temporary, path)
            done.append((path, size, count))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    temporary = f"{base}/.part-{context.partitionId():06d}-{context.taskAttemptId()}-{len(done):04d}"
                    out, size, count = store.open_output_stream(temporary), 0, 0
                body = row["html"].encode()
                member = record(row["page_id"], row["url"], body, base32_sha1(body), row["refers_to"], row["revisit"])
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        columns = list(zip(*done)) if done else [[], [], []]
        kinds = [pa.string(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["path", "bytes", "records"])

    # Written at once: a later action must not write the archives again.
    return written(rows.mapInArrow(write, "path string, bytes bigint, records bigint"), "archives")


class _Window:
    """Forward reads of one file in pieces."""

    def __init__(self, file, at: int):
        self.file, self.at = file, at
        file.seek(at)

    def more(self) -> bytes:
        piece = self.file.read(READ)
        self.at += len(piece)
        return piece


def _decode(first: bytes, window: _Window, limit: int | None = None) -> tuple[bytes, bytes] | None:
    """A gzip member that starts with ``first``: its content and what was read behind it.

    With a limit only so many bytes of content. None if it cannot be decoded.
    """
    unpack, parts, size, piece = zlib.decompressobj(31), [], 0, first
    try:
        while True:
            got = unpack.decompress(piece, limit or 0)
            parts.append(got)
            size += len(got)
            if unpack.eof:
                return b"".join(parts), unpack.unused_data
            if limit and size >= limit:
                return b"".join(parts), b""
            piece = window.more()
            if not piece:
                return None
    except zlib.error:
        return None


def parse_record(content: bytes) -> tuple:
    """Fields of a record in the order of ``COLUMNS``.

    Length and digest of a response are those of the payload read; other ones than its headers name are an error. A
    revisit has no payload, so its headers' are returned.
    """
    head, _, block = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(
        int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")
    )

    digest = fields["WARC-Payload-Digest"].partition(":")[2]
    if fields["WARC-Type"] == "response":
        named, (length, digest) = (length, digest), (len(payload), base32_sha1(payload))
        if (length, digest) != named:
            raise ValueError(f"{fields['WARC-Record-ID']}: payload has {(length, digest)}, headers name {named}")

    def number(name: str) -> int | None:
        value = fields.get(name, f"<{ID}null>")[len(ID) + 1 : -1]
        return None if value == "null" else int(value)

    return (
        number("WARC-Record-ID"), unquote(fields["WARC-Target-URI"]), payload, length,
        digest, fields["WARC-Type"], number("WARC-Refers-To"),
    )


def members(file, begin: int, end: int) -> Iterator[bytes]:
    """Contents of the records that start in [begin, end)."""
    window = _Window(file, begin)
    rest, at = window.more(), begin  # ``rest`` are the bytes read from ``at`` on
    while at < end:
        found = rest.find(MAGIC)
        if found < 0:
            keep = rest[-(len(MAGIC) - 1) :]
            at += len(rest) - len(keep)
            piece = window.more()
            if not piece:
                return
            rest = keep + piece
            continue
        at, rest = at + found, rest[found:]
        if at >= end:
            return
        # Enough bytes for a header; a candidate is a record if it decodes to a version line.
        while len(rest) < 4096:
            piece = window.more()
            if not piece:
                break
            rest += piece
        probe = _decode(rest[:4096], _Window(pa.BufferReader(b""), 0), len(VERSION))
        if probe is None or not probe[0].startswith(VERSION):
            at, rest = at + 1, rest[1:]
            continue
        content = _decode(rest, window)
        if content is None:
            at, rest = at + 1, rest[1:]
            window = _Window(file, at)
            rest = window.more()
            continue
        yield content[0]
        rest = content[1]
        at = window.at - len(rest)
        if not rest:
            rest = window.more()
            if not rest:
                return


def read_archives(archives: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """All records of the archives (``path``, ``bytes``), one row each."""
    ranges = archives.where("bytes > 0").select(
        "path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("begin")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        for batch in batches:
            for path, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = _target(path)
                with store.open_input_file(name) as file:
                    rows, size = [], 0
                    for content in members(file, begin, begin + range_bytes):
                        rows.append(parse_record(content))
                        size += len(content)
                        if size >= RANGE:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                            rows, size = [], 0
                    if rows:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    # A number of its own, as rows of a few bytes would be merged into one task whatever they stand for.
    size = archives.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    return ranges.repartition(int(size), "path", "begin").mapInArrow(read, COLUMNS)


def archive_report(pages: DataFrame, **options: int) -> DataFrame:
    """Write the pages, read the archives back, and return what the records say."""
    spark = ready(pages.sparkSession)
    return read_archives(write_archives(spark, pages, **options)).drop("payload", "url")
