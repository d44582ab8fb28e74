"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames; each frame holds some whole
records.  A skippable frame at the end holds the seek table (compressed and
plain size of each frame), and an index table maps every record to its bundle,
frame and place within the frame, so one record is read by decompressing one
frame.  Records with equal payloads of at least ``REVISIT_BYTES`` are stored
once: the one with the smallest id as response, the others as revisits.

Tasks write bundles of bounded size straight to the shared folder, under names
of their own; the index, committed by Spark, names the bundles of the attempts
that count, so a lost or repeated task leaves no half bundle in use.  A task
holds one frame of records at a time.

Defined cases: a null payload is empty; a null url gives no target header; rows
with a null id are always responses; repeated rows of the smallest id are all
responses; empty tables give no bundles and no rows; columns that are not asked
for are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm.common import read_table
from lapse.session import scratch_table

REVISIT_BYTES = 100
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
LEVEL = 3
# Fixed values of the seekable format and of WARC 1.1.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"       # the table has no crawl time
INDEX = ("page_id long, bundle string, frame int, frame_at long, frame_size long, at long, size long")


def open_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pyarrow.fs.FileSystem.from_uri(uri)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)),
            ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    head += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response"),
             ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """(record, end) of the record at ``at``; the digest of a stored payload is checked."""
    cut = data.index(b"\r\n\r\n", at)
    lines = data[at:cut].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record here")
    head = dict(x.split(": ", 1) for x in lines[1:])
    end = cut + 4 + int(head["Content-Length"])
    http, payload = data[cut + 4:end].split(b"\r\n\r\n", 1)
    length = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")).split(": ")[1])
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = head["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
    number = lambda name: int(head[name]) if name in head else None
    return {"page_id": number("X-Page-ID"), "url": head.get("WARC-Target-URI"), "payload_bytes": length, "payload_digest": digest,
            "record_type": kind, "refers_to": number("X-Refers-To-Page-ID"),
            "payload": payload if kind == "response" else None}, end + 4


class BundleWriter:
    """One bundle file; ``add`` fills frames, ``close`` writes the seek table and gives the index rows."""

    def __init__(self, fs: pyarrow.fs.FileSystem, folder: str):
        self.name = f"bundle-{uuid.uuid4().hex}.warc.zst"
        self.out = fs.open_output_stream(f"{folder}/{self.name}", compression=None)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.sizes: list[tuple[int, int]] = []
        self.written, self.held, self.ids, self.index = 0, bytearray(), [], []

    def add(self, page_id: int | None, record: bytes) -> None:
        self.ids.append((page_id, len(self.held), len(record)))
        self.held += record
        if len(self.held) >= FRAME_BYTES:
            self._end_frame()

    def _end_frame(self) -> None:
        if self.held:
            frame = self.packer.compress(bytes(self.held))
            self.out.write(frame)
            self.index += [(p, self.name, len(self.sizes), self.written, len(frame), a, n) for p, a, n in self.ids]
            self.sizes.append((len(frame), len(self.held)))
            self.written += len(frame)
            self.held, self.ids = bytearray(), []

    def close(self) -> list[tuple]:
        self._end_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()
        return self.index


def read_seek_table(file) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of every frame of an open bundle."""
    total = file.size()
    file.seek(total - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("not a seekable bundle")
    file.seek(total - 9 - 8 * n)
    frames, at = [], 0
    for packed, plain in struct.iter_unpack("<II", file.read(8 * n)):
        frames.append((at, packed, plain))
        at += packed
    return frames


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


INDEX_ROWS = pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("frame_at", pa.int64()),
                        ("frame_size", pa.int64()), ("at", pa.int64()), ("size", pa.int64())])
RECORD_ROWS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                         ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, payload binary")


def with_revisits(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with ``refers_to``: the smallest page_id of an equal payload, if smaller."""
    body = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                         F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("n"))
    large = pages.where(F.col("n") >= REVISIT_BYTES).select("page_id", "digest")
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    refers = (large.join(first, "digest").where("page_id > first")
              .select("page_id", "digest", F.col("first").alias("refers_to")).distinct())
    return pages.join(refers, ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html, refers_to) into bundles in ``folder``; give the stored index."""
    spark = pages.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(f"{folder}/bundles")
        fs.create_dir(path, recursive=True)
        bundle = None
        for batch in batches:
            for page, url, html, refers in zip(*(batch[c] for c in ("page_id", "url", "html", "refers_to"))):
                page = page.as_py()
                bundle = bundle or BundleWriter(fs, path)
                bundle.add(page, make_record(page, url.as_py(), (html.as_py() or "").encode(), refers.as_py()))
                if bundle.written >= BUNDLE_BYTES:
                    yield _batch(bundle.close(), INDEX_ROWS)
                    bundle = None
        if bundle:
            yield _batch(bundle.close(), INDEX_ROWS)

    index = f"{folder}/index"
    pages.mapInArrow(write, INDEX).write.mode("overwrite").parquet(index)
    return spark.read.schema(INDEX).parquet(index)


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """All records of the bundles that ``index`` names."""
    names = index.select("bundle").distinct()
    # a few bytes per row stand for a whole bundle each: deal them out by number, not by size
    names = names.repartition(max(1, names.count()), "bundle")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(f"{folder}/bundles")
        for batch in batches:
            for name in batch["bundle"].to_pylist():
                with fs.open_input_file(f"{path}/{name}") as file:
                    for at, packed, plain in read_seek_table(file):
                        file.seek(at)
                        data = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)
                        rows, end = [], 0
                        while end < len(data):
                            record, end = parse_record(data, end)
                            rows.append(tuple(record[f.name] for f in RECORD_ROWS))
                        yield _batch(rows, RECORD_ROWS)

    return names.mapInArrow(read, RECORD)


def fetch_records(wanted: DataFrame, folder: str) -> DataFrame:
    """The records of some rows of the index; only their frames are read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(f"{folder}/bundles")
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                with fs.open_input_file(f"{path}/{r['bundle']}") as file:
                    file.seek(r["frame_at"])
                    data = zstandard.ZstdDecompressor().decompress(file.read(r["frame_size"]))
                record, _ = parse_record(data, r["at"])
                rows.append(tuple(record[f.name] for f in RECORD_ROWS))
            yield _batch(rows, RECORD_ROWS)

    return wanted.mapInArrow(read, RECORD)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC bundles, read them back and describe the records."""
    folder = scratch_table(spark, f"warc-{uuid.uuid4().hex}")
    index = write_bundles(with_revisits(read_table(spark, sf_dir, "pages")), folder)
    return read_bundles(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest AS d, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f ON payload_digest = d
"""
