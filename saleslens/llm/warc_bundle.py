"""WARC archives in seekable Zstandard bundles.

Every task writes the records of its rows into one bundle: records are grouped
into independent frames of about ``FRAME_BYTES``, and a seek table in a skippable
frame closes the file.  The index maps each record to (bundle, frame, offset in
the frame, length), so one record is read by decoding one frame.

Equal payloads are stored once.  They meet as digests with their smallest place,
pre-aggregated per task; the pages join that small table, and a digest that a
third of all pages share is split by the adaptive planner.

Lost executors: a bundle has a new name in each attempt, and only the bundles of
committed index rows are ever read; both lie in the shared folder.

Defined results: NULL payload is empty; a NULL page_id comes last among equal
payloads; of rows that repeat a page_id and payload, exactly one is the response;
a NULL url is written as an empty target; a payload larger than a frame has a frame of
its own (a payload is below 2 GB, as any string is, so a frame stays below the
4 GiB of the seek table); an empty table writes no bundle; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
import struct
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, read, scratch_folder

FRAME_BYTES, LEVEL = 1 << 20, 3
SKIPPABLE, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
#: Frames that one reading task decodes.
READ_FRAMES = 16
CAPTURED = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class BundleWriter:
    """Writes records into frames; ``add`` returns (frame, offset, length)."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        if frame_bytes >= 1 << 31:
            raise ValueError("a frame with its last record must stay below 4 GiB")
        self.out, self.limit = out, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.parts, self.size, self.table = [], 0, []

    def add(self, record: bytes) -> tuple[int, int, int]:
        if self.parts and self.size + len(record) > self.limit:
            self._flush()
        place = (len(self.table), self.size, len(record))
        self.parts.append(record)
        self.size += len(record)
        return place

    def _flush(self):
        if self.parts:
            packed = self.packer.compress(b"".join(self.parts))
            self.out.write(packed)
            self.table.append((len(packed), self.size))
            self.parts, self.size = [], 0

    def close(self):
        self._flush()
        body = b"".join(struct.pack("<II", *t) for t in self.table)
        body += struct.pack("<IBI", len(self.table), 0, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)


class BundleReader:
    """Reads single frames with the seek table at the end of the file."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table")
        file.seek(size - 9 - 8 * n)
        body = file.read(8 * n)
        self.frames, at = [], 0
        for packed, plain in struct.iter_unpack("<II", body):
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.frames[number]
        self.file.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=plain)


def opened(path: str):
    """(file system, path in it) of a path as Spark names it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(record_id: str, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    target = "".join(c if c >= " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {CAPTURED}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes):
    """(headers, http headers, payload) of each record in a decoded frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = fields(data[at:end])
        size = int(head["Content-Length"])
        block = data[end + 4:end + 4 + size]
        cut = block.index(b"\r\n\r\n")
        yield head, fields(block[:cut]), block[cut + 4:]
        at = end + 4 + size + 4


def fields(head: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])


INDEX = "record_id string, bundle string, frame int, offset bigint, length bigint"


def with_row_ids(df: DataFrame) -> DataFrame:
    """The pages with ``_file`` and ``_row``, which tell rows apart and are the same in every scan.

    For a frame that doesn't come straight from files, write it first.
    """
    return df.select("page_id", "url", "html", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def decided(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """(record_id, url, payload, refers_to) of pages (page_id, url, html, _file, _row)."""
    own_id = F.concat(
        F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(":"),
        F.lower(F.hex(F.xxhash64("_file", "_row"))))
    rows = pages.select(
        own_id.alias("record_id"), "page_id", "_file", "_row", F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.unhex(F.sha1("payload")))
    place = F.struct(F.col("page_id").isNull().alias("n"), "page_id", "_file", "_row", "record_id")
    shared = (
        rows.where(F.octet_length("payload") >= min_payload).groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
        .select("digest", F.col("first.record_id").alias("first_id")))
    return rows.join(shared, "digest", "left").select(
        "record_id", "url", "payload", F.when(F.col("first_id") != F.col("record_id"), F.col("first_id")).alias("refers_to"))


def write_bundles(records: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write the bundles and return their index, which is written too."""

    def run(batches):
        writer = out = path = None
        rows = []
        for batch in batches:
            if writer is None:
                path = f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"
                fs, inner = opened(path)
                fs.create_dir(inner.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(inner, compression=None)
                writer = BundleWriter(out, frame_bytes)
            for i in range(batch.num_rows):
                rid, url, payload, refers = (batch.column(c)[i].as_py() for c in range(4))
                place = writer.add(record_bytes(rid, url, payload, bare_digest(payload), refers))
                rows.append((rid, path, *place))
            yield pa.RecordBatch.from_pylist([dict(zip(INDEX_NAMES, r)) for r in rows], schema=INDEX_SCHEMA)
            rows = []
        if writer is not None:
            writer.close()
            out.close()

    return materialize(records.select("record_id", "url", "payload", "refers_to").mapInArrow(run, INDEX), "warc-index")


INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]
INDEX_SCHEMA = pa.schema([("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])
RESULT = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
RESULT_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def fetch(bundle: str, frame: int, offset: int, length: int) -> bytes:
    """One record, by decoding one frame."""
    fs, inner = opened(bundle)
    with fs.open_input_file(inner) as file:
        return BundleReader(file).frame(frame)[offset:offset + length]


def page_of(urn: str | None) -> int | None:
    page = urn.strip("<>").split(":")[2] if urn else "null"
    return None if page == "null" else int(page)


def read_bundles(index: DataFrame) -> DataFrame:
    """What the archives say of every record; payloads are checked against their digests."""
    frames = materialize(index.select("bundle", "frame").distinct(), "warc-frames")
    parts = max(1, math.ceil(frames.count() / READ_FRAMES))

    def run(batches):
        # Frames come in order, so a bundle is opened, and its seek table read, once in a task.
        path = file = reader = None
        for batch in batches:
            for bundle, frame in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bundle != path:
                    if file:
                        file.close()
                    fs, inner = opened(bundle)
                    path, file = bundle, fs.open_input_file(inner)
                    reader = BundleReader(file)
                rows = []
                for head, http, payload in parse_records(reader.frame(frame)):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = head["WARC-Type"]
                    if kind == "response" and (bare_digest(payload) != digest or len(payload) != int(http["Content-Length"])):
                        raise ValueError(f"{bundle}: {head['WARC-Record-ID']} is damaged")
                    rows.append((
                        page_of(head["WARC-Record-ID"]), int(http["Content-Length"]), digest, kind, page_of(head.get("WARC-Refers-To"))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), RESULT_SCHEMA.types)], schema=RESULT_SCHEMA)
        if file:
            file.close()

    dealt = frames.repartitionByRange(parts, "bundle", "frame").sortWithinPartitions("bundle", "frame")
    return dealt.mapInArrow(run, RESULT)


def op4_warc_bundles(spark, sf_dir: str) -> DataFrame:
    pages = with_row_ids(read(spark, sf_dir, "pages"))
    return read_bundles(write_bundles(decided(pages), scratch_folder(spark, "warc")))


OP4_SQL = """
WITH sized AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
first AS (SELECT html, min(page_id) AS first_id FROM sized GROUP BY html),
digest AS (
  SELECT s.page_id, strlen(s.html)::BIGINT AS payload_bytes, sha1(s.html) AS hex, f.first_id FROM sized s JOIN first f ON s.html = f.html),
bits AS (
  SELECT *, [('0x' || substr(hex, k * 10 + 1, 10))::BIGINT FOR k IN range(4)] AS words FROM digest)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((words[i // 8 + 1] >> (35 - 5 * (i % 8))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM bits
"""
