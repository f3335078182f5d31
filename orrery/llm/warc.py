"""WARC archives in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each with whole WARC records
of about ``frame_bytes``, and a footer: a skippable frame with the seek table
(compressed and plain size of each frame), as in the public seekable format. An
index row per record names its file, its frame and its place in the plain
frame, so one record is read by decompressing one frame.

Records of equal payload are written once: the one with the smallest id is a
``response``, the others are ``revisit`` records that name it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import make_dir, mapped, open_fs, open_mapped

# fixed values of the seekable format
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")  # frames, descriptor, magic number
ENTRY = struct.Struct("<II")  # compressed size, plain size


class BundleWriter:
    """Appends records; holds one frame."""

    def __init__(self, uri: str, frame_bytes: int, level: int):
        fs, path = open_fs(uri)
        self.out = fs.open_output_stream(path, compression=None)
        self.pack = zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=True)
        self.frame_bytes, self.table = frame_bytes, []
        self.held, self.n = [], 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and place in it."""
        if self.n and self.n + len(record) > self.frame_bytes:
            self._flush()
        at = len(self.table), self.n
        self.held.append(record)
        self.n += len(record)
        return at

    def _flush(self) -> None:
        packed = self.pack.compress(b"".join(self.held))
        self.out.write(packed)
        self.table.append((len(packed), self.n))
        self.held, self.n = [], 0

    def close(self) -> None:
        if self.n:
            self._flush()
        body = b"".join(ENTRY.pack(*e) for e in self.table) + FOOTER.pack(len(self.table), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()


class BundleReader:
    """Random access by frame; keeps the last frame's plain bytes."""

    def __init__(self, uri: str):
        self.file = open_mapped(uri)
        size = self.file.size()
        self.file.seek(size - FOOTER.size)
        n, flags, magic = FOOTER.unpack(self.file.read(FOOTER.size))
        if magic != SEEKABLE:
            raise ValueError(f"{uri}: no seek table")
        entry = ENTRY.size + (4 if flags & 0x80 else 0)
        self.file.seek(size - FOOTER.size - n * entry)
        table = np.frombuffer(self.file.read(n * entry), np.uint32).reshape(n, entry // 4)
        self.starts = np.r_[0, np.cumsum(table[:, 0], dtype=np.int64)]
        self.plain = table[:, 1]
        self.open = zstandard.ZstdDecompressor()
        self.now, self.data = -1, b""

    def frame(self, k: int) -> bytes:
        if k != self.now:
            self.file.seek(int(self.starts[k]))
            packed = self.file.read(int(self.starts[k + 1] - self.starts[k]))
            self.now, self.data = k, self.open.decompress(packed, max_output_size=int(self.plain[k]))
        return self.data


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC/1.1 record. A revisit has no payload and names its response."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url or '')}",
            "Content-Type: text/html; charset=utf-8", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record begins here")
    head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    start = end + 4
    stop = start + int(head["content-length"])
    return head, data[start:stop], stop + 4


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write(pages: DataFrame, folder: str, min_bytes: int = 0, frame_bytes: int = 1 << 20, level: int = 3,
          date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages(page_id, url, html)`` as bundles under ``folder`` and
    return the index (page_id, file, frame, at, bytes): a row per record.

    Payloads are the html in UTF-8, null: empty. Of payloads of at least
    ``min_bytes`` that are equal (by SHA-1 and length), the smallest page_id is
    the response. Rows that repeat the response's page_id and payload are
    responses too: a record doesn't revisit itself. Null page_ids are written
    as ``None`` and are responses. An empty table gives no files and an empty
    index. Other columns are not read.

    A task writes a file under a name of its own; the index, which Spark
    commits once for each task, names the files that count."""
    spark = pages.sparkSession
    folder = folder.rstrip("/")
    make_dir(folder)
    body = F.coalesce("html", F.lit("")).cast("binary")
    key = [F.unhex(F.sha1(body)).alias("sha"), F.length(body).alias("n")]
    src = pages.select("page_id", "url", body.alias("body"), *key)
    ids = pages.select("page_id", *key)
    # the copies of a payload are counted before anything is joined; single ones need no join
    first = (ids.where(F.col("n") >= min_bytes).groupBy("sha", "n")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
             .where("copies > 1").drop("copies"))
    later = (ids.join(first, ["sha", "n"]).where(F.col("page_id") != F.col("first"))
             .select("page_id", "sha", "first").distinct())
    rows = src.join(later, ["page_id", "sha"], "left").select("page_id", "url", "body", "first")
    schema = T.StructType([src.schema["page_id"]]).add("file", "string").add("frame", "integer").add(
        "at", "long").add("bytes", "long")

    def run(it):
        out = file = None
        try:
            for b in it:
                if not b.num_rows:
                    continue
                if out is None:
                    file = f"{folder}/pages-{uuid.uuid4().hex}.warc.zst"
                    out = BundleWriter(file, frame_bytes, level)
                frames, places, sizes = [], [], []
                for pid, url, body, first in zip(*(b.column(k).to_pylist() for k in range(4))):
                    r = record(pid, url, body, base32_sha1(body), first, date)
                    frame, at = out.add(r)
                    frames.append(frame)
                    places.append(at)
                    sizes.append(len(r))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([file] * len(frames), pa.string()), pa.array(frames, pa.int32()),
                     pa.array(places, pa.int64()), pa.array(sizes, pa.int64())], names=schema.names)
        finally:
            if out is not None:
                out.close()

    index_path = f"{folder}/index"
    rows.transform(mapped, run, schema).write.parquet(index_path)
    return spark.read.schema(schema).parquet(index_path)


READ = T.StructType().add("page_id", "long").add("record_type", "string").add("url", "string").add(
    "payload_bytes", "long").add("payload_digest", "string").add("refers_to", "long").add("payload", "binary")


def read(index: DataFrame, payload: bool = True) -> DataFrame:
    """The records that ``index`` names, read from their bundles: type, url,
    full payload's size and digest, refers_to, and the payload (revisits: null;
    all null if ``payload`` is false). A record whose payload doesn't have the
    size and digest that its head states raises."""
    schema = READ if payload else T.StructType(READ.fields[:-1])

    def number(urn: str | None):
        m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
        return int(m[1]) if m else None

    def rows(b) -> Iterator[tuple]:
        name = reader = None
        for file, frame, at, size in zip(*(b.column(k).to_pylist() for k in range(4))):
            if file != name:
                name, reader = file, BundleReader(file)
            head, body, end = parse(reader.frame(frame), at)
            kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
            n = int(head["x-payload-length"])
            if end != at + size or kind == "response" and (len(body) != n or base32_sha1(body) != digest):
                raise ValueError(f"{file}: record at {frame}, {at} is damaged")
            yield (number(head["warc-record-id"]), kind, head["warc-target-uri"], n, digest,
                   number(head.get("warc-refers-to")), body if kind == "response" else None)

    def run(it):
        for b in it:
            cols = list(zip(*rows(b))) or [[]] * len(READ)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols[:len(schema)], (
                    pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()))],
                names=schema.names)

    # by file, over a fixed number of tasks: an index row is small, what it names is not
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_file = (index.select("file", "frame", "at", "bytes").repartition(n, "file")
               .sortWithinPartitions("file", "frame", "at"))
    return by_file.transform(mapped, run, schema)
