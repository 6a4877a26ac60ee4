"""WARC archives in seekable Zstandard bundles.

A bundle is a series of independent Zstandard frames, each holding whole WARC records up to about
``FRAME_BYTES``, followed by a seek table in a skippable frame (the layout of the public
"Zstandard seekable format": sizes of each frame, then a footer with their number). The index
maps a record identifier to (bundle, frame, offset in the frame, length), so a record is read by
decompressing one frame.

Records with equal payloads are written once: that with the smallest id is the response, others
are revisits that refer to it and carry its HTTP header with the full length but no payload. Which
one is first comes from one aggregate over the digests and a join; the join's large side is split
by Spark where one payload holds many rows.

Tasks write bundles under names of their own and return the index rows; only rows of committed
tasks reach the stored index, so files of a failed or repeated attempt are never read
(``orphans`` lists them). Bundles go through ``pyarrow.fs`` to the folder's own file system, which must
be one that all executors share.

A null payload is an empty one. Of records without an id, none is first as long as another record
of the group has an id; a group without any id is all responses. Rows that repeat both id and
payload of a response are responses too. Records below ``min_revisit`` bytes are always responses.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


FRAME_BYTES = 1024 * 1024
BUNDLE_BYTES = 128 * 1024 * 1024
#: Fixed values of the seekable format: skippable frame, footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(uri: str | None) -> int | None:
    value = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def _line(value: str) -> str:
    """A header value without control characters."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(page_id, url: str | None, payload: bytes, first, date: str) -> bytes:
    """One WARC record; ``first``: the id it revisits, or None for a response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if first is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {record_uri(page_id)}",
            f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if first is not None:
        head += [f"WARC-Refers-To: {record_uri(first)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + END + block + END


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of the records in a decompressed frame."""
    at = 0
    while at < len(data):
        stop = data.index(END, at)
        lines = data[at:stop].decode().split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        end = stop + 4 + int(headers["Content-Length"])
        if lines[0] != "WARC/1.1" or data[end: end + 4] != END:
            raise ValueError(f"no WARC record at {at}")
        yield at, end + 4 - at, headers, data[stop + 4: end]
        at = end + 4


def parsed(headers: dict[str, str], block: bytes) -> dict:
    """id, type, reference, full length, digest and payload of a record; the digest of a response
    is computed from what was read."""
    cut = block.index(END) + 4
    http = dict(x.split(": ", 1) for x in block[:cut - 4].decode().split("\r\n")[1:])
    kind, length, digest = headers["WARC-Type"], int(http["Content-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = block[cut:] if kind == "response" else None
    if payload is not None and (len(payload) != length or sha1_base32(payload) != digest):
        raise ValueError(f"damaged payload of {headers['WARC-Record-ID']}")
    return {"page_id": page_of(headers["WARC-Record-ID"]), "url": headers.get("WARC-Target-URI"), "payload_bytes": length,
            "payload_digest": digest, "record_type": kind, "refers_to": page_of(headers.get("WARC-Refers-To")), "payload": payload}


# ---- bundles -------------------------------------------------------------------------------

def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """Skippable frame with (compressed, decompressed) sizes and the footer."""
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(f) -> list[tuple[int, int]]:
    """(offset, compressed size) of each frame of an open bundle."""
    size = f.size()
    f.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    f.seek(size - 9 - n * entry)
    raw, frames, at = f.read(n * entry), [], 0
    for i in range(n):
        packed, _ = struct.unpack_from("<II", raw, i * entry)
        frames.append((at, packed))
        at += packed
    return frames


class BundleWriter:
    """Writes records into bundles under ``folder``; yields index rows as frames are closed."""

    def __init__(self, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES):
        self.fs, self.path = fs.FileSystem.from_uri(folder)
        self.frame_bytes, self.bundle_bytes = frame_bytes, bundle_bytes
        self.zstd, self.out = zstandard.ZstdCompressor(level=3, write_content_size=True), None
        self.buffer, self.rows, self.filled = [], [], 0

    def add(self, key, data: bytes) -> list[tuple]:
        done = self.close_frame() if self.filled and self.filled + len(data) > self.frame_bytes else []
        self.rows.append((key, self.filled, len(data)))
        self.buffer.append(data)
        self.filled += len(data)
        return done

    def close_frame(self) -> list[tuple]:
        if not self.filled:
            return []
        if self.out is None:
            self.name, self.sizes, self.total = f"bundle-{uuid.uuid4().hex}.warc.zst", [], 0
            self.out = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None)
        packed = self.zstd.compress(b"".join(self.buffer))
        self.out.write(packed)
        done = [(key, self.name, len(self.sizes), at, n) for key, at, n in self.rows]
        self.sizes.append((len(packed), self.filled))
        self.total += self.filled
        self.buffer, self.rows, self.filled = [], [], 0
        if self.total >= self.bundle_bytes:
            self.close_bundle()
        return done

    def close_bundle(self) -> None:
        if self.out is not None:
            self.out.write(seek_table(self.sizes))
            self.out.close()
            self.out = None


INDEX = "page_id long, bundle string, frame int, offset int, length int"


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html", min_revisit: int = 0,
          date: str = "1970-01-01T00:00:00Z", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write a record per row to bundles in ``folder``; the index is stored beside them and returned."""
    spark = pages.sparkSession
    data = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), data.alias("payload"),
                        F.sha1(data).alias("digest"))
    firsts = rows.groupBy("digest").agg(F.min("page_id").alias("first"))
    told = rows.join(firsts, "digest", "left").select(
        "page_id", "url", "payload",
        F.when(F.col("first").eqNullSafe(F.col("page_id")) | (F.octet_length("payload") < min_revisit), None).otherwise(F.col("first")).alias("first"))
    target = f"{folder.rstrip('/')}/bundles"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(target)
    path.getFileSystem(conf).mkdirs(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(target, frame_bytes, bundle_bytes)

        def index(done: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)],
                                              ["page_id", "bundle", "frame", "offset", "length"])

        for b in batches:
            done = []
            for key, link, body, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                done += writer.add(key, record(key, link, body, first, date))
            if done:
                yield index(done)
        done = writer.close_frame()
        writer.close_bundle()
        if done:
            yield index(done)

    told.mapInArrow(run, INDEX).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/index")
    return spark.read.schema(INDEX).parquet(f"{folder.rstrip('/')}/index")


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(spark: SparkSession, folder: str, payload: bool = True, frames_per_task: int = 32) -> DataFrame:
    """Every record of the indexed bundles, frame by frame (``payload``: with the payload bytes)."""
    index = spark.read.schema(INDEX).parquet(f"{folder.rstrip('/')}/index")
    frames = index.groupBy("bundle", "frame").agg(F.count(F.lit(1)).alias("records"))
    n = max(1, -(-frames.count() // frames_per_task))
    # an explicit number of partitions: frames are few rows, but much to read
    spread = frames.repartition(n, "bundle", F.floor(F.col("frame") / frames_per_task)).sortWithinPartitions("bundle", "frame")
    target = f"{folder.rstrip('/')}/bundles"
    schema = RECORD + (", payload binary" if payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][:len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(target)
        unzip = zstandard.ZstdDecompressor()
        opened, f, table = None, None, []
        for b in batches:
            for bundle, frame, count in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if bundle != opened:
                    f = store.open_input_file(f"{path}/{bundle}")
                    opened, table = bundle, read_seek_table(f)
                at, size = table[frame]
                f.seek(at)
                rows = [parsed(h, block) for _, _, h, block in records(unzip.decompress(f.read(size)))]
                if len(rows) != count:
                    raise ValueError(f"frame {frame} of {bundle} holds {len(rows)} records, the index {count}")
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in zip(names, kinds)], names)

    return spread.mapInArrow(run, schema)


def lookup(spark: SparkSession, folder: str, ids: DataFrame, page_id: str = "page_id") -> DataFrame:
    """The records of the given ids: one frame is read for each, at the offset the index names."""
    wanted = ids.select(F.col(page_id).cast("long").alias("page_id")).distinct()
    index = spark.read.schema(INDEX).parquet(f"{folder.rstrip('/')}/index").join(wanted, "page_id", "left_semi")
    target = f"{folder.rstrip('/')}/bundles"
    names = [x.split()[0] for x in (RECORD + ", payload binary").split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(target)
        unzip = zstandard.ZstdDecompressor()
        for b in batches:
            for bundle, frame, at, n in zip(*(b.column(i).to_pylist() for i in range(1, 5))):
                with store.open_input_file(f"{path}/{bundle}") as f:
                    start, size = read_seek_table(f)[frame]
                    f.seek(start)
                    data = unzip.decompress(f.read(size))[at: at + n]
                _, _, headers, block = next(records(data))
                row = parsed(headers, block)
                yield pa.RecordBatch.from_arrays([pa.array([row[c]], k) for c, k in zip(names, kinds)], names)

    return index.mapInArrow(run, RECORD + ", payload binary")


def orphans(spark: SparkSession, folder: str) -> list[str]:
    """Bundles of attempts that were not committed (names only; the caller decides)."""
    named = {r[0] for r in spark.read.schema(INDEX).parquet(f"{folder.rstrip('/')}/index").select("bundle").distinct().collect()}
    store, path = fs.FileSystem.from_uri(f"{folder.rstrip('/')}/bundles")
    return sorted(i.base_name for i in store.get_file_info(fs.FileSelector(path)) if i.base_name not in named)
