"""Seekable Zstandard bundles of WARC records.

Records are grouped into independent Zstandard frames of about ``FRAME_BYTES``, so that small and
similar pages share their compression; a longer record makes its frame as long as it is.  A bundle
ends with the public seek table: a skippable frame with the compressed and the uncompressed size of
every frame and a footer, so a reader that knows a record's frame, or only the seek table,
decompresses nothing else.  The manifest maps record identifiers to bundle, frame, the frame's
place in the bundle and the record's offset inside the frame.

Of records with equal payloads the response is the one with the largest identifier; others
become revisits that refer to it.  Payloads are compared by length and SHA-1 in a grouping
that Spark combines before the shuffle.  Bundle names carry the task attempt, and only bundles
that the committed manifest names are read, so what a lost or repeated task leaves is ignored.
"""

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_bytes, shuffle_partitions, slices

LEVEL = 3
BUNDLE_BYTES = 32 << 20
FRAME_BYTES = 256 << 10
BATCH_BYTES = 8 << 20
LEAST_PAYLOAD = 1000

# Fixed values of the seekable format and of the revisit profile.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = (
    "page_id long, url string, bundle string, frame int, frame_offset long, offset long, n_bytes long"
)
RECORDS = (
    "bundle string, frame int, offset long, page_id long, record_type string, refers_to long, "
    "payload_digest string, payload_bytes long, payload binary"
)


def sha1_hex(payload: bytes) -> str:
    return hashlib.sha1(payload).hexdigest()


def _number(value: str | None) -> int | None:
    return None if value in (None, "-") else int(value)


def record_bytes(page_id, url, kind, refers_to, digest, length, payload: bytes) -> bytes:
    """One WARC/1.1 record; a revisit has no block but names digest and length of the payload."""
    block = payload if kind == "response" else b""
    mark = base64.b32encode(bytes.fromhex(digest)).decode()
    target = "".join(c if c.isprintable() and c != " " else f"%{ord(c):02X}" for c in url or "about:blank")
    name = "-" if page_id is None else page_id
    seed = f"{name}|{target}|{digest}"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, seed)}>",
        "WARC-Date: 1970-01-01T00:00:00Z",  # pages carry no time
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{mark}",
        f"X-Page-ID: {name}",
        f"X-Payload-Length: {length}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record_at(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Fields and block of the record that begins at ``at``, and where it ends."""
    body = data.find(b"\r\n\r\n", at) + 4
    lines = data[at : max(body - 4, at)].decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    end = body + int(fields.get("Content-Length", -1))
    if not lines[0].startswith("WARC/") or end < body or data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return fields, data[body:end], end + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", c, d) for c, d in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def read_seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of every frame, read from the end of the bundle."""
    count, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    frames, offset = [], 0
    for c, d in struct.iter_unpack("<II", bundle[-9 - 8 * count : -9]):
        frames.append((offset, c, d))
        offset += c
    return frames


def read_frame(bundle: bytes, frame: tuple[int, int, int]) -> bytes:
    offset, packed, size = frame
    return zstandard.ZstdDecompressor().decompress(
        bundle[offset : offset + packed], max_output_size=size
    )


class _Bundle:
    """Collects records in frames and writes them with the seek table as one file."""

    def __init__(self, folder: str, name: str, frame_bytes: int):
        self.store, self.path = fs.FileSystem.from_uri(folder)
        self.name, self.number, self.packer = name, 0, zstandard.ZstdCompressor(level=LEVEL)
        self.frame_bytes = frame_bytes
        self._clear()

    def _clear(self):
        self.parts, self.sizes, self.rows, self.held = [], [], [], 0
        self.open, self.filled = [], 0

    def add(self, page_id, url, record: bytes):
        self.rows.append((page_id, url, len(self.sizes), self.held, self.filled, len(record)))
        self.open.append(record)
        self.filled += len(record)
        if self.filled >= self.frame_bytes:
            self._end_frame()

    def _end_frame(self):
        if self.open:
            frame = self.packer.compress(b"".join(self.open))
            self.parts.append(frame)
            self.sizes.append((len(frame), self.filled))
            self.held += len(frame)
            self.open, self.filled = [], 0

    def close(self) -> Iterator[pa.RecordBatch]:
        self._end_frame()
        if not self.parts:
            return
        name = f"{self.name}-{self.number:05d}.warc.zst"
        with self.store.open_output_stream(f"{self.path}/{name}", compression=None) as out:
            for part in self.parts:
                out.write(part)
            out.write(seek_table(self.sizes))
        ids, urls, frames, places, offsets, sizes = map(list, zip(*self.rows))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(urls, pa.string()),
                pa.array([name] * len(ids), pa.string()),
                pa.array(frames, pa.int32()),
                pa.array(places, pa.int64()),
                pa.array(offsets, pa.int64()),
                pa.array(sizes, pa.int64()),
            ],
            ["page_id", "url", "bundle", "frame", "frame_offset", "offset", "n_bytes"],
        )
        self.number += 1
        self._clear()


def _writer(folder: str, bundle_bytes: int, frame_bytes: int):
    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        bundle = _Bundle(folder, f"part-{task.partitionId():06d}-{task.taskAttemptId()}", frame_bytes)
        for batch in slices(batches, "html", BATCH_BYTES):
            payloads = raw_bytes(batch.column("html"))
            columns = ("page_id", "url", "record_type", "refers_to", "digest", "n_bytes")
            rows = zip(*(batch.column(c).to_pylist() for c in columns), payloads)
            for page_id, url, kind, refers_to, digest, length, payload in rows:
                record = record_bytes(page_id, url, kind, refers_to, digest, length, payload)
                bundle.add(page_id, url, record)
                if bundle.held >= bundle_bytes:
                    yield from bundle.close()
        yield from bundle.close()

    return run


def _pages(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("n_bytes"),
        F.sha1(html.cast("binary")).alias("digest"),
    )


def record_kinds(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Pages with record_type and refers_to; only digests are shuffled.

    A page without page_id is a response, and revisits cannot refer to it.  Repeated page_ids
    with equal payloads: one row, any of them as they are equal, would be the response for
    all, so each of them is a response.
    """
    rows = _pages(pages)
    content = F.concat_ws(":", "digest", "n_bytes").alias("content")
    newest = (
        rows.where((F.col("n_bytes") >= least) & F.col("page_id").isNotNull())
        .groupBy("digest", "n_bytes")
        .agg(F.max("page_id").alias("newest"), F.min("page_id").alias("oldest"))
        .where(F.col("oldest") < F.col("newest"))
        # A key of its own makes both sides of the join come from a shuffle, so that a hot
        # payload can be split.
        .select(content, "newest")
    )
    older = F.col("page_id") < F.col("newest")
    return rows.select("*", content).join(newest, "content", "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        "n_bytes",
        F.when(older, "revisit").otherwise("response").alias("record_type"),
        F.when(older, F.col("newest")).alias("refers_to"),
    )


def write_bundles(
    pages: DataFrame, folder: str, bundle_bytes: int = BUNDLE_BYTES, frame_bytes: int = FRAME_BYTES
) -> DataFrame:
    """Write bundles under ``folder`` (a URI that all executors reach) and store the manifest.

    Returns the manifest as read back from ``folder/_manifest``.  No page gives no bundle.  A page
    of any length is one record in one frame, so it must fit a task's memory some five times.
    """
    spark = pages.sparkSession
    manifest = record_kinds(pages).mapInArrow(_writer(folder, bundle_bytes, frame_bytes), MANIFEST)
    manifest.write.parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def _reader(folder: str):
    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("bundle").to_pylist():
                with store.open_input_file(f"{root}/{name}") as file:
                    yield from _records(name, file.read())

    return run


def _records(name: str, bundle: bytes) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for number, frame in enumerate(read_seek_table(bundle)):
        data, at = read_frame(bundle, frame), 0
        while at < len(data):
            offset = at
            fields, block, at = record_at(data, at)
            kind = fields["WARC-Type"]
            digest = base64.b32decode(fields["WARC-Payload-Digest"].split(":", 1)[1]).hex()
            length = int(fields["X-Payload-Length"])
            if kind == "response" and (sha1_hex(block) != digest or len(block) != length):
                raise ValueError(f"payload at {offset} of frame {number} in {name} is damaged")
            page, refers = _number(fields["X-Page-ID"]), _number(fields.get("X-Refers-To-Page-ID"))
            rows.append((name, number, offset, page, kind, refers, digest, length, block))
            held += len(block)
            if held >= BATCH_BYTES:
                yield _record_batch(rows)
                rows, held = [], 0
    if rows:
        yield _record_batch(rows)


def _record_batch(rows):
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    kinds += [pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_bundles(manifest: DataFrame, folder: str) -> DataFrame:
    """All records of the bundles that the manifest names; payload digests are checked."""
    # One row per bundle, a few bytes each.  Dealt by a hash of the name: by the name itself, which
    # distinct() has dealt them by already, Spark would leave the repartition out and merge all tasks.
    names = manifest.select("bundle").distinct()
    names = names.repartition(shuffle_partitions(manifest.sparkSession), F.xxhash64("bundle"))
    return names.mapInArrow(_reader(folder), RECORDS)


def read_record(folder: str, bundle: str, frame_offset: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its manifest entry; of the bundle only the record's frame is decompressed."""
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{root}/{bundle}") as file:
        file.seek(frame_offset)
        reader = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=False)
        return record_at(reader.read(), offset)[:2]


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages as bundles and return what the archives say about each page."""
    manifest = write_bundles(pages, folder)
    return read_bundles(manifest, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
