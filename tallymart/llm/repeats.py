"""Which hash keys occur twice in the whole corpus, asked without shuffling rows per key.

Documents are stored once in chunks of a few megabytes.  A chunk sorts its keys, drops
repeats and sends them in ranges ("buckets") as delta-coded byte planes; a bucket compares the
chunks' lists and answers each with one bit per key, which the chunk can place because it
computes the same sorted list again.  A key that very many documents share is one entry per
chunk at most.
"""

from collections.abc import Callable, Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .common import documents, raw_bytes, shuffle_partitions, slices

CHUNKS = "chunk long, ids array<long>, sizes array<long>, blob binary"
KEYS = "bucket int, chunk long, n long, packed binary"
ANSWERS = "chunk long, bucket int, n long, bits binary"
KEYS_PER_BUCKET = 1 << 20
REMOVED = "array<struct<begin:long,end:long>>"
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


# Chunks of documents.


def _chunked(chunk_bytes: int):
    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        packer = zstandard.ZstdCompressor(level=3)
        ids, texts, held = [], [], 0

        def row():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                    pa.array([packer.compress(b"".join(texts))], pa.binary()),
                ],
                ["chunk", "ids", "sizes", "blob"],
            )

        for batch in slices(batches, "text", chunk_bytes):
            for doc, text in zip(batch.column("doc_id").to_pylist(), raw_bytes(batch.column("text"))):
                ids.append(doc)
                texts.append(text)
                held += len(text)
                if held >= chunk_bytes:
                    yield row()
                    number += 1
                    ids, texts, held = [], [], 0
        if ids:
            yield row()

    return run


def stored_chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """The documents as stored rows of about ``chunk_bytes``; one long text is a chunk of its own."""
    return pin(documents(docs).mapInArrow(_chunked(chunk_bytes), CHUNKS), "chunks")


def chunk_rows(batches) -> Iterator[dict]:
    """Rows of a chunk table, one at a time, with the texts' bytes as ``data``."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k].as_py() for name in batch.schema.names if name != "blob"}
            row["data"] = zstandard.ZstdDecompressor().decompress(batch.column("blob")[k].as_py())
            yield row


def total_bytes(chunks: DataFrame) -> int:
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)
    return chunks.agg(F.sum(size)).first()[0] or 0


def bucket_count(chunks: DataFrame, keys: int) -> int:
    return max(2 * shuffle_partitions(chunks.sparkSession), ceil(keys / KEYS_PER_BUCKET))


def filter_width(keys: int) -> int:
    """Bits of a key that only filters: one other key in about 2 to the 10 looks the same."""
    return max(33, min(62, ceil(log2(max(keys, 2))) + 10))


# Sorted key lists.


def sorted_keys(keys: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order; flag 1 is added to keys that occur twice, other flags are or-ed."""
    order = np.argsort(keys, kind="stable")
    keys, flags = keys[order], flags[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else order
    times = np.diff(np.append(first, len(keys)))
    flags = np.bitwise_or.reduceat(flags, first) if len(keys) else flags
    return keys[first], flags | (times > 1).astype(np.uint8)


def bucket_bounds(keys: np.ndarray, width: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers that occur and where each begins and ends in the sorted keys."""
    top = (keys >> np.uint64(width - 32)) * np.uint64(buckets) >> np.uint64(32)
    edges = np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1]))) if len(keys) else np.zeros(0, int)
    return top[edges].astype(np.int32), np.append(edges, len(keys))


def pack_list(keys: np.ndarray, flags: np.ndarray) -> bytes:
    """Delta-coded keys as byte planes, and the flags, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0))
    planes = [p for p in steps.astype("<u8").view(np.uint8).reshape(-1, 8).T]
    while len(planes) > 1 and not planes[-1].any():
        planes.pop()
    body = b"".join(p.tobytes() for p in planes) + flags.tobytes()
    return bytes([len(planes)]) + zstandard.ZstdCompressor(level=1).compress(body)


def unpack_list(packed: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), np.uint8)
    planes = np.zeros((8, n), np.uint8)
    planes[: packed[0]] = body[: packed[0] * n].reshape(packed[0], n)
    keys = np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)
    return keys, body[packed[0] * n :]


def key_batch(chunk: int, keys: np.ndarray, flags: np.ndarray, width: int, buckets: int) -> pa.RecordBatch:
    numbers, bounds = bucket_bounds(keys, width, buckets)
    parts = [slice(a, b) for a, b in zip(bounds[:-1], bounds[1:])]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(numbers, pa.int32()),
            pa.array([chunk] * len(parts), pa.int64()),
            pa.array([p.stop - p.start for p in parts], pa.int64()),
            pa.array([pack_list(keys[p], flags[p]) for p in parts], pa.binary()),
        ],
        ["bucket", "chunk", "n", "packed"],
    )


def answer(table: pa.Table, decide: Callable, merge: Callable = np.bitwise_or.reduceat) -> pa.Table:
    """Bits for every list of a bucket: ``decide(owners, flags)`` says which keys are marked.

    ``owners`` is the number of chunks that hold the key; ``merge`` makes one value of a key's flags.
    """
    sizes = table.column("n").to_pylist()
    lists = [unpack_list(p, n) for p, n in zip(table.column("packed").to_pylist(), sizes)]
    keys = np.concatenate([k for k, _ in lists])
    flags = np.concatenate([f for _, f in lists])
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
    owners = np.diff(np.append(first, len(keys)))
    marks = decide(owners, merge(flags[order], first)).astype(np.uint8)
    marked = np.empty(len(keys), np.uint8)
    marked[order] = np.repeat(marks, owners)
    ends = np.cumsum(sizes)
    bits = [
        zstandard.ZstdCompressor(level=1).compress(
            np.packbits((marked[b - n : b, None] >> np.arange(2, dtype=np.uint8)) & 1).tobytes()
        )
        for b, n in zip(ends, sizes)
    ]
    return pa.table(
        {
            "chunk": table.column("chunk").cast(pa.int64()),
            "bucket": table.column("bucket").cast(pa.int32()),
            "n": pa.array(sizes, pa.int64()),
            "bits": pa.array(bits, pa.binary()),
        }
    )


def answers(
    keys: DataFrame, decide: Callable, name: str, merge: Callable = np.bitwise_or.reduceat
) -> DataFrame:
    """One row per chunk: the marks of all its keys, as a list by bucket."""

    def run(table: pa.Table) -> pa.Table:
        return answer(table, decide, merge)

    said = keys.groupBy("bucket").applyInArrow(run, ANSWERS)
    return said.groupBy(F.col("chunk").alias(f"{name}_chunk")).agg(
        F.sort_array(F.collect_list(F.struct("bucket", "n", "bits"))).alias(name)
    )


def with_answers(chunks: DataFrame, said: DataFrame, name: str) -> DataFrame:
    return chunks.join(said, F.col("chunk") == F.col(f"{name}_chunk"), "left").drop(f"{name}_chunk")


def marks_of(said: list[dict] | None) -> np.ndarray:
    """The marks, 0 to 3, of a chunk's sorted keys."""
    if not said:
        return np.zeros(0, np.uint8)
    parts = []
    for part in said:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(part["bits"]), np.uint8)
        bits = np.unpackbits(raw, count=2 * part["n"]).reshape(-1, 2)
        parts.append(bits[:, 0] + 2 * bits[:, 1])
    return np.concatenate(parts)


def marks_at(keys: np.ndarray, distinct: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The mark of each key, given the marks of the sorted distinct keys."""
    if not len(distinct):
        return np.zeros(len(keys), np.uint8)
    return marks[np.searchsorted(distinct, keys)]


# What is left.


def removed_spans(keep: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """For every document of a chunk its runs (begin, end) of places that are not kept."""
    edge = np.zeros(len(keep) + 1, bool)
    edge[begins] = edge[ends] = True
    gone = np.concatenate(([False], ~keep, [False]))
    first = np.flatnonzero(gone[1:-1] & (~gone[:-2] | edge[:-1]))
    last = np.flatnonzero(gone[1:-1] & (~gone[2:] | edge[1:])) + 1
    doc = np.searchsorted(ends, first, "right")
    offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(ends)))))
    runs = pa.StructArray.from_arrays(
        [pa.array(first - begins[doc], pa.int64()), pa.array(last - begins[doc], pa.int64())], ["begin", "end"]
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs)
