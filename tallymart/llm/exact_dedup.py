"""Exact dedup with Patricia tries that own the smallest identifiers.

Texts are equal if they are identical after white space ``[\\x20\\x09-\\x0D]`` is deleted.
Each task first inserts its own texts into tries, so a text leaves a task once for
every ``LOCAL_BYTES`` of new text at most however many copies it has; the rest is dealt
by (length, content hash) and inserted again.  Terminal nodes hold the owner and the
number of rows.  Rows arrive ordered by length and hash, so a trie whose texts exceed
``TRIE_BYTES`` is emitted at the next change of hash and dropped: no later row can
belong to it.
"""

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, documents, keyed_documents, raw_bytes, slices

LOCAL_BYTES = 16 << 20
TRIE_BYTES = 32 << 20
BATCH_BYTES = 8 << 20
OWNER_ROWS = 4096

KEYS = "doc_id long, n_bytes long, text_sha256 string"
ENTRIES = "n_bytes long, content_hash long, body binary, points long, owner long, copies long, row_key long"
OWNERS = "n_bytes long, text_sha256 string, keep_id long, group_size long, keep_row long"


class PatriciaTrie:
    """A radix trie over byte strings; edges carry runs of bytes, terminals carry a payload."""

    __slots__ = ("root", "held")

    def __init__(self):
        self.root = [b"", {}, None]  # label, children by first byte, payload
        self.held = 0

    def terminal(self, key: bytes) -> list:
        """The payload list of ``key``, empty if the key is new."""
        node, at = self.root, 0
        while at < len(key):
            child = node[1].get(key[at])
            if child is None:
                leaf = [key[at:], {}, []]
                node[1][key[at]] = leaf
                self.held += len(key) - at
                return leaf[2]
            label = child[0]
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            shared = len(os.path.commonprefix([label, key[at : at + len(label)]]))
            middle = [label[:shared], {label[shared]: child}, None]
            child[0] = label[shared:]
            node[1][key[at]] = middle
            node, at = middle, at + shared
        if node[2] is None:
            node[2] = []
        return node[2]

    def items(self) -> Iterator[tuple[bytes, list]]:
        """Keys with a payload; a stack of its own, as depth may exceed Python's."""
        stack = [(b"", self.root)]
        while stack:
            head, node = stack.pop()
            key = head + node[0]
            if node[2]:
                yield key, node[2]
            stack.extend((key, child) for child in node[1].values())


def _better(points: int, doc, row, payload: list) -> bool:
    """A row with an id before one without, more code points, the smaller id, the smaller row key."""
    if (doc is None) != (payload[1] is None):
        return payload[1] is None
    if points != payload[0]:
        return points > payload[0]
    if doc != payload[1]:
        return doc < payload[1]
    return row is not None and row < payload[3]


def _add(trie: PatriciaTrie, body: bytes, points: int, doc, copies: int, row) -> None:
    payload = trie.terminal(body)
    if not payload:
        payload[:] = [points, doc, copies, row]
        return
    if _better(points, doc, row, payload):
        payload[0], payload[1], payload[3] = points, doc, row
    payload[2] += copies


def content_hash(body: bytes) -> int:
    return xxhash.xxh3_64_intdigest(body) - (1 << 63)


def _digests(batches):
    for batch in slices(batches, "text", BATCH_BYTES):
        bodies = [b.translate(None, SPACES) for b in raw_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(map(len, bodies), pa.int64()),
                pa.array([hashlib.sha256(b).hexdigest() for b in bodies], pa.string()),
            ],
            ["doc_id", "n_bytes", "text_sha256"],
        )


def _entries(tries: dict) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for (n_bytes, mark), trie in tries.items():
        for body, (points, owner, copies, row) in trie.items():
            rows.append((n_bytes, mark, body, points, owner, copies, row))
            size += n_bytes
            if size >= BATCH_BYTES:
                yield _entry_batch(rows)
                rows, size = [], 0
    if rows:
        yield _entry_batch(rows)


def _entry_batch(rows):
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["n_bytes", "content_hash", "body", "points", "owner", "copies", "row_key"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
    )


def _local(batches):
    tries, held = {}, 0
    for batch in slices(batches, "text", BATCH_BYTES):
        points = pc.utf8_length(batch.column("text")).to_pylist()
        ids = batch.column("doc_id").to_pylist()
        keys = batch.column("row_key").to_pylist()
        for doc, n, row, raw in zip(ids, points, keys, raw_bytes(batch.column("text"))):
            body = raw.translate(None, SPACES)
            part = (len(body), content_hash(body))
            trie = tries.get(part)
            if trie is None:
                trie = tries[part] = PatriciaTrie()
            before = trie.held
            _add(trie, body, n or 0, doc, 1, row)
            held += trie.held - before
        if held >= LOCAL_BYTES:
            yield from _entries(tries)
            tries, held = {}, 0
    yield from _entries(tries)


def _owner_batch(rows):
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        ["n_bytes", "text_sha256", "keep_id", "group_size", "keep_row"],
    )


def _merge(batches):
    trie, last, done = PatriciaTrie(), None, []

    def spill():
        done.extend(
            (len(b), hashlib.sha256(b).hexdigest(), p[1], p[2], p[3]) for b, p in trie.items()
        )

    for batch in slices(batches, "body", BATCH_BYTES):
        columns = [c.to_pylist() for c in batch.columns]
        for n_bytes, mark, body, points, owner, copies, row in zip(*columns):
            if last is not None and (n_bytes, mark) != last:
                if n_bytes != last[0] or trie.held >= TRIE_BYTES:
                    spill()
                    trie = PatriciaTrie()
            last = (n_bytes, mark)
            _add(trie, body, points, owner, copies, row)
        if len(done) >= OWNER_ROWS:
            yield _owner_batch(done)
            done.clear()
    spill()
    if done:
        yield _owner_batch(done)


def text_owners(docs: DataFrame, row: str | None = None) -> DataFrame:
    """One row per distinct normalised text: its owner and its number of rows.

    With ``row``, a column that is different in every row, keep_row names the one row that stays.
    """
    return (
        keyed_documents(docs, row)
        .mapInArrow(_local, ENTRIES)
        .repartition("n_bytes", "content_hash")
        .sortWithinPartitions("n_bytes", "content_hash")
        .mapInArrow(_merge, OWNERS)
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of (doc_id, text).

    A null text counts as empty; empty texts form one group.  Of equal texts the row with
    the most code points stays, then the smallest doc_id.  A row without doc_id stays only
    if no row of its text has one; its keep_id is then null.  Rows that repeat a doc_id and
    text share one answer and all count.  An empty table gives no row.
    """
    keys = documents(docs).mapInArrow(_digests, KEYS)
    return keys.join(text_owners(docs).drop("keep_row"), ["n_bytes", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
