"""Substring dedup by fixed-block anchors, on words.

A repeated window of ``window`` words holds at least one of the blocks of
``(window + 1) // 2`` words into which its document is cut from the start.  So the blocks of all
documents are the index, and every rolling window of a block's length probes it: a probe that
meets a block beside the block's own place is a hit.  Around hits, and only there, whole windows
are compared across the corpus by wide hashes; their union is the maximal exact repeats.

Blocks, probes and windows travel as sorted key lists (see ``repeats``), never as rows.  Window
keys have 62 bits: with n windows around hits, n^2 / 2^63 false matches are to be expected, one in
a thousand corpora of 10^8 such windows; at 10^13 a single window errs with a chance of 2 in 10^6.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES
from .repeats import (
    KEYS,
    REMOVED,
    answers,
    bucket_count,
    chunk_rows,
    filter_width,
    key_batch,
    marks_at,
    marks_of,
    mixed,
    removed_spans,
    sorted_keys,
    stored_chunks,
    total_bytes,
    with_answers,
)

WINDOW = 35
CHUNK_BYTES = 4 << 20
WIDE = 62
BASE = 0x9E3779B97F4A7C15
RESULT = f"doc_id long, n_words long, n_removed long, kept string, spans {REMOVED}"

#: A number per byte value, by which words of few letters differ in all bits.
LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
IS_SPACE = np.isin(np.arange(256), np.frombuffer(SPACES, np.uint8))
#: Sums modulo 2^64 cannot tell certain very long strings apart; longer words are hashed one by one.
LONG_WORD = 256


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, np.uint64)
        held[0] = 1
        held = _powers[base] = np.cumprod(held, dtype=np.uint64)
    return held[:n]


def rolling(marks: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, by prefix sums of a polynomial modulo 2^64."""
    n = len(marks) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(marks * powers(BASE, len(marks)), dtype=np.uint64)))
    inverse = pow(BASE, -1, 1 << 64)
    return mixed((sums[size:] - sums[:-size]) * powers(inverse, n))


def runs_of_letters(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; words end with their text."""
    space = IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[0] = edge[np.cumsum(sizes)] = True
    begins = np.flatnonzero(~space & (edge[:-1] | np.concatenate(([True], space[:-1]))))
    ends = np.flatnonzero(~space & (edge[1:] | np.concatenate((space[1:], [True])))) + 1
    return begins, ends


def word_marks(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, by prefix sums of a polynomial over their bytes modulo 2^64."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(LETTERS[data] * powers(BASE, len(data)), out=sums[1:])
    inverse = powers(pow(BASE, -1, 1 << 64), len(data))
    marks = mixed((sums[ends] - sums[begins]) * inverse[begins] + (ends - begins).astype(np.uint64))
    for k in np.flatnonzero(ends - begins > LONG_WORD):
        marks[k] = xxhash.xxh3_64_intdigest(data[begins[k] : ends[k]].tobytes())
    return marks


class Words:
    """The words of a chunk in one row, as places in its bytes, with the documents' bounds."""

    def __init__(self, row: dict):
        self.ids, sizes = row["ids"], np.array(row["sizes"], np.int64)
        self.data = np.frombuffer(row["data"], np.uint8)
        self.byte_ends = np.cumsum(sizes)
        self.first, self.last = runs_of_letters(self.data, sizes)
        self.n = len(self.first)
        self.ends = np.searchsorted(self.first, self.byte_ends)
        self.begins = np.concatenate(([0], self.ends[:-1])).astype(np.int64)
        counts = self.ends - self.begins
        self.marks = word_marks(self.data, self.first, self.last)
        self.place = np.arange(self.n) - np.repeat(self.begins, counts)
        self.rest = np.repeat(self.ends, counts) - np.arange(self.n)

    def kept_texts(self, keep: np.ndarray) -> pa.Array:
        """For every document its kept words, joined by single spaces."""
        kept = np.flatnonzero(keep)
        doc = np.searchsorted(self.ends, kept, "right")
        # A word takes the space after it along, unless it is the last that its document keeps.
        more = np.concatenate((doc[1:] == doc[:-1], [False])) if len(kept) else np.zeros(0, bool)
        change = np.zeros(len(self.data) + 2, np.int8)
        change[self.first[kept]] += 1
        np.add.at(change, self.last[kept] + more, -1)
        taken = np.cumsum(change[: len(self.data)], dtype=np.int8) > 0
        text = np.where(IS_SPACE[self.data[taken]], np.uint8(32), self.data[taken])
        sums = np.concatenate(([0], np.cumsum(taken)))
        offsets = np.concatenate(([0], sums[self.byte_ends])).astype(np.int64)
        found = pa.Array.from_buffers(
            pa.large_string(), len(self.byte_ends), [None, pa.py_buffer(offsets), pa.py_buffer(text)]
        )
        return found.cast(pa.string())

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of all runs of ``size`` words inside a document."""
        hashes = rolling(self.marks, size)
        inside = np.flatnonzero(self.rest[: len(hashes)] >= size)
        return inside, hashes[inside]


class Probes:
    """A chunk's probes, and after the answer its candidate windows."""

    def __init__(self, words: Words, window: int, width: int):
        self.words, self.window, self.block = words, window, (window + 1) // 2
        self.at, hashes = words.windows(self.block)
        self.keys = hashes >> np.uint64(64 - width)
        anchors = (words.place[self.at] % self.block == 0).astype(np.uint8) * 2
        self.distinct, self.flags = sorted_keys(self.keys, anchors)

    def candidates(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts and keys of the windows around hits, and the distinct keys with flags."""
        hit = np.zeros(self.words.n + 1, np.int64)
        hit[self.at[marks_at(self.keys, self.distinct, marks) > 0]] = 1
        sums = np.concatenate(([0], np.cumsum(hit)))
        at, hashes = self.words.windows(self.window)
        near = sums[at + self.window - self.block + 1] > sums[at]
        at, keys = at[near], hashes[near] >> np.uint64(64 - WIDE)
        return at, keys, *sorted_keys(keys, np.zeros(len(keys), np.uint8))


def _emit_probes(window: int, width: int, buckets: int):
    def run(batches):
        for row in chunk_rows(batches):
            probes = Probes(Words(row), window, width)
            yield key_batch(row["chunk"], probes.distinct, probes.flags, width, buckets)

    return run


def _emit_windows(window: int, width: int, buckets: int):
    def run(batches):
        for row in chunk_rows(batches):
            found = Probes(Words(row), window, width).candidates(marks_of(row["probes"]))
            yield key_batch(row["chunk"], found[2], found[3], WIDE, buckets)

    return run


def _remove(window: int, width: int):
    def run(batches):
        for row in chunk_rows(batches):
            words = Words(row)
            at, keys, distinct, _ = Probes(words, window, width).candidates(marks_of(row["probes"]))
            repeated = at[marks_at(keys, distinct, marks_of(row["windows"])) > 0]
            change = np.zeros(words.n + 1, np.int64)
            np.add.at(change, repeated, 1)
            np.add.at(change, repeated + window, -1)
            keep = np.cumsum(change)[:-1] == 0
            gone = np.concatenate(([0], np.cumsum(~keep)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(words.ids, pa.int64()),
                    pa.array(words.ends - words.begins, pa.int64()),
                    pa.array(gone[words.ends] - gone[words.begins], pa.int64()),
                    words.kept_texts(keep),
                    removed_spans(keep, words.begins, words.ends),
                ],
                ["doc_id", "n_words", "n_removed", "kept", "spans"],
            )

    return run


def _indexed(owners: np.ndarray, flags: np.ndarray) -> np.ndarray:
    return ((owners > 1) | (flags & 1 > 0)) & (flags & 2 > 0)


def _repeated(owners: np.ndarray, flags: np.ndarray) -> np.ndarray:
    return (owners > 1) | (flags & 1 > 0)


def substring_texts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept, spans for every row of (doc_id, text).

    ``kept`` is the words that stay, joined by single spaces; ``spans`` lists the removed runs by
    word number (begin, end exclusive).

    Every word covered by a window whose words also start anywhere else is removed; all copies
    go, the first as well.  A null, empty or blank text has no words, and a text of fewer words
    than a window keeps all.  Repeated rows count as further copies.  An empty table gives
    no row.  A chunk, and so the longest text, must fit a task's memory about fifty times.
    """
    chunks = stored_chunks(docs, CHUNK_BYTES)
    size = total_bytes(chunks) // 4
    width, buckets = filter_width(size), bucket_count(chunks, size)
    ask: Callable = _emit_probes(window, width, buckets)
    probed = answers(chunks.select("chunk", "ids", "sizes", "blob").mapInArrow(ask, KEYS), _indexed, "probes")
    near = with_answers(chunks, probed, "probes")
    found = answers(near.mapInArrow(_emit_windows(window, width, buckets), KEYS), _repeated, "windows")
    return with_answers(near, found, "windows").mapInArrow(_remove(window, width), RESULT)


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: ``substring_texts`` with a digest for the text."""
    return substring_texts(docs, window).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
