"""Packing of token sequences by patterns and non-negative least squares.

A document's token ids, then id 0, are cut into pieces of at most ``capacity`` tokens.  Only
the histogram of the pieces' lengths, at most ``capacity`` numbers, reaches the driver.  There
patterns of up to three length classes that fill a sequence are enumerated and their repeat
counts fitted to the histogram by non-negative least squares; the counts are rounded down
and given exact lengths, and what is left is packed best-fit by length.  The resulting plan has a
row per pattern and length, whatever the number of documents.  Each piece gets a rank among
the pieces of its length, and finds its sequence and offset in the plan by that rank.  Ranks of
frequent lengths are counted in salted parts of about ``RANK_ROWS`` rows.
"""

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin
from .common import documents, raw_bytes, slices

CAPACITY = 2048
CLASS_WIDTH = 16
RANK_ROWS = 50_000
SHARES = (1.0, 0.9, 0.75, 0.5, 0.25, 0.1)  # of the fit that is kept, until little is lost
KNOWN_WORDS = 1_000_000
SHORT_WORD = 8
BATCH_BYTES = 4 << 20
JOINED = 256

PIECES = "doc_id long, piece int, start long, length long, ids binary"
PLAN = "length long, first long, last long, copies long, base long, place long"


# Tokens.


class WordTokenizer:
    """Ids of white-space separated words, remembered as bytes.

    Only for tokenizers that drop white space and never join words across it, such as word
    BPE; the ids of a text are then those of its words in order.  Words not met before are encoded
    many at a time, and each id goes to the word that its offset lies in.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: 16 bits where the vocabulary allows it: ids are stored and shuffled before they are widened.
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.known: dict[bytes, bytes] = {}

    def _encoded(self, words: list[bytes]) -> Iterator[bytes]:
        blocks = [[w.decode() for w in words[k : k + JOINED]] for k in range(0, len(words), JOINED)]
        width = np.dtype(self.kind).itemsize
        for k in range(0, len(blocks), JOINED):
            some = blocks[k : k + JOINED]
            coded = self.tokenizer.encode_batch([" ".join(b) for b in some], add_special_tokens=False)
            for block, found in zip(some, coded):
                starts = np.fromiter((at for at, _ in found.offsets), np.int64, len(found.ids))
                ends = np.searchsorted(starts, np.cumsum([len(w) + 1 for w in block])) * width
                ids, first = np.array(found.ids, self.kind).tobytes(), 0
                for end in ends.tolist():
                    yield ids[first:end]
                    first = end

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian ids of every text, of the kind that ``kind`` says."""
        words = [t.split() for t in texts]
        new = list({w for ws in words for w in ws if w not in self.known})
        if len(self.known) + len(new) > KNOWN_WORDS:
            # Short words are the frequent ones.
            self.known = {w: ids for w, ids in self.known.items() if len(w) <= SHORT_WORD}
            if len(self.known) > KNOWN_WORDS // 2:
                self.known = {}
            new = list({w for ws in words for w in ws if w not in self.known})
        self.known.update(zip(new, self._encoded(new)))
        return [b"".join(map(self.known.__getitem__, ws)) for ws in words]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _pieces(path: str, capacity: int):
    def run(batches):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        tokenizer = word_tokenizer(path)
        for batch in slices(batches, "text", BATCH_BYTES):
            rows = []
            coded = tokenizer.ids(raw_bytes(batch.column("text")))
            width = np.dtype(tokenizer.kind).itemsize
            for doc, ids in zip(batch.column("doc_id").to_pylist(), coded):
                ids += bytes(width)  # id 0
                for piece, begin in enumerate(range(0, len(ids) // width, capacity)):
                    part = ids[width * begin : width * (begin + capacity)]
                    rows.append((doc, piece, begin, len(part) // width, part))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    return run


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids of every piece; ids are little-endian, of 16 or 32 bits.

    :func:`widened` gives 32 bits in either case.
    """
    return documents(docs).mapInArrow(_pieces(path, capacity), PIECES)


def _widen(batches):
    for batch in batches:
        ids = batch.column("ids").cast(pa.large_binary())
        # offsets and values of the column, without an object per row
        _, ends, values = ids.buffers()
        ends = np.frombuffer(ends, np.int64)[ids.offset : ids.offset + len(ids) + 1]
        length = batch.column("length").to_numpy()
        narrow = (ends[-1] - ends[0]) < 4 * length.sum()
        kind = "<u2" if narrow else "<u4"
        wide = np.frombuffer(values, np.uint8)[ends[0] : ends[-1]].view(kind).astype("<u4")
        offsets = np.concatenate([[0], np.cumsum(4 * length)]).astype(np.int64)
        column = pa.Array.from_buffers(
            pa.large_binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(wide)]
        )
        at = batch.schema.get_field_index("ids")
        yield batch.set_column(at, "ids", column.cast(pa.binary()))


def widened(pieces: DataFrame) -> DataFrame:
    """The pieces with their ids in 32 bits."""
    return pieces.mapInArrow(_widen, pieces.schema)


# The plan.


def nnls(columns: np.ndarray, goal: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """min |W (A x - goal)| with x >= 0 by the active-set method.

    ``columns[j]`` has the row numbers of column j's ones, -1 for none; repeats add up.
    """
    rows, n = len(goal), len(columns)
    goal = goal * weight
    safe = np.where(columns < 0, rows, columns)

    def dense(chosen):
        a = np.zeros((rows + 1, len(chosen)))
        for k in range(columns.shape[1]):
            np.add.at(a, (safe[chosen, k], np.arange(len(chosen))), 1.0)
        return a[:rows] * weight[:, None]

    x, active = np.zeros(n), np.zeros(n, bool)
    rest, floor = goal.astype(float), 1e-9 * max(goal.max(initial=0), 1.0)
    for _ in range(3 * rows):
        gain = np.append(rest * weight, 0.0)[safe].sum(1)
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= floor:
            break
        active[best] = True
        while True:
            chosen = np.flatnonzero(active)
            a = dense(chosen)
            z = np.linalg.lstsq(a, goal, rcond=None)[0]
            low = z <= floor
            if not low.any():
                x[:] = 0
                x[chosen] = z
                break
            now = x[chosen]
            step = np.min(now[low] / np.maximum(now[low] - z[low], 1e-300))
            x[chosen] = now + step * (z - now)
            gone = low & (x[chosen] <= floor)
            if not gone.any():
                gone = low & (z == z.min())
            x[chosen[gone]] = 0
            active[chosen[gone]] = False
            if not active.any():
                break
        chosen = np.flatnonzero(active)
        rest = goal - dense(chosen) @ x[chosen]
        if not active[best] and gain[best] <= 10 * floor:
            break
    return x


def patterns(present: list[int], units: int) -> np.ndarray:
    """Up to three length classes that fill the units exactly, in falling order."""
    has, found = set(present), []
    for a in present:
        if a == units:
            found.append((a, -1, -1))
        for b in present:
            if b > a:
                break
            if a + b == units:
                found.append((a, b, -1))
            c = units - a - b
            if 0 < c <= b and c in has:
                found.append((a, b, c))
    return np.array(found, int).reshape(-1, 3)


def fit_patterns(left: np.ndarray, capacity: int) -> list[tuple[list[int], float]]:
    """Patterns of length classes with their fitted repeat counts, most frequent first."""
    width = CLASS_WIDTH if capacity >= 64 * CLASS_WIDTH else 1
    units = capacity // width
    goal = np.zeros(units + 1)
    np.add.at(goal, [min(-(-n // width), units) for n in range(capacity + 1)], left)
    found = patterns([c for c in range(1, units + 1) if goal[c]], units)
    if not len(found):
        return []
    # A long piece that is left over costs a sequence, a short one hardly anything.
    counts = nnls(found, goal, np.arange(units + 1) / units)
    order = np.argsort(-counts, kind="stable")
    return [([int(c) * width for c in found[j] if c > 0], float(counts[j])) for j in order if counts[j] > 0]


def filled(fit, share: float, left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Round ``share`` of the fit down and give the places exact lengths, taken from ``left``."""
    width = CLASS_WIDTH if capacity >= 64 * CLASS_WIDTH else 1
    out = []

    def largest(most: int, least: int) -> int:
        some = np.flatnonzero(left[max(least, 1) : most + 1] > 0)
        return int(some[-1]) + max(least, 1) if len(some) else 0

    for classes, count in fit:
        wanted = int(count * share + 1e-6)
        while wanted > 0:
            room, chosen = capacity, []
            for k, top in enumerate(classes):
                # The last place takes the best fit, which makes good what classes round up.
                last = k == len(classes) - 1
                length = largest(room, room - 2 * width) if last else largest(min(top, room), top - width + 1)
                if not length:
                    break
                chosen.append(length)
                left[length] -= 1
                room -= length
            for length in chosen:
                left[length] += 1
            if len(chosen) < len(classes):
                break
            n = min(wanted, *(int(left[v]) // chosen.count(v) for v in chosen))
            for length in chosen:
                left[length] -= n
            out.append((tuple(chosen), n))
            wanted -= n
    return out


def best_fit(left: np.ndarray, capacity: int, started) -> list[tuple[tuple[int, ...], int]]:
    """Pack the remaining histogram, longest first, each into the tightest open sequences.

    Sequences with the same contents are held as one entry with a count.
    """
    rooms: list[int] = []  # distinct rooms of open sequences, sorted
    open_by: dict[int, dict[tuple[int, ...], int]] = {}

    def put(content, n):
        room = capacity - sum(content)
        if room not in open_by:
            open_by[room] = {}
            insort(rooms, room)
        open_by[room][content] = open_by[room].get(content, 0) + n

    for content, n in started:
        put(content, n)
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                fits = capacity // length
                if n >= fits:
                    put((length,) * fits, n // fits)
                    n %= fits
                else:
                    put((length,) * n, 1)
                    n = 0
                continue
            room = rooms[k]
            content, m = open_by[room].popitem()
            fits = room // length
            used = min(m, n // fits)
            if used:
                put(content + (length,) * fits, used)
                n -= used * fits
            elif n:
                put(content + (length,) * n, 1)
                used, n = 1, 0
            if m > used:
                open_by[room][content] = m - used
            if not open_by[room]:
                del open_by[room]
                rooms.remove(room)
    left[:] = 0
    return [item for by in open_by.values() for item in by.items()]


def packing_plan(histogram: dict[int, int], capacity: int) -> list[tuple]:
    """Rows (length, first rank, last rank, copies per sequence, first sequence, offset)."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    whole = int(left[capacity])
    left[capacity] = 0
    least = -(-int(left @ np.arange(capacity + 1)) // capacity)
    fit, sequences, fewest = fit_patterns(left, capacity), [], None
    for share in SHARES:
        rest = left.copy()
        tried = best_fit(rest, capacity, filled(fit, share, rest, capacity))
        n = sum(count for _, count in tried)
        if fewest is None or n < fewest:
            sequences, fewest = tried, n
        if fewest <= least * 1.001:
            break
    if whole:
        sequences.append(((capacity,), whole))
    used: dict[int, int] = {}
    rows, base = [], 0
    for content, n in sorted(sequences):
        place = 0
        for length in sorted(set(content), reverse=True):
            copies = content.count(length)
            first = used.get(length, 0)
            used[length] = first + n * copies
            rows.append((length, first, used[length], copies, base, place))
            place += copies * length
        base += n
    return rows


# Assignment.


def packed_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset of every piece.

    ``ids`` holds the piece's token ids, little-endian unsigned 32-bit; a sequence is the ids of its
    pieces by offset.  They are stored once, in 16 bits where the vocabulary allows, stay out of the
    ranking, are met again by row and widened last.
    A null or empty text has the single id 0, so each document has a piece.  Pieces of rows
    without doc_id or with a repeated one are packed like any other.  An empty table gives no
    row.  Sequence numbers run from 0 without gaps.
    """
    spark = docs.sparkSession
    coded = token_pieces(docs, path, capacity)
    stored = pin(coded.select("*", F.crc32("ids").alias("mark"), F.monotonically_increasing_id().alias("row")), "pieces")
    pieces = stored.select("row", "doc_id", "piece", "length", "mark")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(packing_plan(histogram, capacity), PLAN)

    parts = F.lit([1 + histogram.get(length, 0) // RANK_ROWS for length in range(1, capacity + 1)])
    salt = F.pmod(F.xxhash64("doc_id", "piece", "mark"), F.element_at(parts, F.col("length").cast("int")))
    salted = pieces.withColumn("salt", salt)
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "mark")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("n"))
        .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    )
    ranked = (
        salted.withColumn("inner", F.row_number().over(inside) - 1)
        .join(offsets, ["length", "salt"])
        .withColumn("rank", F.col("inner") + F.col("skip"))
    )
    plan = F.broadcast(plan.withColumnRenamed("length", "of"))  # bounded by the capacity alone
    local = F.col("rank") - F.col("first")
    placed = ranked.join(
        plan,
        (F.col("length") == F.col("of"))
        & (F.col("rank") >= F.col("first"))
        & (F.col("rank") < F.col("last")),
    ).select(
        "row",
        (F.col("base") + F.floor(local / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("place") + local % F.col("copies") * F.col("length")).cast("long").alias("offset"),
    )
    found = stored.join(placed, "row").select(
        "doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"
    )
    return widened(found)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``packed_pieces`` with a digest, ids_crc32, for the ids."""
    return packed_pieces(docs, path, capacity).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
