"""Benchmark decontamination by q-gram lemma filtering.

Texts and items are reduced to lower-case words with single spaces.  Every run of ``WINDOW``
characters of an item is a window; a shorter item is one window.  A region of a text that is within ``e`` edits of
a window of ``w`` characters shares at least ``w + 1 - q (e + 1)`` of its q-grams, and these lie
on diagonals (position in the text less position in the item) at most ``e`` apart.  So shared
q-grams are counted in diagonal bands that overlap by half; regions that reach the bound are
verified by an alignment restricted to the band.

No text is shuffled.  Distinct items go to the tasks in blocks of about ``BLOCK_CHARS``
characters; a larger benchmark takes one pass for each block, whose result is stored before the
driver reads the next block.  A text is held by one task, with some ten times its size in memory.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .common import documents, raw_bytes, slices

Q = 12
WINDOW = 80
EDITS = 5
#: Windows that are aligned at a time.
ALIGNED = 4096
BLOCK_CHARS = 1 << 20
BATCH_BYTES = 4 << 20
FILTER_BITS = 22

WORD = re.compile(r"[^\W_]+")
REGIONS = "doc_id long, digest string, item_id long, begin long, end long, edits int"


def reduced(text: str) -> str:
    return " ".join(WORD.findall(text)).lower()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def gram_hashes(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every q-gram, built from hashes of 1, 2, 4 and 8 characters."""
    if len(points) < Q:
        return np.zeros(0, np.uint64)
    factor = 0x9E3779B97F4A7C15
    wrap = (1 << 64) - 1
    known = {1: points.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)}
    for n in (1, 2, 4):
        h = known[n]
        known[2 * n] = h[:-n] * np.uint64(pow(factor, n) & wrap) + h[n:]
    tail = known[Q - 8]
    h = known[8][: len(tail) - 8] * np.uint64(pow(factor, Q - 8) & wrap) + tail[8:]
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Rule:
    """What holds for every window of an item: its size, the edits it allows, the q-grams it must share."""

    size: int
    edits: int
    least: int

    @classmethod
    def of(cls, length: int) -> "Rule":
        size = min(WINDOW, length)
        edits = min(EDITS * size // WINDOW, (size + 1) // Q - 1)
        return cls(size, edits, size + 1 - Q * (edits + 1))


class BenchmarkIndex:
    """q-grams of a block of items, sorted by hash, with a bit filter before them."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.points = [code_points(t) for _, t in items]
        grams = [gram_hashes(p) for p in self.points]
        hashes = np.concatenate([*grams, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, int)])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner, self.place = hashes[order], owner[order], place[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.hashes >> np.uint64(64 - FILTER_BITS)] = True
        self.rules = [Rule.of(len(p)) for p in self.points]
        self.least = min((r.least for r in self.rules), default=1)

    def hits(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions in the text, items and positions in the items of all shared q-grams."""
        h = gram_hashes(points)
        at = np.flatnonzero(self.filter[h >> np.uint64(64 - FILTER_BITS)])
        low = np.searchsorted(self.hashes, h[at], "left")
        n = np.searchsorted(self.hashes, h[at], "right") - low
        entry = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(at, n), self.owner[entry], self.place[entry]


def aligned(
    item: np.ndarray, text: np.ndarray, low: int, high: int, begins=(0,), size: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of windows of an item against the text on diagonals low..high, and their ends.

    A diagonal is the place in the text less the place in the item.  Text before and after the
    region is free.  Cells outside the text cost more than any match.
    """
    begins = np.asarray(begins)
    size = len(item) if size is None else size
    far = size + len(text) + 1
    padded = np.append(text, 0)
    shift = np.arange(low, high + 1)
    start = begins[:, None] + shift
    cost = np.where((start >= 0) & (start <= len(text)), 0, far)
    up = np.full(cost.shape, far)
    for row in range(size):
        at = start + row
        inside = (at >= 0) & (at < len(text))
        # The cost of a step along the diagonal, and of a character left out of the text.
        step = np.where(inside, padded[np.where(inside, at, -1)] != item[begins + row][:, None], far)
        skip = np.where(inside | (at == -1), 1, far)
        up[:, :-1] = cost[:, 1:] + skip[:, :-1]
        cost = np.minimum.accumulate(np.minimum(cost + step, up) - shift, axis=1) + shift
    best = np.argmin(cost, axis=1)
    return cost[np.arange(len(begins)), best], begins + size + shift[best]


def exact(item: np.ndarray, text: np.ndarray, diagonal: int, begins: np.ndarray, size: int) -> np.ndarray:
    """Whether windows of an item stand in the text, unchanged, on a diagonal."""
    at = np.arange(len(item)) + diagonal
    inside = (at >= 0) & (at < len(text))
    wrong = ~inside
    wrong[inside] = text[at[inside]] != item[inside]
    before = np.concatenate(([0], np.cumsum(wrong)))
    return before[begins + size] == before[begins]


def regions(index: BenchmarkIndex, points: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(item number, begin, end, edits) of verified windows, merged where they overlap.

    ``edits`` is that of the worst window.
    """
    at, item, place = index.hits(points)
    if len(at) < index.least:
        return []
    width = 2 * (EDITS + 1)
    found = set()
    for offset in (0, width // 2):
        band = (at - place + offset) // width
        order = np.lexsort((place, band, item))
        i, b, p = item[order], band[order], place[order]
        edges = np.flatnonzero((i[1:] != i[:-1]) | (b[1:] != b[:-1])) + 1
        bounds = np.concatenate(([0], edges, [len(i)]))
        for k in np.flatnonzero(np.diff(bounds) >= index.least):
            lo, hi = bounds[k], bounds[k + 1]
            number = int(i[lo])
            rule, pattern = index.rules[number], index.points[number]
            begins = np.arange(len(pattern) - rule.size + 1)
            seen = np.unique(p[lo:hi])
            shared = np.searchsorted(seen, begins + rule.size - Q + 1) - np.searchsorted(seen, begins)
            begins = begins[shared >= rule.least]
            diagonal = int(np.median(at[order[lo:hi]] - p[lo:hi]))
            same = exact(pattern, points, diagonal, begins, rule.size)
            found.update((number, x, x + rule.size, 0) for x in (begins[same] + diagonal).tolist())
            begins = begins[~same]
            low = int(b[lo]) * width - offset - rule.edits
            high = low + width - 1 + 2 * rule.edits
            for cut in range(0, len(begins), ALIGNED):
                edits, ends = aligned(pattern, points, low, high, begins[cut : cut + ALIGNED], rule.size)
                for e, end in zip(edits.tolist(), ends.tolist()):
                    if e <= rule.edits:
                        found.add((number, max(0, end - rule.size), end, e))
    merged = []
    for number, begin, end, edits in sorted(found):
        if merged and merged[-1][0] == number and begin <= merged[-1][2]:
            _, first, last, most = merged[-1]
            merged[-1] = (number, first, max(last, end), max(most, edits))
        else:
            merged.append((number, begin, end, edits))
    return merged


def in_original(text: str, begin: int, end: int) -> tuple[int, int]:
    """Code points of the words that a region of the reduced text touches."""
    at, found = 0, []
    for word in WORD.finditer(text):
        size = len(word.group().lower())
        if at < end and at + size > begin:
            found.append(word.span())
        at += size + 1
    return (found[0][0], found[-1][1]) if found else (0, 0)


def _scan(index: BenchmarkIndex):
    def run(batches):
        for batch in slices(batches, "text", BATCH_BYTES):
            rows = []
            keys = zip(batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist())
            for key, raw in zip(keys, raw_bytes(batch.column("text"))):
                text = raw.decode()
                for number, begin, end, edits in regions(index, code_points(reduced(text))):
                    rows.append((*key, index.ids[number], *in_original(text, begin, end), edits))
            if rows:
                kinds = [pa.int64(), pa.string(), *[pa.int64()] * 3, pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    ["doc_id", "digest", "item_id", "begin", "end", "edits"],
                )

    return run


def indexes(benchmark: DataFrame) -> Iterator[BenchmarkIndex]:
    """Indexes over blocks of the benchmark, one at a time.

    Items of equal text share the least id, and so do items of a block whose texts are equal
    once reduced.  Items without item_id or with under Q characters of reduced text are ignored.
    """
    texts = (
        benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
        .where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
        .groupBy("text")
        .agg(F.min("item_id").alias("item_id"))
    )
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    count = int(total // BLOCK_CHARS + 1)
    for block in range(count):
        items: dict[str, int] = {}
        for t, i in texts.where(F.pmod(F.xxhash64("text"), F.lit(count)) == block).collect():
            t = reduced(t)
            items[t] = min(i, items.get(t, i))
        kept = sorted((i, t) for t, i in items.items() if len(t) >= Q)
        if kept:
            yield BenchmarkIndex(kept)


def digested(docs: DataFrame) -> DataFrame:
    """doc_id, text and a digest that, with doc_id, tells texts apart."""
    return documents(docs).withColumn("digest", F.md5(F.coalesce("text", F.lit(""))))


def contaminated_regions(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, digest (MD5 of the text), item_id, begin, end (code points, end exclusive), edits.

    Rows equal in doc_id and text give their regions once each.
    """
    texts = digested(docs)
    found = docs.sparkSession.createDataFrame([], REGIONS)
    for index in indexes(benchmark):
        found = found.unionAll(pin(texts.mapInArrow(_scan(index), REGIONS), "regions"))
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_regions, regions for every row of (doc_id, text).

    ``regions`` lists item:begin:end:edits by begin, comma-joined.  Every row is judged by its own
    text, also where doc_id repeats or is missing.  A null or empty text is clean, and so is every
    text if the benchmark is empty.  Texts of any length are read whole.  A passage that several
    items share counts for each.  Other columns are left out, whatever their names.
    """
    region = F.struct("begin", "end", "item_id", "edits")
    per_text = (
        contaminated_regions(docs, benchmark)
        .distinct()
        .groupBy(F.col("doc_id").alias("hit_id"), F.col("digest").alias("hit_digest"))
        .agg(F.sort_array(F.collect_list(region)).alias("found"))
    )
    said = F.transform(
        "found", lambda r: F.concat_ws(":", r["item_id"], r["begin"], r["end"], r["edits"])
    )
    rows = digested(docs).select("doc_id", "digest")
    same = rows["doc_id"].eqNullSafe(per_text["hit_id"]) & (rows["digest"] == per_text["hit_digest"])
    return rows.join(per_text, same, "left").select(
        "doc_id",
        F.col("found").isNotNull().alias("contaminated"),
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_regions"),
        F.coalesce(F.array_join(said, ","), F.lit("")).alias("regions"),
    )


def _touched(index: BenchmarkIndex):
    @F.arrow_udf("boolean")
    def touched(texts: pa.Array) -> pa.Array:
        found = (regions(index, code_points(reduced(t.decode()))) for t in raw_bytes(texts))
        return pa.array(map(bool, found), pa.bool_())

    return touched


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose own text has no region; all columns stay and no text is shuffled.

    Rows are stored between the passes of a benchmark of several blocks.
    """
    for k, index in enumerate(indexes(benchmark)):
        if k:
            docs = pin(docs, "decontaminated")
        docs = docs.where(~_touched(index)(docs["text"].cast("string")))
    return docs
