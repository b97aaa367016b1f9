"""Importance resampling towards a target corpus, by hashed word n-grams.

A batch of texts is joined with separators, one regular expression finds all words of it, the words'
places are looked up among the texts' offsets, and runs that cross from one text into the next are
masked.  Buckets are then counted with ``bincount``.

Two passes over the texts: one counts the buckets of the whole corpus, one weighs every document.  A
task sends at most one row per bucket, and gains, one number per bucket, go to the tasks.  Scores are
whole numbers, of which there are some hundred thousand at most, whatever the corpus (see
:func:`cut_score`), so counts per score give the place where the draw ends, and only rows at or above
it are sorted.

Defined results: null texts and texts without a word have no feature and weight 0.  A row without
doc_id counts in the corpus and has a weight, but no score and no rank, and is not among the documents
that are drawn from.  Repeated rows are all counted and ranked; rows that tie in score and doc_id follow
their order in the input.  An empty table gives no row, an empty target a gain from the corpus alone.
Only doc_id and text are read.  Texts are never cut: one that exceeds ``SLICE`` is a batch of its own
and needs some twenty times its size in its task.
"""

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin
from .common import documents, raw_bytes, slices

#: Words after A-Z are lower-cased: digits, small letters and everything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\x00"
#: Bytes of text that are joined at a time.
SLICE = 4 << 20
TASK_BIT = 33
HASH_RANGE = 2.0**32

SCORED = "doc_id long, n_features long, n_words long, weight long, score long"


def batch_features(
    texts: list[bytes], longest: int, buckets: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and bucket of every run of 1 to ``longest`` words, and the words of each text."""
    ends = np.cumsum([len(t) + len(SEPARATOR) for t in texts])
    found = [(m.start(), m.group()) for m in WORD.finditer(SEPARATOR.join(texts).lower())]
    words = [w for _, w in found]
    starts = np.fromiter((s for s, _ in found), np.int64, len(found))
    owner = np.searchsorted(ends, starts, "right")
    owners, numbers = [], []
    codes = list(map(crc32, words))
    for length in range(1, longest + 1):
        runs = len(words) - length + 1
        if runs < 1:
            break
        if length > 1:
            codes = [crc32(w, crc32(b" ", c)) for w, c in zip(words[length - 1 :], codes)]
        whole = owner[:runs] == owner[length - 1 :]
        owners.append(owner[:runs][whole])
        numbers.append(np.fromiter(codes, np.int64, runs)[whole] % buckets)
    if not owners:
        owners = numbers = [np.zeros(0, np.int64)]
    return np.concatenate(owners), np.concatenate(numbers), np.bincount(owner, minlength=len(texts))


def bucket_counts(docs: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features per bucket over all texts; ``buckets`` numbers reach the driver."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for piece in slices(batches, "text", SLICE):
            _, numbers, _ = batch_features(raw_bytes(piece.column("text")), longest, buckets)
            counts += np.bincount(numbers, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["bucket", "n"])

    parts = docs.select(F.col("text").cast("string")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of a bucket's smoothed shares in target and corpus, floored."""
    buckets = float(len(corpus))
    own, other = float(corpus.sum()) + buckets, float(target.sum()) + buckets
    ratios = [(float(t) + 1.0) * own / ((float(s) + 1.0) * other) for s, t in zip(corpus, target)]
    return np.array([math.floor(1000.0 * math.log(r)) for r in ratios], np.int64)


def luck(doc_id: int, seed: int) -> int:
    """A document's Gumbel draw in thousandths, from its id and the seed."""
    digits = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8]
    return math.floor(-1000.0 * math.log(-math.log((int(digits, 16) + 0.5) / HASH_RANGE)))


def scored_documents(
    docs: DataFrame, gains: np.ndarray, longest: int, seed: int
) -> DataFrame:
    """Features, words, weight and score of every row."""
    buckets = len(gains)

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", SLICE):
            texts, ids = raw_bytes(piece.column("text")), piece.column("doc_id").to_pylist()
            owner, numbers, n_words = batch_features(texts, longest, buckets)
            n = np.bincount(owner, minlength=len(texts))
            total = np.zeros(len(texts), np.int64)
            np.add.at(total, owner, gains[numbers])
            weight = total // np.maximum(n, 1)
            score = [None if i is None else int(w) + luck(i, seed) for i, w in zip(ids, weight)]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(n.astype(np.int64)),
                    pa.array(n_words.astype(np.int64)),
                    pa.array(weight),
                    pa.array(score, pa.int64()),
                ],
                ["doc_id", "n_features", "n_words", "weight", "score"],
            )

    return documents(docs).mapInArrow(weigh, SCORED)


def cut_score(eligible: DataFrame, drawn: int) -> int | None:
    """The score of the last row that is drawn.

    A weight lies within 1000 times the log of (features + buckets) squared, a Gumbel draw within
    -3200 and 23,000, so the counted scores are some hundred thousand rows at most.
    """
    counts = eligible.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    reached = counts.select("score", F.sum("n").over(above).alias("n"))
    return reached.where(F.col("n") >= drawn).agg(F.max("score")).first()[0]


def numbered_in_order(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3 ... over all of them.

    Ranges of the order are sorted side by side; their sizes, one row per range, give the offsets.
    """
    place = F.monotonically_increasing_id().alias("place")
    ranged = pin(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("*", place), "ranked")
    task = F.shiftright("place", TASK_BIT)
    sizes = ranged.groupBy(task.alias("task")).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")
    )
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "task", "first", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("offset")
    )
    return (
        ranged.withColumn("task", task)
        .join(F.broadcast(offsets), "task")  # one row per range
        .withColumn("rank", F.col("place") - F.col("first") + F.col("offset") + 1)
        .select(*rows.columns, "rank")
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``; rank is null for rows that are not drawn.

    Of the documents with ``least_words`` words or more, ``percent`` in 100 are drawn without
    replacement, with chances that follow their weight.
    """
    gains = bucket_gains(
        bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets)
    )
    rows = pin(
        scored_documents(docs, gains, longest, seed).withColumn("row", F.monotonically_increasing_id()),
        "scored",
    )
    may = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    drawn = rows.where(may).count() * percent // 100
    cut = cut_score(rows.where(may), drawn) if drawn else None
    if cut is None:
        return rows.select(*columns, none)
    high = may & (F.col("score") >= cut)
    ranked = numbered_in_order(rows.where(high), F.desc("score"), F.asc("doc_id"), F.asc("row"))
    place = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    return ranked.select(*columns, place).unionAll(
        rows.where(~F.coalesce(high, F.lit(False))).select(*columns, none)
    )
