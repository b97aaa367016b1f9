"""Quality classifier by compression.

Two Zstandard dictionaries are built, one from texts labelled good and one from texts
labelled bad.  A text is cut into blocks, as long texts would otherwise teach the compressor
themselves, and every block is compressed with both.  The normalised difference of the summed
sizes, together with the ratio reached with the good dictionary, becomes a probability by a
logistic curve fitted on labelled texts that the dictionaries have not seen.

Only the fit reads a sample: per label at most ``FIT_ROWS`` texts for the dictionary and as
many for the curve, each of at most ``FIT_CHARS`` characters, so at most
4 x FIT_ROWS x FIT_CHARS characters reach the driver.  Scoring reads whole texts.
"""

from dataclasses import dataclass
from math import exp, log

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, raw_bytes

FIT_ROWS = 1500
FIT_CHARS = 16_384
BLOCK = 2000
DICTIONARY = 112_640
LEVEL = 3


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]


class Sizer:
    """Summed block sizes under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = self._compressor(good), self._compressor(bad)

    @staticmethod
    def _compressor(content: bytes):
        plain = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        words = zstandard.ZstdCompressionDict(content) if content else None
        return zstandard.ZstdCompressor(dict_data=words, compression_params=plain)

    def features(self, text: bytes) -> tuple[float, float]:
        good = bad = 0
        for block in blocks(text):
            good += len(self.good.compress(block))
            bad += len(self.bad.compress(block))
        return (bad - good) / max(good, bad, 1), log((good + 1) / (len(text) + 1))


def blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK] for i in range(0, max(len(text), 1), BLOCK)]


def _dictionary(texts: list[bytes]) -> bytes:
    samples = [b for t in texts for b in blocks(t) if b]
    size = min(DICTIONARY, sum(map(len, samples)) // 8)
    if len(samples) < 8 or size < 1024:
        return b""  # too little to build a dictionary from: plain compression
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # such as samples that are all alike
        return b""


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps on the penalised, weighted log loss."""
    x = np.c_[np.ones(len(x)), x]
    keep = np.full(x.shape[1], ridge)
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        bend = (x.T * (weight * p * (1 - p))) @ x + np.diag(keep)
        step = np.clip(np.linalg.solve(bend, x.T @ (weight * (p - y)) + keep * w), -5, 5)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, quality) of at most 2 x FIT_ROWS labelled rows per label, spread by a hash.

    The sample is drawn from the narrow labels table, so documents are only filtered.
    """
    marked = labels.select(
        F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality")
    ).where(~held_out("label_id"))
    drawn = [
        marked.where(F.col("quality") == q)
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(2 * FIT_ROWS)
        for q in (0, 1)
    ]
    few = F.broadcast(drawn[0].unionAll(drawn[1]))  # at most 4 x FIT_ROWS rows
    texts = documents(docs).where(F.length("text") <= FIT_CHARS)
    met = texts.join(few, texts["doc_id"] == few["label_id"])
    # A doc_id that many rows repeat, or that is labelled again, counts once, by its least text.
    return met.groupBy("label_id").agg(F.min(F.struct("text", "quality")).alias("row")).select("row.*")


def fit(docs: DataFrame, labels: DataFrame) -> CompressionModel:
    """Fit on the labelled documents (``quality`` 1 good, 0 bad) that are not held out.

    Other labels, null texts and texts of over FIT_CHARS characters are not learnt from.
    Without labels of both kinds the score is the smoothed share of good labels.
    """
    rows = sorted((r["text"].encode(), r["quality"]) for r in labelled_sample(docs, labels).collect())
    rows.sort(key=lambda r: xxhash.xxh3_64_intdigest(r[0]))
    kinds = {q: [t for t, k in rows if k == q] for q in (0, 1)}
    good, bad = _dictionary(kinds[1][::2]), _dictionary(kinds[0][::2])
    if not kinds[0] or not kinds[1]:
        share = (len(kinds[1]) + 1) / (len(rows) + 2)
        level = (log(share / (1 - share)), 0.0, 0.0)
        return CompressionModel(good, bad, (0.0, 0.0), (1.0, 1.0), level)
    shares = dict(
        labels.where(F.col("quality").isin(0, 1) & ~held_out())
        .groupBy(F.col("quality").cast("int"))
        .count()
        .collect()
    )
    sizer = Sizer(good, bad)
    curve = [(t, q) for q, texts in kinds.items() for t in (texts[1::2] or texts)]
    x = np.array([sizer.features(t) for t, _ in curve])
    y = np.array([q for _, q in curve], float)
    drawn = {q: max(1, int((y == q).sum())) for q in (0, 1)}  # give the labels their own shares
    weight = np.array([shares[q] / drawn[q] for _, q in curve])
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    w = _logistic((x - centre) / scale, y, weight * len(y) / weight.sum())
    return CompressionModel(good, bad, *(tuple(map(float, v)) for v in (centre, scale, w)))


def score_text(sizer: Sizer, model: CompressionModel, text: bytes) -> float:
    z = model.weights[0]
    for v, c, s, w in zip(sizer.features(text), model.centre, model.scale, model.weights[1:]):
        z += w * (v - c) / s
    return 1 / (1 + exp(-max(-30.0, min(30.0, z))))


def quality_score(model: CompressionModel, text: Column | str = "text") -> Column:
    """The probability of label 1; null counts as empty, and empty texts have a score too."""

    @F.arrow_udf("double")
    def score(parts: pa.Array) -> pa.Array:
        sizer = Sizer(model.good, model.bad)
        return pa.array([score_text(sizer, model, t) for t in raw_bytes(parts)], pa.float64())

    return score((F.col(text) if isinstance(text, str) else text).cast("string"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text is 1 modulo 3.

    A row without id counts as held out.
    """
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of (doc_id, text).

    Repeated rows have equal scores; an empty table gives no row.
    """
    model = fit(docs, labels)
    scored = docs.select(
        F.col("doc_id").cast("long"),
        held_out().alias("held_out"),
        quality_score(model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
