"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints: every shingle's XXH64 votes on 64 bits.  Equal fingerprints become one class
at once, so copies never meet each other.  Two classes link at ``distance`` or fewer
differing bits.

Search: correlated bits are put into the same partition (correlations come from all
classes).  If thresholds t_1..t_m with sum ``distance - m + 1`` are given to the partitions,
any linked pair agrees up to t_i bits in at least one partition i.  A dynamic programme
chooses the thresholds, -1 meaning that a partition is not probed, by the estimated number of
probes and candidates.  Probes enumerate the values within t_i bits; candidates are verified
on all 64 bits.

A partition value that more than ``BUCKET`` classes share is not searched by pairs.  There the
pigeonhole is applied from both sides on the whole fingerprint: two values within ``distance``
bits have a common neighbour within half of it of each, so every class is listed under its
neighbours and linked to the smallest class of each list.  That costs the same for every
class however large the bucket is, and loses no link of the components.
"""

from functools import reduce
from itertools import combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .common import documents, hex_long, keyed_documents, raw_bytes, slices
from .components import components

BITS = 64
SEED = 42
BUCKET = 64
BATCH_BYTES = 4 << 20
VOTE_ROWS = 1 << 17


def shingles(text: bytes, size: int) -> list[bytes]:
    """Space-joined word shingles, A-Z lower-cased; fewer words give the whole sequence."""
    words = text.lower().split()
    if not words:
        return []
    if len(words) <= size:
        return [b" ".join(words)]
    return list(map(b" ".join, zip(*(words[k:] for k in range(size)))))


def votes(marks: np.ndarray) -> np.ndarray:
    """How many of the uint64 marks have each bit set, lowest bit first."""
    total = np.zeros(BITS, np.int64)
    for begin in range(0, len(marks), VOTE_ROWS):
        part = marks[begin : begin + VOTE_ROWS].astype("<u8").view(np.uint8)
        total += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(
            0, dtype=np.int64
        )
    return total


def fingerprint(text: bytes, size: int) -> int:
    """The SimHash as a signed 64-bit number; no words give zero."""
    found = shingles(text, size)
    if not found:
        return 0
    marks = np.fromiter(
        (xxhash.xxh64_intdigest(s, SEED) for s in found), np.uint64, len(found)
    )
    bits = votes(marks) * 2 > len(found)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _row_fingerprints(size: int):
    def run(batches):
        for batch in slices(batches, "text", BATCH_BYTES):
            raw = raw_bytes(batch.column("text"))
            marks = [fingerprint(t, size) for t in raw]
            points = [len(t.decode()) for t in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(points, pa.int64()), pa.array(marks, pa.int64())],
                ["doc_id", "row_key", "points", "mark"],
            )

    return run


def _fingerprints(size: int):
    def run(batches):
        for batch in slices(batches, "text", BATCH_BYTES):
            marks = [fingerprint(t, size) for t in raw_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(marks, pa.int64())], ["doc_id", "mark"]
            )

    return run


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    return documents(docs).mapInArrow(_fingerprints(shingle), "doc_id long, mark long")


# Partitions and thresholds.


def _pair_counts(batches):
    """Per task, the 64 x 64 counts of classes in which two bits are both set."""
    total, seen = np.zeros((BITS, BITS), np.int64), 0
    for batch in batches:
        marks = batch.column("mark").to_numpy(zero_copy_only=False).astype("<i8")
        for begin in range(0, len(marks), VOTE_ROWS):
            part = np.ascontiguousarray(marks[begin : begin + VOTE_ROWS]).view(np.uint8)
            x = np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += np.rint(x.T @ x).astype(np.int64)
            seen += len(x)
    if seen:
        cells = np.append(total.ravel(), seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(cells)), pa.int64()), pa.array(cells, pa.int64())],
            ["cell", "n"],
        )


def bit_statistics(classes: DataFrame) -> tuple[np.ndarray, int]:
    """Counts of common set bits over all classes; 4097 numbers reach the driver."""
    rows = (
        classes.select("mark")
        .mapInArrow(_pair_counts, "cell long, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    cells = np.zeros(BITS * BITS + 1, np.int64)
    for cell, n in rows:
        cells[cell] = n
    return cells[:-1].reshape(BITS, BITS).astype(float), int(cells[-1])


def group_bits(common: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Partitions of equal size; each grows by the free bit most correlated with it."""
    mean = np.diag(common) / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    near = np.abs(common / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        most = (BITS - sum(map(len, groups))) // (parts - k)
        first = max(sorted(free), key=lambda b: near[b, sorted(free)].sum())
        group = [first]
        free.remove(first)
        while len(group) < most:
            best = max(sorted(free), key=lambda b: near[b, group].sum())
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def expected_pairs(common: np.ndarray, n: int, group: list[int], most: int) -> list[float]:
    """Estimated pairs of classes that differ in at most 0..most bits of a partition."""
    mean = np.diag(common)[group] / max(n, 1)
    differ = 2 * mean * (1 - mean)
    chance = np.zeros(most + 1)
    chance[0] = 1.0
    for p in differ:
        chance[1:] = chance[1:] * (1 - p) + chance[:-1] * p
        chance[0] *= 1 - p
    return list(np.cumsum(chance) * n * n / 2)


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds of at least -1 that add up to ``total`` at the least cost.

    ``costs[i][t + 1]`` is the cost of threshold t in partition i.
    """
    best = {0: (0.0, [])}
    for cost in costs:
        grown: dict[int, tuple[float, list[int]]] = {}
        for held, (paid, chosen) in best.items():
            for t in range(-1, len(cost) - 1):
                option = (paid + cost[t + 1], [*chosen, t])
                if held + t not in grown or option < grown[held + t]:
                    grown[held + t] = option
        best = grown
    return best[total][1]


def plan(common: np.ndarray, n: int, distance: int) -> tuple[list[list[int]], list[int]]:
    """Partitions and their thresholds with the least estimated cost."""
    found = None
    top = max(1, min(distance + 1, round(BITS / max(log2(max(n, 2)), 8))))
    for parts in range(1, top + 1):
        groups = group_bits(common, n, parts)
        costs = []
        for group in groups:
            pairs = expected_pairs(common, n, group, distance)
            probes = np.cumsum([comb(len(group), d) for d in range(distance + 1)])
            costs.append([0.0, *(n * (p + 1) + c for p, c in zip(probes, pairs))])
        chosen = allocate(costs, distance - parts + 1)
        paid = sum(cost[t + 1] for cost, t in zip(costs, chosen))
        if found is None or paid < found[0]:
            found = (paid, groups, chosen)
    return found[1], found[2]


def _word(bits) -> int:
    """A signed 64-bit number with these bits set."""
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _flips(bits: list[int], most: int) -> list[int]:
    return [_word(c) for d in range(most + 1) for c in combinations(bits, d)]


def links(classes: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) between classes ``mark``; their components are those of all linked pairs."""
    common, n = bit_statistics(classes)
    groups, chosen = plan(common, n, distance)
    marks = classes.select("mark")
    parts = [(i, g, t) for i, (g, t) in enumerate(zip(groups, chosen)) if t >= 0]
    keys = reduce(
        DataFrame.unionAll,
        [
            marks.select(
                F.lit(i).alias("part"), F.col("mark").bitwiseAND(F.lit(_word(g))).alias("key"), "mark"
            )
            for i, g, _ in parts
        ],
    )
    sizes = keys.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"))
    index = keys.join(sizes, ["part", "key"])
    calm = index.where(F.col("n") <= BUCKET)

    flips = {i: _flips(g, t) for i, g, t in parts}
    around = F.coalesce(
        *[
            F.when(F.col("part") == i, F.array(*[F.lit(f) for f in found]))
            for i, found in flips.items()
        ]
    )
    if all(t == 0 for _, _, t in parts):
        probes = calm.select("part", "key", F.col("mark").alias("other"))
    else:
        probes = index.select(
            "part", "key", F.col("mark").alias("other"), F.explode(around).alias("flip")
        ).select("part", F.col("key").bitwiseXOR(F.col("flip")).alias("key"), "other")
    pairs = (
        calm.join(probes, ["part", "key"])
        .where(F.col("mark") != F.col("other"))
        .where(F.bit_count(F.col("mark").bitwiseXOR(F.col("other"))) <= distance)
        .select(F.least("mark", "other").alias("a"), F.greatest("mark", "other").alias("b"))
    )

    crowded = index.where(F.col("n") > BUCKET).select("mark").distinct()
    steps = F.array(*[F.lit(f) for f in _flips(list(range(BITS)), distance // 2)])
    lists = crowded.select("mark", F.explode(steps).alias("flip")).select(
        "mark", F.col("mark").bitwiseXOR(F.col("flip")).alias("centre")
    )
    heads = lists.groupBy("centre").agg(F.min("mark").alias("head"), F.count(F.lit(1)).alias("m"))
    stars = (
        lists.join(heads.where(F.col("m") > 1), "centre")
        .where(F.col("mark") != F.col("head"))
        .select(F.col("head").alias("a"), F.col("mark").alias("b"))
    )
    return pairs.unionAll(stars).distinct()


def _rooted(classes: DataFrame, distance: int) -> DataFrame:
    """The classes with the root of their component."""
    if distance % 2:
        raise ValueError("common neighbours of crowded values need an even distance")
    roots = components(links(classes, distance))
    return classes.join(roots, classes["mark"] == roots["node"], "left").withColumn(
        "root", F.coalesce("root", "mark")
    )


def kept_rows(docs: DataFrame, row: str, shingle: int = 3, distance: int = 2) -> DataFrame:
    """keep_row: of every component the one row that stays, by ``row``, different in every row.

    Rows with an id come first, then the smallest doc_id, the most code points, the smallest row key.
    """
    keyed = keyed_documents(docs, row).mapInArrow(
        _row_fingerprints(shingle), "doc_id long, row_key long, points long, mark long"
    )
    best = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", (-F.col("points")).alias("less"), "row_key")
    classes = pin(keyed.groupBy("mark").agg(F.min(best).alias("best")), "classes")
    owned = _rooted(classes, distance).groupBy("root").agg(F.min("best").alias("best"))
    return owned.select(F.col("best.row_key").alias("keep_row"))


def simhash_dedup(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of (doc_id, text).

    Null, empty and blank texts have fingerprint zero and link like any other.  component_id
    is the smallest doc_id reachable over links; rows without doc_id belong to components but
    do not name them (a component without any id has a null component_id).  Repeated rows
    repeat their answer; an empty table gives no row.  ``distance`` must be even.
    """
    marks = pin(fingerprints(docs, shingle), "fingerprints")
    classes = pin(marks.groupBy("mark").agg(F.min("doc_id").alias("smallest")), "classes")
    owned = _rooted(classes, distance).select("mark", "smallest", "root")
    names = owned.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = owned.join(names, "root").select("mark", "component_id")
    return marks.join(named, "mark").select(
        "doc_id", hex_long(F.col("mark")).alias("fingerprint"), "component_id"
    )
