"""Centroid clustering of integer vectors, with n-simplex bounds before exact comparison.

The squared distances of every vector to a few pivots are found once and stored.  Together with the
pivots' own distances they place a vector as the apex of a simplex over the pivots: coordinates
inside the pivots' span and a height above it.  Between two apexes, the height difference gives a
lower bound of the true distance and the height sum an upper one, so a centroid whose lower bound
exceeds the least upper bound cannot be nearest.  The others are compared in exact integers.

Only centroids, ``k`` times ``dims`` whole numbers, pass through the driver.

Defined results: vectors of another length, null ones and those with a null or non-finite component
are left out.  Rows without vec_id are clustered like others, with an empty id in the starting hash;
rows that repeat a vec_id or a vector are all kept, and starting ties go to the smaller vector.  With
fewer than ``k`` vectors there are fewer centroids; of equal centroids the smaller number has the
vectors, and an empty one stays where it is.  An empty table gives no row.  Components beyond
``LIMIT`` after scaling raise an error, as squared distances would outgrow a long.  Columns other
than vec_id and embedding are not read.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin

#: Largest component: 64 squared differences of such numbers fit a long.
LIMIT = 2**27
#: Pivots that are closer to the span of those before, relative to their distance, are not used.
FLAT = 1e-3
#: Rounding in the bounds, relative to the squared lengths that they come from.
SLACK = 1e-6

CACHED = "vec_id long, v array<int>, pivot_sq array<long>"
ASSIGNED = "vec_id long, cluster int, distance long"


def squared_distances(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``v`` to the one vector, or the row each, ``w``."""
    apart = v - w
    return np.einsum("ij,ij->i", apart, apart)


class Simplex:
    """The base simplex over pivots, known by their distances alone."""

    def __init__(self, pivots: np.ndarray):
        between = np.array([squared_distances(pivots, p) for p in pivots], float)
        used, lower = [0], np.zeros((0, 0))
        for i in range(1, len(pivots)):
            far = between[0, i]
            place = self._solve(lower, (far + between[0, used[1:]] - between[i, used[1:]]) / 2)
            height = far - place @ place
            if far and height > FLAT**2 * far:
                lower = np.block([[lower, np.zeros((len(place), 1))], [place, np.sqrt(height)]])
                used.append(i)
        self.pivots = pivots[used]
        self.to_first = between[0, used[1:]]
        self.inverse = np.linalg.inv(lower)

    @staticmethod
    def _solve(lower: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.linalg.solve(lower, b) if len(b) else b

    def distances(self, v: np.ndarray) -> np.ndarray:
        return np.stack([squared_distances(v, p) for p in self.pivots], 1)

    def apexes(self, squared: np.ndarray) -> np.ndarray:
        """Coordinates from squared pivot distances: the span's, then the height."""
        squared = squared.astype(float)
        inner = (squared[:, :1] + self.to_first - squared[:, 1:]) / 2
        span = inner @ self.inverse.T
        height = np.sqrt(np.maximum(squared[:, 0] - np.einsum("ij,ij->i", span, span), 0))
        return np.hstack([span, height[:, None]])


def candidates(apexes: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """True where a centroid may be the nearest: lower bound up to the least upper bound."""
    sizes = np.einsum("ij,ij->i", apexes, apexes)
    centre_sizes = np.einsum("ij,ij->i", centres, centres)
    lower = sizes[:, None] + centre_sizes - 2 * (apexes @ centres.T)
    upper = lower + 4 * apexes[:, -1:] * centres[:, -1]
    slack = SLACK * (sizes + centre_sizes.max())
    return lower <= (upper.min(1) + 2 * slack)[:, None]


def nearest(
    simplex: Simplex, centroids: np.ndarray, v: np.ndarray, squared: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Number and exact squared distance of each row's nearest centroid; ties to the smaller number."""
    maybe = candidates(simplex.apexes(squared), simplex.apexes(simplex.distances(centroids)))
    best = np.full(len(v), np.iinfo(np.int64).max)
    number = np.zeros(len(v), np.int32)
    for j, centroid in enumerate(centroids):
        rows = np.flatnonzero(maybe[:, j])
        found = squared_distances(v[rows], centroid)
        closer = found < best[rows]
        best[rows[closer]] = found[closer]
        number[rows[closer]] = j
    return number, best


def integer_vectors(df: DataFrame, dims: int, scale: float) -> DataFrame:
    """``vec_id, v``: the kept vectors, each component the floor of ``scale`` times it."""
    x = F.col("embedding").cast("array<double>")
    whole = F.transform(x, lambda c: c * F.lit(float(scale)))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    large = F.exists(whole, lambda c: F.abs(c) > F.lit(float(LIMIT)))
    error = F.raise_error(F.lit(f"a component is beyond {LIMIT} after scaling"))
    v = F.transform(whole, lambda c: F.floor(c).cast("int"))
    return df.where((F.size(x) == dims) & ~bad).select(
        F.col("vec_id").cast("long"),
        F.when(large, error.cast("array<int>")).otherwise(v).alias("v"),
    )


def starting_hash(seed: int) -> Column:
    number = F.coalesce(F.col("vec_id").cast("string"), F.lit(""))
    return F.sha2(F.concat(F.lit(f"{seed}:"), number).cast("binary"), 256)


def starting_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of their id; ``k`` rows reach the driver."""
    rows = vectors.orderBy(starting_hash(seed), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)


def _with_pivot_distances(vectors: DataFrame, simplex: Simplex) -> DataFrame:
    def cache(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = simplex.distances(_matrix(batch.column("v"), batch.num_rows))
                ends = np.arange(batch.num_rows + 1, dtype=np.int32) * found.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("v"), lists], ["vec_id", "v", "pivot_sq"]
                )

    return vectors.mapInArrow(cache, CACHED)


def _updated(cached: DataFrame, simplex: Simplex, centroids: np.ndarray) -> np.ndarray:
    """Centroids moved to the floored means of their vectors.

    A task adds up its own vectors; at most ``k`` times ``dims + 1`` sums leave it or reach the driver.
    """
    k, dims = centroids.shape

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                v, squared = (_matrix(batch.column(c), batch.num_rows) for c in ("v", "pivot_sq"))
                number, _ = nearest(simplex, centroids, v, squared)
                np.add.at(sums, number, v)
                counts += np.bincount(number, minlength=k)
        held = np.flatnonzero(counts)
        totals = np.hstack([sums, counts[:, None]])[held].ravel()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(held, dims + 1).astype(np.int32)),
                pa.array(np.tile(np.arange(dims + 1, dtype=np.int32), len(held))),
                pa.array(totals),
            ],
            ["cluster", "place", "total"],
        )

    parts = cached.mapInArrow(add, "cluster int, place int, total long")
    moved = centroids.copy()
    sums = {(r[0], r[1]): r[2] for r in parts.groupBy("cluster", "place").agg(F.sum("total")).collect()}
    for cluster in {c for c, _ in sums}:
        n = sums[cluster, dims]
        moved[cluster] = [sums[cluster, place] // n for place in range(dims)]
    return moved


def _assigned(cached: DataFrame, simplex: Simplex, centroids: np.ndarray) -> DataFrame:
    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v, squared = (_matrix(batch.column(c), batch.num_rows) for c in ("v", "pivot_sq"))
                number, distance = nearest(simplex, centroids, v, squared)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(number), pa.array(distance)],
                    ["vec_id", "cluster", "distance"],
                )

    return cached.mapInArrow(assign, ASSIGNED)


class Clustering:
    """``centroids`` (k x dims), ``rows`` (vec_id, cluster, distance) and ``inertia`` per centroid."""

    def __init__(self, centroids: np.ndarray, rows: DataFrame):
        self.centroids, self.rows = centroids, rows
        found = rows.groupBy("cluster").agg(F.sum("distance")).collect()  # one row per centroid
        self.inertia = [0] * len(centroids)
        for cluster, total in found:
            self.inertia[cluster] = total


def cluster(
    df: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: float = 64.0,
    seed: int = 1, pivots: int = 8,
) -> Clustering:
    """``rounds`` times assign all vectors and move the centroids, then assign once more.

    The pivots are the first ``pivots`` starting centroids; they stay while centroids move.
    """
    vectors = integer_vectors(df, dims, scale)
    centroids = starting_centroids(vectors, k, seed)
    if not len(centroids):
        return Clustering(centroids, vectors.sparkSession.createDataFrame([], ASSIGNED))
    simplex = Simplex(centroids[:pivots])
    cached = pin(_with_pivot_distances(vectors, simplex), "pivot-distances")
    for _ in range(rounds):
        centroids = _updated(cached, simplex, centroids)
    return Clustering(centroids, pin(_assigned(cached, simplex, centroids), "clusters"))


def centroid_digest(centroid: Iterable[int]) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def cluster_digest(df: DataFrame, **options) -> DataFrame:
    """Per vector its cluster and distance, the cluster's and the whole inertia, the centroid's sha256."""
    found = cluster(df, **options)
    if not len(found.centroids):
        own, digest, total = F.lit(None).cast("long"), F.lit(None).cast("string"), 0
    else:
        at = F.col("cluster") + 1
        own = F.element_at(F.array(*[F.lit(n).cast("long") for n in found.inertia]), at)
        digest = F.element_at(F.array(*[F.lit(centroid_digest(c)) for c in found.centroids]), at)
        total = sum(found.inertia)
    return found.rows.select(
        "*",
        own.alias("cluster_inertia"),
        F.lit(total).cast("long").alias("inertia"),
        digest.alias("centroid_sha256"),
    )
