"""RFM scores, customer clusters and segments."""

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..config import CLUSTER_STARTS, CLUSTERS, SEED, SEGMENTS
from ..functions.money import cents, mean_amount, mean_count
from ..functions.scoring import QUINTILE_EDGES
from ..session import pin
from .marts import active_customers
from .ranking import value_percentiles

PARALLEL_FITS = 5
SCORES = ("r_score", "f_score", "m_score")
# score -> (measure column, True if a small value is the good one)
SCORE_OF = {
    "r_score": ("recency_days", True),
    "f_score": ("frequency", False),
    "m_score": ("monetary", False),
}
SEGMENT_COLUMNS = (
    "customer_id",
    "customer_name",
    "city",
    "acquisition_channel",
    "segment",
    "recency_days",
    "frequency",
    "total_revenue",
    *SCORES,
    "rfm_score",
)


def snapshot_of(lifetime: DataFrame) -> Column:
    """The day after the last order, as a scalar subquery."""
    return lifetime.select(F.date_add(F.max("last_order_date"), 1)).scalar()


def rfm_base(lifetime: DataFrame, snapshot: Column | None = None) -> DataFrame:
    """Recency (last order of any status), frequency and monetary value per active customer."""
    snapshot = snapshot_of(lifetime) if snapshot is None else snapshot
    return active_customers(lifetime).select(
        "*",
        F.datediff(snapshot, "last_order_date").alias("recency_days"),
        F.col("completed_orders").alias("frequency"),
        F.col("total_revenue").alias("monetary"),
    )


def score_limits(base: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row: for each score the four measure values at which it changes.

    A score is monotone in its measure, so four limits replace a rank per row and
    no table is joined back to the customers.
    """
    pcts = value_percentiles(base, {m: m for m, _ in SCORE_OF.values()}, ranges)
    limits = []
    for score, (measure, reverse) in SCORE_OF.items():
        own = F.col("measure") == measure
        for i, edge in enumerate(QUINTILE_EDGES):
            if reverse:
                limit = F.min(F.when(own & (1 - F.col("pct") <= edge), F.col("x")))
            else:
                limit = F.max(F.when(own & (F.col("pct") <= edge), F.col("x")))
            limits.append(limit.alias(f"{score}_{i + 1}"))
    return pcts.agg(*limits)


def rfm_scores(base: DataFrame, ranges: int | None = None) -> DataFrame:
    """Scores 1.0 .. 5.0 by percentile rank, and their sum.

    The limits are found first, by two jobs over ``base``; pass a table or a
    pinned frame.  What is returned is then a plain projection of ``base`` that
    any number of later steps can read without another shuffle.
    """
    limits = score_limits(base, ranges).first()
    scores = {}
    for score, (measure, reverse) in SCORE_OF.items():
        x = F.col(measure).cast("double")
        out = F.when(x.isNull(), F.lit(None).cast("double"))
        for i in range(len(QUINTILE_EDGES)):
            limit = limits[f"{score}_{i + 1}"]
            if limit is not None:
                out = out.when(x >= limit if reverse else x <= limit, float(i + 1))
        scores[score] = out.otherwise(5.0)
    return base.withColumns(scores).withColumn(
        "rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score")
    )


def score_distribution(scored: DataFrame) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max of ``rfm_score``.

    Runs on the counts per score value: half-integers from 3 to 15 at most.
    """
    per_score = (
        scored.where(F.col("rfm_score").isNotNull())
        .groupBy("rfm_score")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n, x = F.col("n"), F.col("rfm_score").cast("long")
    stats = per_score.agg(
        F.sum("n").alias("count"),
        F.sum(n * x).alias("s1"),
        F.sum(n * x * x).alias("s2"),
        F.min("rfm_score").alias("min"),
        F.expr("percentile(rfm_score, array(0.25D, 0.5D, 0.75D), n)").alias("q"),
        F.max("rfm_score").alias("max"),
    )
    # exact numerator of n * (n - 1) * variance; decimal, as it outgrows a long
    count, s1, s2 = (F.col(c).cast("decimal(19,0)") for c in ("count", "s1", "s2"))
    spread = count * s2 - s1 * s1
    pairs = F.col("count") * (F.col("count") - 1)
    return stats.select(
        "count",
        F.round(F.col("s1") / F.col("count").cast("double"), 2).alias("mean"),
        F.round(F.sqrt(F.try_divide(spread.cast("double"), pairs.cast("double"))), 2).alias(
            "std"
        ),
        "min",
        F.round(F.col("q")[0], 2).alias("q25"),
        F.round(F.col("q")[1], 2).alias("q50"),
        F.round(F.col("q")[2], 2).alias("q75"),
        "max",
    )


def scorable(scored: DataFrame) -> DataFrame:
    """Rows with all three scores."""
    return scored.na.drop(subset=list(SCORES))


def minmax(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Columns scaled to [0, 1] over the whole table; a constant column becomes 0."""
    ends = df.agg(
        *[F.min(c).alias(f"{c}_lo") for c in columns],
        *[F.max(c).alias(f"{c}_hi") for c in columns],
    )
    out = df.withColumn("ends", ends.select(F.struct("*")).scalar())
    for c in columns:
        lo, hi = F.col(f"ends.{c}_lo"), F.col(f"ends.{c}_hi")
        scaled = F.coalesce(F.try_divide(F.col(c) - lo, hi - lo), F.lit(0.0))
        out = out.withColumn(c + suffix, F.when(F.col(c).isNotNull(), scaled))
    return out.drop("ends")


def score_grid(scored: DataFrame) -> DataFrame:
    """Scaled score combinations with their customer counts: at most 5 x 5 x 5 rows."""
    grid = scorable(scored).groupBy(*SCORES).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return minmax(grid, SCORES)


class Clusters:
    """Centres in the scaled score space and the weighted squared distance to them."""

    def __init__(self, centres: Sequence[Sequence[float]], cost: float):
        self.centres, self.cost = [tuple(map(float, c)) for c in centres], cost

    def nearest(self) -> Column:
        """``(distance, cluster)`` of a row's nearest centre; ties go to the smaller number."""
        costs = []
        for number, centre in enumerate(self.centres):
            parts = [(F.col(f"{c}_scaled") - F.lit(x)) ** 2 for c, x in zip(SCORES, centre)]
            distance = parts[0] + parts[1] + parts[2]
            costs.append(F.struct(distance.alias("distance"), F.lit(number).alias("cluster")))
        return F.array_min(F.array(*costs))


def settle(grid: DataFrame, clusters: Clusters) -> Clusters:
    """Move centres to the weighted means of their points until they stay, which leaves a fixed point.

    The cost falls with each round, so the rounds end; each is one aggregate of at most 125 points.
    One sorted partition, so that sums do not depend on how the points came.  A centre without points
    is dropped.
    """
    grid = grid.coalesce(1).sortWithinPartitions(*SCORES)
    while True:
        near = F.col("near")
        moved = (
            grid.withColumn("near", clusters.nearest())
            .groupBy(near["cluster"].alias("cluster"))
            .agg(
                F.sum("weight").alias("weight"),
                F.sum(F.col("weight") * near["distance"]).alias("cost"),
                *[F.sum(F.col("weight") * F.col(f"{c}_scaled")).alias(c) for c in SCORES],
            )
            .orderBy("cluster")
            .collect()
        )
        centres = [tuple(r[c] / r["weight"] for c in SCORES) for r in moved]
        settled = Clusters(centres, sum(r["cost"] for r in moved))
        if centres == clusters.centres or settled.cost >= clusters.cost:
            return Clusters(clusters.centres, settled.cost)
        clusters = settled


def fit_clusters(
    grid: DataFrame, k: int = CLUSTERS, starts: int = CLUSTER_STARTS, seed: int = SEED
) -> Clusters:
    """The best of ``starts`` weighted k-means fits on the score grid, settled.

    The grid is brought into one sorted partition, so that the result depends on
    the data and the seed alone.
    """
    columns = [f"{c}_scaled" for c in SCORES]
    points = (
        VectorAssembler(inputCols=columns, outputCol="features")
        .transform(grid)
        .coalesce(1)
        .sortWithinPartitions(*SCORES)
        .select("features", "weight")
        .persist()
    )

    def fit(start: int):
        return KMeans(k=k, seed=seed + start, weightCol="weight").fit(points)

    try:
        # Each fit is a chain of tiny jobs; several chains keep the cluster busier.
        with ThreadPool(min(starts, PARALLEL_FITS)) as pool:
            fits = pool.map(inheritable_thread_target(points.sparkSession)(fit), range(starts))
        best = min(fits, key=lambda m: m.summary.trainingCost)
        return settle(grid, Clusters(best.clusterCenters(), float("inf")))
    finally:
        points.unpersist()


def assign_clusters(scored: DataFrame, grid: DataFrame, clusters: Clusters) -> DataFrame:
    """Append ``cluster``; the lookup has one row per grid point (<= 125)."""
    cells = grid.select(*SCORES, clusters.nearest()["cluster"].alias("cluster"))
    return scored.join(F.broadcast(cells), list(SCORES), "left")


def cluster_certificate(clustered: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """One row that proves a clustering a fixed point of k-means, from the customers alone.

    Centres are taken anew as the means of the scaled scores per cluster; ``misplaced`` customers lie
    nearer to another centre than to their own.  The centres, one row per cluster, are one scalar.
    """
    rows = minmax(scorable(clustered).where(F.col("cluster").isNotNull()), SCORES)
    means = rows.groupBy("cluster").agg(*[F.avg(f"{c}_scaled").alias(c) for c in SCORES])
    centres = means.agg(F.collect_list(F.struct("cluster", *SCORES)).alias("centres")).scalar()

    def distance(centre: Column) -> Column:
        parts = [(F.col(f"{c}_scaled") - centre[c]) ** 2 for c in SCORES]
        return parts[0] + parts[1] + parts[2]

    own = F.filter("centres", lambda c: c["cluster"] == F.col("cluster"))[0]
    least = F.array_min(F.transform("centres", distance))
    return (
        rows.withColumn("centres", centres)
        .select("cluster", distance(own).alias("own"), least.alias("least"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.count_distinct("cluster").alias("clusters"),
            F.count_if(F.col("own") > F.col("least") + tolerance).alias("misplaced"),
        )
    )


def cluster_summary(clustered: DataFrame) -> DataFrame:
    """Size and four means per cluster, to one decimal."""
    return (
        clustered.where(F.col("cluster").isNotNull())
        .groupBy("cluster")
        .agg(
            F.count("customer_id").alias("count"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("recency_days").cast("long")).alias("recency"),
            F.sum("frequency").alias("frequency"),
            F.sum(cents(F.col("monetary"))).alias("cents"),
            F.sum(F.col("rfm_score").cast("long")).alias("rfm"),
        )
        .select(
            "cluster",
            "count",
            mean_count(F.col("recency"), F.col("rows")).alias("avg_recency"),
            mean_count(F.col("frequency"), F.col("rows")).alias("avg_frequency"),
            mean_amount(F.col("cents"), F.col("rows"), 1).alias("avg_revenue"),
            mean_count(F.col("rfm"), F.col("rows")).alias("avg_rfm"),
        )
    )


def cluster_labels(summary: DataFrame, labels: Sequence[str] = SEGMENTS) -> DataFrame:
    """``(cluster, segment)``: labels in order of falling mean score.

    The window runs over one row per cluster.  A cluster beyond the last label
    gets none.
    """
    place = F.row_number().over(Window.orderBy(F.desc("avg_rfm"), "cluster"))
    names: Mapping[int, str] = dict(enumerate(labels, start=1))
    ranked = summary.select("cluster", place.alias("place"))
    segment = F.lit(None).cast("string")
    for i, label in names.items():
        segment = F.when(F.col("place") == i, label).otherwise(segment)
    return ranked.select("cluster", segment.alias("segment"))


def label_segments(clustered: DataFrame, labels: Sequence[str] = SEGMENTS) -> DataFrame:
    """Append ``segment``; the lookup has one row per cluster."""
    names = cluster_labels(cluster_summary(clustered), labels)
    return clustered.join(F.broadcast(names), "cluster", "left")


def segment_mart(labelled: DataFrame) -> DataFrame:
    """The segment mart's columns."""
    return labelled.withColumn("total_revenue", F.col("monetary")).select(*SEGMENT_COLUMNS)


def customer_segments(
    lifetime: DataFrame,
    snapshot: Column | None = None,
    k: int = CLUSTERS,
    starts: int = CLUSTER_STARTS,
    seed: int = SEED,
) -> DataFrame:
    """Lifetime mart to segment mart."""
    scored = rfm_scores(pin(rfm_base(lifetime, snapshot)))
    grid = pin(score_grid(scored))
    model = fit_clusters(grid, k, starts, seed)
    return segment_mart(label_segments(assign_clusters(scored, grid, model)))


def segment_checks(mart: DataFrame) -> DataFrame:
    """One row: customers, segments, and the segments whose mean score is not below the one before.

    ``untidy`` customers break the mart's definition: no segment, or a sum that is not their scores'.
    """
    place = F.array_position(F.lit(list(SEGMENTS)), F.col("segment"))
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    means = mart.groupBy(place.alias("place")).agg(
        F.count(F.lit(1)).alias("n"),
        mean_count(F.sum(F.col("rfm_score").cast("long")), F.count(F.lit(1))).alias("mean"),
        F.count_if(F.col("segment").isNull() | (F.col("rfm_score") != total)).alias("untidy"),
    )
    before = F.lag("mean").over(Window.orderBy("place"))  # one row per segment
    return means.select("*", (F.col("mean") > before).alias("rises")).agg(
        F.sum("n").alias("customers"),
        F.count(F.lit(1)).alias("segments"),
        F.count_if("rises").alias("misordered"),
        F.sum("untidy").alias("untidy"),
    )
