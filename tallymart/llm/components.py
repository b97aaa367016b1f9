"""Connected components by alternating large and small stars.

Every round is a minimum per node, which Spark combines before the shuffle, and a join, so a
node with very many links is no task of its own.  Rounds are stored, not kept as lineage.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_scratch, scratch_folder


def _larger_first(edges: DataFrame) -> DataFrame:
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours move to the smallest of a node and its neighbours."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return around.where(F.col("v") > F.col("u")).join(least, "u").select(
        F.col("v").alias("a"), F.col("m").alias("b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours and the node itself move to the smallest neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.count_distinct("v")
    ).first()
    return tuple(row)


def _stored(edges: DataFrame) -> tuple[str, DataFrame]:
    folder = scratch_folder(edges.sparkSession, "edges")
    edges.write.parquet(folder)
    return folder, edges.sparkSession.read.schema(edges.schema).parquet(folder)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of the edges (a, b); the root is the smallest node."""
    folder, edges = _stored(_larger_first(links))
    state = _state(edges)
    while state[0]:
        newer, edges = _stored(_larger_first(_small_star(_larger_first(_large_star(edges)))))
        drop_scratch(folder)
        folder, older, state = newer, state, _state(edges)
        if state == older:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionAll(edges.select("v", "v").distinct())
