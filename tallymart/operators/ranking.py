"""Percentile ranks over a whole table without a single-task window.

Rows are first counted per distinct value, so a value that holds a third of all rows is one counted
row.  The distinct values are dealt by ranges of (measure, value): Spark samples the counted values
themselves, so ranges are balanced however the rows are spread over them.  The ranges are stored, so
that every later step sees the same ones; running totals are taken inside each and shifted by the
totals of the ranges before it.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin


def value_counts(df: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    """``(measure, x, n)``: rows per distinct non-null value of each measure.

    ``measures`` maps a measure name to its column.
    """
    wide = df.select(*[F.col(c).cast("double").alias(m) for m, c in measures.items()])
    return (
        wide.unpivot([], list(measures), "measure", "x")
        .where(F.col("x").isNotNull())
        .groupBy("measure", "x")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def running_totals(
    counts: DataFrame, totals: Sequence[str] = ("n",), ranges: int | None = None
) -> DataFrame:
    """Add ``<t>_before`` and ``<t>_total`` per measure for every ``t`` in ``totals``.

    ``counts`` has one row per (measure, x).  ``ranges`` is the number of ranges, by default that of
    shuffle partitions, fewer where adaptive execution joins small ones; it changes no result.
    """
    order = ("measure", "x")
    dealt = counts.repartitionByRange(*([ranges] if ranges else []), *order)
    cut = pin(dealt.withColumn("part", F.spark_partition_id()), "ranges")
    inside = (
        Window.partitionBy("part", "measure")
        .orderBy("x")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = cut.select("*", *[F.sum(t).over(inside).alias(f"{t}_inside") for t in totals])

    # A range holds one measure or the seam of a few: at most as many rows as ranges and measures.
    per_part = cut.groupBy("measure", "part").agg(*[F.sum(t).alias(t) for t in totals])
    across = Window.partitionBy("measure")
    earlier = across.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "measure",
        "part",
        *[F.sum(t).over(earlier).alias(f"{t}_offset") for t in totals],
        *[F.sum(t).over(across).alias(f"{t}_total") for t in totals],
    )
    zero = F.lit(0).cast("long")
    return ranked.join(F.broadcast(offsets), ["measure", "part"]).select(
        *counts.columns,
        *[
            (F.coalesce(f"{t}_offset", zero) + F.coalesce(f"{t}_inside", zero)).alias(
                f"{t}_before"
            )
            for t in totals
        ],
        *[f"{t}_total" for t in totals],
    )


def value_percentiles(
    df: DataFrame, measures: Mapping[str, str], ranges: int | None = None
) -> DataFrame:
    """``(measure, x, n, n_total, pct)``: average rank of each distinct value over n.

    Ties share the mean of their ranks.
    """
    ranks = running_totals(value_counts(df, measures), ranges=ranges)
    pct = (F.col("n_before") + (F.col("n") + 1) / F.lit(2.0)) / F.col("n_total")
    return ranks.select("measure", "x", "n", "n_total", pct.alias("pct"))


def percentile_rank(
    df: DataFrame, columns: Mapping[str, str], ranges: int | None = None
) -> DataFrame:
    """Append the percentile rank of each input column as a row-level column.

    ``columns`` maps an output name to an input column; NULL values get a NULL rank.  The ranks of the
    distinct values are stored and looked up by a left join on the bare value, so that adaptive
    execution can split a value, or NULL, that many rows share.
    """
    ranks = pin(value_percentiles(df, columns, ranges), "ranks")
    for name, column in columns.items():
        own = ranks.where(F.col("measure") == name)
        lookup = own.select(F.col("x").alias("look_x"), F.col("pct").alias(name))
        df = df.join(lookup, F.col(column).cast("double") == F.col("look_x"), "left").select(
            *df.columns, name
        )
    return df
