"""Weighted shards by rendezvous hashing of stable record keys.

Every shard draws a number from the record's key and its own name, and the record goes to the shard
with the least ``-ln(draw) / weight``.  A record's draws do not depend on the other shards, so one
more shard, or a larger weight, moves records into that shard only, and each shard gets its weight's
share of all records.

The rows are written as one folder per shard.  They are dealt to tasks by ranges of (shard, key), so a
shard is not one task, and a key that a third of all rows repeat is spread as well: the row's number
is the last part of the range key.  A manifest, one row per range and shard, turns places in the files
into slots.

Defined results: a row without a key is placed by its text's digest.  Null and empty texts count as
empty, repeated rows each have a slot, rows of one key are ordered by their text's crc32.  Within a
shard, slots follow the key.  All columns of the input are kept inside ``record``, whatever their names.
An empty table gives empty shards.  A text of any length is one value, never cut.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Hex digits of a draw: their bits and a half fit a double exactly.
DRAW_DIGITS = 13
#: monotonically_increasing_id keeps the task above this bit and the row of the task below it.
TASK_BIT = 33


def draw(key: Column, shard: Column) -> Column:
    """A number in (0, 1) that depends on the key and the shard alone."""
    digest = F.md5(F.concat(key, F.lit(":"), shard.cast("string")).cast("binary"))
    number = F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("long").cast("double")
    return (number + F.lit(0.5)) / F.lit(float(16**DRAW_DIGITS))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard, 0 .. len(weights) - 1, of a text key; ties go to the smaller shard.

    A shard of weight 0 gets no record.
    """
    if not all(math.isfinite(w) and w >= 0 for w in weights) or not any(weights):
        raise ValueError("weights must be finite, not negative and not all 0")
    shards = F.array(
        *[
            F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight"))
            for i, w in enumerate(weights)
            if w
        ]
    )
    costs = F.transform(
        shards,
        lambda s: F.struct(
            (-F.ln(draw(key, s["shard"])) / s["weight"]).alias("cost"), s["shard"].alias("shard")
        ),
    )
    return F.array_min(costs)["shard"]


def whole_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def stable_key(key: Column, text: Column) -> Column:
    """The key as text; without one, a digest of the record's text."""
    return F.coalesce(key.cast("string"), F.concat(F.lit("text:"), F.md5(whole_text(text).cast("binary"))))


def write_shards(
    df: DataFrame, folder: str, weights: Sequence[float], key: str = "doc_id", text: str = "text"
) -> None:
    """Write the rows as ``folder/shard=N``, sorted by key, with their place in the writing tasks."""
    order = ["shard", "key", "sum", "row"]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("record"))
    own, body = F.col("record")[key], F.col("record")[text]
    (
        rows.select(
            "record",
            rendezvous(stable_key(own, body), weights).alias("shard"),
            own.alias("key"),
            F.crc32(whole_text(body).cast("binary")).alias("sum"),
            F.monotonically_increasing_id().alias("row"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("record", F.monotonically_increasing_id().alias("place"), "shard")
        .write.partitionBy("shard")
        .parquet(folder)
    )


def _files(spark: SparkSession, folder: str, record: T.DataType) -> DataFrame:
    schema = T.StructType().add("record", record).add("place", T.LongType()).add("shard", T.IntegerType())
    return spark.read.schema(schema).parquet(folder)


def manifest(files: DataFrame) -> DataFrame:
    """``shard, task, first_place, first_slot, rows``: one row per shard and per task that holds part of it.

    Ranges follow (shard, key), so there are fewer rows than tasks and shards together.
    """
    parts = files.groupBy("shard", F.shiftright("place", TASK_BIT).alias("task")).agg(
        F.min("place").alias("first_place"), F.count(F.lit(1)).alias("rows")
    )
    before = (
        Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.coalesce(F.sum("rows").over(before), F.lit(0).cast("long"))
    return parts.withColumn("first_slot", first)


def read_shards(spark: SparkSession, folder: str, record: T.DataType) -> DataFrame:
    """``shard, slot, record`` of a folder that :func:`write_shards` wrote; slots count from 0 per shard."""
    files = _files(spark, folder, record)
    places = manifest(files).select("shard", "task", "first_place", "first_slot")
    return (
        files.withColumn("task", F.shiftright("place", TASK_BIT))
        .join(F.broadcast(places), ["shard", "task"])  # bounded by tasks and shards, see manifest
        .select("shard", (F.col("place") - F.col("first_place") + F.col("first_slot")).alias("slot"), "record")
    )


def shard_digest(df: DataFrame, folder: str, shards: int, overhead: int = 8) -> DataFrame:
    """Write and read ``shards`` equal shards: size, crc32, shard, slot and the shard under one more."""
    write_shards(df, folder, [1.0] * shards)
    record = T.StructType(df.schema.fields)
    rows = read_shards(df.sparkSession, folder, record)
    key, text = F.col("record.doc_id").cast("long"), F.col("record.text")
    body = whole_text(text)
    return rows.select(
        key.alias("doc_id"),
        (F.octet_length(body) + overhead).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        rendezvous(stable_key(key, text), [1.0] * (shards + 1)).alias("grown_shard"),
    )
