"""Incremental event load: new files only, one row per event, daily counts.

An event is told by its day and event_id.  Of rows that repeat one, the row stored first stays;
within a batch that is the one with the least (event_time, then the other columns).  An id that comes
back with another day is another event.  Rows of any lateness are kept.

Both loads run with ``availableNow``: each start takes the files that arrived since the last one and
stops.  Stored events are partitioned by day and batch.  A batch reads the ids of the days it touches
and no other partition, and writes partitions of its own, so a batch that is run again after a failure
replaces what it wrote.  Counts are kept as one addend per batch, taken from the rows that were really
new: a late event adds to them without an event of its day being counted again.
Days are those of the zone-less event time, whatever the session's time zone.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.staging import stage_events
from ..sources.schemas import RAW_SCHEMAS

DAY, ID, BATCH = "event_date", "event_id", "batch"


def read_event_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    """New JSON-lines event files of a folder."""
    reader = spark.readStream.schema(T.StructType.fromDDL(RAW_SCHEMAS["events"]))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("mode", "FAILFAST").json(folder)


def daily_counts(staged: DataFrame) -> DataFrame:
    """Events per day and type."""
    return staged.groupBy(DAY, "event_type").agg(F.count(F.lit(1)).alias("events"))


def first_per_event(staged: DataFrame) -> DataFrame:
    """One row per day and event_id: the least by time, then by the other columns."""
    rest = ["event_time", *[c for c in staged.columns if c not in (DAY, ID, "event_time")]]
    least = staged.groupBy(DAY, ID).agg(F.min(F.struct(*rest)).alias("least"))
    return least.select(DAY, ID, "least.*").select(*staged.columns)


def stored_events(spark: SparkSession, schema: T.StructType, target: str) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(target)


def new_events(batch: DataFrame, stored: DataFrame, number: int) -> DataFrame:
    """The batch's events that no other batch has stored; reads the touched days' partitions only.

    The touched days, of which a batch has as many as the calendar at most, become a partition filter.
    """
    days = [r[0] for r in batch.select(DAY).distinct().collect()]
    touched = F.col(DAY).isin([d for d in days if d is not None])
    if None in days:
        touched = touched | F.col(DAY).isNull()
    known = stored.where(touched & (F.col(BATCH) != number)).select(
        F.col(DAY).alias("known_day"), F.col(ID).alias("known_id")
    )
    first = first_per_event(batch)
    return first.join(
        known, first[DAY].eqNullSafe(known["known_day"]) & (first[ID] == known["known_id"]), "left_anti"
    )


def _replace(df: DataFrame, number: int, folder: str, *partitions: str) -> None:
    df.withColumn(BATCH, F.lit(number).cast("long")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partitions, BATCH).parquet(folder)


def load_batch(batch: DataFrame, number: int, target: str, counts: str | None = None) -> None:
    """Store a batch of staged events and, with ``counts``, what it adds to the daily counts."""
    batch = batch.persist()
    found = new_events(batch, stored_events(batch.sparkSession, batch.schema, target), number).persist()
    # Counts first: writing to the folder that ``found`` was compared with makes Spark drop its cache.
    if counts:
        _replace(daily_counts(found).coalesce(1), number, counts)  # a row per day and type
    # rebalanced by day: few files a day, and a day with many events is split
    _replace(found.hint("rebalance", DAY), number, target, DAY)
    found.unpersist()
    batch.unpersist()


def load_available(
    raw: DataFrame, target: str, state: str, counts: str | None = None
) -> StreamingQuery:
    """Add new events to the Parquet folder ``target``, one partition per day and batch, then stop.

    With ``counts``, each batch also leaves there what it adds to the daily counts.
    """
    staged = stage_events(raw)
    empty = raw.sparkSession.createDataFrame([], staged.schema)
    # so that the first batch can read the folders; the batch number is one that no batch has
    empty.withColumn(BATCH, F.lit(-1).cast("long")).write.mode("append").partitionBy(DAY, BATCH).parquet(target)
    if counts:
        none = daily_counts(empty).withColumn(BATCH, F.lit(-1).cast("long"))
        none.write.mode("append").partitionBy(BATCH).parquet(counts)
    query = (
        staged.writeStream.foreachBatch(lambda df, number: load_batch(df, number, target, counts))
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_events_table(spark: SparkSession, raw: DataFrame, target: str) -> DataFrame:
    """The stored events, in the staged columns' order."""
    schema = stage_events(raw).schema
    return stored_events(spark, schema, target).select(*schema.names)


def read_daily_counts(spark: SparkSession, counts: str) -> DataFrame:
    """Events per day and type: the sum of what the batches added."""
    added = spark.read.schema(f"{DAY} date, event_type string, events long, {BATCH} long").parquet(counts)
    return added.groupBy(DAY, "event_type").agg(F.sum("events").alias("events"))
