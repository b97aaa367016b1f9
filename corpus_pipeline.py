"""From raw documents to packed training sequences, one operator per stage.

Each stage reads what the one before it stored and keeps the columns of ``documents``.
Of equal texts and of near copies exactly one row stays, also among rows that repeat a doc_id or
have none: decisions name rows, not documents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.catalog import word_bpe
from tallymart.llm.common import table
from tallymart.llm.decontaminate import without_contaminated
from tallymart.llm.exact_dedup import text_owners
from tallymart.llm.packing import packed_pieces
from tallymart.llm.quality import fit, quality_score
from tallymart.llm.simhash import kept_rows
from tallymart.session import pin

#: Rows and bytes that a task hands to Python at once: texts are long, and Spark's own limit of
#: 10,000 rows would hold tens of megabytes several times over, in the JVM and in the worker.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def bound_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batch limits; they change no result."""
    for key, most in BATCHES.items():
        spark.conf.set(key, most)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the compression classifier rejects."""
    bound_batches(spark)
    model = fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_score(model, docs["text"]) >= 0.5)


#: A number of every row, for as long as a stage needs it.
ROW = "_pipeline_row"


def numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number each, stored, so that every reader sees the same numbers."""
    return pin(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def only(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows that ``kept`` names.  Both joins are on a key that no row shares."""
    gone = rows.select(ROW).join(kept.select(F.col("keep_row").alias(ROW)), ROW, "left_anti")
    return rows.join(gone, ROW, "left_anti").drop(ROW)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every distinct text."""
    bound_batches(spark)
    rows = numbered(docs)
    return only(rows, text_owners(rows, ROW)).select(docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every group of near copies, one with the smallest doc_id."""
    bound_batches(spark)
    rows = numbered(docs)
    return only(rows, kept_rows(rows, ROW, shingle=3, distance=2)).select(docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold passages of the benchmark."""
    bound_batches(spark)
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their digest, sequence and offset of every piece of the documents that are left."""
    bound_batches(spark)
    return packed_pieces(docs, word_bpe()).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash", simhash_stage),
    ("decontaminate", benchmark_stage),
    ("packing", packing_stage),
]

#: The classifier, the fingerprints and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; every stage is stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
