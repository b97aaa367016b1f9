"""Helpers that several operators of this package share."""

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes.split() and bytes.translate() treat exactly these as white space.
SPACES = b"\x20\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """The two columns that the operators on documents read."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def keyed_documents(docs: DataFrame, row: str | None) -> DataFrame:
    """``documents`` and, as row_key, the column that tells rows apart; null without one."""
    key = F.col(row) if row else F.lit(None)
    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), key.cast("long").alias("row_key")
    )


def raw_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return [b or b"" for b in column.cast(pa.large_binary() if large else pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` has about ``most`` bytes in each; one long row may have more."""
    for batch in batches:
        if not batch.num_rows:
            continue
        begin, held = 0, 0
        sizes = [0 if n is None else n for n in pc.binary_length(batch.column(column)).to_pylist()]
        for row, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size
        yield batch.slice(begin)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hex_long(column: Column) -> Column:
    """A long as 16 lower-case hex digits of its unsigned value."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
