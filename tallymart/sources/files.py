"""Readers for the raw CSV and JSON-lines files and for exported marts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import NULL_TOKENS, RAW_SCHEMAS


def _struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def read_csv(spark: SparkSession, path: str, ddl: str, multiline: bool = False) -> DataFrame:
    """CSV with a header whose names must equal the declared ones.

    Fields are read as text, null tokens become NULL, and the rest is cast; a
    malformed line or value fails the job.  ``multiline`` admits line breaks inside
    quotes, at the price of one task per file.
    """
    schema = _struct(ddl)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    return rows.select(
        *[
            F.when(~F.col(f.name).isin(*NULL_TOKENS), F.col(f.name))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def read_products(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv(spark, path, RAW_SCHEMAS["products"], **options)


def read_customers(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv(spark, path, RAW_SCHEMAS["customers"], **options)


def read_orders(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv(spark, path, RAW_SCHEMAS["orders"], **options)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line; a malformed line fails the job."""
    return (
        spark.read.schema(_struct(RAW_SCHEMAS["events"])).option("mode", "FAILFAST").json(path)
    )


READERS = {
    "products": (read_products, "products.csv"),
    "customers": (read_customers, "customers.csv"),
    "orders": (read_orders, "orders.csv"),
    "events": (read_events, "events.jsonl"),
}


def read_raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One raw table from its file under ``folder``."""
    reader, file = READERS[name]
    return reader(spark, f"{folder}/{file}")
