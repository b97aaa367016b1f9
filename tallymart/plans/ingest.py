"""The load job: raw files to raw tables, with a run log."""

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import READERS, read_raw
from ..sources.warehouse import Warehouse, row_counts


def load_raw(warehouse: Warehouse, folder: str, name: str) -> DataFrame:
    """Full refresh of one raw table from its file."""
    return warehouse.write(read_raw(warehouse.spark, folder, name), f"raw.{name}")


def verify_counts(warehouse: Warehouse) -> DataFrame:
    """Rows of the four raw tables."""
    return row_counts({f"raw.{n}": warehouse.read(f"raw.{n}") for n in READERS})


def run_ingest(spark: SparkSession, folder: str, root: str) -> DataFrame:
    """Load all four tables, log the outcome, return the counts.

    A failure is logged as ``failed: <reason>`` and raised again.
    """
    warehouse = Warehouse(spark, root)
    try:
        warehouse.ensure_namespace("raw")
        for name in READERS:
            load_raw(warehouse, folder, name)
        warehouse.log_run("success")
        return verify_counts(warehouse)
    except Exception as error:
        warehouse.log_run(f"failed: {error}")
        raise
