"""Tables under one root folder, and the exports made from them.

A table ``layer.name`` lives in ``<root>/<layer>/<name>``, so any later session finds it without a
catalog.  Each full load writes a folder ``version-<n>`` of its own there, and a table is its newest
version that is complete, which Spark marks with ``_SUCCESS`` as the last thing it writes.  A load
that fails halfway thus leaves the old rows readable, and none of its own are seen.  The version
before the newest is kept for readers that still hold it.  Each write also registers the temp view
``<layer>_<name>`` for SQL users of the running session.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import quality_report
from .files import read_csv
from .schemas import RUN_LOG_SCHEMA

RUN_LOG = "raw.pipeline_runs"
VERSION = "version-"

# Column types of the exported files.
EXPORT_SCHEMAS = {
    "mart_daily_revenue": (
        "order_date date, total_orders bigint, unique_customers bigint, "
        "total_revenue double, avg_order_value double"
    ),
    "mart_customer_segments": (
        "customer_id string, customer_name string, city string, acquisition_channel string, "
        "segment string, recency_days int, frequency bigint, total_revenue double, "
        "r_score double, f_score double, m_score double, rfm_score double"
    ),
    "mart_revenue_forecast": (
        "forecast_date date, predicted_revenue double, lower_bound double, "
        "upper_bound double, record_type string"
    ),
    "mart_churn_predictions": (
        "customer_id string, customer_name string, city string, acquisition_channel string, "
        "completed_orders bigint, total_revenue double, days_since_last_order int, "
        "churn_probability double, churn_label int, churn_risk string"
    ),
    "mart_product_performance": (
        "product_id string, product_name string, category string, margin_pct double, "
        "total_orders bigint, units_sold double, total_revenue double, avg_order_value double"
    ),
    "stg_customers": (
        "customer_id string, customer_name string, email string, city string, "
        "signup_date date, acquisition_channel string"
    ),
    "stg_orders": (
        "order_id string, customer_id string, product_id string, order_date date, "
        "quantity int, unit_price double, line_revenue double, status string, "
        "is_completed boolean"
    ),
    "stg_products": (
        "product_id string, product_name string, category string, cost_price double, "
        "list_price double, gross_margin double, margin_pct double"
    ),
}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        layer, name = table.split(".", 1)
        return f"{self.root}/{layer}/{name}"

    def ensure_namespace(self, layer: str) -> None:
        """A catalog database whose tables live under the layer's folder."""
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{layer}` LOCATION '{self.root}/{layer}'"
        )

    def _files(self, path: str):
        """The path as Hadoop sees it, and its file system."""
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self, table: str) -> dict[int, bool]:
        """Numbers of the stored versions, and whether each is complete."""
        path, files = self._files(self.path(table))
        if not files.exists(path):
            return {}
        names = [entry.getPath().getName() for entry in files.listStatus(path)]
        numbers = [int(n.removeprefix(VERSION)) for n in names if n.startswith(VERSION)]
        return {n: files.exists(self._files(f"{self._version(table, n)}/_SUCCESS")[0]) for n in numbers}

    def _version(self, table: str, number: int) -> str:
        return f"{self.path(table)}/{VERSION}{number:08d}"

    def current(self, table: str) -> str:
        """Folder of the newest complete version; a table that is only appended to has none."""
        found = self.versions(table)
        path, files = self._files(self.path(table))
        if not found and files.exists(path):
            return self.path(table)
        complete = [n for n, done in found.items() if done]
        if not complete:
            raise FileNotFoundError(f"table {table} has not been loaded under {self.root}")
        return self._version(table, max(complete))

    def write(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Full refresh of a table; returns the stored rows.

        One load of a table runs at a time.  ``df`` may read the table itself.
        """
        before = self.versions(table)
        writer = df.write.mode("error")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self._version(table, max(before, default=0) + 1))
        complete = [n for n, done in before.items() if done]
        for number in set(before) - {max(complete, default=0)}:  # older ones and failed loads
            path, files = self._files(self._version(table, number))
            files.delete(path, True)
        return self.as_view(self.read(table), table.replace(".", "_"))

    def append(self, df: DataFrame, table: str) -> None:
        df.write.mode("append").parquet(self.path(table))

    def read(self, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        df = self.spark.read.parquet(self.current(table))
        return df if columns is None else df.select(*columns)

    def as_view(self, df: DataFrame, name: str) -> DataFrame:
        """Lazy materialisation: the query is run anew by each reader."""
        df.createOrReplaceTempView(name)
        return df

    def as_table(self, df: DataFrame, table: str) -> DataFrame:
        """Eager materialisation as a catalog table."""
        self.ensure_namespace(table.split(".", 1)[0])
        df.write.mode("overwrite").saveAsTable(table)
        return self.spark.table(table)

    def log_run(self, status: str) -> None:
        """One appended row; the status may hold any text."""
        row = self.spark.createDataFrame([(status,)], "status string").select(
            F.current_timestamp().cast("string").alias("run_time"), "status"
        )
        self.append(row, RUN_LOG)

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUN_LOG_SCHEMA).parquet(self.path(RUN_LOG))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, rows)`` per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def export_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header, as many as the frame has partitions."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_mart_csv(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An exported table, typed, from ``<folder>/<name>.csv``."""
    return read_csv(spark, f"{folder}/{name}.csv", EXPORT_SCHEMAS[name])


def write_quality_report(results: DataFrame, path: str) -> None:
    """The report as one JSON object."""
    quality_report(results).write.mode("overwrite").json(path)

