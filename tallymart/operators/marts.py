"""The three revenue marts.

Each mart has two forms with equal results:

* ``*_mart(enriched)`` groups the enriched order view.  It holds for any
  dimension tables, repeated keys included.
* ``*_mart_from_staging(...)`` is the form for large data.  It needs the
  dimension keys to be unique (a declared column test, see ``quality``).  Only
  the bare key of a dimension meets the order lines; names and other attributes
  are joined after the rows have shrunk to one per customer or product.  A hot
  key never lands in one task: lines are first combined per (key, order), which
  spreads it, and after that each map task sends one row per key.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import amount, mean_amount
from .enrich import CUSTOMER_COLUMNS
from .staging import completed, revenue_cents

PRODUCT_KEYS = ("product_id", "product_name", "category", "margin_pct")


def _money_columns(total: Column, lines: Column) -> list[Column]:
    return [
        amount(total).alias("total_revenue"),
        mean_amount(total, lines).alias("avg_order_value"),
    ]


def daily_revenue_mart(enriched: DataFrame) -> DataFrame:
    """Completed revenue per day."""
    return (
        completed(enriched)
        .groupBy("order_date")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.sum(revenue_cents()).alias("cents"),
            F.count("line_revenue").alias("lines"),
        )
        .select(
            "order_date",
            "total_orders",
            "unique_customers",
            *_money_columns(F.col("cents"), F.col("lines")),
        )
    )


def _with_known_id(orders: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Order lines with ``known_id``: their key if the dimension has it, else NULL.

    Only the bare key of the dimension meets the order lines.  It is broadcast if
    it is small enough; otherwise sort-merged, where AQE splits a hot key on the
    order side.  That needs plain shuffles on both sides, so the keys are not made
    distinct first.
    """
    ids = dimension.select(F.col(key).alias("known_id"))
    return orders.join(ids, orders[key] == ids["known_id"], "left")


def _completed_cents(orders: DataFrame) -> DataFrame:
    """Completed lines with their ``cents``, made before the lines are shuffled: whole numbers pack tighter."""
    return completed(orders).withColumn("cents", revenue_cents())


def daily_revenue_mart_from_staging(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Completed revenue per day; neither customer attributes nor products are read.

    Both distinct counts and the sums come from one pass: lines are combined per
    (day, order) and (day, customer) before they are shuffled, so a day with a
    third of all lines is spread over all tasks.
    """
    return (
        _with_known_id(_completed_cents(orders), customers, "customer_id")
        .groupBy("order_date")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("known_id").alias("unique_customers"),
            F.sum("cents").alias("cents"),
            F.count(F.lit(1)).alias("lines"),
        )
        .select(
            "order_date",
            "total_orders",
            "unique_customers",
            *_money_columns(F.col("cents"), F.col("lines")),
        )
    )


def _lifetime_columns() -> list[Column]:
    return [
        F.col("total_orders"),
        F.col("completed_orders"),
        amount(F.col("cents")).alias("total_revenue"),
        mean_amount(F.col("cents"), F.col("lines")).alias("avg_order_value"),
        F.col("first_order_date"),
        F.col("last_order_date"),
        F.col("last_order_date").alias("most_recent_order"),
    ]


def customer_lifetime_mart(enriched: DataFrame) -> DataFrame:
    """Orders of any status per customer; money from completed lines only."""
    done = F.col("is_completed")
    return (
        enriched.groupBy(*CUSTOMER_COLUMNS)
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct(F.when(done, F.col("order_id"))).alias("completed_orders"),
            F.sum(F.when(done, revenue_cents()).otherwise(0)).alias("cents"),
            F.count(F.when(done, F.col("line_revenue"))).alias("lines"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
        .select(*CUSTOMER_COLUMNS, *_lifetime_columns())
    )


def customer_lifetime_mart_from_staging(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders of any status per customer, attributes joined last."""
    done = F.col("is_completed")
    cents_done = F.when(done, revenue_cents()).otherwise(0)
    per_order = (
        _with_known_id(orders.withColumn("cents", cents_done), customers, "customer_id")
        .groupBy("known_id", "order_id")
        .agg(
            F.max(done.cast("int")).alias("done"),
            F.sum("cents").alias("cents"),
            F.count_if(done).alias("lines"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    per_customer = per_order.groupBy("known_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("done").alias("completed_orders"),
        F.sum("cents").alias("cents"),
        F.sum("lines").alias("lines"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
    )
    c = customers.select(*CUSTOMER_COLUMNS)
    return per_customer.join(c, per_customer["known_id"] == c["customer_id"], "left").select(
        *CUSTOMER_COLUMNS, *_lifetime_columns()
    )


def _product_columns() -> list[Column]:
    return [
        F.col("total_orders"),
        F.col("units_sold"),
        *_money_columns(F.col("cents"), F.col("lines")),
    ]


def product_performance_mart(enriched: DataFrame) -> DataFrame:
    """Completed sales per product."""
    return (
        completed(enriched)
        .groupBy(*PRODUCT_KEYS)
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum(F.col("quantity").cast("long")).alias("units_sold"),
            F.sum(revenue_cents()).alias("cents"),
            F.count("line_revenue").alias("lines"),
        )
        .select(*PRODUCT_KEYS, *_product_columns())
    )


def product_performance_mart_from_staging(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Completed sales per product, attributes joined last."""
    per_order = (
        _with_known_id(_completed_cents(orders), products, "product_id")
        .groupBy("known_id", "order_id")
        .agg(
            F.sum(F.col("quantity").cast("long")).alias("units_sold"),
            F.sum("cents").alias("cents"),
            F.count(F.lit(1)).alias("lines"),
        )
    )
    per_product = per_order.groupBy("known_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("units_sold").alias("units_sold"),
        F.sum("cents").alias("cents"),
        F.sum("lines").alias("lines"),
    )
    p = products.select(*PRODUCT_KEYS)
    return per_product.join(p, per_product["known_id"] == p["product_id"], "left").select(
        *PRODUCT_KEYS, *_product_columns()
    )


def category_daily_revenue(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Completed revenue per known category and day; lines are added up per product before they join."""
    per_product = (
        completed(orders).groupBy("product_id", "order_date").agg(F.sum(revenue_cents()).alias("cents"))
    )
    named = products.where(F.col("category").isNotNull()).select("product_id", "category")
    return (
        per_product.join(named, "product_id")
        .groupBy("category", "order_date")
        .agg(amount(F.sum("cents")).alias("total_revenue"))
    )


# The columns the segment and churn models read from the lifetime mart.
ACTIVE_COLUMNS = (
    *CUSTOMER_COLUMNS,
    "total_orders",
    "completed_orders",
    "total_revenue",
    "avg_order_value",
    "first_order_date",
    "last_order_date",
)


def active_customers(lifetime: DataFrame) -> DataFrame:
    """Customers with a completed order."""
    return lifetime.where(F.col("completed_orders") > 0).select(*ACTIVE_COLUMNS)
