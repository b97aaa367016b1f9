"""The four raw retail tables, derived from a TPC-H-like star schema.

One order line becomes one raw order.  Prices are computed in integer cents:
the unit price is the part's list price less the line's discount, the cost is a
share of the list price that grows with the part's size.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import amount, cents, half_up_div

FIRST_DAY = "1995-01-01"

# Declared, so that no job has to open the files for their schema.
SCHEMAS = {
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line.

    The lines meet their part first, so that the second shuffle carries a price and no order
    columns, and come out of the join with their orders in order of the order key.
    """
    line = table(spark, folder, "lineitem")
    head = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, folder, "part").select("p_partkey", "p_retailprice")
    price = half_up_div(
        cents(F.col("p_retailprice")) * (100 - cents(F.col("l_discount"))), F.lit(100)
    )
    status = (
        F.when(F.col("l_returnflag") == "N", "completed")
        .when(F.col("l_returnflag") == "R", "returned")
        .when(F.col("l_returnflag") == "A", "pending")
    )
    priced = line.join(part, line["l_partkey"] == part["p_partkey"], "left").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        price.alias("price"),
        "l_returnflag",
    )
    return priced.join(head, priced["l_orderkey"] == head["o_orderkey"], "left").select(
        F.concat(F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        "quantity",
        amount(F.col("price")).alias("unit_price"),
        status.alias("status"),
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    first = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.min(F.col("o_orderdate").cast("date")).alias("first_date"))
    )
    named = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left")
    return named.join(first, customer["c_custkey"] == first["o_custkey"], "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat("c_name", F.lit("@Example.com")).alias("email"),
        F.col("n_name").alias("city"),
        F.coalesce(F.date_sub("first_date", 1), F.to_date(F.lit(FIRST_DAY))).alias(
            "signup_date"
        ),
        F.col("c_mktsegment").alias("acquisition_channel"),
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    cost = half_up_div(
        cents(F.col("p_retailprice")) * (300 + 15 * F.col("p_size")), F.lit(1000)
    )
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        amount(cost).alias("cost_price"),
        F.col("p_retailprice").alias("list_price"),
    )


def as_raw_events(events: DataFrame) -> DataFrame:
    key = F.get_json_object("props", "$.k")
    return events.select(
        "event_id",
        F.col("user_id").alias("customer_id"),
        key.alias("product_id"),
        "event_type",
        F.col("ts").alias("event_time"),
        F.concat(F.lit("/product/"), key).alias("page"),
        F.concat(F.col("user_id"), F.lit("-"), F.col("ts").cast("date")).alias("session_id"),
    )


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    return as_raw_events(table(spark, folder, "events"))
