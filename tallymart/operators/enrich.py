"""Order lines joined with their customer and product."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER_COLUMNS = (
    "order_id",
    "order_date",
    "status",
    "is_completed",
    "quantity",
    "unit_price",
    "line_revenue",
)
CUSTOMER_COLUMNS = (
    "customer_id",
    "customer_name",
    "city",
    "acquisition_channel",
    "signup_date",
)
PRODUCT_COLUMNS = ("product_id", "product_name", "category", "cost_price", "margin_pct")


def with_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Left join; the customer's own key is kept, so it is NULL for an unknown customer."""
    c = customers.select(*CUSTOMER_COLUMNS)
    joined = orders.join(c, orders["customer_id"] == c["customer_id"], "left")
    return joined.drop(orders["customer_id"])


def with_products(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Left join; the product's own key is kept, so it is NULL for an unknown product."""
    p = products.select(*PRODUCT_COLUMNS)
    joined = orders.join(p, orders["product_id"] == p["product_id"], "left")
    return joined.drop(orders["product_id"])


def enrich_orders(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """The 17-column order view that the plain marts read.

    Both joins carry no hint: the planner broadcasts a dimension that its size
    estimate allows and otherwise sort-merges, where AQE splits a hot key on the
    order side (allowed, as the order side is the outer one).
    """
    joined = with_products(with_customers(orders, customers), products)
    return joined.select(*ORDER_COLUMNS, *CUSTOMER_COLUMNS, *PRODUCT_COLUMNS)


def inner_category(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines of known products with their category; others are dropped."""
    p = products.select(F.col("product_id"), F.col("category"))
    return orders.join(p, "product_id")
