"""Staging: typed, filtered views of the raw tables."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COMPLETED
from ..functions.money import amount, cents, line_cents, margin


def _typed(col: str, kind: str, strict: bool) -> Column:
    return F.col(col).cast(kind) if strict else F.col(col).try_cast(kind)


@dataclass(frozen=True)
class View:
    """A staged view over one raw table: which rows it keeps, and its columns."""

    source: str
    keep: Column
    columns: dict[str, Column]

    def of(self, raw: DataFrame) -> DataFrame:
        return raw.where(self.keep).select(*[c.alias(n) for n, c in self.columns.items()])


def _same(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def orders_view(strict: bool = True) -> View:
    keep = (
        F.col("order_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & (F.col("quantity") > 0)
        & (F.col("unit_price") > 0)
    )
    columns = {
        **_same("order_id", "customer_id", "product_id"),
        "order_date": _typed("order_date", "date", strict),
        **_same("quantity", "unit_price"),
        "line_revenue": amount(line_cents(F.col("quantity"), F.col("unit_price"))),
        **_same("status"),
        "is_completed": F.coalesce(F.col("status") == COMPLETED, F.lit(False)),
    }
    return View("raw_orders", keep, columns)


def customers_view(strict: bool = True) -> View:
    columns = {
        **_same("customer_id"),
        "customer_name": F.col("name"),
        "email": F.lower("email"),
        **_same("city"),
        "signup_date": _typed("signup_date", "date", strict),
        **_same("acquisition_channel"),
    }
    return View("raw_customers", F.col("customer_id").isNotNull() & F.col("email").isNotNull(), columns)


def products_view() -> View:
    gross, share = margin(F.col("list_price"), F.col("cost_price"))
    columns = {
        **_same("product_id", "product_name", "category", "cost_price", "list_price"),
        "gross_margin": amount(gross),
        "margin_pct": share,
    }
    keep = F.col("product_id").isNotNull() & (F.col("list_price") > F.col("cost_price"))
    return View("raw_products", keep, columns)


def staged_rules() -> dict[str, View]:
    """The staged views by name, for what is compiled down to the raw tables."""
    return {"stg_orders": orders_view(), "stg_customers": customers_view(), "stg_products": products_view()}


def stage_orders(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Valid order lines with line revenue and a completion flag.

    ``strict=False`` turns unreadable dates into NULL instead of failing the job;
    count them with :func:`reject_count`.
    """
    return orders_view(strict).of(raw)


def stage_customers(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Customers with an id and an email; email in lower case."""
    return customers_view(strict).of(raw)


def stage_products(raw: DataFrame) -> DataFrame:
    """Products sold above cost, with margin in money and percent."""
    return products_view().of(raw)


def stage_events(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Events with an id; time as a zone-less timestamp and as a date."""
    return raw.where(F.col("event_id").isNotNull()).select(
        "event_id",
        "customer_id",
        "product_id",
        "event_type",
        _typed("event_time", "timestamp_ntz", strict).alias("event_time"),
        _typed("event_time", "timestamp_ntz", strict).cast("date").alias("event_date"),
        "page",
        "session_id",
    )


def reject_count(raw: DataFrame, column: str, kind: str) -> DataFrame:
    """One row: how many non-null values of ``column`` cannot be read as ``kind``."""
    bad = F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()
    return raw.agg(F.count_if(bad).alias("rejected"))


def completed(staged_orders: DataFrame) -> DataFrame:
    """Completed lines only.

    Tests the stored status rather than the derived flag: the same rows, but a
    predicate the Parquet scan can take over.
    """
    return staged_orders.where(F.col("status") == COMPLETED)


def revenue_cents() -> Column:
    return cents(F.col("line_revenue"))
