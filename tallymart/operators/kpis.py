"""KPI tables behind the dashboard pages and the weekly report."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ALL_RISKS, FORECAST, HISTOGRAM_BINS, LOWEST_RISK, RISK_BANDS, SEGMENTS
from ..functions.money import (
    PRICE_UNITS,
    amount,
    cents,
    decimal_line,
    in_units,
    mean_amount,
    mean_count,
    price_units,
    round_amount,
)
from .enrich import inner_category
from .staging import completed, revenue_cents

RISKS = (*(label for _, label in RISK_BANDS), LOWEST_RISK)


# -- executive page ---------------------------------------------------------


def in_date_range(
    df: DataFrame, column: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Rows between two dates, both included; an open end does not filter."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end).cast("date"))
    return df


def executive_kpis(daily: DataFrame) -> DataFrame:
    """Totals over the days given.

    Customers are summed over days and order values averaged over days, as the
    names say; neither is a figure over distinct customers or orders.
    """
    aov = F.sum(cents(F.col("avg_order_value"))).cast("double")
    n = F.count("avg_order_value").cast("double")
    return daily.agg(
        amount(F.sum(cents(F.col("total_revenue")))).alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.try_divide(aov, n * 100.0).alias("mean_daily_aov"),
        F.sum("unique_customers").alias("sum_daily_unique_customers"),
    )


def daily_series(daily: DataFrame) -> DataFrame:
    return daily.select("order_date", "total_revenue").orderBy("order_date")


def category_revenue(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Completed revenue per category, highest first; unknown products are left out.

    Lines are summed per product before they meet the product table.
    """
    per_product = (
        completed(orders)
        .groupBy("product_id")
        .agg(F.sum(revenue_cents()).alias("cents"))
    )
    return (
        inner_category(per_product, products)
        .groupBy("category")
        .agg(amount(F.sum("cents")).alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def channel_customers(customers: DataFrame) -> DataFrame:
    return (
        customers.where(F.col("acquisition_channel").isNotNull())
        .groupBy("acquisition_channel")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


# -- segments page ----------------------------------------------------------


def in_segment(segments: DataFrame, segment: str) -> DataFrame:
    return segments.where(F.col("segment") == segment)


def _segment_sums(segments: DataFrame) -> DataFrame:
    return (
        segments.where(F.col("segment").isNotNull())
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("customer_id").alias("customers"),
            F.sum(cents(F.col("total_revenue"))).alias("cents"),
            F.sum("frequency").alias("orders"),
            F.sum(F.col("recency_days").cast("long")).alias("recency"),
        )
    )


def segment_cards(segments: DataFrame) -> DataFrame:
    """Customers and mean value of the four segments in fixed order, 0 when empty."""
    cards = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(s).alias("segment"))
            for i, s in enumerate(SEGMENTS, start=1)
        ]
    )
    frame = segments.sparkSession.range(1).select(F.inline(cards))
    sums = _segment_sums(segments).select(
        "segment",
        F.col("rows").alias("customers"),
        mean_amount(F.col("cents"), F.col("rows")).alias("avg_ltv"),
    )
    return (
        frame.join(sums, "segment", "left")
        .select(
            "position",
            "segment",
            F.coalesce("customers", F.lit(0).cast("long")).alias("customers"),
            F.coalesce("avg_ltv", F.lit(0.0)).alias("avg_ltv"),
        )
        .orderBy("position")
    )


def segment_summary(segments: DataFrame) -> DataFrame:
    """Size and means per segment to one decimal, most valuable first."""
    n = F.col("rows")
    return (
        _segment_sums(segments)
        .select(
            "segment",
            "customers",
            mean_amount(F.col("cents"), n, 1).alias("avg_ltv"),
            mean_count(F.col("orders"), n).alias("avg_orders"),
            mean_count(F.col("recency"), n).alias("avg_recency"),
        )
        .orderBy(F.desc("avg_ltv"), "segment")
    )


def segment_revenue_summary(segments: DataFrame) -> DataFrame:
    """Size, mean and total revenue and mean orders per segment to two decimals."""
    n = F.col("rows")
    return (
        _segment_sums(segments)
        .select(
            "segment",
            "customers",
            mean_amount(F.col("cents"), n).alias("avg_revenue"),
            amount(F.col("cents")).alias("total_revenue"),
            mean_count(F.col("orders"), n, 2).alias("avg_orders"),
        )
        .orderBy(F.desc("avg_revenue"), "segment")
    )


def segment_breakdown(segments: DataFrame, places: int = 2) -> DataFrame:
    """Customers and mean value per segment, a NULL segment included."""
    return (
        segments.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            mean_amount(
                F.sum(cents(F.col("total_revenue"))), F.count("total_revenue"), places
            ).alias("avg_ltv"),
        )
        .orderBy(F.desc("avg_ltv"), "segment")
    )


def segment_sizes(segments: DataFrame) -> DataFrame:
    return (
        segments.where(F.col("segment").isNotNull())
        .groupBy("segment")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("customers"), "segment")
    )


def champions_facts(segments: DataFrame) -> DataFrame:
    """Customers and mean value of the top segment, to whole money."""
    return in_segment(segment_breakdown(segments, places=0), SEGMENTS[0])


def scatter_points(segments: DataFrame) -> DataFrame:
    """One point per customer: recency against revenue by segment."""
    return segments.select(
        "segment", "customer_name", "city", "recency_days", "total_revenue"
    )


def scatter_density(
    segments: DataFrame, days_per_cell: int = 30, money_per_cell: int = 1000
) -> DataFrame:
    """The same points as counts per cell, for tables too large to draw."""
    return segments.groupBy(
        "segment",
        (F.floor(F.col("recency_days") / days_per_cell) * days_per_cell).alias("recency_from"),
        (F.floor(F.col("total_revenue") / money_per_cell) * money_per_cell).alias(
            "revenue_from"
        ),
    ).agg(F.count(F.lit(1)).alias("customers"))


# -- forecast page ----------------------------------------------------------


def of_record_type(mart: DataFrame, kind: str = FORECAST) -> DataFrame:
    return mart.where(F.col("record_type") == kind).orderBy("forecast_date")


def forecast_table(mart: DataFrame) -> DataFrame:
    """The forecast rows as the page lists them."""
    return of_record_type(mart).select(
        "forecast_date", "predicted_revenue", "lower_bound", "upper_bound"
    )


# -- churn page -------------------------------------------------------------


def at_risk(churn: DataFrame, risk: str = ALL_RISKS) -> DataFrame:
    """Rows of one risk band; "All" passes everything."""
    return churn if risk == ALL_RISKS else churn.where(F.col("churn_risk") == risk)


def risk_counts(churn: DataFrame) -> DataFrame:
    """High, medium and low risk customers as one row."""
    return churn.agg(
        *[F.count_if(F.col("churn_risk") == r).alias(f"{r.lower()}_risk") for r in RISKS]
    )


def risk_breakdown(churn: DataFrame) -> DataFrame:
    """Customers and mean revenue per risk band, largest first."""
    return (
        churn.groupBy("churn_risk")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            mean_amount(F.sum(cents(F.col("total_revenue"))), F.count("total_revenue")).alias(
                "avg_revenue"
            ),
        )
        .orderBy(F.desc("customers"), "churn_risk")
    )


def high_risk_by_city(churn: DataFrame) -> DataFrame:
    return (
        at_risk(churn, RISKS[0])
        .where(F.col("city").isNotNull())
        .groupBy("city")
        .agg(F.count(F.lit(1)).alias("high_risk_customers"))
        .orderBy(F.desc("high_risk_customers"), "city")
    )


def high_risk_count(churn: DataFrame) -> DataFrame:
    return at_risk(churn, RISKS[0]).agg(F.count(F.lit(1)).alias("high_risk_customers"))


def probability_histogram(churn: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Customers per probability bin of equal width and risk band."""
    cell = F.least(F.floor(F.col("churn_probability") * bins) + 1, F.lit(bins).cast("long"))
    return (
        churn.groupBy(cell.alias("bin"), "churn_risk")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy("bin", "churn_risk")
    )


def risk_table(churn: DataFrame) -> DataFrame:
    return churn.select(
        "customer_name",
        "city",
        "acquisition_channel",
        "completed_orders",
        "total_revenue",
        "days_since_last_order",
        "churn_probability",
        "churn_risk",
    )


# -- weekly report ----------------------------------------------------------


def _with_age(daily: DataFrame) -> DataFrame:
    """The daily mart with ``age``, the days since its last one.

    The window runs over one row per calendar day, so what the mart is made from is read once.
    """
    last = F.max("order_date").over(Window.partitionBy(F.lit(1)))
    return daily.withColumn("age", F.datediff(last, "order_date"))


def this_week(daily: DataFrame) -> DataFrame:
    """The seven days up to the last one."""
    return _with_age(daily).where("age < 7").drop("age")


def last_week(daily: DataFrame) -> DataFrame:
    """The seven days before :func:`this_week`."""
    return _with_age(daily).where("age between 7 and 13").drop("age")


def weekly_kpis(daily: DataFrame) -> DataFrame:
    """Revenue of both weeks, their change, and this week's orders and mean order value.

    One pass over the daily mart; the change is 0 when last week had no revenue.
    """
    this, prior = F.col("age") < 7, F.col("age").between(7, 13)
    revenue, aov = cents(F.col("total_revenue")), cents(F.col("avg_order_value"))
    sums = _with_age(daily).agg(
        F.sum(F.when(this, revenue).otherwise(0)).alias("now"),
        F.sum(F.when(prior, revenue).otherwise(0)).alias("before"),
        F.sum(F.when(this, F.col("total_orders")).otherwise(0)).alias("orders"),
        F.sum(F.when(this, aov)).cast("double").alias("aov"),
        F.count(F.when(this, aov)).cast("double").alias("days"),
    )
    change = F.when(
        F.col("before") > 0,
        (F.col("now") - F.col("before")).cast("double") / F.col("before").cast("double") * 100.0,
    ).otherwise(0.0)
    return sums.select(
        amount(F.col("now")).alias("this_week_revenue"),
        amount(F.col("before")).alias("last_week_revenue"),
        change.alias("wow_pct"),
        F.col("orders").alias("this_week_orders"),
        F.try_divide(F.col("aov"), F.col("days") * 100.0).alias("mean_daily_aov"),
        F.when(change >= 0, "up").otherwise("down").alias("direction"),
        F.when(change >= 0, "+").otherwise("").alias("sign"),
    )


def top_category(orders: DataFrame, products: DataFrame) -> DataFrame:
    """The category with the highest completed ``quantity * unit_price``, to whole money.

    Lines are not rounded before they are summed.  Summed as decimals: in units of
    ``1 / PRICE_UNITS`` a large category outgrows a LONG.  Lines whose price is not a whole
    number of units are summed beside them.
    """
    whole, sums = "decimal(18,0)", "decimal(37,15)"
    quantity, price = F.col("quantity"), F.col("unit_price")
    quick = in_units(price, quantity)
    line = F.when(quick, quantity.cast(whole) * price_units(price).cast(whole))
    rest = F.when(~quick, decimal_line(quantity, price))
    per_product = (
        completed(orders).groupBy("product_id").agg(F.sum(line).alias("units"), F.sum(rest).alias("rest"))
    )
    unit = F.lit(Decimal(1) / PRICE_UNITS)
    none = F.lit(0).cast(sums)
    revenue = F.coalesce((F.sum("units").cast("decimal(30,0)") * unit).cast(sums), none) + F.coalesce(
        F.sum("rest").cast(sums), none
    )
    return (
        inner_category(per_product, products)
        .groupBy("category")
        .agg(F.round(revenue, 0).cast("double").alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
        .limit(1)
    )


def forecast_total(mart: DataFrame) -> DataFrame:
    """Predicted revenue of all forecast rows, to whole money."""
    total = F.sum(cents(F.col("predicted_revenue")))
    return of_record_type(mart).agg(round_amount(total, 0).alias("total"))


def newest_days(daily: DataFrame, days: int = 14) -> DataFrame:
    """The newest days in ascending order with a short label."""
    return (
        daily.orderBy(F.desc("order_date"))
        .limit(days)
        .select(
            "order_date",
            F.date_format("order_date", "MMM dd").alias("label"),
            "total_revenue",
        )
        .orderBy("order_date")
    )


def top_rows(df: DataFrame, column: str, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest ``column``; ``key`` breaks ties."""
    return df.orderBy(F.desc(column), key).limit(n)
