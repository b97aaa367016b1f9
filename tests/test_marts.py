import datetime as dt

import pytest
from fixtures import raw_tables, rows
from pyspark.sql import functions as F

from tallymart.operators import enrich, kpis, marts, staging
from tallymart.plans.build import dimension_keys_are_unique, keyed_marts, plain_marts, staging_views


@pytest.fixture(scope="module")
def staged(spark):
    return {k: v.cache() for k, v in staging_views(raw_tables(spark)).items()}


@pytest.fixture(scope="module")
def plain(staged):
    return plain_marts(staged)


def day(m, d):
    return dt.date(2024, m, d)


def test_staging_drops_invalid_rows(staged):
    orders = staged["stg_orders"]
    assert orders.count() == 12
    assert orders.where("order_id in ('o10', 'o11', 'o12')").count() == 0
    assert [r[0] for r in rows(staged["stg_customers"].select("customer_id"))] == [
        "c1", "c2", "c3", "c5", "c6",
    ]
    assert [r[0] for r in rows(staged["stg_products"].select("product_id"))] == ["p1", "p2"]
    assert staged["stg_events"].count() == 3


def test_staging_values(staged):
    revenue = {
        r["order_id"]: r["line_revenue"] for r in staged["stg_orders"].where("customer_id='c1'").collect()
    }
    assert revenue == {"o1": 0.01, "o2": 0.02, "o3": 10.0, "o13": 12.5}
    unknown = staged["stg_orders"].where("order_id = 'o8'").first()
    assert unknown["status"] is None and unknown["is_completed"] is False
    assert staged["stg_customers"].where("email != lower(email)").count() == 0
    p2 = staged["stg_products"].where("product_id = 'p2'").first()
    assert (p2["gross_margin"], p2["margin_pct"]) == (23.33, 70.0)
    last = staged["stg_events"].where("event_id = 'e2'").first()
    assert last["event_date"] == day(2, 1)
    assert last["event_time"] == dt.datetime(2024, 2, 1, 23, 59, 59)


def test_bad_date_fails_or_is_counted(spark):
    raw = raw_tables(spark)["orders"].withColumn("order_date", F.lit("soon"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage_orders(raw).collect()
    assert staging.stage_orders(raw, strict=False).where("order_date is null").count() == 12
    assert staging.reject_count(raw, "order_date", "date").first()[0] == 16


def test_enriched_keeps_orders_and_nulls_unknown_keys(staged):
    enriched = enrich.enrich_orders(
        staged["stg_orders"], staged["stg_customers"], staged["stg_products"]
    )
    assert len(enriched.columns) == 17
    assert enriched.count() == 12
    assert enriched.where("order_id = 'o4'").first()["product_id"] is None
    assert {r["customer_id"] for r in enriched.where("order_id = 'o5'").collect()} == {None}


def test_daily_mart(plain):
    got = {r["order_date"]: tuple(r)[1:] for r in plain["mart_daily_revenue"].collect()}
    assert got == {
        day(2, 1): (2, 1, 0.03, 0.02),
        day(2, 2): (1, 2, 30.0, 15.0),
        day(2, 3): (2, 1, 135.5, 67.75),
        day(2, 4): (1, 0, 10.0, 10.0),
        day(3, 9): (1, 1, 12.5, 12.5),
        day(3, 10): (1, 1, 121.0, 121.0),
    }


def test_lifetime_mart(plain):
    got = {r["customer_id"]: r for r in plain["mart_customer_lifetime"].collect()}
    assert set(got) == {"c1", "c2", "c3", "c5", None}
    c3 = got["c3"]
    assert (c3["total_orders"], c3["completed_orders"]) == (2, 0)
    assert c3["total_revenue"] == 0.0 and c3["avg_order_value"] is None
    nobody = got[None]
    assert (nobody["total_orders"], nobody["completed_orders"]) == (2, 2)
    assert nobody["total_revenue"] == 100.0
    assert (nobody["first_order_date"], nobody["last_order_date"]) == (day(2, 3), day(2, 4))


def test_both_mart_forms_agree(staged, plain):
    assert dimension_keys_are_unique(staged)
    for name, df in keyed_marts(staged).items():
        assert rows(df.select(*plain[name].columns)) == rows(plain[name]), name


def test_plain_marts_follow_repeated_dimension_keys(spark, staged):
    twice = staged["stg_customers"].unionByName(
        staged["stg_customers"].where("customer_id = 'c1'").withColumn("city", F.lit("Surat"))
    )
    repeated = {**staged, "stg_customers": twice}
    assert not dimension_keys_are_unique(repeated)
    lifetime = plain_marts(repeated)["mart_customer_lifetime"]
    assert {(r["city"], r["total_revenue"]) for r in lifetime.where("customer_id='c1'").collect()} == {
        ("Pune", 22.53),
        ("Surat", 22.53),
    }


def test_marts_agree_on_totals(spark, small):
    from tallymart.plans.catalog import Retail

    t = Retail(spark, small)
    sums = {
        round(df.agg(F.sum("total_revenue")).first()[0], 2)
        for df in (t.daily, t.lifetime, t.performance)
    }
    assert len(sums) == 1


def test_forms_agree_with_hot_keys(spark):
    """One customer, product, day and order id each hold a third of the lines."""
    n = 3000
    hot = F.col("id") % 3 == 0
    orders = staging.stage_orders(
        spark.range(n).select(
            F.when(hot, "o").otherwise(F.concat(F.lit("o"), F.col("id") % 700)).alias("order_id"),
            F.when(hot, 1).otherwise(F.col("id") % 40).alias("customer_id"),
            F.when(hot, 2).otherwise(F.col("id") % 30).alias("product_id"),
            F.when(hot, F.lit("2024-01-01").cast("date"))
            .otherwise(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")))
            .alias("order_date"),
            (F.col("id") % 5).cast("int").alias("quantity"),
            (F.col("id") % 101 / 10.0).alias("unit_price"),
            F.when(F.col("id") % 7 < 4, "completed").otherwise("returned").alias("status"),
        )
    ).cache()
    customers = spark.range(0, 30).select(
        F.col("id").alias("customer_id"),
        F.concat(F.lit("n"), "id").alias("customer_name"),
        F.lit("x@y").alias("email"),
        F.lit("city").alias("city"),
        F.lit("2023-01-01").cast("date").alias("signup_date"),
        F.lit("email").alias("acquisition_channel"),
    )
    products = spark.range(0, 25).select(
        F.col("id").alias("product_id"),
        F.lit("p").alias("product_name"),
        F.lit("c").alias("category"),
        F.lit(1.0).alias("cost_price"),
        F.lit(50.0).alias("margin_pct"),
    )
    staged = {"stg_orders": orders, "stg_customers": customers, "stg_products": products}
    plain = plain_marts(staged)
    for name, df in keyed_marts(staged).items():
        assert rows(df.select(*plain[name].columns)) == rows(plain[name]), name


def test_active_customers(plain):
    active = marts.active_customers(plain["mart_customer_lifetime"])
    assert {r["customer_id"] for r in active.collect()} == {"c1", "c2", "c5", None}


def test_category_revenue_outgrows_a_long_in_price_units(spark):
    orders = staging.stage_orders(
        spark.range(4).select(
            F.concat(F.lit("o"), "id").alias("order_id"),
            F.lit("c").alias("customer_id"),
            F.lit("p").alias("product_id"),
            F.lit("2024-01-01").alias("order_date"),
            F.lit(2_000_000_000).alias("quantity"),
            F.lit(400_000.125).alias("unit_price"),
            F.lit("completed").alias("status"),
        )
    )
    products = spark.createDataFrame([("p", "Home")], "product_id string, category string")
    got = kpis.top_category(orders, products).first()
    assert got["revenue"] == 4 * 2e9 * 400_000.125


def test_category_revenue_keeps_every_digit_of_a_price(spark):
    rows = [(f"o{k}", "c", p, "2024-01-01", 1_000_000, x, "completed") for k, (p, x) in enumerate(
        [("p", 0.0000004), ("p", 0.0000001), ("p", 0.000001), ("r", 0.0000013), ("x", 9.0)])]
    raw = spark.createDataFrame(
        rows, "order_id string, customer_id string, product_id string, order_date string, quantity int, "
        "unit_price double, status string",
    )
    products = spark.createDataFrame([("p", "Home"), ("r", "Toys")], "product_id string, category string")
    got = kpis.top_category(staging.stage_orders(raw), products).first()
    assert tuple(got) == ("Home", 2.0)  # 1.50 against 1.30


def test_category_revenue_leaves_out_unknown_products(staged):
    got = kpis.category_revenue(staged["stg_orders"], staged["stg_products"])
    assert [tuple(r) for r in got.collect()] == [("Sports", 151.0), ("Home", 90.03)]
