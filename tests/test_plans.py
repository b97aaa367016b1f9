"""What the physical plans of the registered queries must and must not hold."""

from datetime import datetime

import pytest
from fixtures import raw_tables
from pyspark.sql import functions as F

from tallymart.operators import enrich, marts, staging
from tallymart.plans.build import staging_views
from tallymart.plans.catalog import Retail, registered
from tallymart.sources import star
from tallymart.sources.warehouse import Warehouse

# Queries that fit a model or run a stream before they return.
EAGER = {
    "rfm_clusters",
    "customer_segments",
    "customer_segment_checks",
    "cluster_certificate",
    "churn_coefficients",
    "churn_test_predictions",
    "churn_predictions",
    "churn_derivatives",
    "churn_prediction_checks",
    "revenue_forecast",
    "revenue_forecast_checks",
    "forecast_derivatives",
    "category_forecast",
    "category_forecast_calendar",
    "category_forecast_checks",
    "category_forecast_derivatives",
    "stream_events",
    "stream_daily_counts",
}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registered()) - EAGER))
def test_no_row_at_a_time_python_and_no_pairing_join(spark, small, name):
    plan = physical(registered()[name](spark, small))
    for node in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("plans")))
    raw = {n: warehouse.write(df, f"raw.{n}") for n, df in raw_tables(spark).items()}
    return staging_views(raw)


def scans(df):
    return [line for line in physical(df).splitlines() if "FileScan parquet" in line]


def test_status_filter_and_columns_reach_the_scan(stored):
    plans = {
        "daily": marts.daily_revenue_mart_from_staging(
            stored["stg_orders"], stored["stg_customers"]
        ),
        "product": marts.product_performance_mart_from_staging(
            stored["stg_orders"], stored["stg_products"]
        ),
    }
    for df in plans.values():
        (orders,) = [s for s in scans(df) if "unit_price" in s]
        assert "EqualTo(status,completed)" in orders
        assert "GreaterThan(quantity,0)" in orders and "GreaterThan(unit_price,0.0)" in orders
    (daily_orders,) = [s for s in scans(plans["daily"]) if "unit_price" in s]
    assert "product_id" not in daily_orders


def test_only_the_bare_key_meets_the_order_lines(stored):
    df = marts.customer_lifetime_mart_from_staging(stored["stg_orders"], stored["stg_customers"])
    customers = [s for s in scans(df) if "email" in s]
    assert any("acquisition_channel" not in s.split("ReadSchema")[1] for s in customers)
    assert len([s for s in scans(df) if "unit_price" in s]) == 1  # order lines are read once


def test_each_table_is_read_once_for_its_checks(stored, spark):
    from tallymart.operators import quality

    checks = [c for c in quality.standard_checks() if c.table == "stg_products"]
    assert len(scans(quality.run_checks(stored, checks))) == 1
    tests = [t for t in quality.standard_column_tests() if t.table == "stg_orders"]
    assert len(scans(quality.run_column_tests(stored, tests))) == 2


def test_checks_on_staged_views_join_the_pass_over_the_raw_table(stored, spark, tmp_path):
    from tallymart.operators import quality, staging

    warehouse = Warehouse(spark, str(tmp_path))
    rows = raw_tables(spark)
    tables = {f"raw_{n}": warehouse.write(df, f"raw.{n}") for n, df in rows.items()} | stored
    checks = [c for c in quality.standard_checks(min_orders=1) if not c.table.startswith("mart")]
    compiled = quality.run_checks(tables, checks, staging.staged_rules())
    assert len(scans(compiled)) == 3
    apart = quality.run_checks(tables, checks)
    assert len(scans(apart)) == 5
    assert compiled.orderBy("position").collect() == apart.orderBy("position").collect()


@pytest.fixture(scope="module")
def star_folder(spark, tmp_path_factory):
    """Star tables with repeated, unknown and missing keys."""
    folder = str(tmp_path_factory.mktemp("star"))
    day = datetime(1998, 5, 1)
    rows = {
        "customer": [
            (1, "Ann", 1, 0.0, "A"),
            (2, "Bob", 1, 0.0, "B"),
            (2, "Bob", 1, 0.0, "B"),
            (None, "Cy", 1, 0.0, "B"),
        ],
        "nation": [(1, "India", 1)],
        "part": [
            (1, "Lamp", "b", "SMALL", 1, 10.0),
            (2, "Mug", "b", "LARGE", 2, 5.55),
            (2, "Mug", "b", "LARGE", 2, 5.55),
        ],
        "orders": [
            (1, 1, "O", 1.0, day, "1"),
            (2, 2, "O", 1.0, day, "1"),
            (3, 9, "O", 1.0, None, "1"),
            (3, 8, "O", 1.0, day, "1"),
        ],
        "lineitem": [
            (o, p, 1, n, q, 1.0, d, 0.0, f, "O", day)
            for o, p, n, q, d, f in [
                (1, 1, 1, 2.0, 0.05, "N"),
                (1, 2, 2, 3.0, 0.01, "N"),
                (2, 2, 1, 1.0, 0.0, "R"),
                (3, 7, 1, 1.0, 0.1, "A"),
                (3, 1, 2, 4.0, 0.1, "N"),
                (4, 1, 1, 0.0, 0.1, "N"),
                (None, 1, 1, 5.0, 0.02, None),
            ]
        ],
    }
    for name, found in rows.items():
        spark.createDataFrame(found, star.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
    return folder


def lineitem_reads(df):
    return [line for line in scans(df) if "l_orderkey" in line]


@pytest.mark.parametrize("name", ["quality_checks", "quality_totals"])
def test_checks_join_the_order_lines_once(spark, star_folder, name):
    assert not lineitem_reads(registered()[name](spark, star_folder))  # they read the stored join


def test_order_lines_meet_their_part_before_their_order(spark, star_folder):
    joins = [line for line in physical(star.raw_orders(spark, star_folder)).splitlines() if "Join" in line]
    assert len(joins) == 2
    assert "l_orderkey" in joins[0] and "l_partkey" in joins[1]  # the upper join is printed first


def test_raw_orders_of_repeated_unknown_and_missing_keys(spark, star_folder):
    day = datetime(1998, 5, 1).date()
    expected = [
        ("1-1", 1, 1, day, 2, 9.5, "completed"),
        *[("1-2", 1, 2, day, 3, 5.49, "completed")] * 2,  # part 2 comes twice
        *[("2-1", 2, 2, day, 1, 5.55, "returned")] * 2,
        ("3-1", 9, 7, None, 1, None, "pending"),  # order 3 comes twice, part 7 is unknown
        ("3-1", 8, 7, day, 1, None, "pending"),
        ("3-2", 9, 1, None, 4, 9.0, "completed"),
        ("3-2", 8, 1, day, 4, 9.0, "completed"),
        ("4-1", None, 1, None, 0, 9.0, "completed"),
        (None, None, 1, None, 5, 9.8, None),
    ]
    found = [tuple(r) for r in star.raw_orders(spark, star_folder).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_stored_tables_are_packed(spark, star_folder):
    files = Retail(spark, star_folder).orders_table.inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_checks_over_stored_order_lines_equal_those_over_each_join(spark, star_folder):
    from tallymart.operators import quality

    t = Retail(spark, star_folder)
    apart = t.check_tables | {
        "raw_orders": t.raw_orders,
        "stg_orders": t.orders,
        "mart_daily_revenue": t.daily,
        "mart_customer_lifetime": t.lifetime,
        "mart_product_performance": t.performance,
    }
    checks = quality.standard_checks(categories=2)
    expected = quality.run_checks(apart, checks, staging.staged_rules())
    assert len(lineitem_reads(expected)) == 4
    found = quality.run_checks(t.check_tables, checks, staging.staged_rules())
    assert sorted(found.collect()) == sorted(expected.collect())


def test_weekly_tables_read_the_order_lines_once(stored):
    from tallymart.operators import kpis

    daily = marts.daily_revenue_mart_from_staging(stored["stg_orders"], stored["stg_customers"])
    for table in (kpis.weekly_kpis, kpis.this_week, kpis.last_week):
        assert len([s for s in scans(table(daily)) if "unit_price" in s]) == 1


@pytest.fixture
def large_dimension_settings(spark):
    """No broadcast, and skew limits scaled down to the size of the test rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_a_hot_customer_is_split_in_the_sort_merge_join(spark, tmp_path, large_dimension_settings):
    hot = F.col("id") % 3 == 0
    n = 200_000
    spark.range(0, n, 1, 16).select(
        F.concat(F.lit("o"), "id").alias("order_id"),
        F.when(hot, "c1").otherwise(F.concat(F.lit("c"), F.col("id") % 5000)).alias("customer_id"),
        F.when(hot, "p1").otherwise(F.concat(F.lit("p"), F.col("id") % 5000)).alias("product_id"),
        F.lit("2024-01-01").alias("order_date"),
        F.lit(1).alias("quantity"),
        F.lit(2.5).alias("unit_price"),
        F.lit("completed").alias("status"),
    ).write.parquet(f"{tmp_path}/orders")
    spark.range(5000).select(
        F.concat(F.lit("c"), "id").alias("customer_id"),
        F.concat(F.lit("n"), "id").alias("name"),
        F.lit("a@b").alias("email"),
        F.lit("city").alias("city"),
        F.lit("2023-01-01").alias("signup_date"),
        F.lit("email").alias("acquisition_channel"),
    ).write.parquet(f"{tmp_path}/customers")
    spark.range(5000).select(
        F.concat(F.lit("p"), "id").alias("product_id"),
        F.lit("n").alias("product_name"),
        F.lit("c").alias("category"),
        F.lit(1.0).alias("cost_price"),
        F.lit(2.0).alias("list_price"),
    ).write.parquet(f"{tmp_path}/products")
    products = staging.stage_products(spark.read.parquet(f"{tmp_path}/products"))
    orders = staging.stage_orders(spark.read.parquet(f"{tmp_path}/orders"))
    customers = staging.stage_customers(spark.read.parquet(f"{tmp_path}/customers"))
    cases = (
        (marts.customer_lifetime_mart_from_staging(orders, customers), 5000, 1),
        (marts.product_performance_mart_from_staging(orders, products), 5000, 1),
        (marts.daily_revenue_mart_from_staging(orders, customers), 1, 1),
        (enrich.enrich_orders(orders, customers, products), n, 2),
        (enrich.inner_category(orders, products), n, 1),
    )
    for df, rows, joins in cases:
        assert len(df.collect()) == rows
        final = physical(df).split("Initial Plan")[0]
        assert final.count("SortMergeJoin(skew=true)") == joins
