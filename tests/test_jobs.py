"""File readers, the load job and the whole chain of jobs over a warehouse."""

import json
from pathlib import Path

import pytest
from fixtures import rows
from pyspark.sql import functions as F

from tallymart.operators import quality
from tallymart.plans.build import MARTS, RetailWarehouse
from tallymart.plans.catalog import Retail
from tallymart.plans.ingest import run_ingest
from tallymart.sources import files
from tallymart.sources.schemas import RAW_SCHEMAS
from tallymart.sources.warehouse import RUN_LOG, Warehouse, export_csv, read_mart_csv

PRODUCTS = """product_id,product_name,category,cost_price,list_price
001,"Lamp, ""tall"" one",Home,10.5,20
p2,N/A,null,,33.333
"""
CUSTOMERS = """customer_id,name,email,city,signup_date,acquisition_channel
c1,Ann,ANN@x.org,Pune,2024-01-01,email
"""
ORDERS = """order_id,customer_id,product_id,order_date,quantity,unit_price,status
o1,c1,001,2024-02-01,2,18.5,completed
o2,c1,p2,2024-02-02,1,NA,pending
"""
EVENTS = [
    {"event_id": "e1", "customer_id": "c1", "product_id": "001", "event_type": "purchase",
     "event_time": "2024-02-01 10:00:00", "page": "/product/001", "session_id": "S1"},
    {"event_id": "e2", "customer_id": None, "event_type": "page_view",
     "event_time": "2024-02-01 10:00:05", "page": "/", "session_id": "S1"},
]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "products.csv").write_text(PRODUCTS)
    (tmp_path / "customers.csv").write_text(CUSTOMERS)
    (tmp_path / "orders.csv").write_text(ORDERS)
    (tmp_path / "events.jsonl").write_text("".join(json.dumps(e) + "\n" for e in EVENTS))
    return str(tmp_path)


def test_csv_types_quotes_and_null_tokens(spark, folder):
    got = files.read_products(spark, f"{folder}/products.csv")
    assert [tuple(r) for r in got.collect()] == [
        ("001", 'Lamp, "tall" one', "Home", 10.5, 20.0),
        ("p2", None, None, None, 33.333),
    ]
    assert got.schema.simpleString() == (
        "struct<product_id:string,product_name:string,category:string,"
        "cost_price:double,list_price:double>"
    )
    orders = files.read_orders(spark, f"{folder}/orders.csv")
    assert orders.where("order_id = 'o2'").first()["unit_price"] is None


def test_json_lines(spark, folder):
    got = files.read_events(spark, f"{folder}/events.jsonl").orderBy("event_id").collect()
    assert got[0]["session_id"] == "S1" and got[1]["product_id"] is None


@pytest.mark.parametrize(
    "text",
    [
        PRODUCTS.replace("cost_price", "price"),  # another header
        PRODUCTS + "p3,x,y,cheap,1\n",  # not a number
    ],
)
def test_malformed_csv_fails(spark, folder, text):
    Path(folder, "products.csv").write_text(text)
    with pytest.raises(Exception):
        files.read_products(spark, f"{folder}/products.csv").collect()


def test_malformed_json_fails(spark, folder):
    with open(f"{folder}/events.jsonl", "a") as f:
        f.write('{"event_id": \n')
    with pytest.raises(Exception):
        files.read_events(spark, f"{folder}/events.jsonl").collect()


def test_load_logs_and_counts(spark, folder, tmp_path):
    root = f"{tmp_path}/wh"
    for _ in range(2):  # a full refresh leaves the same rows
        counts = dict(map(tuple, run_ingest(spark, folder, root).collect()))
    assert counts == {"raw.products": 2, "raw.customers": 1, "raw.orders": 2, "raw.events": 2}
    assert [r["status"] for r in Warehouse(spark, root).runs().collect()] == ["success"] * 2


def test_failed_load_is_logged_and_raised(spark, folder, tmp_path):
    Path(folder, "orders.csv").write_text("it's not the right header\n1\n")
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    with pytest.raises(Exception):
        run_ingest(spark, folder, warehouse.root)
    runs = warehouse.read(RUN_LOG).collect()
    assert len(runs) == 1 and runs[0]["status"].startswith("failed: ")


def test_catalog_table_and_view(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    df = spark.range(3)
    assert warehouse.as_table(df, "shop.numbers").count() == 3
    assert warehouse.as_table(df.limit(1), "shop.numbers").count() == 1
    warehouse.as_view(df, "numbers_view")
    assert spark.sql("select sum(id) from numbers_view").first()[0] == 3
    spark.sql("drop database shop cascade")


@pytest.fixture(scope="module")
def retail(spark, small, tmp_path_factory):
    """The test tables written as raw files, loaded, transformed and modelled."""
    base = tmp_path_factory.mktemp("retail")
    t = Retail(spark, small)
    raw = {"products": t.raw_products, "customers": t.raw_customers, "orders": t.raw_orders}
    for name, df in raw.items():
        export_csv(df, f"{base}/in/{name}.csv")
    events = t.raw_events.withColumn("event_time", F.col("event_time").cast("string"))
    events.write.json(f"{base}/in/events.jsonl")
    run_ingest(spark, f"{base}/in", f"{base}/wh")
    out = RetailWarehouse(Warehouse(spark, f"{base}/wh"))
    out.build_marts()
    out.build_models(train_before=str(last_day(out)))
    return out


def last_day(retail):
    return retail.mart(MARTS[0]).agg(F.max("order_date")).first()[0]


def test_chain_gives_the_same_marts(retail, spark, small):
    t = Retail(spark, small)
    assert rows(retail.mart(MARTS[0])) == rows(t.daily)
    for name, df, key in ((MARTS[1], t.lifetime, "customer_id"), (MARTS[2], t.performance, "product_id")):
        want = df.withColumn(key, F.col(key).cast("string"))
        assert rows(retail.mart(name)) == rows(want), name
    for name, df in retail.raw().items():
        assert df.schema.simpleString() == spark.createDataFrame([], RAW_SCHEMAS[name]).schema.simpleString()


def test_chain_models(retail):
    active = retail.mart(MARTS[1]).where("completed_orders > 0").count()
    assert retail.mart("mart_customer_segments").count() == active
    assert retail.mart("mart_churn_predictions").count() == active
    forecast = retail.mart("mart_revenue_forecast")
    assert forecast.count() == retail.mart(MARTS[0]).count() - 1 + 30
    # the day cut from training lies within the mart, so 29 of the 30 days are new
    assert forecast.where("record_type = 'forecast'").count() == 29


def test_quality_report_file(retail, tmp_path):
    results = retail.check_quality(
        f"{tmp_path}/report", min_orders=5000, min_customers=100, categories=6
    )
    assert {r["status"] for r in results.collect()} == {"PASS"}
    (part,) = Path(f"{tmp_path}/report").glob("part-*.json")
    report = json.loads(part.read_text())
    assert (report["passed"], report["failed"], report["total"]) == (14, 0, 14)
    assert set(report) == {"run_time", "passed", "failed", "total", "checks"}
    first = report["checks"][0]
    assert first["check"] == "raw.orders row count > 5000" and first["result"] == "6000"
    assert set(first) == {"check", "result", "status", "checked_at"}


def test_exports_read_back(retail, spark, tmp_path):
    retail.export(str(tmp_path))
    staged = retail.staged()
    for name in ("mart_daily_revenue", "mart_customer_segments", "mart_churn_predictions",
                 "mart_revenue_forecast", "stg_orders", "stg_customers", "stg_products"):
        want = staged[name] if name in staged else retail.mart(name)
        got = read_mart_csv(spark, str(tmp_path), name)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and got.count() == want.count(), name
    assert read_mart_csv(spark, str(tmp_path), MARTS[2]).dtypes[5] == ("units_sold", "double")


def test_weekly_report_frames(retail):
    frames = retail.weekly_report()
    assert frames["weekly_kpis"].count() == 1
    assert frames["newest_days"].count() == 14
    assert frames["top_category"].count() == 1
    assert frames["champions"].first()["segment"] == "Champions"
    assert frames["forecast_next_7"].first()["days"] == 7


def test_failing_checks_and_severities(spark):
    tables = {
        "stg_orders": spark.createDataFrame(
            [("o1", None, "completed", 1), ("o1", "c", "lost", 1), (None, "c", None, 2)],
            "order_id string, customer_id string, status string, quantity int",
        ),
        "stg_customers": spark.createDataFrame(
            [("c1", "a@x"), ("c2", "a@x")], "customer_id string, email string"
        ),
        "stg_products": spark.createDataFrame(
            [("p1", "Home"), ("p2", "Toys"), ("p3", "Toys")], "product_id string, category string"
        ),
    }
    got = {
        (r["table"], r["column"], r["test"]): (r["failures"], r["status"])
        for r in quality.run_column_tests(tables, quality.standard_column_tests()).collect()
    }
    assert len(got) == 12
    assert got["stg_orders", "order_id", "unique"] == (1, "FAIL")
    assert got["stg_orders", "order_id", "not_null"] == (1, "FAIL")
    assert got["stg_orders", "customer_id", "not_null"] == (1, "FAIL")
    assert got["stg_orders", "status", "accepted_values"] == (1, "FAIL")  # NULL is no value
    assert got["stg_orders", "quantity", "not_null"] == (0, "PASS")
    assert got["stg_customers", "email", "unique"] == (1, "WARN")
    assert got["stg_products", "category", "accepted_values"] == (1, "FAIL")
    bad = {r["value"]: r["n"] for r in quality.unaccepted_values(
        tables["stg_products"], "category", ["Home"]).collect()}
    assert bad == {"Toys": 2}


def test_command_line(spark, folder, tmp_path, capsys):
    from tallymart.__main__ import main

    root = f"{tmp_path}/wh"
    main(["ingest", "--data", folder, "--root", root])
    main(["marts", "--root", root])
    main(["quality", "--root", root, "--report", f"{tmp_path}/report"])
    shown = capsys.readouterr().out
    assert "raw.orders" in shown and "raw.orders row count > 9000" in shown
    assert Warehouse(spark, root).read("analytics.mart_daily_revenue").count() == 1
    with pytest.raises(SystemExit):
        main(["nothing"])


def test_a_load_that_fails_halfway_leaves_the_old_table(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    with pytest.raises(FileNotFoundError):
        warehouse.read("raw.t")
    warehouse.write(spark.range(10), "raw.t")
    bad = spark.range(0, 20, 1, 4).select(
        F.when(F.col("id") == 19, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id")
    )
    for _ in range(2):
        with pytest.raises(Exception, match="broken"):
            warehouse.write(bad, "raw.t")
        assert warehouse.read("raw.t").count() == 10
    assert sorted(warehouse.versions("raw.t").values()) == [False, False, True]
    held = warehouse.read("raw.t")
    assert warehouse.write(spark.range(7), "raw.t").count() == 7
    assert held.count() == 10  # a reader of the version before may finish
    assert list(warehouse.versions("raw.t").values()) == [True, True]  # failed loads are gone
    warehouse.write(warehouse.read("raw.t").where("id < 3"), "raw.t")  # reads what it replaces
    assert warehouse.read("raw.t").count() == 3


def test_models_leave_their_evaluation(retail):
    found = {name: df.collect() for name, df in retail.evaluation().items()}
    assert [r["class"] for r in found["churn_report"]] == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    tested = sum(r["n"] for r in found["churn_confusion"])
    active = retail.mart("mart_churn_predictions").count()
    assert abs(tested - active * 0.2) <= 1  # each of the two classes rounds its share
    assert 0 <= found["churn_auc"][0]["auc"] <= 1
    weights = [r["coefficient"] for r in found["churn_coefficients"]]
    assert weights == sorted(weights) and len(weights) == 11


def test_column_tests_of_a_warehouse(retail):
    got = retail.check_columns(("ECONOMY", "LARGE")).collect()
    assert len(got) == 12
    accepted = [r for r in got if r["column"] == "category"]
    assert [r["status"] for r in accepted] == ["FAIL"]


def test_quality_limits_on_the_command_line():
    from tallymart.__main__ import parse

    plain = parse(["quality", "--root", "/w"])
    assert (plain.min_orders, plain.min_customers, plain.min_days, plain.category) == (9000, 1900, 400, None)
    told = parse(["quality", "--root", "/w", "--min-orders", "5", "--category", "A", "--category", "B"])
    assert told.min_orders == 5 and told.category == ["A", "B"]
