"""The transform, model, quality and report jobs over a warehouse."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PRODUCT_CATEGORIES
from ..operators import churn, forecast, kpis, marts, metrics, quality, segments
from ..operators.enrich import enrich_orders
from ..operators.staging import (
    stage_customers,
    stage_events,
    stage_orders,
    stage_products,
    staged_rules,
)
from ..sources.warehouse import EXPORT_SCHEMAS, Warehouse, export_csv, write_quality_report

# How the churn model did on its test rows, and its weights.
EVALUATION = ("churn_report", "churn_confusion", "churn_auc", "churn_coefficients")
MARTS = ("mart_daily_revenue", "mart_customer_lifetime", "mart_product_performance")


def staging_views(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Raw tables to the four staged views."""
    return {
        "stg_orders": stage_orders(raw["orders"]),
        "stg_customers": stage_customers(raw["customers"]),
        "stg_products": stage_products(raw["products"]),
        "stg_events": stage_events(raw["events"]),
    }


def plain_marts(staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The three marts from the enriched view, whatever the dimension keys are."""
    enriched = enrich_orders(
        staged["stg_orders"], staged["stg_customers"], staged["stg_products"]
    )
    return {
        "mart_daily_revenue": marts.daily_revenue_mart(enriched),
        "mart_customer_lifetime": marts.customer_lifetime_mart(enriched),
        "mart_product_performance": marts.product_performance_mart(enriched),
    }


def keyed_marts(staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The three marts for unique dimension keys; the form for large data."""
    orders = staged["stg_orders"]
    customers, products = staged["stg_customers"], staged["stg_products"]
    return {
        "mart_daily_revenue": marts.daily_revenue_mart_from_staging(orders, customers),
        "mart_customer_lifetime": marts.customer_lifetime_mart_from_staging(orders, customers),
        "mart_product_performance": marts.product_performance_mart_from_staging(
            orders, products
        ),
    }


def dimension_keys_are_unique(staged: Mapping[str, DataFrame]) -> bool:
    """Whether both dimension keys pass their declared ``unique`` test."""
    tests = [
        quality.ColumnTest("stg_customers", "customer_id", "unique"),
        quality.ColumnTest("stg_products", "product_id", "unique"),
    ]
    return quality.run_column_tests(staged, tests).agg(F.sum("failures")).first()[0] == 0


class RetailWarehouse:
    """All layers over one :class:`Warehouse`."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse

    def raw(self) -> dict[str, DataFrame]:
        names = ("products", "customers", "orders", "events")
        return {n: self.warehouse.read(f"raw.{n}") for n in names}

    def staged(self) -> dict[str, DataFrame]:
        views = staging_views(self.raw())
        for name, df in views.items():
            self.warehouse.as_view(df, name)
        return views

    def mart(self, name: str) -> DataFrame:
        return self.warehouse.read(f"analytics.{name}")

    def build_marts(self) -> None:
        """Staging views, then the three marts as tables."""
        staged = self.staged()
        build = keyed_marts if dimension_keys_are_unique(staged) else plain_marts
        for name, df in build(staged).items():
            self.warehouse.write(df, f"analytics.{name}")

    def build_models(self, train_before: str | None = None, snapshot: str | None = None) -> None:
        """Segments, churn predictions with their evaluation, and forecasts as tables."""
        lifetime, customers = self.mart("mart_customer_lifetime"), self.staged()["stg_customers"]
        day = None if snapshot is None else F.lit(snapshot).cast("date")
        run = churn.ChurnRun(lifetime, customers, day)
        tested = run.test_predictions()
        outputs = {
            "churn_report": metrics.classification_report(tested),
            "churn_confusion": metrics.confusion(tested),
            "churn_auc": metrics.roc_auc(tested),
            "churn_coefficients": run.coefficients(),
            "mart_customer_segments": segments.customer_segments(lifetime, day),
            "mart_churn_predictions": run.predictions(),
            "mart_revenue_forecast": forecast.revenue_forecast(
                self.mart("mart_daily_revenue"), train_before
            ),
        }
        for name, df in outputs.items():
            self.warehouse.write(df, f"analytics.{name}")

    def check_tables(self) -> dict[str, DataFrame]:
        raw = self.raw()
        return {
            "raw_orders": raw["orders"],
            "raw_customers": raw["customers"],
            "raw_products": raw["products"],
            **self.staged(),
            **{m: self.mart(m) for m in MARTS},
        }

    def check_quality(self, report_path: str | None = None, **limits) -> DataFrame:
        """The fourteen checks; optionally written as a JSON report."""
        results = quality.run_checks(
            self.check_tables(), quality.standard_checks(**limits), staged_rules()
        )
        if report_path is not None:
            write_quality_report(results, report_path)
        return results

    def evaluation(self) -> dict[str, DataFrame]:
        """The stored evaluation of the churn model."""
        return {name: self.mart(name) for name in EVALUATION}

    def check_columns(self, categories=PRODUCT_CATEGORIES) -> DataFrame:
        """The twelve column tests of the staged views."""
        return quality.run_column_tests(self.staged(), quality.standard_column_tests(categories))

    def export(self, folder: str) -> None:
        """Every table the dashboard reads, as CSV."""
        staged = self.staged()
        for name in EXPORT_SCHEMAS:
            df = staged[name] if name in staged else self.mart(name)
            export_csv(df, f"{folder}/{name}.csv")

    def weekly_report(self) -> dict[str, DataFrame]:
        """The frames behind the weekly report."""
        daily, staged = self.mart("mart_daily_revenue"), self.staged()
        segmented = self.mart("mart_customer_segments")
        predicted = self.mart("mart_revenue_forecast")
        return {
            "weekly_kpis": kpis.weekly_kpis(daily),
            "newest_days": kpis.newest_days(daily),
            "segments": kpis.segment_breakdown(segmented, places=0),
            "champions": kpis.champions_facts(segmented),
            "top_category": kpis.top_category(staged["stg_orders"], staged["stg_products"]),
            "high_risk": kpis.high_risk_count(self.mart("mart_churn_predictions")),
            "forecast_total": kpis.forecast_total(predicted),
            "forecast_next_7": forecast.horizon_summary(predicted, 7),
        }
