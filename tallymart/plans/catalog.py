"""The registered queries, all over the star-schema tables of one folder.

Operators that follow a fitted model are fed by a fixed rule instead of the
model, so that SQL can state their result; the models themselves are registered
as well.
"""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scoring import quintile
from ..operators import (
    churn,
    enrich,
    forecast,
    kpis,
    logistic,
    marts,
    metrics,
    quality,
    segments,
    splits,
    staging,
)
from ..operators.ranking import percentile_rank
from ..session import pin, scratch_folder
from ..sources import files, star
from ..sources.warehouse import Warehouse, export_csv, read_mart_csv, row_counts
from ..streaming import events as stream
from .build import keyed_marts

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
RANGE_START, RANGE_END = "1997-01-01", "1999-12-31"
TRAIN_BEFORE = "2001-08-01"
STAR_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
RULE_DAYS = 500.0  # puts customers into all risk bands


class Retail:
    """The layers over one folder of star-schema tables, built when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def raw_orders(self):
        return star.raw_orders(self.spark, self.folder)

    @cached_property
    def raw_customers(self):
        return star.raw_customers(self.spark, self.folder)

    @cached_property
    def raw_products(self):
        return star.raw_products(self.spark, self.folder)

    @cached_property
    def raw_events(self):
        return star.raw_events(self.spark, self.folder)

    @cached_property
    def orders(self):
        return staging.stage_orders(self.raw_orders)

    @cached_property
    def customers(self):
        return staging.stage_customers(self.raw_customers)

    @cached_property
    def products(self):
        return staging.stage_products(self.raw_products)

    @cached_property
    def events(self):
        return staging.stage_events(self.raw_events)

    @cached_property
    def enriched(self):
        return enrich.enrich_orders(self.orders, self.customers, self.products)

    @cached_property
    def daily(self):
        return marts.daily_revenue_mart_from_staging(self.orders, self.customers)

    @cached_property
    def lifetime(self):
        return marts.customer_lifetime_mart_from_staging(self.orders, self.customers)

    @cached_property
    def performance(self):
        return marts.product_performance_mart_from_staging(self.orders, self.products)

    # Stored tables: what several later steps read is computed once.

    @cached_property
    def orders_table(self):
        return pin(self.raw_orders)

    @cached_property
    def daily_table(self):
        return pin(self.daily)

    @cached_property
    def lifetime_table(self):
        return pin(self.lifetime)

    @cached_property
    def base_table(self):
        return pin(segments.rfm_base(self.lifetime_table))

    @cached_property
    def scored(self):
        return segments.rfm_scores(self.base_table)

    @cached_property
    def features(self):
        return churn.churn_features(self.lifetime_table, self.customers)

    # Fixed rules in place of a fitted model.

    @cached_property
    def rule_clusters(self):
        score = F.col("rfm_score")
        rule = F.when(score >= 12, 2).when(score >= 9, 0).when(score >= 6, 3).otherwise(1)
        return self.scored.withColumn("cluster", rule)

    @cached_property
    def rule_segments(self):
        return segments.segment_mart(segments.label_segments(self.rule_clusters))

    @cached_property
    def rule_labels(self):
        p = F.least(F.col("days_since_last_order") / F.lit(RULE_DAYS), F.lit(1.0))
        return churn.label_churn(self.features.withColumn("churn_probability", p))

    @cached_property
    def rule_predictions(self):
        return churn.prediction_mart(self.rule_labels)

    @cached_property
    def category_daily(self):
        return pin(marts.category_daily_revenue(self.orders, self.products))

    @cached_property
    def category_series(self):
        return forecast.category_series(self.category_daily, TRAIN_BEFORE)

    @cached_property
    def series(self):
        return forecast.training_series(self.daily_table, TRAIN_BEFORE)

    @cached_property
    def rule_yhat(self):
        level = F.lit(1000.0) + F.dayofyear("ds") * F.lit(10.0)
        return forecast.future_frame(self.series).select(
            "ds",
            level.alias("yhat"),
            (level - 250.0).alias("yhat_lower"),
            (level + 250.0).alias("yhat_upper"),
        )

    @cached_property
    def rule_forecast(self):
        return forecast.forecast_mart(self.rule_yhat, self.daily_table)

    @cached_property
    def check_tables(self):
        """Raw tables, staged views and marts; all that needs order lines reads one stored table."""
        staged = {
            "stg_orders": staging.stage_orders(self.orders_table),
            "stg_customers": self.customers,
            "stg_products": self.products,
        }
        return {
            "raw_orders": self.orders_table,
            "raw_customers": self.raw_customers,
            **staged,
            **keyed_marts(staged),
        }

    @cached_property
    def check_results(self):
        return quality.run_checks(
            self.check_tables,
            quality.standard_checks(categories=len(STAR_CATEGORIES)),
            staging.staged_rules(),
        )

    @cached_property
    def features_table(self):
        return pin(self.features)

    @cached_property
    def feature_matrix(self):
        levels = churn.one_hot(self.features_table, churn.CHANNEL)
        return churn.assemble(levels, churn.feature_columns(levels))

    def run_stream(self, counts: bool = False) -> DataFrame:
        """Run a stream over the events table to its end and read the result."""
        source = star.as_raw_events(
            self.spark.readStream.schema(star.SCHEMAS["events"])
            .option("pathGlobFilter", "events.parquet")
            .parquet(self.folder)
        )
        folder = scratch_folder(self.spark, "stream")
        found = f"{folder}/counts" if counts else None
        stream.load_available(source, f"{folder}/out", f"{folder}/state", found)
        if counts:
            return stream.read_daily_counts(self.spark, found)
        return stream.read_events_table(self.spark, source, f"{folder}/out")


def _csv_round_trip(t: Retail, raw: DataFrame, read) -> DataFrame:
    """A raw table written as a CSV file folder and read by its loader."""
    folder = scratch_folder(t.spark, "csv")
    export_csv(raw, folder)
    return read(t.spark, folder)


def _jsonl_round_trip(t: Retail) -> DataFrame:
    folder = scratch_folder(t.spark, "jsonl")
    t.raw_events.withColumn("event_time", F.col("event_time").cast("string")).write.json(folder)
    return files.read_events(t.spark, folder)


def _exported(t: Retail) -> DataFrame:
    """A mart loaded into a warehouse, exported as CSV and read back typed."""
    folder = scratch_folder(t.spark, "export")
    stored = Warehouse(t.spark, f"{folder}/warehouse").write(t.daily, "analytics.mart_daily_revenue")
    export_csv(stored, f"{folder}/mart_daily_revenue.csv")
    return read_mart_csv(t.spark, folder, "mart_daily_revenue")


def _reloaded(t: Retail) -> DataFrame:
    """A table after a full load over an earlier one: the rows of the second alone."""
    warehouse = Warehouse(t.spark, scratch_folder(t.spark, "reload"))
    warehouse.write(t.products.unionAll(t.products), "raw.products")
    return warehouse.write(t.products, "raw.products")


def _rfm_clusters(t: Retail) -> DataFrame:
    grid = pin(segments.score_grid(t.scored))
    return segments.assign_clusters(t.scored, grid, segments.fit_clusters(grid)).select(
        "customer_id", *segments.SCORES, "rfm_score", "cluster"
    )


def _standardized(t: Retail) -> DataFrame:
    matrix = pin(t.feature_matrix)
    train, _ = splits.stratified_split(matrix)
    columns = churn.feature_columns(matrix)
    scaled = churn.standardize(matrix, train, columns)
    return scaled.select("customer_id", *[F.round(c, 6).alias(c) for c in columns])


def _prediction_checks(t: Retail) -> DataFrame:
    """How many predictions break their definition, told from the coefficients and plain columns."""
    run = churn.ChurnRun(t.lifetime_table, t.customers)
    weights = run.model.levels.select(F.col("level").alias(churn.CHANNEL), "unit", "weight")
    margin = F.lit(run.model.intercept)
    for x, w in zip(run.inputs, run.model.coefficients):
        margin = margin + F.col(x) * w
    margin = margin + F.coalesce(F.col("unit") * F.col("weight"), F.lit(0.0))
    p, risk = F.col("churn_probability"), F.col("churn_risk")
    band = F.when(p >= 0.75, "High").when(p >= 0.5, "Medium").otherwise("Low")
    return run.scored.join(weights, churn.CHANNEL, "left").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_distinct("customer_id").alias("customer_ids"),
        F.count_if(F.abs(p - 1 / (1 + F.exp(-margin))) > 1e-9).alias("wrong_probabilities"),
        F.count_if(F.col("churn_label") != (p > 0.5).cast("int")).alias("wrong_labels"),
        F.count_if(risk != band).alias("wrong_bands"),
        F.count_if("is_test").alias("test_customers"),
    )


def _seasonal(t: Retail) -> DataFrame:
    full = forecast.seasonal_features(forecast.future_frame(t.series), t.series)
    return full.select("ds", *[F.round(c, 9).alias(c) for c in full.columns[1:]])


def _ranks(t: Retail) -> DataFrame:
    ranked = percentile_rank(
        t.base_table.select("customer_id", "recency_days", "monetary"),
        {"recency_pct": "recency_days", "monetary_pct": "monetary"},
    )
    return ranked.select(
        "customer_id",
        "recency_pct",
        "monetary_pct",
        (1 - F.col("recency_pct")).alias("recency_pct_reversed"),
        quintile(1 - F.col("recency_pct")).alias("recency_score"),
        quintile(F.col("monetary_pct")).alias("monetary_score"),
    )


def _minmax(t: Retail) -> DataFrame:
    return segments.minmax(segments.scorable(t.scored), segments.SCORES).select(
        "customer_id", *[f"{c}_scaled" for c in segments.SCORES]
    )


QUERIES: dict[str, Callable[[Retail], DataFrame]] = {
    # sources and staging
    "raw_row_counts": lambda t: row_counts(
        {
            "raw.products": t.raw_products,
            "raw.customers": t.raw_customers,
            "raw.orders": t.raw_orders,
            "raw.events": t.raw_events,
        }
    ),
    "csv_products": lambda t: _csv_round_trip(t, t.raw_products, files.read_products),
    "csv_customers": lambda t: _csv_round_trip(t, t.raw_customers, files.read_customers),
    "csv_orders": lambda t: _csv_round_trip(t, t.raw_orders, files.read_orders),
    "jsonl_events": _jsonl_round_trip,
    "exported_daily_revenue": _exported,
    "reloaded_products": _reloaded,
    "stg_orders": lambda t: t.orders,
    "stg_customers": lambda t: t.customers,
    "stg_products": lambda t: t.products,
    "stg_events": lambda t: t.events,
    "completed_orders": lambda t: staging.completed(t.orders),
    # joins
    "orders_with_customers": lambda t: enrich.with_customers(t.orders, t.customers),
    "orders_with_products": lambda t: enrich.with_products(t.orders, t.products),
    "orders_enriched": lambda t: t.enriched,
    "orders_inner_category": lambda t: enrich.inner_category(t.orders, t.products),
    "lifetime_of_customers": lambda t: churn.lifetime_of_customers(t.lifetime, t.customers),
    # marts, in the form for large data and in the plain form
    "mart_daily_revenue": lambda t: t.daily,
    "mart_customer_lifetime": lambda t: t.lifetime,
    "mart_product_performance": lambda t: t.performance,
    "plain_daily_revenue": lambda t: marts.daily_revenue_mart(t.enriched),
    "plain_customer_lifetime": lambda t: marts.customer_lifetime_mart(t.enriched),
    "plain_product_performance": lambda t: marts.product_performance_mart(t.enriched),
    "active_customers": lambda t: marts.active_customers(t.lifetime),
    "top_products": lambda t: kpis.top_rows(t.performance, "total_revenue", "product_id", 10),
    "products_by_revenue": lambda t: t.performance.orderBy(
        F.desc("total_revenue"), "product_id"
    ),
    "first_days": lambda t: t.daily.orderBy("order_date").limit(7),
    # executive page and weekly report
    "daily_in_range": lambda t: kpis.in_date_range(t.daily, "order_date", RANGE_START, RANGE_END),
    "executive_kpis": lambda t: kpis.executive_kpis(
        kpis.in_date_range(t.daily, "order_date", RANGE_START, RANGE_END)
    ),
    "executive_kpis_whole": lambda t: kpis.executive_kpis(kpis.in_date_range(t.daily, "order_date")),
    "daily_series": lambda t: kpis.daily_series(t.daily),
    "category_revenue": lambda t: kpis.category_revenue(t.orders, t.products),
    "channel_customers": lambda t: kpis.channel_customers(t.customers),
    "this_week": lambda t: kpis.this_week(t.daily),
    "last_week": lambda t: kpis.last_week(t.daily),
    "weekly_kpis": lambda t: kpis.weekly_kpis(t.daily),
    "top_category": lambda t: kpis.top_category(t.orders, t.products),
    "newest_days": lambda t: kpis.newest_days(t.daily),
    # quality
    "quality_checks": lambda t: t.check_results,
    "quality_totals": lambda t: quality.report_totals(t.check_results),
    "column_tests": lambda t: quality.run_column_tests(
        t.check_tables, quality.standard_column_tests(STAR_CATEGORIES)
    ),
    "repeated_order_ids": lambda t: quality.repeated_values(t.orders, "order_id"),
    "unaccepted_categories": lambda t: quality.unaccepted_values(
        t.products, "category", STAR_CATEGORIES[:5]
    ),
    "null_counts": lambda t: quality.null_counts(
        t.enriched, ["order_id", "customer_id", "product_id", "category"]
    ),
    # ranks and segments
    "percentile_ranks": _ranks,
    "rfm_base": lambda t: segments.rfm_base(t.lifetime_table),
    "rfm_scores": lambda t: t.scored,
    "rfm_score_distribution": lambda t: segments.score_distribution(t.scored),
    "rfm_minmax": _minmax,
    "rfm_score_grid": lambda t: segments.score_grid(t.scored),
    "rfm_clusters": _rfm_clusters,
    "cluster_certificate": lambda t: segments.cluster_certificate(_rfm_clusters(t)),
    "cluster_summary": lambda t: segments.cluster_summary(t.rule_clusters),
    "cluster_labels": lambda t: segments.cluster_labels(
        segments.cluster_summary(t.rule_clusters)
    ),
    "segment_mart_by_rule": lambda t: t.rule_segments,
    "customer_segments": lambda t: segments.customer_segments(t.lifetime_table),
    "customer_segment_checks": lambda t: segments.segment_checks(
        segments.customer_segments(t.lifetime_table)
    ),
    "segment_members": lambda t: kpis.in_segment(t.rule_segments, "Champions"),
    "segment_cards": lambda t: kpis.segment_cards(t.rule_segments),
    "segment_summary": lambda t: kpis.segment_summary(t.rule_segments),
    "segment_revenue_summary": lambda t: kpis.segment_revenue_summary(t.rule_segments),
    "segment_breakdown": lambda t: kpis.segment_breakdown(t.rule_segments),
    "segment_breakdown_whole": lambda t: kpis.segment_breakdown(t.rule_segments, places=0),
    "segment_sizes": lambda t: kpis.segment_sizes(t.rule_segments),
    "champions_facts": lambda t: kpis.champions_facts(t.rule_segments),
    "scatter_points": lambda t: kpis.scatter_points(t.rule_segments),
    "scatter_density": lambda t: kpis.scatter_density(t.rule_segments),
    # churn
    "churn_features": lambda t: t.features,
    "churn_totals": lambda t: churn.churn_totals(t.features),
    "channel_one_hot": lambda t: churn.one_hot(
        t.customers.select("customer_id", churn.CHANNEL), churn.CHANNEL
    ),
    "channel_entries": lambda t: logistic.level_entries(t.customers, "customer_id", churn.CHANNEL),
    "feature_matrix": lambda t: t.feature_matrix.select(
        "customer_id", *churn.feature_columns(t.feature_matrix)
    ),
    "churn_split": lambda t: splits.with_split(t.features_table).select(
        "customer_id", "churned", "is_test"
    ),
    "churn_split_sizes": lambda t: splits.with_split(t.features_table)
    .groupBy("churned")
    .agg(F.count(F.lit(1)).alias("customers"), F.count_if("is_test").alias("test_customers")),
    "standardized_features": _standardized,
    "churn_coefficients": lambda t: churn.ChurnRun(t.lifetime_table, t.customers).coefficients(),
    "churn_test_predictions": lambda t: churn.ChurnRun(
        t.lifetime_table, t.customers
    ).test_predictions(),
    "churn_predictions": lambda t: churn.ChurnRun(t.lifetime_table, t.customers).predictions(),
    "churn_derivatives": lambda t: churn.ChurnRun(t.lifetime_table, t.customers)
    .derivatives()
    .select("feature", (F.round("derivative", 6) + 0.0).alias("derivative")),
    "churn_prediction_checks": _prediction_checks,
    "churn_mart_by_rule": lambda t: t.rule_predictions,
    "classification_report": lambda t: metrics.classification_report(t.rule_labels),
    "confusion_matrix": lambda t: metrics.confusion(t.rule_labels),
    "roc_auc": lambda t: metrics.roc_auc(
        pin(
            t.rule_labels.select(
                (F.col("return_rate") > 0.5).cast("int").alias("churned"), "churn_probability"
            )
        )
    ),
    "risk_band_members": lambda t: kpis.at_risk(t.rule_predictions, "Medium"),
    "risk_band_all": lambda t: kpis.at_risk(t.rule_predictions),
    "risk_counts": lambda t: kpis.risk_counts(t.rule_predictions),
    "risk_breakdown": lambda t: kpis.risk_breakdown(t.rule_predictions),
    "high_risk_by_city": lambda t: kpis.high_risk_by_city(t.rule_predictions),
    "high_risk_count": lambda t: kpis.high_risk_count(t.rule_predictions),
    "probability_histogram": lambda t: kpis.probability_histogram(t.rule_predictions),
    "risk_table": lambda t: kpis.risk_table(t.rule_predictions),
    # forecast
    "training_series": lambda t: t.series,
    "series_profile": lambda t: forecast.series_profile(t.series),
    "future_frame": lambda t: forecast.future_frame(t.series),
    "seasonal_features": _seasonal,
    "revenue_forecast": lambda t: forecast.revenue_forecast(t.daily, TRAIN_BEFORE),
    "revenue_forecast_checks": lambda t: forecast.interval_checks(
        forecast.revenue_forecast(t.daily_table, TRAIN_BEFORE), t.series
    ),
    "forecast_derivatives": lambda t: forecast.derivatives(forecast.fit_forecast(t.series)).select(
        "days", (F.round("derivative", 6) + 0.0).alias("derivative")
    ),
    "category_daily_revenue": lambda t: marts.category_daily_revenue(t.orders, t.products),
    "category_forecast": lambda t: forecast.category_forecast(t.category_daily, TRAIN_BEFORE),
    "category_forecast_calendar": lambda t: forecast.category_forecast(
        t.category_daily, TRAIN_BEFORE
    ).select("category", "forecast_date", "record_type"),
    "category_forecast_checks": lambda t: forecast.interval_checks(
        forecast.category_forecast(t.category_daily, TRAIN_BEFORE), t.category_series, ["category"]
    ),
    "category_forecast_derivatives": lambda t: forecast.derivatives(
        forecast.fit_forecast(t.category_series, ["category"])
    ).select("category", "days", (F.round("derivative", 6) + 0.0).alias("derivative")),
    "forecast_mart_by_rule": lambda t: t.rule_forecast,
    "forecast_horizon": lambda t: forecast.forecast_only(t.rule_yhat, t.series),
    "forecast_table": lambda t: kpis.forecast_table(t.rule_forecast),
    "forecast_history": lambda t: kpis.of_record_type(t.rule_forecast, "actual"),
    "forecast_total": lambda t: kpis.forecast_total(t.rule_forecast),
    "forecast_next_7": lambda t: forecast.horizon_summary(t.rule_forecast, 7),
    "forecast_next_30": lambda t: forecast.horizon_summary(t.rule_forecast),
    "record_type_breakdown": lambda t: forecast.record_type_breakdown(t.rule_forecast),
    # streams over the events table
    "stream_events": lambda t: t.run_stream(),
    "stream_daily_counts": lambda t: t.run_stream(counts=True),
    "daily_event_counts": lambda t: stream.daily_counts(t.events),
}


def registered() -> dict[str, Query]:
    """Name to ``(spark, folder) -> DataFrame``."""

    def bind(build):
        return lambda spark, folder: build(Retail(spark, folder))

    return {name: bind(build) for name, build in QUERIES.items()}
