"""Seasonal revenue forecast on the daily mart.

A piecewise linear trend with yearly and weekly Fourier terms, fitted as one
penalised regression.  Each coefficient has a normal prior; scaling a feature by
its prior's width makes one ridge penalty stand for all of them.

One series or many: ``by`` names the columns that tell series apart.  Features and predictions are
column expressions; a series' equations, from one row per calendar day, are solved in one group of
its own, so the groups do not grow with the orders behind a day.
"""

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ACTUAL, FORECAST, FORECAST_DAYS
from ..functions.money import amount, cents, mean_amount
from ..session import pin

# Fixed values of the seasonal model: periods in days, Fourier orders, trend
# bends and the part of the history they lie in, prior widths, interval.
YEAR_DAYS, YEAR_ORDER = 365.25, 10
WEEK_DAYS, WEEK_ORDER = 7.0, 3
BENDS, BEND_RANGE = 25, 0.8
TREND_PRIOR, BEND_PRIOR, SEASON_PRIOR = 5.0, 0.05, 10.0
INTERVAL_Z = 1.2816  # 80 % of a normal distribution

SEASON_COLUMNS = tuple(
    f"{name}_{wave}_{i}"
    for name, order in (("year", YEAR_ORDER), ("week", WEEK_ORDER))
    for i in range(1, order + 1)
    for wave in ("sin", "cos")
)
TREND_COLUMNS = ("trend", *(f"bend_{i}" for i in range(1, BENDS + 1)))


def training_series(
    daily: DataFrame, before: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """``(*by, ds, y)`` of the daily mart, days before ``before`` only."""
    if before is not None:
        daily = daily.where(F.col("order_date") < F.lit(before).cast("date"))
    return daily.select(*by, F.col("order_date").alias("ds"), F.col("total_revenue").alias("y"))


def series_profile(series: DataFrame) -> DataFrame:
    """First day, last day, number of days and mean revenue."""
    return series.agg(
        F.min("ds").alias("first_day"),
        F.max("ds").alias("last_day"),
        F.count("ds").alias("days"),
        mean_amount(F.sum(cents(F.col("y"))), F.count("y")).alias("mean_revenue"),
    )


def future_frame(
    series: DataFrame, periods: int = FORECAST_DAYS, by: Sequence[str] = ()
) -> DataFrame:
    """``ds`` of the history and of the ``periods`` days after it, for each series."""
    last = F.max("ds")
    ahead = series.groupBy(*by).agg(
        F.sequence(F.date_add(last, 1), F.date_add(last, periods)).alias("days")
    )
    return series.select(*by, "ds").unionByName(ahead.select(*by, F.explode("days").alias("ds")))


def _with_span(df: DataFrame, series: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` with ``span``, the first and last day of its series."""
    ends = (F.min("ds").alias("lo"), F.max("ds").alias("hi"))
    if not by:
        return df.withColumn("span", series.agg(*ends).select(F.struct("*")).scalar())
    spans = series.groupBy(*by).agg(F.struct(*ends).alias("span"))
    return df.join(spans, list(by))


def seasonal_features(df: DataFrame, series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Append trend, bend and Fourier columns; the trend runs 0..1 over each series."""
    days = F.datediff("ds", F.lit("1970-01-01").cast("date"))
    t = F.col("trend")
    out = _with_span(df, series, by).withColumn(
        "trend",
        F.coalesce(
            F.try_divide(
                F.datediff("ds", "span.lo").cast("double"),
                F.datediff("span.hi", "span.lo").cast("double"),
            ),
            F.lit(0.0),
        ),
    )
    columns = [
        F.greatest(t - BEND_RANGE * i / BENDS, F.lit(0.0)).alias(f"bend_{i}")
        for i in range(1, BENDS + 1)
    ]
    for name, period, order in (
        ("year", YEAR_DAYS, YEAR_ORDER),
        ("week", WEEK_DAYS, WEEK_ORDER),
    ):
        for i in range(1, order + 1):
            angle = days * F.lit(2.0 * math.pi * i / period)
            columns.append(F.sin(angle).alias(f"{name}_sin_{i}"))
            columns.append(F.cos(angle).alias(f"{name}_cos_{i}"))
    return out.select(*df.columns, "trend", *columns)


def _prior(column: str) -> float:
    if column in SEASON_COLUMNS:
        return SEASON_PRIOR
    return TREND_PRIOR if column == "trend" else BEND_PRIOR


def _design(df: DataFrame, series: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` with ``x``, its features scaled by their priors, as one array."""
    names = (*TREND_COLUMNS, *SEASON_COLUMNS)
    features = seasonal_features(df, series, by)
    return features.select(*df.columns, F.array(*[F.col(c) * _prior(c) for c in names]).alias("x"))


SOLVED = (
    "days long, scale double, intercept double, weights array<double>, noise double, "
    "residual_dev double"
)


def _solve(x: np.ndarray, y: np.ndarray) -> tuple:
    """Weights of one series.

    A nearly free fit gives the noise variance; the priors then weigh against it.
    """
    scale = float(np.abs(y).max()) or 1.0
    target = y / scale
    centre, level = x.mean(0), target.mean()
    apart, rest = x - centre, target - level
    gram, pull, eye = apart.T @ apart, apart.T @ rest, np.eye(x.shape[1])
    free = np.linalg.solve(gram + 1e-9 * len(y) * eye, pull)
    noise = max(float(np.mean((rest - apart @ free) ** 2)), 1e-12)
    weights = np.linalg.solve(gram + noise * eye, pull)
    dev = math.sqrt(float(np.mean((rest - apart @ weights) ** 2))) * scale
    return len(y), scale, float(level - centre @ weights), weights, noise, dev


class ForecastModel:
    """``models``: a row per series with its weights; ``series``: what they were fitted on."""

    def __init__(self, series: DataFrame, models: DataFrame, by: Sequence[str]):
        self.series, self.models, self.by = series, models, list(by)


def fit_forecast(series: DataFrame, by: Sequence[str] = ()) -> ForecastModel:
    """Fit each series of ``(*by, ds, y)``, one row per calendar day; days without a value are left out."""
    series = pin(series.where(F.col("y").isNotNull()), "series")
    design = _design(series, series, by).withColumn("y", F.col("y").cast("double"))
    keys = [design.schema[c] for c in by]
    schema = ", ".join([*(f"`{k.name}` {k.dataType.simpleString()}" for k in keys), SOLVED])

    def solve(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # sorted, so that sums do not depend on the order in which rows arrive
        rows = rows.sort_values("ds")
        solved = _solve(np.stack(rows["x"].to_numpy()), rows["y"].to_numpy(float))
        return pd.DataFrame([(*key, *solved)])

    models = design.groupBy(*by).applyInPandas(solve, schema)
    return ForecastModel(series, pin(models, "models"), by)


def predict(fitted: ForecastModel, future: DataFrame) -> DataFrame:
    """``(*by, ds, yhat, yhat_lower, yhat_upper)``."""
    by = fitted.by
    design = _design(future.select(*by, "ds"), fitted.series, by)
    if by:
        with_model = design.join(fitted.models, by)
    else:
        model = fitted.models.select(F.struct("*")).scalar()
        with_model = design.withColumn("m", model).select("ds", "x", "m.*")
    product = F.zip_with("x", "weights", lambda a, b: a * b)
    fit = F.aggregate(product, F.lit(0.0), lambda total, p: total + p) + F.col("intercept")
    half = F.lit(INTERVAL_Z) * F.col("residual_dev")
    return with_model.select(
        *by, "ds", (fit * F.col("scale")).alias("yhat"), half.alias("half")
    ).select(
        *by,
        "ds",
        "yhat",
        (F.col("yhat") - F.col("half")).alias("yhat_lower"),
        (F.col("yhat") + F.col("half")).alias("yhat_upper"),
    )


def derivatives(fitted: ForecastModel) -> DataFrame:
    """``(*by, days, derivative)``: the steepest derivative of each series' penalised squares, 0 at their least.

    Taken from the predictions, in the target's own scale.
    """
    by = fitted.by
    rows = _design(fitted.series, fitted.series, by).join(
        predict(fitted, fitted.series), [*by, "ds"]
    )
    rest = F.col("y") - F.col("yhat")
    names = len(TREND_COLUMNS) + len(SEASON_COLUMNS)
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(F.sum(rest), *[F.sum(rest * F.col("x")[i]) for i in range(names)]).alias("sums"),
    )
    models = fitted.models.select(*by, "scale", "weights", "noise")
    if by:
        joined = sums.join(models, by)
    else:
        joined = sums.withColumn("m", models.select(F.struct("*")).scalar()).select("*", "m.*")
    pulled = F.concat(F.array(F.lit(0.0)), F.transform("weights", lambda w: w * F.col("noise")))
    slopes = F.zip_with("sums", pulled, lambda s, w: F.abs(s / F.col("scale") - w))
    return joined.select(*by, F.col("n").alias("days"), F.array_max(slopes).alias("derivative"))


def after_last_day(forecast: DataFrame, series: DataFrame) -> DataFrame:
    """Rows dated after the last training day."""
    return forecast.where(F.col("ds") > series.select(F.max("ds")).scalar())


def forecast_only(forecast: DataFrame, series: DataFrame) -> DataFrame:
    """The horizon, renamed and rounded to cents."""
    return after_last_day(forecast, series).select(
        F.col("ds").alias("date"),
        F.round("yhat", 2).alias("predicted"),
        F.round("yhat_lower", 2).alias("lower_bound"),
        F.round("yhat_upper", 2).alias("upper_bound"),
    )


def record_type(day: Column, daily: DataFrame) -> Column:
    """``actual`` up to the last day of the *whole* daily mart, else ``forecast``.

    A day cut from training but present in the mart is thus labelled actual.
    """
    last = daily.select(F.max("order_date")).scalar()
    return F.when(day <= last, ACTUAL).otherwise(FORECAST)


def forecast_mart(forecast: DataFrame, daily: DataFrame) -> DataFrame:
    """The forecast mart's columns."""
    return forecast.select(
        F.col("ds").cast("date").alias("forecast_date"),
        F.round("yhat", 2).alias("predicted_revenue"),
        F.round("yhat_lower", 2).alias("lower_bound"),
        F.round("yhat_upper", 2).alias("upper_bound"),
        record_type(F.col("ds"), daily).alias("record_type"),
    )


def revenue_forecast(
    daily: DataFrame, train_before: str | None = None, periods: int = FORECAST_DAYS
) -> DataFrame:
    """Daily mart to forecast mart."""
    daily = pin(daily)
    series = training_series(daily, train_before)
    fitted = fit_forecast(series)
    return forecast_mart(predict(fitted, future_frame(series, periods)), daily)


def category_series(category_daily: DataFrame, before: str | None = None) -> DataFrame:
    """``(category, ds, y)`` of the daily revenue per category, days before ``before`` only."""
    return training_series(category_daily, before, ("category",))


def category_forecast(
    category_daily: DataFrame, train_before: str | None = None, periods: int = FORECAST_DAYS
) -> DataFrame:
    """A forecast mart per category, each from its own series.

    A day is ``actual`` up to the last day that the category has in the whole table.
    """
    daily = pin(category_daily, "category-daily")
    series = category_series(daily, train_before)
    fitted = fit_forecast(series, ("category",))
    found = predict(fitted, future_frame(series, periods, ("category",)))
    last = daily.groupBy("category").agg(F.max("order_date").alias("last_day"))
    return found.join(last, "category").select(
        "category",
        F.col("ds").cast("date").alias("forecast_date"),
        F.round("yhat", 2).alias("predicted_revenue"),
        F.round("yhat_lower", 2).alias("lower_bound"),
        F.round("yhat_upper", 2).alias("upper_bound"),
        F.when(F.col("ds") <= F.col("last_day"), ACTUAL).otherwise(FORECAST).alias("record_type"),
    )


def horizon_summary(mart: DataFrame, days: int | None = None) -> DataFrame:
    """Total, mean and bound totals of the first ``days`` forecast rows (None: all)."""
    rows = mart.where(F.col("record_type") == FORECAST)
    if days is not None:
        rows = rows.orderBy("forecast_date").limit(days)
    total = F.sum(F.rint(F.col("predicted_revenue") * 100).cast("long"))
    return rows.agg(
        F.count(F.lit(1)).alias("days"),
        amount(total).alias("predicted"),
        F.try_divide(amount(total), F.count(F.lit(1)).cast("double")).alias("daily_mean"),
        amount(F.sum(cents(F.col("lower_bound")))).alias("lower_bound"),
        amount(F.sum(cents(F.col("upper_bound")))).alias("upper_bound"),
    )


def interval_checks(mart: DataFrame, series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per series, how many rows of a mart break its definition, told from the fitted days alone.

    The interval is ``INTERVAL_Z`` times the root mean square of the rounded residuals to either side.
    """
    known = series.select(*by, F.col("ds").alias("forecast_date"), "y")
    rest = F.col("y") - F.col("predicted_revenue")
    joined = mart.join(known, [*by, "forecast_date"], "left")
    dev = joined.groupBy(*by).agg(F.sqrt(F.avg(rest * rest)).alias("dev"))
    if by:
        joined = joined.join(dev, list(by))
    else:
        joined = joined.withColumn("dev", dev.scalar())
    half, p = INTERVAL_Z * F.col("dev"), F.col("predicted_revenue")
    return joined.groupBy(*by).agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if(F.col("record_type") == ACTUAL).alias("actual_days"),
        F.count("y").alias("fitted_days"),
        F.count_if((F.col("lower_bound") > p) | (p > F.col("upper_bound"))).alias("disordered"),
        F.count_if(
            (F.abs(p - F.col("lower_bound") - half) > 0.03)
            | (F.abs(F.col("upper_bound") - p - half) > 0.03)
        ).alias("wrong_widths"),
    )


def record_type_breakdown(mart: DataFrame) -> DataFrame:
    """Days and mean predicted revenue per record type."""
    total = F.sum(cents(F.col("predicted_revenue"))).cast("double")
    n = F.count("predicted_revenue").cast("double")
    return mart.groupBy("record_type").agg(
        F.count(F.lit(1)).alias("days"),
        F.round(F.try_divide(total, n * 100.0), 0).alias("avg_daily_revenue"),
    )
