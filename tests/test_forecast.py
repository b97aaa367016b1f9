import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.operators import forecast, kpis

START = dt.date(2022, 1, 1)
DAYS = 800


@pytest.fixture(scope="module")
def daily(spark):
    """Trend, week and year, and a spike on the last day."""
    rows = []
    for i in range(DAYS):
        day = START + dt.timedelta(days=i)
        y = 1000 + i + 200 * math.sin(2 * math.pi * i / 365.25) + 100 * (day.weekday() == 5)
        rows.append((day, round(y, 2) if i < DAYS - 1 else 99_999.0, 3, 10.0))
    return spark.createDataFrame(
        rows, "order_date date, total_revenue double, total_orders long, avg_order_value double"
    ).cache()


@pytest.fixture(scope="module")
def cut():
    return str(START + dt.timedelta(days=DAYS - 1))


@pytest.fixture(scope="module")
def mart(daily, cut):
    return forecast.revenue_forecast(daily, cut).cache()


def test_calendar_and_labels(mart):
    assert mart.count() == DAYS - 1 + 30
    assert mart.select("forecast_date").distinct().count() == DAYS - 1 + 30
    kinds = {r["record_type"]: r["days"] for r in forecast.record_type_breakdown(mart).collect()}
    # the cut spike day is predicted, but lies within the mart
    assert kinds == {"actual": DAYS, "forecast": 29}


def test_bounds_enclose_the_prediction(mart):
    bad = "not (lower_bound <= predicted_revenue and predicted_revenue <= upper_bound)"
    assert mart.where(bad).count() == 0


def test_prediction_follows_trend_and_seasons(mart):
    for r in mart.where("record_type = 'forecast'").collect():
        i = (r["forecast_date"] - START).days
        want = 1000 + i + 200 * math.sin(2 * math.pi * i / 365.25)
        want += 100 * (r["forecast_date"].weekday() == 5)
        assert abs(r["predicted_revenue"] - want) < 100


def test_horizon_figures(mart):
    week = forecast.horizon_summary(mart, 7).first()
    rest = forecast.horizon_summary(mart).first()
    assert week["days"] == 7 and rest["days"] == 29
    assert week["daily_mean"] == pytest.approx(week["predicted"] / 7)
    assert kpis.forecast_total(mart).first()["total"] == round(rest["predicted"])


def test_forecast_only_is_the_thirty_new_days(daily, cut):
    series = forecast.training_series(daily, cut)
    fitted = forecast.fit_forecast(series)
    out = forecast.forecast_only(
        forecast.predict(fitted, forecast.future_frame(series)), series
    )
    assert out.count() == 30
    assert out.agg(F.min("date")).first()[0] == START + dt.timedelta(days=DAYS - 1)


def test_negative_total_rounds_away_from_zero(spark):
    mart = spark.createDataFrame(
        [(dt.date(2024, 1, 1), -10.5, -20.0, 0.0, "forecast")],
        "forecast_date date, predicted_revenue double, lower_bound double, upper_bound double, "
        "record_type string",
    )
    assert kpis.forecast_total(mart).first()["total"] == -11.0


def week_frame(spark, values):
    first = dt.date(2024, 1, 1)
    rows = [(first + dt.timedelta(days=i), v, 1, v) for i, v in values.items()]
    return spark.createDataFrame(
        rows, "order_date date, total_revenue double, total_orders long, avg_order_value double"
    )


def test_weeks(spark):
    df = week_frame(spark, {0: 50.0, 1: 100.0, 7: 100.0, 8: 150.0, 14: 150.0})
    assert sorted(r["total_revenue"] for r in kpis.this_week(df).collect()) == [150.0, 150.0]
    assert sorted(r["total_revenue"] for r in kpis.last_week(df).collect()) == [100.0, 100.0]
    got = kpis.weekly_kpis(df).first()
    assert (got["wow_pct"], got["direction"], got["sign"]) == (50.0, "up", "+")
    down = kpis.weekly_kpis(week_frame(spark, {0: 100.0, 7: 40.0})).first()
    assert (down["wow_pct"], down["direction"], down["sign"]) == (-60.0, "down", "")


def test_no_revenue_last_week_gives_no_change(spark):
    got = kpis.weekly_kpis(week_frame(spark, {0: 100.0, 20: 40.0})).first()
    assert got["last_week_revenue"] == 0.0 and got["wow_pct"] == 0.0


def many_series(spark, daily):
    """Three series of one table, of unlike length, level and last day."""
    parts = [("a", 1.0, 0, DAYS), ("b", -0.2, 100, 500), ("c", 7.0, 300, DAYS - 1)]
    first = F.lit(START)
    out = None
    for name, factor, lo, hi in parts:
        own = daily.where((F.col("order_date") >= F.date_add(first, lo)) & (F.col("order_date") < F.date_add(first, hi)))
        own = own.select(F.lit(name).alias("category"), "order_date", F.round(F.col("total_revenue") * factor, 2).alias("total_revenue"))
        out = own if out is None else out.unionByName(own)
    return out.repartition(5)


def test_each_series_equals_its_own_fit(spark, daily, cut):
    table = many_series(spark, daily)
    got = forecast.category_forecast(table, cut).cache()
    for name in "abc":
        own = table.where(F.col("category") == name).drop("category")
        want = forecast.revenue_forecast(own, cut)
        mine = got.where(F.col("category") == name).drop("category")
        pairs = mine.join(want.withColumnsRenamed({c: f"w_{c}" for c in want.columns if c != "forecast_date"}), "forecast_date")
        assert pairs.count() == want.count() == mine.count()
        bad = " or ".join(f"abs({c} - w_{c}) > 0.011" for c in ("predicted_revenue", "lower_bound", "upper_bound"))
        assert pairs.where(f"{bad} or record_type <> w_record_type").count() == 0


def test_fit_equals_a_direct_solution(spark, daily, cut):
    """The weights minimise squared error / noise + squared weights, with a free intercept."""
    series = forecast.training_series(daily, cut)
    fitted = forecast.fit_forecast(series)
    names = [*forecast.TREND_COLUMNS, *forecast.SEASON_COLUMNS]
    pdf = forecast.seasonal_features(series, series).toPandas()
    x = pdf[names].to_numpy() * [forecast._prior(c) for c in names]
    m = fitted.models.first()
    y = pdf["y"].to_numpy() / m["scale"]
    design = np.hstack([np.ones((len(x), 1)), x])
    penalty = np.diag([0.0, *[m["noise"]] * len(names)])
    want = np.linalg.solve(design.T @ design + penalty, design.T @ y)
    assert np.allclose([m["intercept"], *m["weights"]], want, atol=1e-7)
    assert m["residual_dev"] == pytest.approx(np.std(y - design @ want) * m["scale"])
    assert forecast.derivatives(fitted).first()["derivative"] < 1e-9


def test_short_series(spark):
    rows = [("a", START, 5.0), ("b", START, None), ("c", START, 0.0), ("c", START + dt.timedelta(days=1), 0.0)]
    table = spark.createDataFrame(rows, "category string, order_date date, total_revenue double")
    got = forecast.category_forecast(table, periods=2).orderBy("category", "forecast_date").collect()
    assert [r["category"] for r in got if r["category"] != "b"] == ["a"] * 3 + ["c"] * 4
    assert {r["predicted_revenue"] for r in got if r["category"] == "a"} == {5.0}
    assert {r["predicted_revenue"] for r in got if r["category"] == "c"} == {0.0}
