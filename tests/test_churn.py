import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallymart.operators import churn, kpis, logistic, metrics
from tallymart.plans.catalog import Retail


@pytest.fixture(scope="module")
def retail(spark, small):
    return Retail(spark, small)


@pytest.fixture(scope="module")
def run(retail):
    return churn.ChurnRun(retail.lifetime_table, retail.customers)


def test_features_on_the_snapshot_day(spark):
    lifetime = spark.createDataFrame(
        [
            ("c1", "n", "x", "e", "2024-01-01", 4, 3, 30.0, 10.0, "2024-01-01", "2024-01-01"),
            ("c2", "n", "x", "e", "2023-12-02", 2, 1, 30.0, None, "2023-12-02", "2023-10-02"),
            ("c3", "n", "x", "e", "2023-12-02", 2, 0, 0.0, None, "2023-12-02", "2023-12-02"),
            (None, "n", "x", "e", "2023-12-02", 2, 1, 9.0, 9.0, "2023-12-02", "2023-12-02"),
        ],
        "customer_id string, customer_name string, city string, acquisition_channel string, "
        "signup_date string, total_orders long, completed_orders long, total_revenue double, "
        "avg_order_value double, first_order_date string, last_order_date string",
    )
    lifetime = lifetime.withColumns(
        {c: F.col(c).cast("date") for c in lifetime.columns if c.endswith("_date")}
    )
    customers = lifetime.select("customer_id", "customer_name", "acquisition_channel", "city")
    got = {
        r["customer_id"]: r
        for r in churn.churn_features(
            lifetime, customers, F.lit("2024-01-01").cast("date")
        ).collect()
    }
    assert set(got) == {"c1", "c2"}  # no completed order, or no known customer: not scored
    assert got["c1"]["order_rate"] == 0.0 and got["c1"]["return_rate"] == 0.25
    assert got["c1"]["churned"] == 0 and got["c2"]["churned"] == 1
    assert got["c2"]["order_rate"] == 1.0 and got["c2"]["avg_order_value"] == 0.0
    assert got["c2"]["days_since_last_order"] == 91


def test_one_hot_drops_the_first_level(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "ch string")
    got = churn.one_hot(df, "ch")
    assert got.columns == ["ch", "channel_b", "channel_c"]
    assert {(r[0], r[1], r[2]) for r in got.collect()} == {
        ("b", 1, 0),
        ("a", 0, 0),
        ("c", 0, 1),
        (None, 0, 0),
    }


def test_many_levels(spark):
    df = spark.range(600).select(F.format_string("c%03d", "id").alias("ch"))
    assert len(churn.category_levels(df, "ch")) == 600
    assert churn.one_hot(df, "ch").where("channel_c599 = 1").count() == 1


def test_standardize_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0), (5.0, 4.0)], "a double, b double")
    got = churn.standardize(df, df, ["a", "b"]).toPandas()
    want = (np.array([1.0, 3.0, 5.0]) - 3.0) / np.std([1.0, 3.0, 5.0])
    assert np.allclose(got["a"], want) and (got["b"] == 0).all()


def test_model_minimises_the_penalised_loss(spark):
    """Equal to a direct Newton solution of summed loss + half the squared weights."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.3] + 0.5)))).astype(float)
    columns = ["a", "b", "c"]
    train = spark.createDataFrame(pd.DataFrame({**dict(zip(columns, x.T)), "churned": y}))
    model = churn.fit_churn(train, columns)
    design = np.hstack([x, np.ones((400, 1))])
    w, penalty = np.zeros(4), np.diag([1.0, 1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + penalty
        w -= np.linalg.solve(hessian, design.T @ (p - y) + penalty @ w)
    assert np.allclose([*model.coefficients, model.intercept], w, atol=1e-9)
    assert model.largest_derivative < 1e-6 and model.steps < 12


def dense_newton(x, y, c=1.0):
    """Weights and intercept of the same objective by a dense solution."""
    design = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(design.shape[1]), np.eye(design.shape[1]) / c
    penalty[-1, -1] = 0
    for _ in range(100):
        p = 1 / (1 + np.exp(-design @ w))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + penalty
        w -= np.linalg.solve(hessian, design.T @ (p - y) + penalty @ w)
    return w


@pytest.mark.parametrize("c", [1.0, 0.05])
def test_levels_are_fitted_as_their_scaled_columns(spark, c):
    """The table of levels gives what standardised 0/1 columns give; rows without a level included."""
    rng = np.random.default_rng(8)
    n, names = 900, np.array(["a", "b", "c", "d", None], object)
    level = names[rng.choice(5, n, p=[0.5, 0.3, 0.05, 0.1, 0.05])]
    x = rng.normal(size=(n, 2))
    truth = x @ [0.8, -0.5] + np.where(level == "b", 1.0, 0) - np.where(level == "d", 1.5, 0)
    y = (rng.random(n) < 1 / (1 + np.exp(-truth))).astype(int)
    rows = [(*map(float, v), None if lv is None else str(lv), int(t)) for v, lv, t in zip(x, level, y)]
    train = spark.createDataFrame(rows, "u double, v double, ch string, churned int").repartition(5)
    levels = logistic.level_table(train, "ch", F.lit(True))
    model = churn.fit_churn(train, ["u", "v"], c, "ch", levels)
    dummies = np.stack([(level == lv).astype(float) for lv in "bcd"], 1)
    scaled = (dummies - dummies.mean(0)) / dummies.std(0)
    want = dense_newton(np.hstack([x, scaled]), y, c)
    got = {r["level"]: r["weight"] for r in model.levels.collect()}
    assert np.allclose([*model.coefficients, *[got[lv] for lv in "bcd"]], want[:5], atol=1e-9)
    p = 1 / (1 + np.exp(-(np.hstack([x, scaled]) @ want[:5] + want[5])))
    found = model.probability(train, "p").toPandas()
    key = dict(zip(map(tuple, x.round(9)), p))
    assert all(abs(key[tuple(np.round((r.u, r.v), 9))] - r.p) < 1e-9 for r in found.itertuples())


def test_a_hundred_thousand_levels(spark):
    """Neither the plan nor the driver holds the levels, and the loss is at its least value."""
    n = 300_000
    rows = spark.range(0, n, 1, 8).select(
        ((F.xxhash64("id") % 1000) / 500.0).alias("u"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("l%06d", F.col("id") % 100_000)).alias("ch"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(7)) < F.when(F.col("id") % 2 == 0, 5).otherwise(2))
        .cast("int").alias("churned"),
    )
    levels = logistic.level_table(rows, "ch", F.lit(True))
    model = churn.fit_churn(rows, ["u"], 1.0, "ch", levels)
    assert model.levels.count() == 100_000 and model.largest_derivative < 1e-5
    scored = model.probability(rows, "p")
    slope = scored.agg(F.sum((F.col("p") - F.col("churned")) * F.col("u"))).first()[0]
    assert abs(slope + model.coefficients[0]) < 1e-5
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "l000001" not in plan and len(plan) < 20_000


def test_separable_rows_need_shorter_steps(spark):
    train = spark.createDataFrame(
        [(float(i) / 10, int(i > 50)) for i in range(100)], "u double, churned int"
    )
    model = churn.fit_churn(train, ["u"], 1e6)
    x = np.arange(100)[:, None] / 10
    assert model.largest_derivative < 1e-3 and model.coefficients[0] > 10
    p = 1 / (1 + np.exp(-(x[:, 0] * model.coefficients[0] + model.intercept)))
    assert ((p > 0.5) == (np.arange(100) > 50)).all()


def test_nothing_to_fit(spark):
    with pytest.raises(ValueError):
        churn.fit_churn(spark.createDataFrame([], "u double, churned int"), ["u"])


def test_derivatives_vanish(run):
    found = {r["feature"]: r["derivative"] for r in run.derivatives().collect()}
    assert len(found) == 12 and max(map(abs, found.values())) < 1e-6


def test_fit_does_not_depend_on_partitioning(retail):
    columns = ["x_total_revenue", "x_return_rate"]
    base = churn.ChurnRun(retail.lifetime_table, retail.customers).matrix
    fits = [churn.fit_churn(df, columns) for df in (base, base.repartition(17))]
    assert np.allclose(fits[0].coefficients, fits[1].coefficients, atol=1e-9)


def test_predictions(run, retail):
    out = run.predictions().cache()
    active = retail.lifetime_table.where("completed_orders > 0 and customer_id is not null")
    assert out.columns == list(churn.PREDICTION_COLUMNS)
    assert out.count() == active.count()
    assert out.where("churn_probability not between 0 and 1").count() == 0
    counts = kpis.risk_counts(out).first()
    assert sum(counts) == out.count()
    test = run.test_predictions()
    assert 0 < test.count() < out.count()
    assert metrics.roc_auc(test).first()["auc"] > 0.75


def test_coefficients_are_sorted(run):
    rows = run.coefficients().collect()
    values = [r["coefficient"] for r in rows]
    assert values == sorted(values) and len(rows) == 11
    assert all(r["raises_risk"] == (r["coefficient"] > 0) for r in rows)


def test_label_can_be_kept_from_the_model(retail):
    run = churn.ChurnRun(
        retail.lifetime_table, retail.customers, exclude=["days_since_last_order"]
    )
    assert "days_since_last_order" not in run.columns


def test_bands_and_label_at_their_limits(spark):
    p = spark.createDataFrame(
        [(0.75,), (0.7499,), (0.5,), (0.5001,), (0.4999,)], "churn_probability double"
    )
    got = {r[0]: (r[1], r[2]) for r in churn.label_churn(p).collect()}
    assert got == {
        0.75: (1, "High"),
        0.7499: (1, "Medium"),
        0.5: (0, "Medium"),
        0.5001: (1, "Medium"),
        0.4999: (0, "Low"),
    }


def scored_frame(spark, seed):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame(
        {
            "churned": rng.integers(0, 2, 500),
            "churn_probability": rng.integers(0, 30, 500) / 30,
        }
    )
    pdf["churn_label"] = (pdf["churn_probability"] > 0.5).astype(int)
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("seed", range(3))
def test_auc_counts_every_pair(spark, seed):
    pdf, df = scored_frame(spark, seed)
    pos = pdf.loc[pdf.churned == 1, "churn_probability"].to_numpy()[:, None]
    neg = pdf.loc[pdf.churned == 0, "churn_probability"].to_numpy()[None, :]
    want = ((pos > neg) + 0.5 * (pos == neg)).mean()
    assert metrics.roc_auc(df, ranges=6).first()["auc"] == pytest.approx(want, abs=1e-12)


def test_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.4)], "churned int, churn_probability double")
    assert metrics.roc_auc(df).first()["auc"] is None


def test_report_and_matrix(spark):
    df = spark.createDataFrame(
        [(0, 0)] * 5 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(1, 1)] * 4, "churned int, churn_label int"
    )
    cells = {(r[0], r[1]): r[2] for r in metrics.confusion(df).collect()}
    assert cells == {(0, 0): 5, (0, 1): 1, (1, 0): 2, (1, 1): 4}
    report = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert report["1"]["precision"] == 0.8 and report["1"]["recall"] == pytest.approx(4 / 6)
    assert report["accuracy"]["f1_score"] == 0.75 and report["0"]["support"] == 6
    none = metrics.classification_report(df.where("churned = 0 and churn_label = 0")).collect()
    assert {r["class"]: r["recall"] for r in none}["1"] == 0.0
