import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.operators import ranking
from tallymart.operators.ranking import (
    percentile_rank,
    running_totals,
    value_counts,
    value_percentiles,
)
from tallymart.operators.segments import rfm_scores
from tallymart.session import pin


def frame(spark, seed, n=900):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "recency_days": np.where(rng.random(n) < 0.35, 7, rng.integers(0, 40, n)),
            "frequency": rng.integers(1, 9, n),
            "monetary": np.round(rng.random(n) * 500, 2),
        }
    )
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("ranges", [None, 1, 5, 64])
def test_percentile_rank_equals_pandas(spark, seed, ranges):
    pdf, df = frame(spark, seed)
    names = {"r": "recency_days", "f": "frequency", "m": "monetary"}
    got = percentile_rank(df, names, ranges).toPandas().sort_values("id")
    for name, column in names.items():
        want = pdf[column].rank(pct=True)
        assert np.array_equal(got[name].to_numpy(), want.to_numpy()), column


def test_rank_of_nulls_is_null_and_they_are_not_counted(spark):
    df = spark.createDataFrame(
        [(1, 5.0), (2, None), (3, 5.0), (4, 9.0), (5, None)], "id long, x double"
    )
    got = {r["id"]: r["pct"] for r in percentile_rank(df, {"pct": "x"}).collect()}
    assert got == {1: 0.5, 2: None, 3: 0.5, 4: 1.0, 5: None}


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, x double")
    assert percentile_rank(df, {"pct": "x"}).count() == 0


def test_ranges_change_no_result(spark):
    _, df = frame(spark, 11)
    counts = value_counts(df, {"m": "monetary", "r": "recency_days"})
    one, many = running_totals(counts, ranges=1), running_totals(counts, ranges=50)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def stored_ranges(spark, monkeypatch, df, ranges):
    """The stored ranges behind the running totals."""
    kept = []
    monkeypatch.setattr(ranking, "pin", lambda x, label="": kept.append(pin(x, label)) or kept[-1])
    value_percentiles(df, {"x": "x"}, ranges)
    return kept[0]


def test_ranges_stay_balanced_under_a_hot_value(spark, monkeypatch):
    """No range holds much more than its share of the distinct values."""
    n = 20_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id")).alias("x"))
    cut = stored_ranges(spark, monkeypatch, df, 20)
    sizes = [r["count"] for r in cut.groupBy("part").count().collect()]
    assert len(sizes) == 20 and max(sizes) < sum(sizes) / 20 * 2


def test_many_ranges_cost_no_wider_plan(spark, monkeypatch):
    """The plan holds no bound of any range, however many there are."""
    df = spark.range(1000).select(F.col("id").alias("x"))
    plans = []
    for ranges in (8, 1000):
        got = value_percentiles(df, {"x": "x"}, ranges)
        plans.append(got._jdf.queryExecution().optimizedPlan().toString())
    few, many = ("\n".join(line for line in p.splitlines() if "Relation" not in line) for p in plans)
    assert len(few.splitlines()) == len(many.splitlines()) and abs(len(few) - len(many)) < 50


def test_a_hot_value_is_split_in_the_lookup(spark, tmp_path):
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
    try:
        hot = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id"))
        spark.range(0, 300_000, 1, 16).select("id", hot.alias("x")).write.parquet(f"{tmp_path}/rows")
        got = percentile_rank(spark.read.parquet(f"{tmp_path}/rows"), {"pct": "x"})
        assert len(got.collect()) == 300_000
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_no_window_without_a_partition(spark):
    _, df = frame(spark, 5)
    pcts = value_percentiles(df, {"m": "monetary", "f": "frequency"})
    plan = pcts._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("measure" in line for line in windows)


@pytest.mark.parametrize("seed", range(3))
def test_scores_equal_pandas(spark, seed):
    pdf, df = frame(spark, seed)

    def score(series, reverse=False):
        pct = series.rank(pct=True)
        pct = 1 - pct if reverse else pct
        return np.searchsorted([0.2, 0.4, 0.6, 0.8], pct, side="left") + 1.0

    got = rfm_scores(df).toPandas().sort_values("id")
    assert np.array_equal(got["r_score"], score(pdf["recency_days"], True))
    assert np.array_equal(got["f_score"], score(pdf["frequency"]))
    assert np.array_equal(got["m_score"], score(pdf["monetary"]))
    assert np.array_equal(got["rfm_score"], got[["r_score", "f_score", "m_score"]].sum(axis=1))


def test_rank_equals_global_window(spark, small):
    part = spark.read.parquet(f"{small}/lineitem.parquet").select(
        F.col("l_extendedprice").alias("x")
    )
    w = Window.orderBy("x")
    want = part.select(
        "x",
        ((F.rank().over(w) + (F.count("*").over(Window.partitionBy("x")) - 1) / 2.0)
         / F.count("*").over(Window.partitionBy(F.lit(1)))).alias("pct"),
    ).distinct()
    got = value_percentiles(part, {"m": "x"}).select("x", "pct")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
