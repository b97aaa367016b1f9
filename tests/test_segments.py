import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.operators import kpis, segments
from tallymart.plans.catalog import Retail
from tallymart.session import pin


@pytest.fixture(scope="module")
def retail(spark, small):
    return Retail(spark, small)


@pytest.fixture(scope="module")
def scored(retail):
    return retail.scored.cache()


def test_recency_uses_the_day_after_the_last_order(retail):
    base = segments.rfm_base(retail.lifetime_table)
    assert base.agg(F.min("recency_days")).first()[0] >= 1
    fixed = segments.rfm_base(retail.lifetime_table, F.lit(dt.date(2002, 1, 1)))
    row = fixed.first()
    assert row["recency_days"] == (dt.date(2002, 1, 1) - row["last_order_date"]).days


def test_every_customer_gets_one_of_four_segments(spark, retail):
    out = segments.customer_segments(retail.lifetime_table).cache()
    active = retail.lifetime_table.where("completed_orders > 0")
    assert out.count() == active.count() == out.select("customer_id").distinct().count()
    names = {r[0] for r in out.select("segment").distinct().collect()}
    assert names == {"Champions", "Loyal", "At Risk", "Lost"}
    means = {
        r["segment"]: r["m"]
        for r in out.groupBy("segment").agg(F.avg("rfm_score").alias("m")).collect()
    }
    assert means["Champions"] > means["Loyal"] > means["At Risk"] > means["Lost"]
    assert out.columns == list(segments.SEGMENT_COLUMNS)


def test_clusters_do_not_depend_on_partitioning(scored):
    results = []
    for n in (1, 7):
        grid = segments.score_grid(scored.repartition(n))
        model = segments.fit_clusters(grid, starts=3)
        results.append(model.cost)
        assert grid.count() <= 125
        assert len(model.centres) == 4
    assert results[0] == results[1]


def test_best_start_is_kept(scored):
    grid = segments.score_grid(scored).cache()
    one = segments.fit_clusters(grid, starts=1).cost
    ten = segments.fit_clusters(grid, starts=6).cost
    assert ten <= one


def test_minmax_of_a_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1.0, 3.0), (5.0, 3.0), (None, 3.0)], "a double, b double")
    got = segments.minmax(df, ["a", "b"]).select("a_scaled", "b_scaled").collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0), (1.0, 0.0), (None, 0.0)]


def test_rows_without_a_score_are_left_out(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 3.0), (None, 1.0, 1.0)], "r_score double, f_score double, m_score double"
    )
    assert segments.scorable(df).count() == 1


def test_labels_follow_mean_score_then_cluster(spark):
    summary = spark.createDataFrame(
        [(0, 5.0), (1, 9.0), (2, 9.0), (3, 1.0), (4, 0.5)], "cluster int, avg_rfm double"
    )
    got = {r["cluster"]: r["segment"] for r in segments.cluster_labels(summary).collect()}
    assert got == {1: "Champions", 2: "Loyal", 0: "At Risk", 3: "Lost", 4: None}


def test_empty_segment_has_an_empty_card(spark):
    df = spark.createDataFrame(
        [("c1", "Loyal", 10.0, 1, 3), ("c2", "Loyal", 10.01, 2, 4)],
        "customer_id string, segment string, total_revenue double, frequency long, "
        "recency_days int",
    )
    cards = [tuple(r)[1:] for r in kpis.segment_cards(df).collect()]
    assert cards == [
        ("Champions", 0, 0.0),
        ("Loyal", 2, 10.01),  # 10.005 rounds up
        ("At Risk", 0, 0.0),
        ("Lost", 0, 0.0),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_clusters_are_a_fixed_point(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, *map(float, rng.integers(1, 6, 3)), None) for i in range(700)]
    scored = spark.createDataFrame(rows, "customer_id long, r_score double, f_score double, m_score double, cluster int").drop("cluster")
    grid = pin(segments.score_grid(scored))
    model = segments.fit_clusters(grid, k=4, starts=2, seed=seed)
    clustered = segments.assign_clusters(scored, grid, model)
    found = segments.cluster_certificate(clustered).first()
    assert (found["customers"], found["clusters"], found["misplaced"]) == (700, 4, 0)
    wrong = clustered.withColumn("cluster", F.when(F.col("customer_id") < 50, (F.col("cluster") + 1) % 4).otherwise(F.col("cluster")))
    assert segments.cluster_certificate(wrong).first()["misplaced"] > 0
    pdf = clustered.toPandas()
    points = (pdf[["r_score", "f_score", "m_score"]].to_numpy() - 1) / 4
    means = np.stack([points[pdf.cluster == c].mean(0) for c in range(4)])
    assert np.allclose(means, model.centres)
    assert model.cost == pytest.approx(((points - means[pdf.cluster]) ** 2).sum())
