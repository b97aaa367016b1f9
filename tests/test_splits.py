import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tallymart.operators import splits


def order(key, seed=42):
    return hashlib.md5(f"{'' if key is None else key}-{seed}".encode()).hexdigest()


def want(rows, share, seed=42):
    """The first ``round(share * n)`` keys of each class in hash order."""
    test = set()
    for label in {y for _, y in rows}:
        keys = sorted((k for k, y in rows if y == label), key=lambda k: order(k, seed))
        test |= set(keys[: math.floor(len(keys) * share + 0.5)])
    return test


@pytest.mark.parametrize("share,digits", [(0.2, 4), (0.2, 1), (0.37, 2), (0.5, 32), (0.0, 4), (1.0, 4)])
def test_each_class_gives_its_exact_share(spark, share, digits):
    rows = [(i, None if i % 17 == 0 else int(i % 5 == 0)) for i in range(3001)]
    df = spark.createDataFrame(rows, "customer_id long, churned int")
    cuts = splits.class_cuts(df, "churned", "customer_id", share, 42, digits)
    test = splits.is_test_row(cuts, "churned", "customer_id")
    assert {r[0] for r in df.where(test).collect()} == want(rows, share)


def test_split_does_not_depend_on_partitioning_but_on_the_seed(spark):
    df = spark.range(5000).select(F.col("id").alias("customer_id"), (F.col("id") % 3).alias("churned"))
    train, test = splits.stratified_split(df)
    assert train.count() + test.count() == 5000 and test.count() == 333 + 333 + 333
    assert splits.stratified_split(df.repartition(13))[1].exceptAll(test).count() == 0
    assert splits.stratified_split(df, seed=7)[1].exceptAll(test).count() > 0


def test_equal_first_ranges_are_refined(spark, monkeypatch):
    """All keys share the first 28 digits, so seven rounds narrow nothing."""
    df = spark.range(100).select(F.format_string("%032x", "id").alias("customer_id"), F.lit(1).alias("churned"))
    monkeypatch.setattr(splits, "split_hash", lambda key, seed=42: F.col(key))
    got = splits.stratified_split(df)[1]
    assert sorted(int(r[0], 16) for r in got.collect()) == list(range(20))


def test_repeated_and_null_keys_stay_together(spark):
    rows = [(None, 0)] * 40 + [(5, 0)] * 40 + [(i, 1) for i in range(10)]
    df = splits.with_split(spark.createDataFrame(rows, "customer_id int, churned int"))
    sides = df.groupBy("customer_id", "churned").agg(F.count_distinct("is_test").alias("sides"))
    assert sides.where("sides > 1").count() == 0
    assert df.where("churned = 0 and is_test").count() == 40  # the keys at the cut, whole
    assert df.where("churned = 1 and is_test").count() == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "customer_id int, churned int")
    assert splits.with_split(df).count() == 0


def test_counts_not_rows_are_shuffled(spark):
    df = spark.range(10).select(F.col("id").alias("customer_id"), F.lit(1).alias("churned"))
    plan = splits.with_split(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
