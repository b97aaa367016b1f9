"""Integer rounding against exact decimal arithmetic."""

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.functions import money
from tallymart.functions.scoring import band, quintile, safe_ratio


def half_up(value: Decimal, places: int) -> float:
    return float(value.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(1)
    rows = [
        (int(c), int(n)) for c, n in zip(rng.integers(0, 10**12, 3000), rng.integers(1, 500, 3000))
    ]
    rows += [(1, 2), (3, 2), (5, 2), (15, 10), (25, 10), (0, 7)]  # halves
    return rows, spark.createDataFrame(rows, "c long, n long").coalesce(2)


@pytest.mark.parametrize("places", [0, 1, 2])
def test_mean_amount(numbers, places):
    rows, df = numbers
    got = df.select("c", "n", money.mean_amount(F.col("c"), F.col("n"), places).alias("m"))
    for c, n, m in map(tuple, got.collect()):
        assert m == half_up(Decimal(c) / 100 / n, places)


def test_percent_and_mean_count(numbers):
    rows, df = numbers
    got = df.where("c < 100000000000000").select(
        "c",
        "n",
        money.percent(F.col("n"), F.col("c")).alias("p"),
        money.mean_count(F.col("n"), F.lit(8), 2).alias("k"),
    )
    for c, n, p, k in map(tuple, got.collect()):
        assert p == (half_up(Decimal(n) * 100 / c, 2) if c else None)
        assert k == half_up(Decimal(n) / 8, 2)


def test_line_revenue_is_rounded_once(spark):
    rng = np.random.default_rng(2)
    rows = [
        (int(q), float(Decimal(int(u)) / 10_000))
        for q, u in zip(rng.integers(1, 60, 2000), rng.integers(1, 10**9, 2000))
    ]
    rows += [(1, 1.005), (3, 3.333), (1, 0.0049), (1, 0.005)]
    got = spark.createDataFrame(rows, "q int, p double").select(
        "q", "p", money.amount(money.line_cents(F.col("q"), F.col("p"))).alias("r")
    )
    for q, p, r in map(tuple, got.collect()):
        assert r == half_up(Decimal(repr(p)) * q, 2)


def test_cents_round_trip(spark):
    df = spark.range(0, 2_000_000, 37).select(F.col("id").alias("c"))
    back = df.where(money.cents(money.amount(F.col("c"))) != F.col("c"))
    assert back.count() == 0


def test_no_lines_have_no_mean(spark):
    got = spark.range(1).select(money.mean_amount(F.lit(0), F.lit(0))).first()[0]
    assert got is None


def test_scores_at_the_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.2, 0.2000001, 0.8, 1.0, None)], "p double")
    got = [r[0] for r in df.select(quintile(F.col("p"))).collect()]
    assert got == [1.0, 1.0, 2.0, 4.0, 5.0, None]
    assert df.select(safe_ratio(F.lit(3), F.lit(0))).first()[0] == 3.0
    assert df.select(band(F.lit(0.6), ((0.7, "a"), (0.5, "b")), "c")).first()[0] == "b"


def test_small_prices_and_negative_means(spark):
    from pyspark.sql import functions as F

    from tallymart.functions.money import half_up_div, line_cents, mean_count

    row = spark.range(1).select(
        line_cents(F.lit(1000), F.lit(0.00123)).alias("a"),
        line_cents(F.lit(300_000), F.lit(0.00003)).alias("b"),
        mean_count(F.lit(-7), F.lit(2)).alias("c"),
        mean_count(F.lit(-10), F.lit(3)).alias("d"),
        half_up_div(F.lit(5), F.lit(0)).alias("e"),
    ).first()
    assert tuple(row) == (123, 900, -3.5, -3.3, None)


def test_prices_of_any_digits_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(1_000_000, 0.0000004), (2_000_000_000, 0.000000001), (3, 1.23456789), (2_000_000_000, 400_000.125)]
    rows += [(1, 123456789012.345), (7, 999999999.999999), (200, 0.0000250000001), (200, 0.000025)]
    rows += [
        (int(q), float(Decimal(int(u)).scaleb(-int(d))))
        for q, u, d in zip(rng.integers(1, 10**6, 2000), rng.integers(1, 10**9, 2000), rng.integers(2, 12, 2000))
    ]
    priced = spark.createDataFrame(rows, "q int, p double")
    for q, p, cents in priced.select("q", "p", money.line_cents(F.col("q"), F.col("p"))).collect():
        assert cents == half_up(Decimal(repr(p)) * q * 100, 0), (q, p)
    assert spark.range(1).select(money.line_cents(F.lit(None).cast("int"), F.lit(None).cast("double"))).first()[0] is None


def test_margins_of_any_digits_are_exact(spark):
    rng = np.random.default_rng(6)
    pairs = [(0.0000004, 0.0000001), (1.23456789, 1.2), (5.0, 4.0), (3.0, -1.5), (12345678901.25, 0.005)]
    pairs += [
        (float(Decimal(int(a)).scaleb(-d)), float(Decimal(int(b)).scaleb(-d)))
        for a, b, d in zip(rng.integers(1, 10**9, 500), rng.integers(1, 10**9, 500), map(int, rng.integers(2, 12, 500)))
    ]
    frame = spark.createDataFrame(pairs, "p double, c double")
    got = frame.select("p", "c", *money.margin(F.col("p"), F.col("c"))).collect()
    for p, c, cents, share in got:
        price, cost = Decimal(repr(p)), Decimal(repr(c))
        assert cents == half_up((price - cost) * 100, 0), (p, c)
        assert share == half_up((price - cost) / price * 100, 2), (p, c)
    none = spark.range(1).select(*money.margin(F.lit(0.0), F.lit(0.0000000001))).first()
    assert tuple(none) == (0, None)
