"""Sums and moments that are the same bits in any order of the rows."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerlink.functions.numbers import exact_moments, exact_sum
from ledgerlink.operators.segment import outliers, segment

PARTS = (1, 7, 200)


def _frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, price double")


def _bits(df, n, seed):
    """The moments over ``n`` partitions of the rows in some order."""
    shuffled = df.orderBy(F.rand(seed)).repartition(n)
    row = exact_moments(shuffled, F.col("price")).first()
    return row["mean"], row["stddev"]


RNG = random.Random(3)
CASES = {
    "prices": [round(RNG.uniform(1, 900), 2) for _ in range(3000)],
    "signs": [RNG.uniform(-1e6, 1e6) for _ in range(2000)],
    "around a whole number": [4 + RNG.choice([-1e-6, 1e-6]) for _ in range(1000)],
    "large": [RNG.uniform(0, 9e11) for _ in range(1000)],
    "equal": [3.1] * 77,
}


@pytest.mark.parametrize("name", CASES)
def test_moments_are_exact_in_any_order(spark, name):
    values = CASES[name]
    found = {_bits(_frame(spark, values), n, n) for n in PARTS}
    assert len(found) == 1
    mean, stddev = found.pop()
    exact = [Fraction(v) for v in values]
    true_mean = sum(exact) / len(exact)
    variance = sum((v - true_mean) ** 2 for v in exact) / len(exact)
    assert math.isclose(mean, true_mean, rel_tol=1e-12)
    # Values are taken to nine decimals.
    assert math.isclose(stddev, math.sqrt(variance), rel_tol=1e-12, abs_tol=1e-9)
    if name == "equal":
        assert stddev == 0.0


def test_moments_of_odd_values(spark):
    of = lambda values: tuple(exact_moments(_frame(spark, values), F.col("price")).first())
    assert of([None, 1.0, None, 2.0]) == (1.5, 0.5)
    assert exact_moments(_frame(spark, [1.0]).limit(0), F.col("price")).first()["mean"] is None
    assert of([1e15, 1e15]) == (1e15, 0.0)
    mean, stddev = of([1.0, math.inf])
    assert mean == math.inf and math.isnan(stddev)


def test_a_score_at_the_threshold_has_one_label(spark):
    """Four zeros to each one: the score of the ones is 2, and not above it."""
    df = _frame(spark, [0.0] * 4000 + [1.0] * 1000)
    for n in PARTS:
        assert outliers(df.orderBy(F.rand(n)).repartition(n), "id", "price").isEmpty()
    labelled = [
        sorted(tuple(r) for r in segment(_frame(spark, CASES["prices"]).repartition(n))
               .select("id", "z_score", "category").collect())
        for n in PARTS
    ]
    assert labelled[0] == labelled[1] == labelled[2]


@pytest.mark.parametrize(
    "values",
    [
        [1e20, 0.01, -1e20, 0.02],
        [1e20, 0.01],
        [-1e20, 0.01, 5e18, 7.25],
        [1e18, -0.01],
        [2.5e18] * 500 + [0.01] * 7,
        [1e35, 1.5, -1e35],
        [-1e18, 1e18 - 1e9, 0.5],
    ],
)
def test_large_and_small_amounts_add_up(spark, values):
    df = _frame(spark, values)
    found = {
        df.orderBy(F.rand(n)).repartition(n).agg(exact_sum(F.col("price")).alias("s")).first()[0]
        for n in PARTS
    }
    assert found == {float(sum(Fraction(repr(v)) for v in values))}
