"""Casts, blanks, identifiers and roundings, against DuckDB, NumPy and Decimal."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlink.functions import casts, numbers, text

NUMBERS = [
    "12", "12.0", "12.5", "-12.5", "1e3", "1.25e1", "0.49999999999999",
    "0.49999999999999999999", ".5", "5.", "+5", "1e-1", "5e-1", "4.9e-1", "1 2", "",
    "-", "12.0abc", "\t12\n", "9223372036854775807", "9223372036854775807.4",
    "9223372036854775807.5", "9223372036854775808", "-9223372036854775808.4", "1e18",
    "1e19", "0.5", "-0.5", "1.5", "2.5", "1,5", "true", "1.", "1.e2", ".", "1e",
    "00012", "-0", "15e-1", "149e-2", "123456789.123456789123456789", "--5", "nan",
    "NaN", "inf", "-Infinity", "infinity", "+inf", "INF", "1.5d", "1.5f", "2D",
    "0x1p3", "1e400", "-1e400", "1e-400", "1L", "infinit", "1 e5", "1.0E5", "1e+",
    "٣", "١٢.0", "n/a", "X-97", None,
]


def _column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def _duck(values, expression):
    connection = duckdb.connect()
    return [connection.execute(expression, [v]).fetchone()[0] for v in values]


def _evaluate(df, column):
    return [row[0] for row in df.select(column).collect()]


@pytest.mark.parametrize(
    "cast, target",
    [(casts.to_long, "BIGINT"), (casts.to_int, "INTEGER"), (casts.to_double, "DOUBLE")],
)
def test_tolerant_casts_take_the_same_forms(spark, cast, target):
    ours = _evaluate(_column(spark, NUMBERS), cast(F.col("x")))
    theirs = _duck(NUMBERS, f"SELECT TRY_CAST(? AS {target})")
    differing = [
        (value, mine, other)
        for value, mine, other in zip(NUMBERS, ours, theirs, strict=True)
        if str(mine) != str(other)
    ]
    assert differing == []


def test_casts_do_not_take_separators_and_prefixes(spark):
    # The other engine takes 1_000 and 0x10; they are no numbers here.
    df = _column(spark, ["1_000", "0x10"])
    assert _evaluate(df, casts.to_long(F.col("x"))) == [None, None]


def test_timestamps_need_a_full_date(spark):
    values = [
        "2020", "2020-01", "2020-01-02", "2020-1-2", "2020-01-02 10:00",
        "2020-01-02T10:00:00", "2020-01-02 10:00:00.123456", "2020-01-02 10:00:00+02",
        "2020-01-02 10:00:00Z", "bad", " 2020-01-02 ", "2020-01-02 25:00:00",
        "2020-13-01", "10:00", "2020-01-02 10", "2020/01/02", "2024-02-30",
        "2020/1/2 10:00:00", "2020-01-02 1:02:03", "2020-01-02 ", "2020-01-02T",
        " 2020-1-02", "2020-1-02 10:00:00 ", "  2020-01-02 10:00:00", " 2020-01-02",
        "2020/01/02 ", " 2020/01/02", "2020/01-02", None,
    ]
    ours = _evaluate(_column(spark, values), casts.to_timestamp_ntz(F.col("x")))
    assert ours == _duck(values, "SELECT TRY_CAST(? AS TIMESTAMP)")


def test_strip_spaces_strips_what_sql_trim_strips(spark):
    marks = [chr(i) for i in range(1, 0x3100) if chr(i).isspace()] + ["\u200b", "\u180e"]
    values = [f"{mark}a{mark}b{mark}" for mark in marks] + ["", "  ", " ", "é "]
    ours = _evaluate(_column(spark, values), text.strip_spaces(F.col("x")))
    assert ours == _duck(values, "SELECT trim(?)")


def _identifier(value):
    """What an identifier becomes, said in Python."""
    if value is None:
        return None
    stripped = value.strip()
    head, point, tail = stripped.partition(".")
    digits = head.removeprefix("-")
    if point and tail == "0" and digits and all(d.isdecimal() for d in digits):
        return head
    return stripped or None


def test_identifiers_of_text(spark):
    values = [
        "15298.0", " 13127-1 ", "bon-cadeau-25-euros", None, "", " \t\n", "-7.0",
        "1.00", "12.50", "12.0.0", ".0", "-.0", "+7.0", "  7.0 ", "٣12.0",
        "é.0", "\x1c7\x85", "0.0", "7.0\n", "a.0",
    ]
    df = text.normalize_identifiers(_column(spark, values), ["x"])
    assert [row.x for row in df.collect()] == [_identifier(v) for v in values]


def test_identifiers_of_typed_cells(spark):
    df = spark.createDataFrame(
        [(15298.0, True, 7, "kept "), (12.5, False, -3, None), (None, None, None, "")],
        "product_id double, id_web boolean, sku bigint, other string",
    )
    rows = text.normalize_identifiers(df, ["product_id", "id_web", "sku"]).collect()
    assert [tuple(row) for row in rows] == [
        ("15298", "true", "7", "kept "),
        ("12.5", "false", "-3", None),
        (None, None, None, ""),
    ]
    special = _column(spark, [float("nan"), float("inf"), -float("inf")], "double")
    ours = text.normalize_identifiers(special, ["x"]).collect()
    assert [row.x for row in ours] == [None, "inf", "-inf"]


def test_roundings(spark):
    rng = random.Random(5)
    values = [rng.randrange(0, 2_000_000) / 1000 for _ in range(20_000)]
    values += [157.605, -157.605, 0.5, 1.005, 2.675, 1e300, float("inf"), 0.0]
    df = _column(spark, values, "double")
    half_away = _evaluate(df, numbers.round_half_away(F.col("x"), 2))
    assert half_away == _duck(values, "SELECT round(?::DOUBLE, 2)")
    finite = values[:-2]
    half_even = _evaluate(
        _column(spark, finite, "double"), numbers.round_half_even(F.col("x"), 2)
    )
    with np.errstate(over="ignore"):
        expected = np.round(np.array(finite[:-1]), 2).tolist()
    assert half_even[:-1] == expected


def test_finite(spark):
    values = [1.0, None, float("nan"), float("inf"), -float("inf"), -1e308]
    ours = _evaluate(_column(spark, values, "double"), numbers.is_finite(F.col("x")))
    assert ours == [True, False, False, False, False, True]


def test_cents_round_half_up_on_the_decimal_text(spark):
    values = [70568.605, 70568.6049, 0.005, -0.005, 1.115, 1e15 + 0.25, 0.00499999999996]
    ours = _evaluate(_column(spark, values, "double"), numbers.to_cents(F.col("x")))
    cent = Decimal("0.01")
    assert ours == [
        Decimal(str(v)).quantize(cent, rounding=ROUND_HALF_UP) for v in values
    ]
    pair = spark.createDataFrame(
        [(1.0, None), (float("nan"), 1.0), (2.004, 2.0)], "a double, b double"
    )
    same = _evaluate(pair, numbers.same_cents(F.col("a"), F.col("b")))
    assert same == [False, False, True]


def test_exact_sum_does_not_depend_on_the_order(spark):
    rng = random.Random(7)
    values = [rng.randrange(1, 10**9) / 100 for _ in range(5_000)]
    total = float(sum(Decimal(str(v)) for v in values))
    for seed in range(3):
        rng.shuffle(values)
        df = _column(spark, values, "double").repartition(seed + 1)
        assert df.agg(numbers.exact_sum(F.col("x"))).first()[0] == total


def test_exact_sum_loses_no_value(spark):
    def total(*values):
        df = _column(spark, values, "double")
        return df.agg(numbers.exact_sum(F.col("x"))).first()[0]

    assert total() is None
    assert total(None) is None
    assert total(1.5, None, 2.25) == 3.75
    assert total(1e300, 1e300) == 2e300
    assert total(1e20, 1.0) == 1e20 + 1.0
    assert math.isnan(total(1.0, float("nan")))
    assert total(1.0, float("inf")) == math.inf
    assert math.isnan(total(-float("inf"), float("inf")))
