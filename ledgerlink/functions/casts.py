"""Tolerant casts of source text: a value that does not parse is null.

Spark's own ``try_cast`` differs from the source system's in the forms it takes
(``12.0`` as an integer, ``1.5d`` as a double, ``2020`` as a timestamp); the
functions below accept the source system's forms.

A ``try_cast`` to a number that fails raises and catches an exception inside, at
many times the cost of a success.  So cheap tests of the text come first, and a
cast is tried only where it will nearly always succeed.  The functions refer to
their argument several times: give them a column, not a long expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]{1,3})?\s*$"
# The integer part depends on the first decimal only, so decimals beyond the
# 17th are cut before they could round up.
_LONG_FRACTION = r"^([^eE]*\.[0-9]{17})[0-9]+$"
_DATE_OR_DATE_TIME = r"^\s*[0-9]{4,6}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:.*)?\z"
_SLASHED_DATE = r"^\s*([0-9]{4,6})/([0-9]{1,2})/([0-9]{1,2})"


def _starts_like_number(c: Column) -> Column:
    """The first character is a digit, sign, point or blank, not a letter."""
    return F.ascii(c).between(9, 57)


def _any(tests: list[Column]) -> Column:
    found = tests[0]
    for test in tests[1:]:
        found = found | test
    return found


def to_long(c: Column) -> Column:
    """Integer of ``12``, ``12.0``, ``12.5`` (13, half away from zero), ``1e3``."""
    return _to_integer(c, "bigint")


def to_int(c: Column) -> Column:
    return _to_integer(c, "int")


def _to_integer(c: Column, target: str) -> Column:
    # A double may hold an integral number as text: ``12.0`` is as usual as ``12``.
    fractional = _any([F.contains(c, F.lit(mark)) for mark in (".", "e", "E")])
    digits = F.when(
        F.length(c) > 19, F.regexp_replace(c, _LONG_FRACTION, "$1")
    ).otherwise(c)
    rounded = F.round(digits.try_cast("decimal(38,18)"), 0).try_cast(target)
    return F.when(
        _starts_like_number(c),
        F.when(~fractional, c.try_cast(target)).when(c.rlike(_NUMBER), rounded),
    )


def to_double(c: Column) -> Column:
    """Double; nan and infinities pass, Java's type suffixes and hex forms do not."""
    java_only = _any(
        [F.endswith(c, F.lit(letter)) for letter in ("d", "D", "f", "F")]
        + [F.contains(c, F.lit(letter)) for letter in ("x", "X")]
    )
    word = F.lower(F.trim(c)).isin(
        "nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"
    )
    signed_nan = F.lower(F.trim(c)).isin("+nan", "-nan")
    return (
        F.when(signed_nan, F.lit(float("nan")))
        .when(_starts_like_number(c) & ~java_only, c.try_cast("double"))
        .when(word, c.try_cast("double"))
    )


def decimal_point(c: Column) -> Column:
    """The same number with a point where it has a decimal comma."""
    return F.when(
        F.contains(c, F.lit(",")), F.replace(c, F.lit(","), F.lit("."))
    ).otherwise(c)


def to_timestamp_ntz(c: Column) -> Column:
    """Zone-less timestamp of a full date, optionally with a time.

    The usual lengths are told by their separators; other forms are matched.
    """

    def has(position: int, mark: str) -> Column:
        return F.substring(c, position, 1) == mark

    size = F.length(c)
    usual = (size == 19) & has(5, "-") & has(17, ":")
    usual = usual | ((size == 10) & has(5, "-") & has(8, "-"))
    dashed = F.regexp_replace(c, _SLASHED_DATE, "$1-$2-$3")
    return (
        F.when(usual, c.try_cast("timestamp_ntz"))
        .when(c.rlike(_DATE_OR_DATE_TIME), c.try_cast("timestamp_ntz"))
        .when(
            F.contains(c, F.lit("/")) & dashed.rlike(_DATE_OR_DATE_TIME),
            dashed.try_cast("timestamp_ntz"),
        )
    )
