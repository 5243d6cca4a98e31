"""Text and identifier normalisation."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink import fixed_values as fv


def strip_spaces(c: Column) -> Column:
    """Strip every Unicode space separator; tabs and line ends stay.

    The plain ``trim`` knows U+0020 only, and a ``trim`` that is given characters
    is far slower.  Text in ASCII alone, which has as many bytes as characters,
    needs no more than the plain one.
    """
    plain = F.trim(c)
    return F.when(F.length(plain) == F.octet_length(plain), plain).otherwise(
        F.trim(c, F.lit(fv.SPACE_SEPARATORS))
    )


def strip_white_space(c: Column) -> Column:
    """Strip spaces of every kind, tabs, line ends and separators."""
    plain = F.trim(c)
    clean_ascii = (
        (F.length(plain) == F.octet_length(plain))
        & (F.ascii(plain) > 32)
        & (F.ascii(F.right(plain, F.lit(1))) > 32)
    )
    return F.when(clean_ascii, plain).otherwise(F.trim(c, F.lit(fv.WHITE_SPACE)))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def shorten_identifier(c: Column) -> Column:
    """Stripped text as an identifier: blank is null, a trailing ``.0`` is cut.

    Few values end in ``.0``, so the expression behind that test seldom runs.
    """
    integral = F.endswith(c, F.lit(".0")) & c.rlike(r"^-?\p{Nd}+\.0\z")
    return F.when(integral, F.left(c, F.length(c) - F.lit(2))).when(c != "", c)


def identifier_of_number(c: Column) -> Column:
    """Digits of a floating-point identifier; NaN is null."""
    return (
        F.when(F.isnan(c), F.lit(None))
        .when(c == F.lit(float("inf")), F.lit("inf"))
        .when(c == F.lit(float("-inf")), F.lit("-inf"))
        .when(F.rint(c) == c, c.try_cast("decimal(38,0)").cast("string"))
        .otherwise(c.cast("string"))
    )


def normalize_identifiers(df: DataFrame, names: Collection[str]) -> DataFrame:
    """Give identifier columns their canonical text; other columns stay.

    Numbers become their digits, booleans ``true`` / ``false``; text is stripped,
    blank text is null and a trailing ``.0`` of an integral number is cut.  Any
    other text stays as it is (``13127-1``, ``1.00``, ``12.50``).

    Stripping and shortening are two projections, so that the stripped text is
    computed once although the second one refers to it several times.
    """
    texts = {
        item.name
        for item in df.schema
        if item.name in names and isinstance(item.dataType, T.StringType)
    }

    def first(item: T.StructField) -> Column:
        c = F.col(f"`{item.name}`")
        if item.name in texts:
            return strip_white_space(c).alias(item.name)
        if item.name not in names:
            return c
        if isinstance(item.dataType, (T.FloatType, T.DoubleType)):
            return identifier_of_number(c).alias(item.name)
        return c.cast("string").alias(item.name)

    def second(name: str) -> Column:
        c = F.col(f"`{name}`")
        return shorten_identifier(c).alias(name) if name in texts else c

    stripped = df.select(*(first(item) for item in df.schema))
    return stripped.select(*(second(name) for name in df.columns))
