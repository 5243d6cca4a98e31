"""Cast the raw text tables and keep the rows that can be keyed and priced.

Optional fields that do not parse become null and keep their row.  The filter is on
the results of the casts, and Catalyst would move it below them with a copy of every
cast it refers to, so that each would run twice and the generated method outgrow
what the JVM compiles.  ``_once`` keeps it above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv
from ledgerlink.functions.casts import (
    decimal_point,
    to_double,
    to_int,
    to_long,
    to_timestamp_ntz,
)
from ledgerlink.functions.text import blank_to_null, strip_spaces


def _stripped(raw: DataFrame, *names: str) -> DataFrame:
    """The named text columns without the blanks around them, and the others."""
    return raw.select(
        *(
            strip_spaces(F.col(name)).alias(name) if name in names else F.col(name)
            for name in raw.columns
        )
    )


def _once(df: DataFrame, *columns: Column) -> DataFrame:
    """A projection that filters are not pushed through: an array of one row."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def clean_products(raw: DataFrame) -> DataFrame:
    """Products with a usable key and price."""
    names = fv.REQUIRED_COLUMNS["erp"]
    typed = _once(
        _stripped(raw.select(*names), *names).withColumn(
            "price", decimal_point(F.col("price"))
        ),
        to_long(F.col("product_id")).alias("product_id"),
        to_int(F.col("onsale_web")).alias("onsale_web"),
        to_double(F.col("price")).alias("price"),
        to_long(F.col("stock_quantity")).alias("stock_quantity"),
        blank_to_null(F.col("stock_status")).alias("stock_status"),
    )
    return typed.where(F.col("product_id").isNotNull() & F.col("price").isNotNull())


def clean_bridge(raw: DataFrame) -> DataFrame:
    """Bridge rows with a usable product key; an empty web key stays, as null."""
    names = fv.REQUIRED_COLUMNS["liaison"]
    typed = _once(
        _stripped(raw.select(*names), *names),
        to_long(F.col("product_id")).alias("product_id"),
        blank_to_null(F.col("id_web")).alias("id_web"),
    )
    return typed.where(F.col("product_id").isNotNull())


def clean_web(raw: DataFrame) -> DataFrame:
    """Web rows of a product type with a key, a sales figure and a title."""
    names = fv.REQUIRED_COLUMNS["web"]
    typed = _once(
        _stripped(raw.select(*names), *(n for n in names if n != "post_modified")),
        F.col("sku"),
        to_long(F.col("total_sales")).alias("total_sales"),
        F.col("post_title"),
        F.lower("post_type").alias("post_type"),
        to_timestamp_ntz(F.col("post_modified")).alias("post_modified"),
        F.col("guid"),
    )
    return typed.where(
        F.col("post_type").isin(*fv.PRODUCT_POST_TYPES)
        & (F.col("sku") != "")
        & (F.col("post_title") != "")
        & F.col("total_sales").isNotNull()
    )
