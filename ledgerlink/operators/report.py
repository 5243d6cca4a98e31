"""Content of the revenue report, under its display headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv


def report_detail(detail: DataFrame) -> DataFrame:
    """Revenue per product, largest first."""
    ordered = detail.orderBy(
        F.col("revenue").desc_nulls_last(), F.col("product_id").asc_nulls_last()
    )
    return ordered.select(
        *(F.col(name).alias(header) for name, header in fv.REPORT_HEADERS.items())
    )


def report_summary(summary: DataFrame) -> DataFrame:
    """Total revenue, products and units."""
    return summary.select(
        *(F.col(name).alias(header) for name, header in fv.SUMMARY_HEADERS.items())
    )
