"""Join both systems through the bridge, and derive revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv
from ledgerlink.functions.numbers import exact_sum, round_half_away


def reconcile(products: DataFrame, bridge: DataFrame, web: DataFrame) -> DataFrame:
    """Products that both systems know, one row per pair of linked rows.

    Bridge and web meet first: a deduplicated bridge and the web table arrive
    partitioned by the web key, so only the joined rows move once more, by
    product.  The other order would move them twice.
    """
    linked = bridge.where(F.col("id_web").isNotNull())
    on_web = linked.join(web, linked["id_web"] == web["sku"], "inner")
    return on_web.join(products, "product_id", "inner").select(*fv.MERGED_COLUMNS)


def revenue_of(price: str = "price", units: str = "total_sales"):
    """Revenue of one product, rounded to the cent."""
    return round_half_away(F.col(price) * F.col(units), 2)


def revenue_detail(merged: DataFrame) -> DataFrame:
    """Revenue per product.  A stored table has no order; reports sort."""
    return merged.withColumn("revenue", revenue_of()).select(*fv.REVENUE_COLUMNS)


def revenue_summary(merged: DataFrame) -> DataFrame:
    """Products, units and total revenue of the whole table, in one row.

    The total rounds the sum once; it is not the sum of the rounded revenues.
    """
    return merged.agg(
        F.count(F.lit(1)).alias("product_count"),
        F.sum("total_sales").alias("bottles_sold"),
        round_half_away(exact_sum(F.col("price") * F.col("total_sales")), 2).alias(
            "total_revenue"
        ),
    )
