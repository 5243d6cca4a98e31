"""Keep one row per key, by a rule that orders the rows of a key completely.

Rank-1 windows get a ``WindowGroupLimit`` before the shuffle, and minima get a
partial aggregate, so a key that holds a third of the table sends one row per
input partition and no more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The first row of every key under ``order``; all columns are kept."""
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def dedup_products(products: DataFrame) -> DataFrame:
    """One product per key: on sale first, then the largest stock.

    Price and status only break ties, so that the result does not depend on the
    order of the input.
    """
    return first_per_key(
        products,
        ["product_id"],
        [
            F.col("onsale_web").desc_nulls_last(),
            F.col("stock_quantity").desc_nulls_last(),
            F.col("price").desc_nulls_last(),
            F.col("stock_status").desc_nulls_last(),
        ],
    )


def bridge_by_product(bridge: DataFrame) -> DataFrame:
    """One bridge row per product: the smallest web key, null only if it has none.

    The row has no column besides key and order, so a minimum, which skips nulls,
    is the rank-1 row under "ascending, nulls last".
    """
    return bridge.groupBy("product_id").agg(F.min("id_web").alias("id_web"))


def linked_bridge(by_product: DataFrame) -> DataFrame:
    """One bridge row per web key: the smallest product; rows without a key go."""
    return (
        by_product.where(F.col("id_web").isNotNull())
        .groupBy("id_web")
        .agg(F.min("product_id").alias("product_id"))
        .select("product_id", "id_web")
    )


def dedup_bridge(bridge: DataFrame) -> DataFrame:
    """Unique products and unique web keys; rows without a web key are all kept.

    The rows without a key take no part in the second shuffle: they would all
    hash to one task.
    """
    by_product = bridge_by_product(bridge)
    unlinked = by_product.where(F.col("id_web").isNull())
    return linked_bridge(by_product).unionByName(unlinked)


def dedup_web(web: DataFrame) -> DataFrame:
    """One web row per sku: a product before an attachment, then the latest.

    Sales and guid only break ties.
    """
    product, _ = fv.PRODUCT_POST_TYPES
    return first_per_key(
        web,
        ["sku"],
        [
            F.when(F.col("post_type") == product, F.lit(0)).otherwise(F.lit(1)).asc(),
            F.col("post_modified").desc_nulls_last(),
            F.col("post_title").asc_nulls_last(),
            F.col("total_sales").asc_nulls_last(),
            F.col("guid").asc_nulls_last(),
        ],
    )
