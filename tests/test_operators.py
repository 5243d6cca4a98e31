"""Deduplication, joins, segmentation and mutations on small and on skewed tables."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv
from ledgerlink.operators import clean, dedup, faults, reconcile, segment

PRODUCT = (
    "product_id bigint, onsale_web int, price double, "
    "stock_quantity bigint, stock_status string"
)
BRIDGE = "product_id bigint, id_web string"
WEB = (
    "sku string, total_sales bigint, post_title string, "
    "post_type string, post_modified string, guid string"
)


def _web(spark, rows):
    df = spark.createDataFrame(rows, WEB)
    return df.withColumn("post_modified", F.col("post_modified").cast("timestamp_ntz"))


def test_clean_products_keeps_rows_with_key_and_price(spark):
    raw = spark.createDataFrame(
        [
            ("  7 ", "1.0", " 12,50 ", "n/a", "  "),
            ("8.0", None, "nan", "3.0", " instock "),
            ("X-9", "1", "1.00", "1", "instock"),
            ("9", "1", None, "1", "instock"),
            ("9", "1", "n/a", "1", "instock"),
        ],
        "product_id string, onsale_web string, price string, stock_quantity string, "
        "stock_status string",
    )
    rows = {r["product_id"]: r for r in clean.clean_products(raw).collect()}
    assert set(rows) == {7, 8}
    assert tuple(rows[7]) == (7, 1, 12.5, None, None)
    assert str(rows[8]["price"]) == "nan"
    assert rows[8]["stock_quantity"] == 3


def test_clean_web_ignores_optional_fields_and_other_types(spark):
    raw = spark.createDataFrame(
        [
            (" a ", "1.0", " T ", " Product ", "bad-date", None),
            ("b", "x", "T", "product", None, None),
            ("", "1", "T", "product", None, None),
            ("c", "1", " ", "product", None, None),
            ("d", "1", "T", "page", None, None),
            ("e", "1", "T", None, None, None),
            (None, "1", "T", "attachment", None, None),
        ],
        WEB.replace("bigint", "string"),
    )
    assert [tuple(r) for r in clean.clean_web(raw).collect()] == [
        ("a", 1, "T", "product", None, None)
    ]


def test_dedup_products_prefers_sale_then_stock(spark):
    df = spark.createDataFrame(
        [
            (1, None, 9.0, 99, "a"),
            (1, 0, 8.0, 50, "b"),
            (1, 0, 7.0, None, "c"),
            (2, 1, 1.0, 1, None),
            (2, 1, 1.0, 1, "x"),
            (2, 1, 2.0, 1, "w"),
        ],
        PRODUCT,
    )
    rows = sorted(map(tuple, dedup.dedup_products(df).collect()))
    assert rows == [(1, 0, 8.0, 50, "b"), (2, 1, 2.0, 1, "w")]


def test_dedup_bridge_keeps_every_product_without_web_key(spark):
    df = spark.createDataFrame(
        [
            (1, None), (1, "b"), (1, "a"),
            (2, "a"), (3, None), (4, None), (4, None), (5, "c"),
        ],
        BRIDGE,
    )
    rows = sorted(map(tuple, dedup.dedup_bridge(df).collect()))
    # Product 2 loses web key a to product 1; 3 and 4 have none.
    assert rows == [(1, "a"), (3, None), (4, None), (5, "c")]


def test_dedup_web_prefers_products_then_the_latest(spark):
    df = _web(
        spark,
        [
            ("a", 1, "x", "attachment", "2024-06-01 00:00:00", None),
            ("a", 2, "y", "product", None, None),
            ("a", 3, "z", "product", "2024-01-01 00:00:00", None),
            ("b", 4, "p", "attachment", None, None),
        ],
    )
    rows = {r["sku"]: r["total_sales"] for r in dedup.dedup_web(df).collect()}
    assert rows == {"a": 3, "b": 4}


def test_a_key_with_a_third_of_all_rows_leaves_the_map_side_small(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("product_id"),
        F.lit(1).alias("onsale_web"),
        F.col("id").cast("double").alias("price"),
        F.col("id").alias("stock_quantity"),
        F.lit(None).cast("string").alias("stock_status"),
    )
    best = dedup.dedup_products(rows)
    assert best.count() == 20_001
    assert best.where("product_id = 0").first()["stock_quantity"] == 29_997
    plan = best._jdf.queryExecution().executedPlan().toString()
    before, _, after = plan.rpartition("Exchange hashpartitioning")
    assert "Final" in before and "Partial" in after


def test_nulls_do_not_meet_in_one_task(spark):
    df = spark.range(1000).select(
        F.col("id").alias("product_id"), F.lit(None).cast("string").alias("id_web")
    )
    result = dedup.dedup_bridge(df)
    assert result.count() == 1000
    assert reconcile_plan_has(result, "Union")


def reconcile_plan_has(df, text):
    return text in df._jdf.queryExecution().optimizedPlan().toString()


def _merged(spark):
    products = spark.createDataFrame(
        [(1, 1, 2.5, 1, "s"), (2, 1, 1.0, 1, None), (3, 1, 9.0, 1, None)], PRODUCT
    )
    bridge = spark.createDataFrame([(1, "a"), (2, None), (3, "zz"), (4, "b")], BRIDGE)
    web = _web(
        spark,
        [
            ("a", 3, "A", "product", None, None),
            ("b", 1, "B", "product", None, None),
        ],
    )
    return reconcile.reconcile(products, bridge, web)


def test_reconcile_keeps_products_known_to_both(spark):
    merged = _merged(spark)
    assert merged.columns == list(fv.MERGED_COLUMNS)
    assert [(r["product_id"], r["sku"]) for r in merged.collect()] == [(1, "a")]


def test_reconcile_moves_the_bridge_once_after_dedup(spark):
    """Five shuffles: one per deduplicated key, and one to meet the products."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        products = spark.createDataFrame([(1, 1, 2.5, 1, "s")], PRODUCT)
        bridge = spark.createDataFrame([(1, "a")], BRIDGE)
        web = _web(spark, [("a", 3, "A", "product", None, None)])
        linked = dedup.linked_bridge(dedup.bridge_by_product(bridge))
        merged = reconcile.reconcile(
            dedup.dedup_products(products), linked, dedup.dedup_web(web)
        )
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 5
    assert plan.count("SortMergeJoin") == 2


def test_revenue_detail_and_summary(spark):
    merged = _merged(spark)
    assert reconcile.revenue_detail(merged).first()["revenue"] == 7.5
    assert tuple(reconcile.revenue_summary(merged).first()) == (1, 3, 7.5)
    empty = merged.where("product_id < 0")
    assert tuple(reconcile.revenue_summary(empty).first()) == (0, None, None)


def _prices(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "product_id int, price double")


def test_segment_is_strict_and_takes_nan_as_ordinary(spark):
    values = [1.0] * 8 + [100.0, float("nan"), None]
    df = _prices(spark, values)
    for known in (None, segment.require_spread(df)):
        rows = {
            r["product_id"]: r for r in segment.segment(df, known=known).collect()
        }
        assert rows[8]["category"] == fv.PREMIUM
        assert rows[8]["wine_type"] == fv.PREMIUM_TYPE
        others = {rows[i]["category"] for i in rows if i != 8}
        assert others == {fv.ORDINARY}
    z = rows[8]["z_score"]
    exactly = segment.segment(df, threshold=z)
    assert exactly.where(F.col("category") == fv.PREMIUM).count() == 0


def test_segment_refuses_empty_and_constant_tables(spark):
    with pytest.raises(ValueError, match="empty"):
        segment.require_spread(_prices(spark, [1.0]).where("price < 0"))
    with pytest.raises(ValueError, match="equal"):
        segment.require_spread(_prices(spark, [3.0, 3.0, 3.0]))


def test_statistics_reach_the_rows_without_a_join(spark):
    plan = segment.segment(_prices(spark, [1.0, 2.0]))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text


def test_segment_lists_are_sorted_and_rounded(spark):
    rng = random.Random(3)
    prices = [rng.random() * 10 for _ in range(200)] + [90.123456, 95.0]
    df = _prices(spark, prices).select(
        "product_id",
        F.lit("w").alias("id_web"),
        F.lit("t").alias("post_title"),
        "price",
        F.lit(1).cast("bigint").alias("total_sales"),
        F.col("price").alias("revenue"),
    )
    segments = segment.segment(df)
    premium = segment.sorted_segment_list(segments, fv.PREMIUM).collect()
    assert [r["product_id"] for r in premium] == [201, 200]
    assert premium[1]["price"] == 90.12
    ordinary = segment.sorted_segment_list(segments, fv.ORDINARY).collect()
    assert [r["product_id"] for r in ordinary] == list(range(200))


def test_mutations(spark):
    df = spark.createDataFrame(
        [(3, "a"), (1, "a"), (2, "b"), (None, "b")], "k int, label string"
    )

    def keys(frame):
        return sorted((r["k"] is None, r["k"]) for r in frame.collect())

    assert keys(faults.drop_smallest(df, "k")) == [
        (False, 2), (False, 3), (True, None),
    ]
    assert keys(faults.drop_k_smallest(df.where("k > 0"), "k", 2)) == [(False, 3)]
    relabelled = faults.relabel_first(df, "k", "label", "a", "b")
    assert relabelled.where("label = 'a'").first()["k"] == 3
    swapped = faults.swap_first_labels(df.where("k > 0"), "k", "label", "a", "b")
    assert {r["k"]: r["label"] for r in swapped.collect()} == {1: "b", 2: "a", 3: "a"}
    copied = faults.append_copy_of_first(df.where("k > 0"), "k")
    assert keys(copied) == [(False, 1), (False, 1), (False, 2), (False, 3)]
