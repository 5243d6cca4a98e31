"""Expected values at any size; null keys, exact texts, and frames built without jobs."""

import pytest
from pyspark.sql import functions as F

from ledgerlink.functions.casts import to_double
from ledgerlink.functions.numbers import exact_sum, exact_text
from ledgerlink.operators import faults
from ledgerlink.operators.segment import sorted_segment_list
from ledgerlink.quality import measures
from ledgerlink.quality.checks import check_frame
from parity.raw_tables import expected_for, expected_values
from parity.spark_queries import Tables


def test_known_sizes(spark, sf_dir):
    found = expected_values(spark, sf_dir)
    assert (found.erp_rows, found.liaison_rows, found.web_cleaned_rows) == (192, 193, 395)
    assert (found.web_rows, found.merged_rows, found.premium_rows) == (200, 174, 7)
    assert str(found.total_revenue) == "141101332.80"


def test_an_odd_number_of_parts_passes_every_check(spark, sf_dir, tmp_path):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    top = part.agg(F.max("p_partkey")).first()[0]
    extra = part.where(F.col("p_partkey") == 5).withColumn("p_partkey", F.lit(top + 1))
    part.where("p_partkey <> 22").unionByName(
        extra.withColumn("p_partkey", F.col("p_partkey").cast(part.schema["p_partkey"].dataType))
    ).write.parquet(f"{tmp_path}/part.parquet")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.parquet(f"{tmp_path}/lineitem.parquet")
    tables = Tables(spark, str(tmp_path)).store(
        ("erp_not_null", "liaison_valid", "web_not_null"),
        ("erp_clean", "liaison_clean", "web_clean"), "merged_wines",
        ("revenue_by_product", "revenue_summary"), "wine_segmentation",
    )
    rows = check_frame(tables, "all", expected_for(spark, str(tmp_path))).collect()
    assert len(rows) == 34 and [r["check_name"] for r in rows if not r["passed"]] == []


def test_null_keys_come_last(spark):
    df = spark.createDataFrame([(None, "z"), (1, "b"), (1, "a"), (2, "c"), (3, "d")], "k int, v string")
    left = faults.drop_k_smallest(df, "k", 3).collect()
    assert sorted((r["k"] or 0, r["v"]) for r in left) == [(0, "z"), (3, "d")]
    grown = faults.append_copy_of_first(df, "k").collect()
    assert [tuple(r) for r in grown].count((1, "a")) == 2


def test_ordinary_list_has_null_keys_last(spark, sf_dir):
    segments = Tables(spark, sf_dir).wine_segmentation
    lost = faults.update_where(segments, "product_id", F.lit(None), F.col("product_id") < 10)
    ids = [r["product_id"] for r in sorted_segment_list(lost, "ordinaire").collect()]
    assert None in ids and ids.index(None) == len(ids) - ids.count(None)


def test_signed_nan_is_nan(spark):
    df = spark.createDataFrame([("-nan",), ("+NaN",), (" nan ",), ("x",)], "c string")
    values = [r[0] for r in df.select(to_double(F.col("c"))).collect()]
    assert [v is not None and v != v for v in values] == [True, True, True, False]


def test_amounts_are_shown_as_they_are(spark):
    df = spark.createDataFrame([(141101332.8,), (0.125,), (7.0,), (1.00000012,), (None,)], "a double")
    texts = [r[0] for r in df.select(exact_text(F.col("a"))).collect()]
    assert texts == ["141101332.80", "0.125", "7.00", "1.00000012", None]


def test_too_many_pairs_end_the_query(spark):
    count = measures._as_count(F.col("n"))
    fits = spark.sql("SELECT CAST(9223372036854775807 AS DECIMAL(38,0)) AS n")
    assert fits.select(count).first()[0] == 2**63 - 1
    with pytest.raises(Exception, match="differing pairs"):
        fits.select((F.col("n") + 1).cast("decimal(38,0)").alias("n")).select(count).collect()


def test_sums_keep_cents_near_the_limit(spark):
    df = spark.createDataFrame([(9e12 + 0.25,), (0.01,), (-9e12,)], "a double")
    assert round(df.agg(exact_sum(F.col("a"))).first()[0], 2) == 0.26


def test_building_the_score_check_starts_no_job(spark, sf_dir):
    t = Tables(spark, sf_dir).store("revenue_by_product", "wine_segmentation")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "the frame")
    measures.wrong_z_scores(t.wine_segmentation, t.revenue_by_product)
    assert tracker.getJobIdsForGroup("building") == []
    spark.sparkContext.setJobGroup("other", "")


def test_building_the_checks_starts_no_job(spark, sf_dir):
    """Expected values are found out by the plan that compares with them."""
    t = Tables(spark, sf_dir).store("merged_wines", "revenue_by_product", "wine_segmentation")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("checks", "the frame")
    check_frame(t, "all", expected_for(spark, sf_dir))
    assert tracker.getJobIdsForGroup("checks") == []
    spark.sparkContext.setJobGroup("other", "")


def test_all_checks_group_the_revenue_once(spark, sf_dir):
    """One grouping by product serves the checks of all stages; counted in the plan."""
    t = Tables(spark, sf_dir).store("merged_wines", "revenue_by_product", "wine_segmentation")
    frame = measures.product_profile(
        F.col("price") * F.col("total_sales"), t.merged_wines, t.revenue_by_product,
        t.wine_segmentation,
    )
    # Subqueries, for the statistics and for keys of several values, are no leaves.
    leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
    assert leaves.size() == 3


@pytest.mark.parametrize("seed", range(3))
def test_one_profile_equals_the_single_measures(spark, seed):
    import random

    rng = random.Random(seed)
    prices = [1.5, 2.5, None, float("nan")]
    merged, detail, segments = [], [], []
    for _ in range(60):
        row = (rng.choice([1, 1, 2, 3, None]), rng.choice(["a", "b", None]), rng.choice(prices),
               rng.choice([1, 2, None]))
        known = None if None in row[2:] else row[2] * row[3]
        if rng.random() < 0.8:
            merged.append((*row, row[1], "t"))
        if rng.random() < 0.8:
            detail.append((*row, rng.choice([known, known, 1.0])))
        if rng.random() < 0.8:
            segments.append((*row, known, rng.choice([0.5, 2.5, None, -1.0]),
                             rng.choice(["premium", "ordinaire", "x", None])))
    plain = "product_id long, id_web string, price double, total_sales long"
    merged = spark.createDataFrame(merged, plain + ", sku string, post_title string")
    detail = spark.createDataFrame(detail, plain + ", revenue double")
    segments = spark.createDataFrame(
        segments, plain + ", revenue double, z_score double, category string")
    revenue = F.col("price") * F.col("total_sales")
    # Scores can be recomputed from finite prices only.
    for prices_of in (detail, detail.where("NOT isnan(price)")):
        one = measures.product_profile(revenue, merged, prices_of, segments).first()
        assert one["revenue_mismatches"] == measures.revenue_mismatches(
            merged, prices_of, revenue).first()[0]
        assert one["segment_mismatches"] == measures.segment_mismatches(
            prices_of, segments).first()[0]
        scores = measures.wrong_z_scores(segments, prices_of).first()
        assert (one["wrong"], one["valid"]) == (scores["wrong"], scores["valid"])
        for name, df, null_is_key, invalid in (
            ("merged", merged, False, measures.invalid_merged()),
            ("segments", segments, True, measures.invalid_label()),
        ):
            alone = measures.keyed_profile(df, "product_id", invalid, null_is_key).first()
            for what in ("rows", "repeated", "invalid"):
                assert one[f"{name}_{what}"] == alone[what], (name, what)
        alone = measures.keyed_profile(prices_of, "product_id", null_is_key=True).first()
        assert (one["detail_rows"], one["detail_repeated"]) == (alone["rows"], alone["repeated"])


def test_variants_equal_their_mutations(spark, sf_dir):
    from ledgerlink.operators.faults import Change, variants

    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, None)], "k int, v string")
    two = F.col("k") == 2
    got = variants(df, {
        "same": Change(), "set": Change({"v": F.lit("x")}, two), "gone": Change(drop=two),
        "twice": Change({"v": F.lit("y")}, F.col("k") == 1, repeat=two),
    })
    out = {n: sorted(map(str, ((r["k"], r["v"]) for r in got.where(F.col("variant") == n).collect())))
           for n in ("same", "set", "gone", "twice")}
    rows = lambda frame: sorted(str(tuple(r)) for r in frame.collect())
    assert out["same"] == rows(df)
    assert out["set"] == rows(faults.update_where(df, "v", F.lit("x"), two))
    assert out["gone"] == rows(df.where(F.coalesce(~two, F.lit(True))))
    changed = faults.update_where(df, "v", F.lit("y"), F.col("k") == 1)
    assert out["twice"] == rows(changed.unionByName(changed.where(two)))
