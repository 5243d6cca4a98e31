"""The counted checks against the joins they stand for, and faults against gates."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv
from ledgerlink.config import Expected
from ledgerlink.quality import checks, measures
from ledgerlink.quality.gate import QualityGateError, validate
from ledgerlink.operators.reconcile import revenue_of
from ledgerlink.sources.sinks import read_json
from parity.spark_queries import FAULTS, Tables

NAN, INF = float("nan"), float("inf")
MERGED = "product_id bigint, id_web string, price double, total_sales bigint"
DETAIL = MERGED + ", revenue double"
SCORES = "product_id bigint, id_web string, price double, z_score double"


def _rows(rng, n, with_revenue):
    """Rows with many repeats, missing keys and odd numbers."""
    rows = []
    for _ in range(n):
        price = rng.choice([1.25, 2.5, 7.005, None, NAN, INF])
        units = rng.choice([1, 2, 3, None])
        row = (
            rng.choice([0, 0, 0, 1, 2, 3, None]),
            rng.choice(["a", "b", None]),
            price,
            units,
        )
        if with_revenue:
            product = None if None in (price, units) else price * units
            row += (rng.choice([product, product, None, 1.0]),)
        rows.append(row)
    return rows


def _brute_force(sql, **tables):
    connection = duckdb.connect()
    for name, (schema, rows) in tables.items():
        connection.execute(f"CREATE TABLE {name} ({schema.replace('string', 'text')})")
        marks = ", ".join("?" * len(schema.split(",")))
        if rows:
            connection.executemany(f"INSERT INTO {name} VALUES ({marks})", rows)
    return connection.execute(sql).fetchone()[0]


@pytest.mark.parametrize("seed", range(4))
def test_revenue_mismatches_count_what_the_outer_join_finds(spark, seed):
    rng = random.Random(seed)
    merged, detail = _rows(rng, 40, False), _rows(rng, 60, True)
    expected = _brute_force(
        """SELECT count(*) FROM m FULL OUTER JOIN r ON m.product_id = r.product_id
        WHERE m.product_id IS NULL OR r.product_id IS NULL
          OR r.id_web IS DISTINCT FROM m.id_web OR r.price IS DISTINCT FROM m.price
          OR r.total_sales IS DISTINCT FROM m.total_sales
          OR r.revenue IS NULL OR NOT isfinite(r.revenue)
          OR r.revenue IS DISTINCT FROM round(m.price * m.total_sales, 2)""",
        m=(MERGED, merged),
        r=(DETAIL, detail),
    )
    counted = measures.revenue_mismatches(
        spark.createDataFrame(merged, MERGED),
        spark.createDataFrame(detail, DETAIL),
        revenue_of(),
    )
    assert counted.first()["mismatches"] == expected > 0


@pytest.mark.parametrize("seed", range(4))
def test_wrong_scores_count_what_the_join_finds(spark, seed):
    rng = random.Random(seed)
    prices = [3.0, 4.5, 6.0, 9.75, None]
    detail = [
        (rng.choice([0, 0, 1, 2, 3, None]), "w", rng.choice(prices), 1, 1.0)
        for _ in range(50)
    ]
    known = [p for *_, p, _, _ in detail if p is not None]
    mean = sum(known) / len(known)
    sd = (sum((p - mean) ** 2 for p in known) / len(known)) ** 0.5
    near = [0.0, 1e-10, -1e-10, 5e-9, -1e-6, 1.0]
    scores = [
        (
            rng.choice([0, 0, 1, 2, 4, None]),
            "w",
            1.0,
            rng.choice(
                [(rng.choice(known) - mean) / sd + rng.choice(near), None, NAN, INF]
            ),
        )
        for _ in range(80)
    ]
    expected = _brute_force(
        """SELECT count(*) FROM s JOIN r ON s.product_id = r.product_id,
          (SELECT avg(price) AS mean, stddev_pop(price) AS sd FROM r) f
        WHERE s.z_score IS NULL OR NOT isfinite(s.z_score)
          OR abs(s.z_score - (r.price - f.mean) / f.sd) > 1e-9""",
        s=(SCORES, scores),
        r=(DETAIL, detail),
    )
    counted = measures.wrong_z_scores(
        spark.createDataFrame(scores, SCORES), spark.createDataFrame(detail, DETAIL)
    ).first()
    assert counted["valid"] is True
    assert counted["wrong"] == expected > 0


def test_a_key_repeated_on_both_sides_builds_no_pairs(spark):
    n = 200_000
    side = spark.range(n).select(
        F.lit(1).cast("bigint").alias("product_id"),
        F.lit("w").alias("id_web"),
        (F.col("id") % 50_000).cast("double").alias("price"),
        F.lit(1).cast("bigint").alias("total_sales"),
    )
    detail = side.withColumn("revenue", F.col("price"))
    found = measures.revenue_mismatches(side, detail, revenue_of()).first()[0]
    assert found == n * n - 4 * n
    scores = side.withColumn("z_score", F.lit(0.0))
    assert measures.wrong_z_scores(scores, detail).first()["wrong"] == n * n


def test_statistics_that_give_no_scores_fail_the_check(spark):
    detail = spark.createDataFrame([(1, "a", 2.0, 1, 2.0), (2, "b", 2.0, 1, 2.0)], DETAIL)
    scores = spark.createDataFrame([(1, "a", 2.0, 0.0), (2, "b", 2.0, 0.0)], SCORES)
    assert measures.wrong_z_scores(scores, detail).first()["valid"] is False
    with_nan = detail.withColumn("price", F.lit(NAN))
    assert measures.statistics(with_nan).first()["valid"] is False
    empty = detail.where("product_id > 9")
    assert measures.statistics(empty).first()["valid"] is False


def test_repeated_keys_with_and_without_null(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert measures.repeated_keys(df, "k").first()[0] == 1
    assert measures.repeated_keys(df, "k", null_is_key=True).first()[0] == 2


# The run on the smallest data set, stored once for all tests below.

EXPECTED = Expected(192, 193, 395, 200, 174, fv.Decimal("141101332.80"), 7)


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return Tables(spark, sf_dir).store(
        "erp_not_null", "liaison_valid", "web_not_null", "erp_clean", "liaison_clean",
        "web_clean", "merged_wines", "revenue_by_product", "revenue_summary",
        "wine_segmentation",
    )


def test_all_checks_pass_on_good_tables(spark, tables, tmp_path):
    report = validate(spark, tables, "all", EXPECTED, str(tmp_path))
    assert report["status"] == "passed"
    assert len(report["checks"]) == 34
    assert all(report["checks"].values())
    assert report["metrics"]["total_revenue"] == "141101332.80"
    assert report["metrics"]["incorrect_zscores"] == 0
    assert report["row_count_tests"]["merged_count"] == {
        "actual": 174,
        "expected": 174,
        "passed": True,
    }
    assert len(report["row_count_tests"]) == 7
    assert read_json(spark, f"{tmp_path}/quality_report.json") == report


@pytest.mark.parametrize(
    "fault, failed",
    [
        ("drop_min_key", {"merged_count_matches_expected"}),
        ("drop_k_smallest", {"merged_count_matches_expected"}),
        (
            "bump_value",
            {
                "revenue_detail_mismatches",
                "revenue_detail_matches_reference",
                "revenue_summary_matches_reference",
            },
        ),
        (
            "premium_to_ordinary",
            {
                "premium_count_matches_reference",
                "ordinary_count_matches_reference",
                "segmentation_invalid_classification",
            },
        ),
        (
            "ordinary_to_premium",
            {
                "premium_count_matches_reference",
                "ordinary_count_matches_reference",
                "segmentation_invalid_classification",
            },
        ),
        ("swap_labels", {"segmentation_invalid_classification"}),
        (
            "append_duplicate",
            {
                "erp_after_deduplication_matches_expected",
                "erp_clean_product_id_duplicates",
            },
        ),
        ("null_price", {"erp_clean_invalid_required_fields"}),
        ("nan_price", {"erp_clean_invalid_required_fields"}),
    ],
)
def test_each_fault_trips_its_checks_and_no_other(
    spark, tables, tmp_path, fault, failed
):
    stage, change = FAULTS[fault]
    with pytest.raises(QualityGateError) as refused:
        validate(
            spark, tables.replaced(change(tables)), stage, EXPECTED, str(tmp_path)
        )
    assert set(refused.value.failed) == failed
    for name in failed:
        assert name in str(refused.value)
    written = read_json(spark, f"{tmp_path}/quality_{stage}.json")
    assert written["status"] == "failed"
    assert {name for name, ok in written["checks"].items() if not ok} == failed


def test_unknown_expectations_fail_and_are_not_skipped(spark, tables):
    unknown = Expected(None, None, None, None, None, None, None)
    with pytest.raises(QualityGateError) as refused:
        validate(spark, tables, "revenue", unknown)
    assert set(refused.value.failed) == {
        "revenue_product_count_matches_expected",
        "revenue_detail_matches_reference",
        "revenue_summary_matches_reference",
    }


def test_two_summary_rows_are_refused(spark, tables):
    doubled = tables.revenue_summary.unionByName(tables.revenue_summary)
    with pytest.raises(QualityGateError) as refused:
        validate(
            spark, tables.replaced({"revenue_summary": doubled}), "revenue", EXPECTED
        )
    assert set(refused.value.failed) == {
        "revenue_summary_has_one_row",
        "revenue_reconciles",
        "revenue_summary_matches_reference",
        "revenue_summary_counts_match",
    }


def test_unknown_stage(spark, tables):
    with pytest.raises(ValueError, match="Unknown validation stage: later"):
        validate(spark, tables, "later", EXPECTED)


def test_each_stage_names_its_checks(tables):
    sizes = {
        stage: checks.check_frame(tables, stage, EXPECTED).count()
        for stage in fv.STAGES
    }
    assert sizes == {"cleaning": 14, "merge": 4, "revenue": 8, "segmentation": 8}
