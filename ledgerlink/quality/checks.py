"""The checks of every stage: a row per check, from as few measurements as there are.

A measurement is a one-row frame that may serve several checks, of several stages; the
tables by product are measured once for all of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv
from ledgerlink.config import Expected, Value, value
from ledgerlink.functions.numbers import exact_text, same_cents
from ledgerlink.operators.reconcile import revenue_of
from ledgerlink.quality import measures as m
from ledgerlink.sources.specs import union_all

Tables = Mapping[str, DataFrame]

# Kinds of a check: how its row enters the report.
ROWS, ZERO, CLASS, MONEY, FLAG = "rows", "zero", "class", "money", "flag"


def _check(
    name: str,
    kind: str,
    passed: Column,
    metric: str | None = None,
    actual: Column | None = None,
    expected: Column | None = None,
    amount: Column | None = None,
    target: Column | None = None,
) -> Column:
    def number(c: Column | None) -> Column:
        return (F.lit(None) if c is None else c).cast("bigint")

    def text(c: Column | None) -> Column:
        return (F.lit(None) if c is None else c).cast("string")

    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(kind).alias("kind"),
        F.lit(metric).cast("string").alias("metric"),
        number(actual).alias("actual"),
        number(expected).alias("expected"),
        text(None if amount is None else exact_text(amount)).alias("amount"),
        text(target).alias("expected_amount"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def row_count(name: str, expected: Value, column: str = "rows") -> Column:
    actual, target = F.col(column), value(expected).cast("bigint")
    return _check(
        f"{name}_matches_expected", ROWS, actual == target, name, actual, target
    )


def class_count(name: str, metric: str, expected: Value) -> Column:
    actual, target = F.col(metric), value(expected).cast("bigint")
    return _check(name, CLASS, actual == target, metric, actual, target)


def zero(name: str, column: str, metric: str | None = None) -> Column:
    return _check(
        name, ZERO, F.col(column) == 0, metric or name, F.col(column), F.lit(0)
    )


def flag(name: str, passed: Column) -> Column:
    return _check(name, FLAG, passed)


def money(
    name: str, metric: str | None, amount: Column, other: Column
) -> Column:
    return _check(
        name, MONEY, same_cents(amount, other), metric, amount=amount,
        target=None if metric is None else other,
    )


#: A measurement and what is checked with it.
Measured = tuple[DataFrame, Sequence[Column]]


def cleaning_checks(tables: Tables, expected: Expected) -> list[Measured]:
    """Row counts, required fields and unique keys of the cleaned tables."""
    invalid = {
        "erp": m.invalid_product(),
        "liaison": m.invalid_bridge(),
        "web": m.invalid_web(),
    }

    def fields(table: str) -> Column:
        return zero(f"{table}_invalid_required_fields", "invalid")

    def unique(table: str, key: str) -> Column:
        return zero(f"{table}_{key}_duplicates", "repeated")

    def cleaned(name: str, key: str, rows: Value) -> Measured:
        profile = m.keyed_profile(tables[f"{name}_clean"], key, invalid[name])
        return profile, [
            row_count(f"{name}_after_deduplication", rows),
            fields(f"{name}_clean"), unique(f"{name}_clean", key),
        ]

    def filtered(name: str, table: str, *checks: Column) -> Measured:
        return m.table_profile(tables[table], invalid[name]), [*checks, fields(table)]

    return [
        cleaned("erp", "product_id", expected.erp_rows),
        cleaned("liaison", "product_id", expected.liaison_rows),
        (m.repeated_keys(tables["liaison_clean"], "id_web"), [unique("liaison_clean", "id_web")]),
        cleaned("web", "sku", expected.web_rows),
        filtered("web", "web_not_null",
                 row_count("web_after_cleaning", expected.web_cleaned_rows)),
        filtered("erp", "erp_not_null"),
        filtered("liaison", "liaison_valid"),
    ]


def merge_checks(expected: Expected) -> list[Column]:
    """Row count, unique products and required fields of the merged table."""
    return [
        row_count("merged_count", expected.merged_rows, "merged_rows"),
        zero("merged_product_id_duplicates", "merged_repeated"),
        zero("merged_invalid_required_fields", "merged_invalid"),
    ]


def revenue_checks(expected: Expected) -> list[Column]:
    """Revenue follows from the merged table."""
    return [
        row_count("revenue_product_count", expected.merged_rows, "detail_rows"),
        zero("revenue_product_id_duplicates", "detail_repeated"),
        zero("revenue_detail_mismatches", "revenue_mismatches", "revenue_detail_mismatches"),
    ]


def total_checks(expected: Expected) -> list[Column]:
    """Revenue adds up, and is the stated total."""
    reference = value(expected.total_revenue).cast("decimal(38,2)")
    stated, added = F.col("total_revenue"), F.col("detail_revenue")
    counts_agree = (
        F.col("product_count").eqNullSafe(F.col("source_products"))
        & F.col("bottles_sold").eqNullSafe(F.col("source_units"))
        & (F.col("summary_rows") == 1)
    )
    return [
        flag("revenue_summary_has_one_row", F.col("summary_rows") == 1),
        money("revenue_reconciles", None, added, stated),
        money("revenue_detail_matches_reference", "detail_total_revenue", added, reference),
        money("revenue_summary_matches_reference", "total_revenue", stated, reference),
        flag("revenue_summary_counts_match", counts_agree),
    ]


def segmentation_checks(expected: Expected) -> list[Column]:
    """Class sizes, labels, source rows and recomputed scores of the segments."""
    valid = F.col("valid")
    return [
        row_count("segmentation_count", expected.merged_rows, "segments_rows"),
        class_count(
            "premium_count_matches_reference", "premium_count", expected.premium_rows
        ),
        class_count(
            "ordinary_count_matches_reference", "ordinary_count", expected.ordinary_rows
        ),
        zero("segmentation_product_id_duplicates", "segments_repeated"),
        zero("segmentation_invalid_classification", "segments_invalid"),
        zero("segmentation_source_mismatches", "segment_mismatches",
             "segmentation_source_mismatches"),
        flag("zscore_statistics_valid", valid),
        _check(
            "zscore_calculation_is_correct",
            ZERO,
            valid & (F.col("wrong") == 0),
            "incorrect_zscores",
            F.when(valid, F.col("wrong")),
            F.lit(0),
        ),
    ]


def stages_of(stage: str) -> tuple[str, ...]:
    """The stages that a name selects; ``all`` selects every one."""
    if stage == "all":
        return fv.STAGES
    if stage not in fv.STAGES:
        raise ValueError(f"Unknown validation stage: {stage}")
    return (stage,)


def _of(stage: str, checks: Sequence[Column]) -> list[Column]:
    return [F.struct(F.lit(stage).alias("stage"), check.alias("of")) for check in checks]


def check_frame(tables: Tables, stage: str, expected: Expected) -> DataFrame:
    """All checks of a stage, or of every stage: about one short row per check.

    Building the frame starts no job.
    """
    stages = stages_of(stage)
    measured: list[Measured] = []
    if "cleaning" in stages:
        measured += [(df, _of("cleaning", c)) for df, c in cleaning_checks(tables, expected)]
    by_product: list[Column] = []
    needed: set[str] = set()
    for name, checks, sides in (
        ("merge", merge_checks, ("merged",)),
        ("revenue", revenue_checks, ("merged", "detail")),
        ("segmentation", segmentation_checks, ("detail", "segments")),
    ):
        if name in stages:
            by_product += _of(name, checks(expected))
            needed.update(sides)
    if by_product:
        sides = {side: tables[_PRODUCT_TABLES[side]] for side in needed}
        measured.append((m.product_profile(revenue_of(), **sides), by_product))
    if "merge" in stages:
        repeated = m.repeated_keys(tables["merged_wines"], "id_web")
        measured.append((repeated, _of("merge", [zero("merged_id_web_duplicates", "repeated")])))
    if "revenue" in stages:
        totals = m.revenue_totals(
            tables["merged_wines"], tables["revenue_by_product"], tables["revenue_summary"]
        )
        measured.append((totals, _of("revenue", total_checks(expected))))
    return union_all(
        expected.beside(df).select(F.inline(F.array(*checks))).select("stage", "of.*")
        for df, checks in measured
    )


_PRODUCT_TABLES = {
    "merged": "merged_wines", "detail": "revenue_by_product", "segments": "wine_segmentation",
}
