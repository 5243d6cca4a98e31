"""The registered queries: each takes a session and a data folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv
from ledgerlink.functions.numbers import (
    exact_sum,
    is_finite,
    round_half_away,
    to_cents,
)
from ledgerlink.functions.text import normalize_identifiers
from ledgerlink.operators import clean, dedup, faults, reconcile, report, segment
from ledgerlink.operators.faults import Change
from ledgerlink.quality import measures as m
from ledgerlink.quality.checks import check_frame
from ledgerlink.plans import run as plans
from ledgerlink.sources.sinks import json_numbers, write_csv, write_json
from ledgerlink.sources.specs import (
    SourceSpec,
    manifest,
    read_source,
    stage_frame,
    union_all,
)
from ledgerlink.sources.store import (
    TableStore,
    register,
    scratch_path,
    stored,
    together,
    unregister,
)
from parity import raw_tables
from parity.raw_tables import expected_for, expected_values, table

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Tables:
    """The tables of one query, each planned when first asked for.

    A table that several plans of the query read is written once (``stored``), so
    that the work below it is not repeated; the others stay part of one plan.
    """

    spark: SparkSession
    sf_dir: str

    @cached_property
    def raw_erp(self) -> DataFrame:
        return raw_tables.raw_erp(self.spark, self.sf_dir)

    @cached_property
    def raw_liaison(self) -> DataFrame:
        return raw_tables.raw_liaison(self.spark, self.sf_dir)

    @cached_property
    def raw_web(self) -> DataFrame:
        return raw_tables.raw_web(self.spark, self.sf_dir)

    @cached_property
    def erp_not_null(self) -> DataFrame:
        return clean.clean_products(self.raw_erp)

    @cached_property
    def liaison_valid(self) -> DataFrame:
        return clean.clean_bridge(self.raw_liaison)

    @cached_property
    def web_not_null(self) -> DataFrame:
        return clean.clean_web(self.raw_web)

    @cached_property
    def erp_clean(self) -> DataFrame:
        return dedup.dedup_products(self.erp_not_null)

    @cached_property
    def liaison_clean(self) -> DataFrame:
        return dedup.dedup_bridge(self.liaison_valid)

    @cached_property
    def web_clean(self) -> DataFrame:
        return dedup.dedup_web(self.web_not_null)

    @cached_property
    def merged_wines(self) -> DataFrame:
        if "liaison_clean" in self.__dict__:
            bridge = self.liaison_clean
        else:
            # Not stored: plan the rows that can join, and leave the others out.
            bridge = dedup.linked_bridge(dedup.bridge_by_product(self.liaison_valid))
        return reconcile.reconcile(self.erp_clean, bridge, self.web_clean)

    @cached_property
    def revenue_by_product(self) -> DataFrame:
        return reconcile.revenue_detail(self.merged_wines)

    @cached_property
    def revenue_summary(self) -> DataFrame:
        return reconcile.revenue_summary(self.merged_wines)

    @cached_property
    def wine_segmentation(self) -> DataFrame:
        return segment.segment(self.revenue_by_product)

    def store(self, *steps: str | tuple[str, ...]) -> Tables:
        """Write tables step by step; later steps read what earlier ones wrote.

        The tables of one step do not depend on each other.
        """
        for step in steps:
            names = (step,) if isinstance(step, str) else step
            frames = [getattr(self, name) for name in names]
            written = together(
                *(partial(stored, df, name) for name, df in zip(names, frames))
            )
            self.__dict__.update(zip(names, written))
        return self

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def replaced(self, changes: dict[str, DataFrame]) -> Tables:
        """The same tables, some of them changed; nothing is derived anew."""
        other = Tables(self.spark, self.sf_dir)
        other.__dict__.update(self.__dict__)
        other.__dict__.update(changes)
        return other


_CLEANED = ("erp_not_null", "liaison_valid", "web_not_null")


def _plain(name: str) -> Query:
    """A table of the run as it is."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Tables(spark, sf_dir), name)

    return query


def _with_revenue(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir).store("revenue_by_product")


def normalize_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    columns = (
        ("erp", "product_id", t.raw_erp),
        ("liaison", "product_id", t.raw_liaison),
        ("liaison", "id_web", t.raw_liaison),
        ("web", "sku", t.raw_web),
    )
    return union_all(
        normalize_identifiers(df.select(name), [name]).select(
            F.lit(source).alias("source"),
            F.lit(name).alias("column_name"),
            F.col(name).alias("identifier"),
        )
        for source, name, df in columns
    )


def staging_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    raw = {"erp": t.raw_erp, "liaison": t.raw_liaison, "web": t.raw_web}
    staged = together(
        *(partial(stored, stage_frame(df), f"raw_{name}") for name, df in raw.items())
    )
    return manifest(dict(zip(raw, staged)))


def revenue_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    wanted = expected_for(spark, sf_dir)
    expected = wanted.total_revenue
    totals = wanted.beside(
        m.revenue_totals(t.merged_wines, t.revenue_by_product, t.revenue_summary)
    )
    stated, added = to_cents(F.col("total_revenue")), to_cents(F.col("detail_revenue"))

    def same(a, b):
        return F.coalesce(a == b, F.lit(False))

    return totals.select(
        stated.cast("double").alias("summary_total"),
        added.cast("double").alias("detail_total"),
        same(added, stated).alias("reconciles"),
        same(added, expected).alias("detail_matches_reference"),
        same(stated, expected).alias("summary_matches_reference"),
        (
            F.col("product_count").eqNullSafe(F.col("source_products"))
            & F.col("bottles_sold").eqNullSafe(F.col("source_units"))
        ).alias("counts_match"),
    )


def price_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = segment.spread(Tables(spark, sf_dir).revenue_by_product)
    usable = is_finite(F.col("mean")) & is_finite(F.col("stddev"))
    return one.select(
        "row_count",
        round_half_away(F.col("mean"), 6).alias("mean_price"),
        round_half_away(F.col("stddev"), 6).alias("population_standard_deviation"),
        (usable & (F.col("stddev") > 0)).alias("valid"),
    )


def _rounded_segments(segments: DataFrame) -> DataFrame:
    return segments.withColumn("z_score", round_half_away(F.col("z_score"), 6))


def segment_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_segments(_with_revenue(spark, sf_dir).wine_segmentation)


def segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.class_counts(_with_revenue(spark, sf_dir).wine_segmentation)


def premium_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _with_revenue(spark, sf_dir)
    return segment.sorted_segment_list(t.wine_segmentation, fv.PREMIUM)


def ordinary_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _with_revenue(spark, sf_dir)
    return segment.sorted_segment_list(t.wine_segmentation, fv.ORDINARY)


def revenue_report_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The global sort samples its input for range bounds, and so reads it twice.
    return report.report_detail(_with_revenue(spark, sf_dir).revenue_by_product)


def revenue_report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_summary(Tables(spark, sf_dir).revenue_summary)


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    expected = expected_for(spark, sf_dir)
    counted = (
        ("erp_after_deduplication", t.erp_clean, expected.erp_rows),
        ("liaison_after_deduplication", t.liaison_clean, expected.liaison_rows),
        ("web_after_cleaning", t.web_not_null, expected.web_cleaned_rows),
        ("web_after_deduplication", t.web_clean, expected.web_rows),
        ("merged_count", t.merged_wines, expected.merged_rows),
    )
    return union_all(
        expected.beside(df.agg(F.count(F.lit(1)).alias("actual"))).select(
            F.lit(name).alias("name"),
            "actual",
            target.cast("bigint").alias("expected"),
            F.coalesce(F.col("actual") == target, F.lit(False)).alias("passed"),
        )
        for name, df, target in counted
    )


def required_field_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that lack a required field, in the raw tables and after cleaning."""
    t = Tables(spark, sf_dir).store(_CLEANED)
    typed_erp = t.raw_erp.withColumn(
        "price", F.replace("price", F.lit(","), F.lit(".")).try_cast("double")
    )
    frames = (
        ("raw_erp", typed_erp, m.invalid_product()),
        ("raw_liaison", t.raw_liaison, m.invalid_bridge()),
        ("raw_web", t.raw_web, m.invalid_web()),
        ("erp_not_null", t.erp_not_null, m.invalid_product()),
        ("erp_clean", t.erp_clean, m.invalid_product()),
        ("liaison_valid", t.liaison_valid, m.invalid_bridge()),
        ("liaison_clean", t.liaison_clean, m.invalid_bridge()),
        ("web_not_null", t.web_not_null, m.invalid_web()),
        ("web_clean", t.web_clean, m.invalid_web()),
    )
    return union_all(
        m.table_profile(df, invalid).select(
            F.lit(name).alias("table_name"), F.col("rows").alias("n_rows"), "invalid"
        )
        for name, df, invalid in frames
    )


def merged_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invalid rows of the merged table, as it is and after three faults."""
    dear = F.col("price") > 5000
    changed = faults.variants(
        Tables(spark, sf_dir).merged_wines,
        {
            "as_built": Change(),
            "price_lost": Change({"price": F.lit(None)}, dear),
            "price_not_finite": Change({"price": F.lit(float("nan"))}, dear),
            "keys_differ": Change(
                {"sku": F.concat("sku", F.lit("?"))}, F.col("onsale_web") == 1
            ),
        },
    )
    return m.table_profile(changed, m.invalid_merged(), by=["variant"]).withColumnRenamed(
        "rows", "n_rows"
    )


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that occur more than once, before and after deduplication."""
    t = Tables(spark, sf_dir).store(_CLEANED)
    frames = (
        ("erp_not_null", "product_id", t.erp_not_null),
        ("liaison_valid", "product_id", t.liaison_valid),
        ("liaison_valid", "id_web", t.liaison_valid),
        ("web_not_null", "sku", t.web_not_null),
        ("erp_clean", "product_id", t.erp_clean),
        ("liaison_clean", "product_id", t.liaison_clean),
        ("liaison_clean", "id_web", t.liaison_clean),
        ("web_clean", "sku", t.web_clean),
    )
    return union_all(
        m.repeated_keys(df, key).select(
            F.lit(name).alias("table_name"),
            F.lit(key).alias("key_name"),
            F.col("repeated").alias("duplicates"),
        )
        for name, key, df in frames
    )


def revenue_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the revenue table that do not follow from the merged one."""
    t = Tables(spark, sf_dir).store("merged_wines")
    key, dear = F.col("product_id"), F.col("price") > 5000
    columns = ("product_id", "id_web", "price", "total_sales")
    merged = t.merged_wines.select(*columns)
    detail = t.revenue_by_product.select(*columns, "revenue")
    first = key == faults.smallest_key(merged, "product_id")
    changes = {
        "as_built": Change(),
        "row_lost": Change(drop=first),
        "row_added": Change(),
        "revenue_off": Change({"revenue": F.col("revenue") + 1}, dear),
        "revenue_lost": Change({"revenue": F.lit(None)}, dear),
        "repeated_and_off": Change(
            {"total_sales": F.lit(0)}, F.col("price") > 5700, repeat=dear
        ),
    }
    sources = {name: Change(drop=first if name == "row_added" else None) for name in changes}
    return m.revenue_mismatches(
        faults.variants(merged, sources), faults.variants(detail, changes),
        reconcile.revenue_of(), by=["variant"],
    )


def segment_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the segmentation that do not follow from the revenue table."""
    t = _with_revenue(spark, sf_dir)
    detail = t.revenue_by_product.select("product_id", "id_web", "price")
    segments = t.wine_segmentation.select("product_id", "id_web", "price", "category")
    premium = F.col("category") == fv.PREMIUM
    changes = {
        "as_built": Change(),
        "row_lost": Change(drop=faults.among_smallest(detail, "product_id", 14)),
        "price_lost": Change({"price": F.lit(None)}, premium),
        "key_changed": Change({"id_web": F.lit("sku-0")}, premium),
    }
    return m.segment_mismatches(
        faults.in_each(detail, list(changes)), faults.variants(segments, changes), by=["variant"]
    )


def label_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose label contradicts the score, as built and after faults."""
    t = _with_revenue(spark, sf_dir)
    segments = t.wine_segmentation.select("product_id", "z_score", "category")
    premium = F.col("category") == fv.PREMIUM
    flip = ("product_id", "category", fv.PREMIUM, fv.ORDINARY)
    changes = {
        "as_built": Change(),
        "one_flipped": Change(
            {"category": F.lit(fv.ORDINARY)}, faults.is_first(segments, "product_id", premium)
        ),
        "two_swapped": Change({"category": faults.swapped_labels(segments, *flip)}),
        "unknown_label": Change({"category": F.lit("luxe")}, premium),
        "score_lost": Change({"z_score": F.lit(None)}, premium),
    }
    profile = m.table_profile(
        faults.variants(segments, changes), m.invalid_label(), by=["variant"]
    )
    return profile.withColumnRenamed("rows", "n_rows")


def zscore_recheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored scores that are not the recomputed ones, as built and after faults."""
    t = _with_revenue(spark, sf_dir)
    detail = t.revenue_by_product.select("product_id", "price")
    segments = t.wine_segmentation.select("product_id", "z_score", "category")
    premium = F.col("category") == fv.PREMIUM
    changes = {
        "as_built": Change(),
        "score_off": Change({"z_score": F.col("z_score") + 1e-6}, premium),
        "score_within_tolerance": Change({"z_score": F.col("z_score") + 1e-11}, premium),
        "score_lost": Change({"z_score": F.lit(None)}, premium),
        "repeated": Change(repeat=premium),
    }
    return m.wrong_z_scores(
        faults.variants(segments, changes), faults.in_each(detail, list(changes)),
        by=["variant"], known=detail,
    ).withColumnRenamed("wrong", "incorrect")


_CHECK_COLUMNS = ("stage", "check_name", "actual", "expected", "passed")


# The tables that the checks of a stage read more than once, in order of dependence.
_STORED_FOR = {
    "cleaning": (_CLEANED, ("erp_clean", "liaison_clean", "web_clean")),
    "merge": ("merged_wines",),
    "revenue": ("merged_wines", ("revenue_by_product", "revenue_summary")),
    "segmentation": ("revenue_by_product", "wine_segmentation"),
}


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir).store(
        *_STORED_FOR["cleaning"], *_STORED_FOR["revenue"], "wine_segmentation"
    )
    checks = check_frame(t, "all", expected_for(spark, sf_dir))
    return checks.select(*_CHECK_COLUMNS, "amount")


# Faults: the changed table, and what the gates make of it.


def _drop_min_key(t: Tables) -> dict[str, DataFrame]:
    return {"merged_wines": faults.drop_smallest(t.merged_wines, "product_id")}


def _drop_k_smallest(t: Tables) -> dict[str, DataFrame]:
    return {"merged_wines": faults.drop_k_smallest(t.merged_wines, "product_id", 14)}


def _bump_value(t: Tables) -> dict[str, DataFrame]:
    detail = t.revenue_by_product
    first = faults.smallest_key(detail, "product_id")
    bumped = faults.update_where(
        detail, "revenue", F.col("revenue") + 1, F.col("product_id") == first
    )
    total = round_half_away(exact_sum(F.col("revenue")), 2)
    return {
        "revenue_by_product": bumped,
        "revenue_summary": faults.rebuild_total(t.revenue_summary, bumped, total),
    }


def _flip(old: str, new: str) -> Callable[[Tables], dict[str, DataFrame]]:
    def fault(t: Tables) -> dict[str, DataFrame]:
        flipped = faults.relabel_first(
            t.wine_segmentation, "product_id", "category", old, new
        )
        return {"wine_segmentation": flipped}

    return fault


def _swap_labels(t: Tables) -> dict[str, DataFrame]:
    swapped = faults.swap_first_labels(
        t.wine_segmentation, "product_id", "category", fv.PREMIUM, fv.ORDINARY
    )
    return {"wine_segmentation": swapped}


def _append_duplicate(t: Tables) -> dict[str, DataFrame]:
    return {"erp_clean": faults.append_copy_of_first(t.erp_clean, "product_id")}


def _lose_price(value: float | None) -> Callable[[Tables], dict[str, DataFrame]]:
    def fault(t: Tables) -> dict[str, DataFrame]:
        first = faults.smallest_key(t.erp_clean, "product_id")
        lost = faults.update_where(
            t.erp_clean, "price", F.lit(value), F.col("product_id") == first
        )
        return {"erp_clean": lost}

    return fault


FAULTS = {
    "drop_min_key": ("merge", _drop_min_key),
    "drop_k_smallest": ("merge", _drop_k_smallest),
    "bump_value": ("revenue", _bump_value),
    "premium_to_ordinary": ("segmentation", _flip(fv.PREMIUM, fv.ORDINARY)),
    "ordinary_to_premium": ("segmentation", _flip(fv.ORDINARY, fv.PREMIUM)),
    "swap_labels": ("segmentation", _swap_labels),
    "append_duplicate": ("cleaning", _append_duplicate),
    "null_price": ("cleaning", _lose_price(None)),
    "nan_price": ("cleaning", _lose_price(float("nan"))),
}


def _faulty(fault: str, name: str, *store: str) -> Query:
    """The table that a fault changed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = Tables(spark, sf_dir).store(*store)
        changed = FAULTS[fault][1](t)[name]
        return _rounded_segments(changed) if "z_score" in changed.columns else changed

    return query


def _fault_checks(stage: str) -> Query:
    """The checks of a stage, for every fault that the stage has to find."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = Tables(spark, sf_dir).store(*_STORED_FOR[stage])
        expected = expected_for(spark, sf_dir)
        return union_all(
            check_frame(t.replaced(fault(t)), stage, expected).select(
                F.lit(name).alias("fault"), *_CHECK_COLUMNS
            )
            for name, (guard, fault) in FAULTS.items()
            if guard == stage
        )

    return query


# The same operators on tables as they are given.


def latest_line_per_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    # Order key and line number do not identify a line in every data set; lines
    # equal in all four are the same row here.
    order = [
        F.col(name).desc_nulls_last()
        for name in ("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    ]
    return dedup.first_per_key(lines, ["l_partkey"], order)


def _outliers(name: str, key: str, value: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = segment.outliers(table(spark, sf_dir, name), key, value)
        return _rounded_segments(rows)

    return query


def part_revenue_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = stored(
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(round_half_away(exact_sum(F.col("l_extendedprice")), 2).alias("revenue")),
        "part_revenue",
    )
    return _rounded_segments(segment.outliers(revenue, "l_partkey", "revenue"))


# The code that a run uses, from written sources to stored tables.


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge as delimited text, read back and staged as a run does."""
    path = scratch_path(spark, "bridge_text")
    write_csv(raw_tables.raw_liaison(spark, sf_dir), path)
    return stage_frame(read_source(spark, SourceSpec("liaison", path, "csv")))


def sql_step_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored SQL step with a bound value, over a frame known by name."""
    store = TableStore(spark, scratch_path(spark, "steps"), "bound_steps")
    register(raw_tables.raw_liaison(spark, sf_dir), "given_bridge")
    step = """SELECT trim(id_web) AS web_key, count(*) AS n FROM given_bridge
        WHERE length(trim(id_web)) < :width GROUP BY trim(id_web)"""
    try:
        return store.run_steps([("short_keys", step)], {"width": 8})["short_keys"]
    finally:
        unregister(spark, "given_bridge")


def report_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of the JSON documents of a run, written and read back."""
    t, folder = _with_revenue(spark, sf_dir), scratch_path(spark, "documents")
    known = segment.require_spread(t.revenue_by_product)
    raw = {"erp": t.raw_erp, "liaison": t.raw_liaison, "web": t.raw_web}
    documents = {
        "zscore_metrics": plans.score_metrics(
            segment.segment(t.revenue_by_product, known=known), known
        ),
        "staging_manifest": plans.manifest_lines(
            {name: stage_frame(df) for name, df in raw.items()}
        ),
    }
    for name, document in documents.items():
        write_json(spark, f"{folder}/{name}.json", document)
    return union_all(
        json_numbers(spark, f"{folder}/{name}.json").select(F.lit(name).alias("document"), "*")
        for name in documents
    )


def run_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments that a complete gated run leaves behind."""
    t, folder = Tables(spark, sf_dir), scratch_path(spark, "run")
    raw = {"erp": t.raw_erp, "liaison": t.raw_liaison, "web": t.raw_web}
    for name, df in raw.items():
        df.write.parquet(f"{folder}/{name}")
    sources = [SourceSpec(name, f"{folder}/{name}") for name in raw]
    plans.run(spark, sources, f"{folder}/out", expected_values(spark, sf_dir), "parity_run")
    store = TableStore(spark, f"{folder}/out/tables", "parity_run")
    return _rounded_segments(store.load("wine_segmentation"))


QUERIES: dict[str, Query] = {
    "raw_products": _plain("raw_erp"),
    "raw_bridge": _plain("raw_liaison"),
    "raw_web": _plain("raw_web"),
    "normalize_ids": normalize_ids,
    "staging_manifest": staging_manifest,
    "clean_products": _plain("erp_not_null"),
    "clean_bridge": _plain("liaison_valid"),
    "clean_web": _plain("web_not_null"),
    "dedup_products": _plain("erp_clean"),
    "dedup_bridge": _plain("liaison_clean"),
    "dedup_web": _plain("web_clean"),
    "reconcile": _plain("merged_wines"),
    "revenue_detail": _plain("revenue_by_product"),
    "revenue_summary": _plain("revenue_summary"),
    "revenue_totals": revenue_totals,
    "price_stats": price_stats,
    "segment": segment_query,
    "segment_counts": segment_counts,
    "premium_list": premium_list,
    "ordinary_list": ordinary_list,
    "revenue_report_detail": revenue_report_detail,
    "revenue_report_summary": revenue_report_summary,
    "row_counts": row_counts,
    "required_field_violations": required_field_violations,
    "merged_violations": merged_violations,
    "duplicate_keys": duplicate_keys,
    "revenue_mismatches": revenue_mismatches,
    "segment_mismatches": segment_mismatches,
    "label_violations": label_violations,
    "zscore_recheck": zscore_recheck,
    "quality_report": quality_report,
    "fault_drop_min_key": _faulty("drop_min_key", "merged_wines", "merged_wines"),
    "fault_drop_k_smallest": _faulty(
        "drop_k_smallest", "merged_wines", "merged_wines"
    ),
    "fault_bump_value": _faulty(
        "bump_value", "revenue_by_product", "revenue_by_product"
    ),
    "fault_bump_summary": _faulty("bump_value", "revenue_summary", "merged_wines"),
    "fault_flip_label": _faulty(
        "premium_to_ordinary",
        "wine_segmentation", "revenue_by_product", "wine_segmentation",
    ),
    "fault_swap_labels": _faulty(
        "swap_labels", "wine_segmentation", "revenue_by_product", "wine_segmentation"
    ),
    "fault_append_duplicate": _faulty("append_duplicate", "erp_clean", "erp_clean"),
    "fault_lose_price": _faulty("null_price", "erp_clean", "erp_clean"),
    "fault_checks_cleaning": _fault_checks("cleaning"),
    "fault_checks_merge": _fault_checks("merge"),
    "fault_checks_revenue": _fault_checks("revenue"),
    "fault_checks_segmentation": _fault_checks("segmentation"),
    "latest_line_per_part": latest_line_per_part,
    "event_value_outliers": _outliers("events", "event_id", "value"),
    "document_length_outliers": _outliers("documents", "doc_id", "n_chars"),
    "part_revenue_outliers": part_revenue_outliers,
    "csv_round_trip": csv_round_trip,
    "sql_step_bound": sql_step_bound,
    "report_documents": report_documents,
    "run_segments": run_segments,
}
