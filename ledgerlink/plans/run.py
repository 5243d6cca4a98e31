"""The complete run, gated after every stage, and its parts on their own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv
from ledgerlink.config import Expected
from ledgerlink.operators import clean, dedup, reconcile
from ledgerlink.operators.segment import Spread, require_spread, segment
from ledgerlink.quality.checks import stages_of
from ledgerlink.quality.gate import validate
from ledgerlink.sources.sinks import write_json, write_revenue_report, write_segments
from ledgerlink.sources.specs import SourceSpec, manifest, read_source, stage_frame
from ledgerlink.sources.store import TableStore, own_scratch, together

# Stored tables in the order of a run, with the key each is laid out by.
TABLES = {
    "raw_erp": None,
    "raw_liaison": None,
    "raw_web": None,
    "erp_not_null": None,
    "liaison_valid": None,
    "web_not_null": None,
    "erp_clean": "product_id",
    # By product: bridge rows without web key would all lie in one bucket.
    "liaison_clean": "product_id",
    "web_clean": "sku",
    "merged_wines": "product_id",
    "revenue_by_product": "product_id",
    "revenue_summary": None,
    "wine_segmentation": "product_id",
}

# The tables that each table is built from.
INPUTS = {
    "erp_not_null": ("raw_erp",),
    "liaison_valid": ("raw_liaison",),
    "web_not_null": ("raw_web",),
    "erp_clean": ("erp_not_null",),
    "liaison_clean": ("liaison_valid",),
    "web_clean": ("web_not_null",),
    "merged_wines": ("erp_clean", "liaison_clean", "web_clean"),
    "revenue_by_product": ("merged_wines",),
    "revenue_summary": ("merged_wines",),
    "wine_segmentation": ("revenue_by_product",),
}
# The tables that the checks of each stage read.
CHECKED = {
    "cleaning": ("erp_not_null", "liaison_valid", "web_not_null", "erp_clean",
                 "liaison_clean", "web_clean"),
    "merge": ("merged_wines",),
    "revenue": ("merged_wines", "revenue_by_product", "revenue_summary"),
    "segmentation": ("revenue_by_product", "wine_segmentation"),
}


def _save(store: TableStore, **tables: DataFrame) -> dict[str, DataFrame]:
    """Store tables that do not depend on each other, side by side."""
    saved = together(
        *(
            partial(store.save, name, df, TABLES[name], INPUTS.get(name, ()))
            for name, df in tables.items()
        )
    )
    return dict(zip(tables, saved, strict=True))


def stage(
    store: TableStore, sources: Sequence[SourceSpec], out: str | None = None
) -> dict[str, dict[str, int]]:
    """Store every source as text with normalised identifiers; write the manifest.

    All sources of the domain must be given, and no others.
    """
    names = [spec.name for spec in sources]
    if sorted(names) != sorted(fv.REQUIRED_COLUMNS):
        raise ValueError(
            f"Sources needed: {', '.join(fv.REQUIRED_COLUMNS)}; given: {', '.join(names)}"
        )
    raw = _save(
        store,
        **{
            f"raw_{spec.name}": stage_frame(read_source(store.spark, spec))
            for spec in sources
        },
    )
    staged = {name.removeprefix("raw_"): df for name, df in raw.items()}
    lines = manifest_lines(staged)
    if out is not None:
        write_json(store.spark, f"{out}/staging_manifest.json", lines)
    return lines


def manifest_lines(staged: Mapping[str, DataFrame]) -> dict[str, dict[str, int]]:
    """Rows, columns and repeated rows of every staged source, as the document has them."""
    counts = ("rows", "columns", "full_row_duplicates")
    return {row["source"]: {c: row[c] for c in counts} for row in manifest(staged).collect()}


def build_clean(store: TableStore) -> None:
    _save(
        store,
        erp_not_null=clean.clean_products(store.load("raw_erp")),
        liaison_valid=clean.clean_bridge(store.load("raw_liaison")),
        web_not_null=clean.clean_web(store.load("raw_web")),
    )


def build_dedup(store: TableStore) -> None:
    _save(
        store,
        erp_clean=dedup.dedup_products(store.load("erp_not_null")),
        liaison_clean=dedup.dedup_bridge(store.load("liaison_valid")),
        web_clean=dedup.dedup_web(store.load("web_not_null")),
    )


def build_merged(store: TableStore) -> None:
    merged = reconcile.reconcile(
        store.load("erp_clean"), store.load("liaison_clean"), store.load("web_clean")
    )
    _save(store, merged_wines=merged)


def build_revenue(store: TableStore) -> None:
    merged = store.load("merged_wines")
    _save(
        store,
        revenue_by_product=reconcile.revenue_detail(merged),
        revenue_summary=reconcile.revenue_summary(merged),
    )


def build_segments(store: TableStore, out: str | None = None) -> dict[str, object]:
    """Store the segments, export both lists, and return the z-score metrics."""
    detail = store.load("revenue_by_product")
    known = require_spread(detail)
    scored = _save(store, wine_segmentation=segment(detail, known=known))
    segments = scored["wine_segmentation"]
    metrics = score_metrics(segments, known)
    if out is not None:
        write_segments(segments, out)
        write_json(store.spark, f"{out}/zscore_metrics.json", metrics)
    return metrics


def score_metrics(segments: DataFrame, known: Spread) -> dict[str, object]:
    """Statistics and class sizes, as the document of the z-scores has them."""
    counts = segments.agg(
        F.count_if(F.col("category") == fv.PREMIUM).alias("premium"),
        F.count_if(F.col("category") == fv.ORDINARY).alias("ordinary"),
    ).first()
    return {
        "mean_price": round(known.mean, 6),
        "population_standard_deviation": round(known.stddev, 6),
        "premium_count": counts["premium"],
        "ordinary_count": counts["ordinary"],
    }


def stored_tables(
    store: TableStore, names: Sequence[str] = tuple(TABLES)
) -> Mapping[str, DataFrame]:
    """Those of the tables that were stored so far."""
    return {name: store.load(name) for name in names if store.exists(name)}


def attach_existing(store: TableStore) -> None:
    """Make the tables that an earlier session stored known to this one."""
    store.attach([name for name in TABLES if store.exists(name)])


def validate_stage(
    store: TableStore,
    stage_name: str,
    expected: Expected,
    out: str | None = None,
) -> dict[str, object]:
    """Check one stage, or all, of the stored tables.

    Tables of which one was built from a replaced version of another are refused before
    anything is checked: a stage of an ended run beside a newer one, for instance.
    """
    names = list(dict.fromkeys(n for stage in stages_of(stage_name) for n in CHECKED[stage]))
    store.require_one_set(names)
    return validate(store.spark, stored_tables(store, names), stage_name, expected, out)


def export(store: TableStore, out: str) -> dict[str, object]:
    """Write the revenue report and return its summary."""
    summary = store.load("revenue_summary")
    first = summary.first()
    if first is None:
        raise ValueError("The revenue summary is missing.")
    write_revenue_report(store.load("revenue_by_product"), summary, out)
    return first.asDict()


def run(
    spark: SparkSession,
    sources: Sequence[SourceSpec],
    out: str,
    expected: Expected,
    database: str = "default",
    buckets: int | None = None,
) -> dict[str, object]:
    """Run everything below ``out``; the first stage that fails ends the run."""
    store = TableStore(spark, f"{out}/tables", database, buckets)
    reports = f"{out}/outputs"
    with own_scratch(spark):
        stage(store, sources, f"{out}/staging")
        build_clean(store)
        build_dedup(store)
        validate_stage(store, "cleaning", expected, reports)
        build_merged(store)
        validate_stage(store, "merge", expected, reports)
        build_revenue(store)
        validate_stage(store, "revenue", expected, reports)
        build_segments(store, reports)
        validate_stage(store, "segmentation", expected, reports)
        report = validate_stage(store, "all", expected, reports)
        export(store, reports)
    store.vacuum()
    return report
