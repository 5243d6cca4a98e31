"""The whole run, from source files to reports, and its command line."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv
from ledgerlink.__main__ import main
from ledgerlink.config import Expected
from ledgerlink.plans import run as plans
from ledgerlink.quality.gate import QualityGateError
from ledgerlink.sources import specs
from ledgerlink.sources.sinks import read_json, write_csv
from ledgerlink.sources.specs import SourceSpec
from ledgerlink.sources.store import (
    MixedVersionsError,
    TableStore,
    scratch_root,
    together,
)
from parity import raw_tables

EXPECTED = Expected(192, 193, 395, 200, 174, fv.Decimal("141101332.80"), 7)


@pytest.fixture(scope="module")
def inputs(spark, sf_dir, tmp_path_factory):
    """Two Parquet sources and a delimited one."""
    folder = tmp_path_factory.mktemp("sources")
    raw_tables.raw_erp(spark, sf_dir).write.parquet(f"{folder}/erp")
    raw_tables.raw_web(spark, sf_dir).write.parquet(f"{folder}/web")
    write_csv(raw_tables.raw_liaison(spark, sf_dir), f"{folder}/liaison")
    return [
        SourceSpec("erp", f"{folder}/erp"),
        SourceSpec("liaison", f"{folder}/liaison", "csv"),
        SourceSpec("web", f"{folder}/web"),
    ]


@pytest.fixture(scope="module")
def finished(spark, inputs, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    report = plans.run(spark, inputs, out, EXPECTED, "finished")
    return out, report


def test_run_passes_every_gate(spark, finished):
    out, report = finished
    assert report["status"] == "passed"
    for stage in fv.STAGES:
        written = read_json(spark, f"{out}/outputs/quality_{stage}.json")
        assert written["status"] == "passed"
    assert read_json(spark, f"{out}/staging/staging_manifest.json") == {
        "erp": {"rows": 240, "columns": 5, "full_row_duplicates": 8},
        "liaison": {"rows": 216, "columns": 2, "full_row_duplicates": 1},
        "web": {"rows": 423, "columns": 6, "full_row_duplicates": 0},
    }


def test_tables_can_be_queried_by_name(spark, finished):
    merged = spark.sql("SELECT count(*) FROM finished.merged_wines").first()[0]
    premium = spark.sql(
        "SELECT count(*) FROM finished.wine_segmentation WHERE z_score > 2"
    ).first()[0]
    assert (merged, premium) == (174, 7)


def test_exports(spark, finished):
    out, _ = finished

    def read(name):
        return spark.read.options(**specs.CSV_READ_OPTIONS).csv(f"{out}/outputs/{name}")

    premium, ordinary = read("vins_premium.csv"), read("vins_ordinaires.csv")
    assert (premium.count(), ordinary.count()) == (7, 167)
    assert premium.columns == list(fv.SEGMENT_COLUMNS)
    assert premium.where("cast(z_score AS double) <= 2").count() == 0
    assert ordinary.where("cast(z_score AS double) > 2").count() == 0
    detail = read("rapport_chiffre_affaires/ca_par_produit.csv")
    assert detail.columns == list(fv.REPORT_HEADERS.values())
    summary = read("rapport_chiffre_affaires/synthese.csv").first()
    assert [float(cell) for cell in summary] == [141101332.8, 174, 129920]
    metrics = read_json(spark, f"{out}/outputs/zscore_metrics.json")
    assert metrics["premium_count"] == 7
    assert metrics["ordinary_count"] == 167
    assert metrics["mean_price"] > 0


def _rounded(df):
    # Means add up in another order, which shows in the last digits of a score.
    if "z_score" not in df.columns:
        return df
    return df.withColumn("z_score", F.round("z_score", 9))


def test_bucketed_run_gives_the_same_tables(spark, inputs, finished, tmp_path):
    report = plans.run(spark, inputs, str(tmp_path), EXPECTED, "laid_out", buckets=4)
    assert report["status"] == "passed"
    for name in plans.TABLES:
        ours = _rounded(spark.table(f"laid_out.{name}"))
        other = _rounded(spark.table(f"finished.{name}")).select(*ours.columns)
        assert ours.exceptAll(other).isEmpty() and other.exceptAll(ours).isEmpty()
    described = spark.sql("DESCRIBE EXTENDED laid_out.web_clean").collect()
    facts = {row["col_name"]: row["data_type"] for row in described}
    assert facts["Num Buckets"] == "4"


def test_a_failed_gate_ends_the_run(spark, inputs, tmp_path):
    wrong = Expected(192, 193, 395, 200, 173, fv.Decimal("141101332.80"), 7)
    with pytest.raises(QualityGateError, match="merged_count_matches_expected"):
        plans.run(spark, inputs, str(tmp_path), wrong, "refused")
    store = TableStore(spark, f"{tmp_path}/tables", "refused")
    assert store.exists("merged_wines") and not store.exists("revenue_by_product")


def test_a_newer_stage_beside_older_ones_is_refused(spark, inputs, tmp_path):
    """A second run that ended early leaves tables of the first beside its own."""
    plans.run(spark, inputs, str(tmp_path), EXPECTED, "twice")
    store = TableStore(spark, f"{tmp_path}/tables", "twice")
    plans.stage(store, inputs)
    plans.build_clean(store)
    plans.build_dedup(store)
    assert plans.validate_stage(store, "cleaning", EXPECTED)["status"] == "passed"
    for stage in ("merge", "revenue", "segmentation", "all"):
        with pytest.raises(MixedVersionsError, match="merged_wines"):
            plans.validate_stage(store, stage, EXPECTED)
    plans.build_merged(store)
    assert plans.validate_stage(store, "merge", EXPECTED)["status"] == "passed"


def test_runs_side_by_side_leave_no_scratch(spark, inputs, tmp_path):
    before = set(_scratch_folders(spark))
    wrong = Expected(192, 193, 395, 200, 173, fv.Decimal("141101332.80"), 7)

    def refused():
        with pytest.raises(QualityGateError):
            plans.run(spark, inputs, f"{tmp_path}/bad", wrong, "side_bad")
        return "refused"

    good, bad = together(
        lambda: plans.run(spark, inputs, f"{tmp_path}/good", EXPECTED, "side_good"), refused
    )
    assert good["status"] == "passed" and bad == "refused"
    assert set(_scratch_folders(spark)) <= before


def _scratch_folders(spark):
    from pathlib import Path

    root = Path(scratch_root(spark).removeprefix("file:"))
    return [p.name for p in root.glob("ledgerlink-*/*/*") if any(p.iterdir())]


def test_commands_return_a_status(spark, inputs, finished, tmp_path, capsys):
    out, _ = finished
    base = ["--tables", f"{out}/tables", "--out", str(tmp_path), "--database", "later"]
    good = json.dumps({**EXPECTED.__dict__, "total_revenue": "141101332.80"})
    assert main(["validate", *base, "--expected", good]) == 0
    assert json.loads(capsys.readouterr().out)["status"] == "passed"
    assert main(["validate", *base, "--stage", "merge", "--expected", "published"]) == 1
    assert "merged_count_matches_expected" in capsys.readouterr().err
    with pytest.raises(SystemExit):
        main(["validate", *base, "--stage", "merge"])
    assert "--expected" in capsys.readouterr().err
    assert main(["segment", *base]) == 0
    assert json.loads(capsys.readouterr().out)["premium_count"] == 7
    assert main(["export", *base]) == 0
    assert json.loads(capsys.readouterr().out)["bottles_sold"] == 129920
    query = "dear=SELECT * FROM merged_wines WHERE price > 5000"
    assert main(["sql", *base, "--step", query]) == 0
    assert spark.table("later.dear").count() == 7
