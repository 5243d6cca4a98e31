"""Run the checks of a stage, write the report, and stop the run on a failure."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Row, SparkSession

from ledgerlink import fixed_values as fv
from ledgerlink.config import Expected
from ledgerlink.quality import checks as c
from ledgerlink.sources.sinks import write_json


class QualityGateError(ValueError):
    """A stage failed; ``report`` is what was written, ``failed`` names the checks."""

    def __init__(self, report: dict[str, object], failed: list[str]) -> None:
        self.report, self.failed = report, failed
        names = ", ".join(failed)
        super().__init__(f"Quality checks failed [{report['stage']}]: {names}")


def failed_checks(rows: Iterable[Row]) -> list[str]:
    return [row["check_name"] for row in rows if not row["passed"]]


def _metric(row: Row) -> dict[str, object]:
    """What a check adds to the metrics: its count, or its amount as text."""
    if row["metric"] is None:
        return {}
    if row["kind"] == c.MONEY:
        return {
            row["metric"]: row["amount"],
            fv.EXPECTED_TOTAL_METRIC: row["expected_amount"],
        }
    return {} if row["actual"] is None else {row["metric"]: row["actual"]}


def build_report(rows: Iterable[Row], stage: str) -> dict[str, object]:
    """Report of the collected checks, under the keys of the report's contract."""
    rows = list(rows)
    metrics: dict[str, object] = {}
    for row in rows:
        metrics |= _metric(row)
    counted = {
        row["metric"]: {key: row[key] for key in ("actual", "expected", "passed")}
        for row in rows
        if row["kind"] == c.ROWS and row["metric"] is not None
    }
    values = {
        "status": fv.FAILED if failed_checks(rows) else fv.PASSED,
        "stage": stage,
        "generated_at_utc": datetime.now(timezone.utc).isoformat(),
        "metrics": metrics,
        "row_count_tests": counted,
        "checks": {row["check_name"]: row["passed"] for row in rows},
    }
    return {key: values[key] for key in fv.REPORT_KEYS}


def report_name(stage: str) -> str:
    return fv.REPORT_FILES.get(stage, f"quality_{stage}.json")


def validate(
    spark: SparkSession,
    tables: c.Tables,
    stage: str,
    expected: Expected,
    out: str | None = None,
) -> dict[str, object]:
    """Check a stage; the report is written before a failure is raised.

    The only rows that reach the driver are the checks themselves, 34 at most.
    """
    rows = c.check_frame(tables, stage, expected).collect()
    report = build_report(rows, stage)
    if out is not None:
        write_json(spark, f"{out.rstrip('/')}/{report_name(stage)}", report)
    failed = failed_checks(rows)
    if failed:
        raise QualityGateError(report, failed)
    return report
