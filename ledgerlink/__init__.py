"""Reconcile two business systems through a bridge table, on Spark DataFrames."""

from ledgerlink.config import Expected
from ledgerlink.plans.run import export, run, stage, validate_stage
from ledgerlink.sources.specs import SourceSpec

__all__ = ["Expected", "SourceSpec", "export", "run", "stage", "validate_stage"]
