"""Expected results of a run: what the quality gates compare against."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv

#: A known value, one that the plan of the checks finds out, or None.
Value = int | Decimal | Column | None


#: The column that ``Expected.beside`` adds.
EXPECTED_ROW = "_expected"


def value(of: Value) -> Column:
    return of if isinstance(of, Column) else F.lit(of)


@dataclass(frozen=True)
class Expected:
    """Row counts, total and class size that a correct run must reproduce; all are given.

    A value of ``None`` is unknown: the check that needs it fails, it is never
    skipped.  A column, usually a scalar subquery, is a value that is found out when the
    checks run.
    """

    erp_rows: Value
    liaison_rows: Value
    web_cleaned_rows: Value
    web_rows: Value
    merged_rows: Value
    total_revenue: Value
    premium_rows: Value
    #: A scalar subquery of a struct; the values above may be fields of ``EXPECTED_ROW``.
    row: Column | None = None

    def beside(self, df: DataFrame) -> DataFrame:
        """A frame with the values that its checks compare with, found out once."""
        return df if self.row is None else df.withColumn(EXPECTED_ROW, self.row)

    @classmethod
    def published(cls) -> Expected:
        """Those of the original business data set; no other data set has them."""
        rows = fv.EXPECTED_ROWS
        return cls(
            rows["erp_after_deduplication"], rows["liaison_after_deduplication"],
            rows["web_after_cleaning"], rows["web_after_deduplication"], rows["merged_count"],
            fv.EXPECTED_TOTAL_REVENUE, fv.EXPECTED_PREMIUM,
        )

    @property
    def ordinary_rows(self) -> Value:
        if self.merged_rows is None or self.premium_rows is None:
            return None
        return self.merged_rows - self.premium_rows
