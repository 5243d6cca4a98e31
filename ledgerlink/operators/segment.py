"""Separate outliers from ordinary rows with a z-score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv
from ledgerlink.functions.numbers import exact_moments, round_half_even


@dataclass(frozen=True)
class Spread:
    """Mean and population standard deviation of a column, on the driver."""

    mean: float
    stddev: float


def spread(df: DataFrame, value: str = "price") -> DataFrame:
    """One row: number of rows, mean and population standard deviation.

    NaN values count as rows and are left out of both statistics.  Neither depends on
    the order of the rows, so a score at the threshold gets one label in every run.
    """
    number = F.when(~F.isnan(F.col(value)), F.col(value).cast("double"))
    return exact_moments(df, number, row_count=F.count(F.lit(1)))


def require_spread(df: DataFrame, value: str = "price") -> Spread:
    """The statistics of a column; an empty table or equal values are refused."""
    row = spread(df, value).first()
    if row["row_count"] == 0:
        raise ValueError("The table is empty: z-scores cannot be computed.")
    if row["stddev"] == 0.0:
        raise ValueError(f"All values of {value} are equal: no z-score is defined.")
    missing = float("nan")
    return Spread(
        missing if row["mean"] is None else row["mean"],
        missing if row["stddev"] is None else row["stddev"],
    )


def z_score(df: DataFrame, value: str, known: Spread | None = None) -> Column:
    """Distance of a value from the mean, in standard deviations.

    Without known statistics they are a scalar subquery: computed once and put
    into the projection as a literal, so no row is joined to anything.
    """
    number = F.col(value).cast("double")
    if known is not None:
        return (number - F.lit(known.mean)) / F.lit(known.stddev)
    both = spread(df, value).select(F.struct("mean", "stddev").alias("both")).scalar()
    return (number - both["mean"]) / F.nullif(both["stddev"], F.lit(0.0))


def is_outlier(z: Column, threshold: float = fv.Z_THRESHOLD) -> Column:
    """Strictly above the threshold; a NaN score is not (Spark sorts NaN last).

    An infinite score compares as it is.
    """
    return F.coalesce((z > F.lit(threshold)) & ~F.isnan(z), F.lit(False))


def segment(
    df: DataFrame,
    value: str = "price",
    threshold: float = fv.Z_THRESHOLD,
    known: Spread | None = None,
) -> DataFrame:
    """Add z-score, category and type to every row."""
    scored = df.withColumn("z_score", z_score(df, value, known))
    premium = is_outlier(F.col("z_score"), threshold)

    def label(yes: str, no: str) -> Column:
        return F.when(premium, F.lit(yes)).otherwise(F.lit(no))

    return scored.withColumn("category", label(fv.PREMIUM, fv.ORDINARY)).withColumn(
        "wine_type", label(fv.PREMIUM_TYPE, fv.ORDINARY_TYPE)
    )


def outliers(
    df: DataFrame, key: str, value: str, threshold: float = fv.Z_THRESHOLD
) -> DataFrame:
    """Rows of any table whose value lies above the threshold, with their score."""
    scored = df.select(key, value, z_score(df, value).alias("z_score"))
    return scored.where(is_outlier(F.col("z_score"), threshold))


def class_counts(segments: DataFrame) -> DataFrame:
    """Rows per category."""
    return segments.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def segment_list(segments: DataFrame, category: str) -> DataFrame:
    """One category for export, rounded; unsorted (see ``sorted_segment_list``)."""
    rounded = {"price": 2, "revenue": 2, "z_score": 6}
    return segments.where(F.col("category") == category).select(
        *(
            round_half_even(F.col(name), rounded[name]).alias(name)
            if name in rounded
            else F.col(name)
            for name in fv.SEGMENT_COLUMNS
        )
    )


def sorted_segment_list(segments: DataFrame, category: str) -> DataFrame:
    """One category in report order: premium by score, ordinary by product."""
    rows = segment_list(segments, category)
    if category == fv.PREMIUM:
        return rows.orderBy(
            F.col("z_score").desc_nulls_last(), F.col("product_id").asc_nulls_last()
        )
    return rows.orderBy(F.col("product_id").asc_nulls_last())
