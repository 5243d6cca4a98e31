"""Named sources: where they lie, what they must carry, how they are staged."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink import fixed_values as fv
from ledgerlink.functions.bitmaps import with_listed
from ledgerlink.functions.text import normalize_identifiers
from ledgerlink.sources.delimited import read_delimited

# Delimited text as the source system writes it: quotes are doubled, cells may
# hold line ends, an empty cell is null.  Types are never inferred.
CSV_READ_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "encoding": "UTF-8",
    "inferSchema": "false",
}


@dataclass(frozen=True)
class SourceSpec:
    """One source file or folder.

    Delimited text is read by many tasks a file, also where cells hold line ends.  With
    the option ``multiLine`` Spark's own reader is used: ``true`` reads a file in one task
    and takes quotes inside unquoted cells as they are, ``false`` knows no line ends in
    cells.
    """

    name: str
    path: str
    format: str = "parquet"
    required: tuple[str, ...] | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def required_columns(self) -> tuple[str, ...]:
        if self.required is not None:
            return self.required
        return fv.REQUIRED_COLUMNS.get(self.name, ())


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Read a source, strip its header and check its columns."""
    defaults = CSV_READ_OPTIONS if spec.format == "csv" else {}
    options = {**defaults, **spec.options}
    reader = spark.read.format(spec.format).options(**options)
    try:
        df = reader.load(spec.path)
        if spec.format == "csv" and "multiLine" not in spec.options and _plain(options):
            df = read_delimited(spark, spec.path, options, df.schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(
                f"Source {spec.name} not found: {spec.path}"
            ) from error
        raise
    return check_columns(strip_header(df), spec)


def _plain(options: Mapping[str, str]) -> bool:
    """Whether quotes are doubled, as the splittable reader takes them."""
    return options["quote"] == options["escape"] and options["encoding"] == "UTF-8"


def strip_header(df: DataFrame) -> DataFrame:
    return df.toDF(*(name.strip() for name in df.columns))


def check_columns(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Refuse a source that lacks a required column; others are tolerated."""
    missing = sorted(set(spec.required_columns()) - set(df.columns))
    if missing:
        raise ValueError(f"Columns missing in {spec.name}: {', '.join(missing)}")
    return df


def stage_frame(df: DataFrame) -> DataFrame:
    """All columns as text, empty text as null, identifiers normalised."""

    def text(item: T.StructField) -> Column:
        cell = F.col(f"`{item.name}`")
        if item.name in fv.IDENTIFIER_COLUMNS:
            return cell
        return F.nullif(cell.cast("string"), F.lit("")).alias(item.name)

    identified = normalize_identifiers(df, fv.IDENTIFIER_COLUMNS)
    return identified.select(*(text(item) for item in identified.schema))


def full_row_duplicates(df: DataFrame) -> Column:
    """Number of rows that repeat an earlier row in every column, as a scalar.

    Whole rows are wide and repeats are rare, so the first pass counts a hash per row, on
    the map side first.  A bitmap of the hashes that repeat is broadcast, and only rows
    that it knows are shuffled to be compared in full, copies collapsed before; that makes
    the count exact.  No job runs while the frame is built.
    """
    rows = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    hashed = rows.withColumn("_hash", F.xxhash64(*rows.columns))
    repeated = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    marked = with_listed(hashed, F.col("_hash"), repeated, F.col("_hash"), "_again")
    copies = marked.where("_again").groupBy("_hash", *rows.columns).agg(
        F.count(F.lit(1)).alias("n")
    )
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).scalar()


def manifest(staged: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and full-row duplicates of every staged source."""

    def line(name: str, df: DataFrame) -> DataFrame:
        counted = df.agg(F.count(F.lit(1)).alias("rows"))
        return counted.select(
            F.lit(name).alias("source"),
            "rows",
            F.lit(len(df.columns)).cast("bigint").alias("columns"),
            full_row_duplicates(df).alias("full_row_duplicates"),
        )

    return union_all(line(name, df) for name, df in staged.items())


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
