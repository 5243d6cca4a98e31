"""Shared helpers: scratch tables, batches of texts, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.functions.bitmaps import BITS, with_listed
from ledgerlink.sources.store import note_written, scratch_root

#: Texts that tasks hold at once: so many rows and bytes, or one longer text.
BATCH_ROWS, BATCH_BYTES = 512, 4_000_000
ROWS_AT_ONCE = 1_000


class Scratch:
    """Tables of one job below the folder that all executors share.

    A written table ends the lineage: a lost executor costs the running stage only.
    """

    def __init__(self, spark: SparkSession, job: str) -> None:
        self.spark = spark
        app = spark.sparkContext.applicationId
        self.root = f"{scratch_root(spark)}/{job}-{app}-{uuid.uuid4().hex}"
        self.tables = 0
        _small_batches(spark)
        # Inside of ``own_scratch`` the tables go with the run that they belong to.
        note_written(self.root)

    def store(self, df: DataFrame, compression: str = "zstd", by: str | None = None) -> DataFrame:
        """Write a frame and return it as read back; ``by`` is a last column with a folder
        for each of its values."""
        self.tables += 1
        path = f"{self.root}/{self.tables}"
        df.write.option("compression", compression).parquet(
            path, partitionBy=[] if by is None else [by]
        )
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete the tables, once no plan reads them any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _small_batches(spark: SparkSession) -> None:
    """Hand at most ``ROWS_AT_ONCE`` rows at once to Python from now on, for this session:
    rows hold whole texts, and two tasks of an executor hold a batch each, in the JVM and
    in Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS_AT_ONCE:
        spark.conf.set(name, str(ROWS_AT_ONCE))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs inside hand at most so many rows at once to Python: for rows that are large."""
    with configured(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}):
        yield


@contextmanager
def configured(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Jobs inside have these settings."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of a bounded number of rows and bytes of its text column."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
    start = held = 0
    for i, size in enumerate(lengths.to_pylist()):
        if i > start and (held + size > BATCH_BYTES or i - start >= BATCH_ROWS):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def first_of(df: DataFrame, wanted: str) -> str:
    """``wanted``, or it with underscores, so that it clashes with no column of df."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def components(
    scratch: Scratch, edges: DataFrame, u: str = "u", v: str = "v", rounds: int = 100
) -> DataFrame:
    """The smallest node that each node of ``edges`` is connected with.

    Columns ``node`` and ``label``; nodes without edges are not in the result.  Each
    round hooks every node to its smallest neighbour, follows the hooks to their roots
    and contracts the edges to those between different roots, so that edges get fewer
    from round to round, until none is left.  Only the news whether anything is left
    reaches the driver.
    """
    low, high = F.least(u, v), F.greatest(u, v)
    left = scratch.store(
        edges.where(F.col(u) != F.col(v)).select(low.alias("u"), high.alias("v")).distinct()
    )
    labels = None
    for _ in range(rounds):
        root = _roots(scratch, left, rounds)
        if labels is None:
            labels = root
        else:
            follow = root.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = scratch.store(
                labels.join(follow, "label", "left")
                .select("node", F.coalesce("next", "label").alias("label"))
            )
        left = scratch.store(
            left.join(root.select(F.col("node").alias("u"), F.col("label").alias("a")), "u")
            .join(root.select(F.col("node").alias("v"), F.col("label").alias("b")), "v")
            .where("a <> b")
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
        )
        if left.isEmpty():
            return labels
    raise RuntimeError(f"Components did not settle in {rounds} rounds.")


def _roots(scratch: Scratch, edges: DataFrame, rounds: int) -> DataFrame:
    """``node`` and ``label``: the node that hooks to smaller neighbours lead to."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hooks = scratch.store(
        both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("best"))
        .select("node", F.least("node", "best").alias("label"))
    )
    for _ in range(rounds):
        target = hooks.select(F.col("node").alias("label"), F.col("label").alias("far"))
        moved = scratch.store(
            hooks.join(target, "label").select("node", F.col("far").alias("label"),
                                               (F.col("far") != F.col("label")).alias("moved"))
        )
        hooks = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return hooks
    raise RuntimeError(f"Hooks did not settle in {rounds} rounds.")


def maybe_listed(
    rows: DataFrame, key: Column, listed: DataFrame, listed_key: Column, bits: int = BITS
) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose key may be among the listed ones, and the rest.

    Keys are 64-bit hashes, not null.  Rows of the rest need no shuffle to meet the list;
    all rows of listed keys are in the first part.  ``listed`` is a written table.
    """
    flag = first_of(rows, "_listed")
    marked = with_listed(rows, key, listed, listed_key, flag, bits)
    return tuple(
        marked.where(part).select(*(F.col(f"`{c}`") for c in rows.columns))
        for part in (F.col(flag), ~F.col(flag))
    )


def packed(df: DataFrame, text_col: str) -> DataFrame:
    """Two columns: ``_row`` with all other columns, whatever their names, and ``_text``."""
    _small_batches(df.sparkSession)
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns) if c != text_col]
    return df.select(
        F.struct(F.lit(True).alias("row"), *others).alias("_row"),
        F.col(f"`{text_col}`").cast("string").alias("_text"),
    )


def unpacked(columns: list[str], text_col: str, text: str = "_text") -> list[Column]:
    """The columns that ``packed`` took, for a select on what came of it."""
    return [
        F.col(text).alias(c) if c == text_col else F.col("_row").getField(f"c{i}").alias(c)
        for i, c in enumerate(columns)
    ]


def wider(df: DataFrame, more: str) -> T.StructType:
    """The schema of a frame with further columns, given as DDL."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(more).fields])
