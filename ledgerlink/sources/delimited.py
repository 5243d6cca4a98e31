"""Delimited text whose cells may hold line ends, read by many tasks a file.

Lines are read in splits.  A line with an odd number of quotes opens a cell that goes on,
or closes one; so what matters of a split is how many such lines it has, and the sum of
those of earlier splits says for each line whether it begins a record.  Records are put
together where their lines are, in order; only pieces of records that a split cuts are
shuffled to be joined.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.sources.store import stored

_LINES = "file string, block long, line long, odd long, own int, value string"
#: Characters of an open record that a task holds; beyond them its lines are pieces.
_LONGEST = 16_000_000


def _numbered(quote: str):
    """Tasks that number the lines of each split and count those with odd quotes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, lines, odds = None, 0, 0
        for batch in batches:
            # A batch may hold lines of several splits, one after the other.
            files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            odd = pc.count_substring(batch.column(2), quote).to_numpy(zero_copy_only=False) % 2
            begins = [i for i in range(batch.num_rows)
                      if i == 0 or (files[i], blocks[i]) != (files[i - 1], blocks[i - 1])]
            for lo, hi in zip(begins, [*begins[1:], batch.num_rows], strict=True):
                if split != (files[lo], blocks[lo]):
                    split, lines, odds = (files[lo], blocks[lo]), 0, 0
                counts = odds + np.cumsum(odd[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in batch.columns[:2]),
                     pa.array(np.arange(lines, lines + hi - lo)),
                     pa.array(counts.astype(np.int64)), pa.array(odd[lo:hi].astype(np.int32)),
                     batch.column(2).slice(lo, hi - lo)],
                    ["file", "block", "line", "odd", "own", "value"],
                )
                lines, odds = lines + hi - lo, int(counts[-1])

    return run


_PIECES = {
    "value": pa.string(), "first": pa.bool_(), "file": pa.string(), "record": pa.int64(),
    "block": pa.int64(), "line": pa.int64(),
}
_PIECES_DDL = "value string, first boolean, file string, record long, block long, line long"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_PIECES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _PIECES.values(), strict=True)], list(_PIECES)
    )


class _Assembler:
    """Puts the lines of a task together to records; ``held`` are those of an open one."""

    def __init__(self) -> None:
        self.held: list[tuple] = []
        self.size = 0
        self.opened = False
        self.last: tuple | None = None

    def pieces(self) -> list[tuple]:
        """What is held, as lines of records that begin or end elsewhere."""
        out, self.held, self.size, self.opened = self.held, [], 0, False
        return out

    def take(self, file: str, block: int, line: int, odds: int, own: int, value: str) -> list[tuple]:
        out = [] if self.last == (file, block, line - 1) else self.pieces()
        self.last = file, block, line
        first, inside = block == line == 0, odds % 2 == 1
        if not own and not inside:
            return [*out, (value, first, None, None, None, None)]
        if own and inside:
            out += self.pieces()
            self.opened = True
        self.held.append((value, first, file, (odds + 1) // 2, block, line))
        self.size += len(value)
        if own and not inside:
            if not self.opened:
                return out + self.pieces()
            lines = self.pieces()
            text = "\n".join(x[0] for x in lines)
            return [*out, (text, lines[0][1], None, None, None, None)]
        return out + self.pieces() if self.size > _LONGEST else out


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and as pieces the lines of records that begin or end elsewhere."""
    work = _Assembler()
    for batch in batches:
        out: list[tuple] = []
        for file, block, line, odd, own, value, before in zip(
            *(c.to_pylist() for c in batch.columns), strict=True
        ):
            out += work.take(file, block, line, before + odd, own, value)
        yield _rows(out)
    yield _rows(work.pieces())


def _records(lines: DataFrame) -> DataFrame:
    """``value``: the text of each record, and ``first``: whether it begins its file."""
    totals = lines.groupBy("file", "block").agg(F.max("odd").alias("total"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = totals.select(
        "file", "block", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before")
    )
    # One short row for each split of the source.
    placed = lines.join(F.broadcast(before), ["file", "block"])
    found = placed.select(*lines.columns, "before").mapInArrow(_assembled, _PIECES_DDL)
    several = (
        found.where("record IS NOT NULL").groupBy("file", "record")
        .agg(F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("lines"),
             F.max("first").alias("first"))
        .select(F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("value"), "first")
    )
    return found.where("record IS NULL").select("value", "first").unionByName(several)


def read_delimited(
    spark: SparkSession, path: str, options: Mapping[str, str], schema: T.StructType
) -> DataFrame:
    """The records of all files below ``path``, parsed as ``options`` say.

    Quotes are doubled inside quoted cells and occur in no others.  Lines end with \\n or
    \\r\\n.  Blank lines are left out, and the first record of each file is its header.  The
    lines are written once, so that all that is said of them is said of the same splits.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    raw = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value",
    )
    lines = stored(raw.mapInArrow(_numbered(options["quote"]), _LINES), "lines")
    records = _records(lines).where("NOT first").select(
        F.regexp_replace(F.regexp_replace("value", "\r$", ""), "\r\n", "\n").alias("value")
    )
    given = {k: v for k, v in options.items() if k not in ("header", "multiLine")}
    parsed = F.from_csv("value", _ddl(schema), given)
    return records.where(F.trim("value") != "").select(parsed.alias("row")).select("row.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema)
