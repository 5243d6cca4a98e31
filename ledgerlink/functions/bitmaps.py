"""Rows that may be on a list, by a bitmap of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Leading bits of a hash that name a bit: 2 ** 27 bits are 16 MB.
BITS = 27
# Bitmaps that Spark builds have 32768 bits.
_IN_ONE = 15


def _place(hash_: Column, bits: int) -> tuple[Column, Column]:
    """The bitmap of a hash, and its bit in there."""
    first = F.shiftrightunsigned(hash_, 64 - bits)
    return F.shiftrightunsigned(first, _IN_ONE), first % (1 << _IN_ONE)


def with_listed(
    rows: DataFrame, key: Column, listed: DataFrame, listed_key: Column, flag: str,
    bits: int = BITS,
) -> DataFrame:
    """``rows`` with a column that is true for all rows whose key is listed.

    Keys are 64-bit hashes, not null.  A bit for each value of their first ``bits`` bits is
    broadcast, 2 ** ``bits`` bits at most, whatever the length of the list; of rows that
    are not listed a few are flagged too.  No row is shuffled.
    """
    block, bit = _place(listed_key, bits)
    bitmaps = listed.groupBy(block.alias("_block")).agg(
        F.bitmap_construct_agg(bit).alias("_bits")
    )
    block, bit = _place(key, bits)
    names = rows.columns
    packed = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"),
        block.alias("_at"), bit.alias("_bit"),
    )
    eight = F.conv(
        F.hex(F.substring("_bits", (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10
    ).cast("int")
    is_set = eight.bitwiseAND(F.expr("shiftleft(1, CAST(_bit % 8 AS INT))")) > 0
    marked = packed.join(F.broadcast(bitmaps), F.col("_at") == F.col("_block"), "left")
    return marked.select("_row.*", F.coalesce(is_set, F.lit(False)).alias(flag))
