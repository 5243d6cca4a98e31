"""Shards that all have the mixture of the sources: proportional stratified interleaving.

Rows of a source are put in a seeded random order; row ``r`` of ``n`` gets the
fraction ``(r + phase) / n``, with a phase per source so that sources of a few rows do
not all fall on one place.  Sorted by fraction, every stretch of the order holds each
source in proportion, to within one row; the order is cut into shards of equal counts.
(Very many sources of a row or two are spread at random, and move the cuts as chance
does.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows that one group of a ranking holds on average.
GROUP_ROWS = 20_000


def _unit(*parts: Column | str) -> Column:
    """The first 52 bits of a text's MD5 as a number from 0 up to 1."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(2.0**52)


def _ranked(df: DataFrame, keys: list[str], group: str, order: list[str], out: str):
    """Ranks from 0 within ``keys``, ordered by ``group`` and then by ``order``.

    Only the counts of the groups are ordered across groups; rows are ordered within
    one group of one key, so a key with most of the rows is spread over its groups.
    """
    sizes = df.groupBy(*keys, group).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(group)
    offsets = sizes.select(
        *(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)),
        F.col(group).alias("_group"),
        (F.sum("_n").over(before) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
    )
    local = F.row_number().over(Window.partitionBy(*keys, group).orderBy(*order))
    same = F.col(group).eqNullSafe(F.col("_group"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return (
        df.withColumn("_local", local)
        .join(offsets, same)
        .withColumn(out, F.col("_before") + F.col("_local") - 1)
        .withColumn(f"{out}_of", F.col("_total"))
        .drop("_local", "_group", "_before", "_total", *(f"_key{i}" for i in range(len(keys))))
    )


def shard(
    docs: DataFrame,
    shards: int = 8,
    seed: int = 1,
    id_col: str = "doc_id",
    source_col: str = "source",
    keep: tuple[str, ...] = (),
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: the id, the source, ``keep``, ``shard`` and ``slot``.

    Shard sizes differ by one at most and slots count from 0 without gaps.  Rows of
    null source form a source of their own; a null id is ordered as the empty text.
    Repeated rows each get a place, in an order that the kept columns decide; rows
    that agree in all of them are alike.  No rows give no rows.  Other columns are not
    read, whatever their names.  Only ids and kept columns are shuffled.
    """
    kept = [c for c in dict.fromkeys(keep) if c not in (id_col, source_col)]
    slim = docs.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).alias("_source"),
        *(F.col(c).alias(f"_keep{i}") for i, c in enumerate(kept)),
    )
    total = docs.count()
    if total == 0:
        rows = slim.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    else:
        groups = max(1, -(-total // group_rows))
        ident = F.coalesce(F.col("_id").cast("string"), F.lit(""))
        source = F.coalesce(F.concat(F.lit("="), F.col("_source").cast("string")), F.lit(""))
        ties = ["_hash", "_id", *(f"_keep{i}" for i in range(len(kept)))]
        mixed = slim.withColumn("_hash", _unit(F.lit(str(seed)), ident)).withColumn(
            "_part", F.floor(F.col("_hash") * groups)
        )
        placed = _ranked(mixed, ["_source"], "_part", ties, "_rank").withColumn(
            "_fraction",
            (F.col("_rank") + _unit(F.lit(f"phase{seed}"), source)) / F.col("_rank_of"),
        )
        spread = placed.withColumn("_part", F.floor(F.col("_fraction") * groups)).withColumn(
            "_all", F.floor(F.col("_part") / 1024)
        )
        order = ["_fraction", "_source", *ties]
        rows = _placed_overall(spread, order).select(
            "*",
            F.expr(f"CAST(_position * {shards} DIV {total} AS INT)").alias("shard"),
        ).withColumn(
            "slot",
            F.col("_position") - F.expr(f"(shard * {total}L + {shards - 1}) DIV {shards}"),
        )
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_source").alias(source_col),
        *(F.col(f"_keep{i}").alias(c) for i, c in enumerate(kept)),
        F.col("shard"),
        F.col("slot").cast("long").alias("slot"),
    )


def _placed_overall(df: DataFrame, order: list[str]) -> DataFrame:
    """``_position`` of each row in the whole order; ``_part`` ascends with it.

    Counts per part are summed in two steps, within blocks of 1024 parts and over the
    blocks, so that no task orders more than the counts of one block or one count per
    block.
    """
    parts = df.groupBy("_all", "_part").agg(F.count(F.lit(1)).alias("_n"))
    inside = parts.withColumn(
        "_inside", F.sum("_n").over(Window.partitionBy("_all").orderBy("_part")) - F.col("_n")
    )
    blocks = parts.groupBy("_all").agg(F.sum("_n").alias("_n"))
    earlier = blocks.select(
        F.col("_all").alias("_block"),
        (F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_all")) - F.col("_n")).alias(
            "_earlier"
        ),
    )
    offsets = inside.join(earlier, F.col("_all") == F.col("_block")).select(
        F.col("_part").alias("_of"), (F.col("_inside") + F.col("_earlier")).alias("_before")
    )
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        df.withColumn("_local", local)
        .join(offsets, F.col("_part") == F.col("_of"))
        .withColumn("_position", F.col("_before") + F.col("_local") - 1)
    )


