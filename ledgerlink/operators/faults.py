"""Row mutations that give a new table, to prove that the gates refuse bad data.

The smallest keys are found by an aggregate or a top-k and reach the rows as a
scalar or as a join side of k rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Change:
    """What a variant does to the rows of a table: new values of some columns in the rows
    that satisfy ``where``, rows that go, and rows that come twice."""

    values: Mapping[str, Column] = field(default_factory=dict)
    where: Column | None = None
    drop: Column | None = None
    repeat: Column | None = None


def variants(df: DataFrame, changes: Mapping[str, Change], name: str = "variant") -> DataFrame:
    """Changed copies of a table side by side, told apart by a column, from one scan.

    Each row becomes the array of its copies, and the array becomes rows.
    """

    def hit(condition: Column | None, otherwise: bool) -> Column:
        return F.coalesce(F.lit(otherwise) if condition is None else condition, F.lit(False))

    def cell(c: str, change: Change) -> Column:
        if c not in change.values:
            return F.col(c)
        new = change.values[c].cast(df.schema[c].dataType)
        return F.when(hit(change.where, True), new).otherwise(F.col(c)).alias(c)

    copies = []
    for variant, change in changes.items():
        row = F.struct(F.lit(variant).alias(name), *(cell(c, change) for c in df.columns))
        times = F.when(hit(change.drop, False), 0).when(hit(change.repeat, False), 2).otherwise(1)
        copies.append(F.array_repeat(row, times))
    return df.select(F.inline(F.flatten(F.array(*copies))))


def in_each(df: DataFrame, names: Sequence[str], name: str = "variant") -> DataFrame:
    """A table as it is in each of the variants."""
    return df.withColumn(name, F.explode(F.array(*map(F.lit, names))))


def smallest_key(df: DataFrame, key: str, where: Column | None = None) -> Column:
    """Smallest key of a table, or of its rows that satisfy ``where``."""
    rows = df if where is None else df.where(where)
    return rows.agg(F.min(key)).scalar()


def drop_smallest(df: DataFrame, key: str) -> DataFrame:
    """Delete the rows of the smallest key; rows without a key stay."""
    return df.where(F.coalesce(F.col(key) != smallest_key(df, key), F.lit(True)))


def drop_k_smallest(df: DataFrame, key: str, k: int) -> DataFrame:
    """Delete the rows of the k first keys in key order; rows without a key are last."""
    victims = df.select(key).orderBy(F.col(key).asc_nulls_last()).limit(k)
    return df.join(victims, key, "left_anti")


def among_smallest(df: DataFrame, key: str, k: int) -> Column:
    """Whether a row has one of the k first keys, as ``drop_k_smallest`` takes them."""
    victims = df.select(key).orderBy(F.col(key).asc_nulls_last()).limit(k)
    return F.array_contains(victims.agg(F.collect_list(key)).scalar(), F.col(key))


def update_where(df: DataFrame, column: str, value: Column, where: Column) -> DataFrame:
    """Set a column in the rows that satisfy ``where``; the type stays."""
    target = df.schema[column].dataType
    hit = F.coalesce(where, F.lit(False))
    return df.withColumn(
        column, F.when(hit, value.cast(target)).otherwise(F.col(column))
    )


def relabel_first(
    df: DataFrame, key: str, label: str, old: str, new: str
) -> DataFrame:
    """Give the first row of one label another label."""
    return update_where(df, label, F.lit(new), is_first(df, key, F.col(label) == old))


def is_first(df: DataFrame, key: str, where: Column) -> Column:
    """Whether a row has the smallest key of those that satisfy ``where``."""
    return F.col(key) == smallest_key(df, key, where)


def swap_first_labels(
    df: DataFrame, key: str, label: str, one: str, other: str
) -> DataFrame:
    """Swap the labels of the first row of each of two labels."""
    return df.withColumn(label, swapped_labels(df, key, label, one, other))


def swapped_labels(df: DataFrame, key: str, label: str, one: str, other: str) -> Column:
    return (
        F.when(is_first(df, key, F.col(label) == one), F.lit(other))
        .when(is_first(df, key, F.col(label) == other), F.lit(one))
        .otherwise(F.col(label))
    )


def append_copy_of_first(df: DataFrame, key: str) -> DataFrame:
    """Append a copy of the first row in key order; rows without a key are last.

    Of rows with one key that one is taken whose other columns are smallest.
    """
    others = [name for name in df.columns if name != key]
    order = [F.col(f"`{name}`").asc_nulls_last() for name in (key, *others)]
    return df.unionByName(df.orderBy(*order).limit(1))


def rebuild_total(summary: DataFrame, detail: DataFrame, total: Column) -> DataFrame:
    """Replace the total of a summary by an aggregate of the detail table."""
    return summary.withColumn("total_revenue", detail.agg(total).scalar())
