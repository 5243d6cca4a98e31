"""Measurements behind the checks.  Each gives a one-row frame.

Everything is measured by grouping on keys with partial aggregation.  Where a
check compares rows of two tables, matching and total pairs are *counted* from
group sizes; the pairs are never built, so a key that repeats millions of times
on both sides costs no more than its rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink import fixed_values as fv
from ledgerlink.functions.numbers import exact_moments, exact_sum, is_finite
from ledgerlink.functions.text import blank_to_null, strip_spaces

_PAIRS = "decimal(38,0)"
_CELL = 1e-6


def table_profile(df: DataFrame, invalid: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows, and rows that violate a predicate, in one scan; for each ``by`` of its own.

    No detail row is shuffled.
    """
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(invalid).alias("invalid")
    )


def keyed_profile(
    df: DataFrame,
    key: str,
    invalid: Column | None = None,
    null_is_key: bool = False,
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rows, violations, repeated keys and class counts from a single grouping."""
    flags = dict(sums or {})
    flags["invalid"] = F.lit(False) if invalid is None else invalid
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(flag).alias(name) for name, flag in flags.items()),
    )
    repeated = F.col("rows") > 1
    if not null_is_key:
        repeated = repeated & F.col(key).isNotNull()
    return per_key.agg(
        F.count_if(repeated).alias("repeated"),
        *(
            F.coalesce(F.sum(name), F.lit(0)).alias(name)
            for name in ("rows", *flags)
        ),
    )


def repeated_keys(df: DataFrame, key: str, null_is_key: bool = False) -> DataFrame:
    """Number of keys that occur more than once."""
    return keyed_profile(df, key, null_is_key=null_is_key).select("repeated")


def broken(rule: fv.FieldRule) -> Column:
    """A row that breaks one of the requirements of its table; never null."""

    def text(name: str) -> Column:
        return blank_to_null(strip_spaces(F.col(name)))

    tests = [
        *(F.col(name).isNull() for name in rule.present),
        *(text(name).isNull() for name in rule.filled),
        *(~is_finite(F.col(name)) for name in rule.finite),
        *(~F.coalesce(F.col(c).isin(*known), F.lit(False)) for c, known in rule.one_of),
        *(F.coalesce(F.col(a) != F.col(b), F.lit(False)) for a, b in rule.equal),
    ]
    return reduce(Column.__or__, tests)


def invalid_product() -> Column:
    return broken(fv.FIELD_RULES["product"])


def invalid_bridge() -> Column:
    return broken(fv.FIELD_RULES["bridge"])


def invalid_web() -> Column:
    return broken(fv.FIELD_RULES["web"])


def invalid_merged() -> Column:
    return broken(fv.FIELD_RULES["merged"])


def invalid_label() -> Column:
    """A score that is not a number, an unknown label, or one on the wrong side."""
    z, label = F.col("z_score"), F.col("category")
    known = F.coalesce(label.isin(fv.PREMIUM, fv.ORDINARY), F.lit(False))
    above = z > F.lit(fv.Z_THRESHOLD)
    return (
        ~is_finite(z)
        | ~known
        | ((label == fv.PREMIUM) & ~above)
        | ((label == fv.ORDINARY) & above)
    )


def mismatches(
    left: DataFrame,
    right: DataFrame,
    key: str,
    payload: Mapping[str, tuple[Column, Column]],
    right_is_valid: Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Pairs and single rows a full outer join on ``key`` would find to differ.

    With ``by``, columns of both sides, rows meet within their values of these only, and
    each has its own count.

    ``payload`` names the compared values of both sides; null equals null.  Pairs
    of a key that agree are those with equal payload, so both are counted from
    group sizes: per payload first, then per key.
    """

    def side(df: DataFrame, number: int) -> DataFrame:
        return df.select(
            *by,
            F.col(key).alias("_key"),
            *(columns[number].alias(name) for name, columns in payload.items()),
            F.lit(1 - number).cast("bigint").alias("l"),
            F.lit(number).cast("bigint").alias("r"),
        )

    per_payload = (
        side(left, 0)
        .unionByName(side(right, 1))
        .groupBy(*by, "_key", *payload)
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    )
    valid = F.lit(True) if right_is_valid is None else right_is_valid
    per_key = per_payload.groupBy(*by, "_key").agg(
        F.sum("l").alias("l"),
        F.sum("r").alias("r"),
        F.sum(F.when(valid, _product("l", "r")).otherwise(F.lit(0))).alias("agree"),
    )
    return per_key.groupBy(*by).agg(
        _as_count(F.sum(_differing("l", "r", "agree"))).alias("mismatches")
    )


def _differing(left: str, right: str, agree: str) -> Column:
    """Pairs of a key that differ; rows that meet none count by themselves."""
    l, r = F.col(left), F.col(right)
    alone = F.col("_key").isNull() | (l == 0) | (r == 0)
    return F.when(alone, (l + r).cast(_PAIRS)).otherwise(_product(left, right) - F.col(agree))


def _product(a: str, b: str) -> Column:
    return (
        F.col(a).cast("decimal(19,0)") * F.col(b).cast("decimal(19,0)")
    ).cast(_PAIRS)


def _as_count(total: Column) -> Column:
    """A sum of pairs as a whole number; one that does not fit ends the query."""
    count = F.coalesce(total, F.lit(0).cast(_PAIRS))
    fits = count <= F.lit(2**63 - 1).cast(_PAIRS)
    refused = F.raise_error(F.lit("More than 2^63 - 1 differing pairs.")).cast("bigint")
    return F.when(fits, count.cast("bigint")).otherwise(refused)


def revenue_mismatches(
    merged: DataFrame, detail: DataFrame, revenue: Column, by: Sequence[str] = ()
) -> DataFrame:
    """Revenue rows that do not follow from the merged table, and missing ones."""
    same = ("id_web", "price", "total_sales")
    payload = {name: (F.col(name), F.col(name)) for name in same}
    payload["revenue"] = (revenue, F.col("revenue"))
    return mismatches(
        merged, detail, "product_id", payload, is_finite(F.col("revenue")), by
    )


def segment_mismatches(
    detail: DataFrame, segments: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Segmented rows that do not follow from the revenue table, and missing ones."""
    payload = {name: (F.col(name), F.col(name)) for name in ("price", "id_web")}
    return mismatches(detail, segments, "product_id", payload, by=by)


def statistics(detail: DataFrame, value: str = "price") -> DataFrame:
    """Mean, deviation and whether z-scores can be computed from them."""
    both = exact_moments(detail, F.col(value))
    usable = is_finite(F.col("mean")) & is_finite(F.col("stddev"))
    return both.withColumn(
        "valid", usable & F.coalesce(F.col("stddev") > 0, F.lit(False))
    )


def wrong_z_scores(
    segments: DataFrame,
    detail: DataFrame,
    by: Sequence[str] = (),
    known: DataFrame | None = None,
) -> DataFrame:
    """Pairs of a key whose stored score is not the recomputed one; and validity.

    The statistics, those of ``known`` or else of ``detail``, are a scalar subquery, so that nothing
    runs while the frame is built.  A key with one value on each side, however often, is
    settled by the sizes and values of its group: one shuffle of narrow rows for the
    whole table.  Keys with several values are counted in ``_close_pairs``, a branch
    without rows if there are none.  With ``by``, columns of both sides, each value of
    these has its own count.
    """
    fact = _score_facts(detail if known is None else known)

    def side(df: DataFrame, score: Column, number: int) -> DataFrame:
        return df.where(F.col("product_id").isNotNull()).select(
            *by,
            F.col("product_id").alias("_key"),
            score.alias("score"),
            F.lit(number).alias("side"),
        )

    rows = side(segments, F.col("z_score"), 0).unionByName(
        side(detail, _recomputed(fact), 1)
    )
    groups = rows.groupBy(*by, "_key").agg(
        *_score_sizes(F.col("score"), F.col("side") == 0, F.col("side") == 1)
    )
    return _settled(rows, groups, fact, by)


def _score_facts(detail: DataFrame) -> Column:
    return statistics(detail).select(F.struct("mean", "stddev", "valid").alias("fact")).scalar()


def _recomputed(fact: Column) -> Column:
    return (F.col("price") - fact["mean"]) / F.nullif(fact["stddev"], F.lit(0.0))


def _score_sizes(score: Column, stored: Column, expected: Column) -> list[Column]:
    """Sizes and ends of a group of stored and of recomputed scores."""
    finite = is_finite(score)
    usable, known = stored & finite, expected & score.isNotNull()
    return [
        F.count_if(usable).alias("s"),
        F.count_if(stored & ~finite).alias("unusable"),
        F.count_if(known).alias("e"),
        F.count_if(expected).alias("all"),
        F.min(F.when(usable, score)).alias("z"),
        F.max(F.when(usable, score)).alias("z_max"),
        F.min(F.when(known, score)).alias("expected"),
        F.max(F.when(known, score)).alias("expected_max"),
    ]


def _several() -> Column:
    return (F.col("z") != F.col("z_max")) | (F.col("expected") != F.col("expected_max"))


def _settled_pairs() -> Column:
    """Wrong pairs of a key; those of a key with several values as if none agreed."""
    agree = F.abs(F.col("z") - F.col("expected")) <= F.lit(fv.Z_TOLERANCE)
    settled = F.when(~_several() & agree, F.lit(0).cast(_PAIRS)).otherwise(_product("s", "e"))
    return settled + _product("unusable", "all")


def _settled(rows: DataFrame, groups: DataFrame, fact: Column, by: Sequence[str]) -> DataFrame:
    """``wrong`` and ``valid`` from the groups of scores and the scores themselves."""
    close = _close_pairs(rows, groups.where(_several()).select(*by, "_key"), by)
    none = F.lit(0).cast(_PAIRS)
    totals = groups.groupBy(*by).agg(F.coalesce(F.sum(_settled_pairs()), none).alias("wrong"))
    if by:
        totals = totals.join(F.broadcast(close), list(by), "left")
        found = F.coalesce("close", none)
    else:
        found = close.scalar()
    return totals.select(
        *by,
        _as_count(F.when(fact["valid"], F.col("wrong") - found)).alias("wrong"),
        fact["valid"].alias("valid"),
    )


def _close_pairs(rows: DataFrame, keys: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pairs within the tolerance, of the keys that have several values.

    Copies of a value collapse first.  Within one key and one cell, much wider than the
    tolerance, all values stand in order; a stored score counts the recomputed ones up
    to its upper end less those below its lower end, so running sums do and no pair is
    built.  A recomputed score enters the next cell too when it lies at the edge.
    """
    edge = F.lit(fv.Z_TOLERANCE)

    def cell(score: Column) -> Column:
        return F.floor(score / F.lit(_CELL))

    copies = (
        rows.where(is_finite(F.col("score"))).join(keys, [*by, "_key"], "left_semi")
        .groupBy(*by, "_key", "side", "score").agg(F.count(F.lit(1)).alias("n"))
    )
    score = F.col("score")

    def event(place: Column, order: int, known: Column, probe: Column) -> Column:
        return F.struct(
            place.alias("place"), F.lit(order).alias("order"),
            known.cast("bigint").alias("known"), probe.cast("bigint").alias("probe"),
        )

    n, none = F.col("n"), F.lit(0)
    probes = copies.where("side = 0").select(
        *by, "_key", cell(score).alias("cell"),
        F.explode(
            F.array(event(score - edge, 0, none, -n), event(score + edge, 2, none, n))
        ).alias("at"),
    )
    values = copies.where("side = 1").select(
        *by, "_key",
        F.explode(F.array_distinct(F.array(cell(score - edge), cell(score + edge)))).alias(
            "cell"
        ),
        event(score, 1, n, none).alias("at"),
    )
    in_order = Window.partitionBy(*by, "_key", "cell").orderBy("at.place", "at.order")
    passed = (
        probes.unionByName(values).select(*by, "_key", "cell", "at.*", F.col("at").alias("at"))
        .withColumn("below", F.sum("known").over(
            in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ))
    )
    return passed.groupBy(*by).agg(
        F.coalesce(F.sum(_product("probe", "below")), F.lit(0).cast(_PAIRS)).alias("close")
    )


#: What ``product_profile`` measures of a table it is not given: no rows.
_PAYLOAD = {"id_web": "string", "price": "double", "total_sales": "bigint", "revenue": "double"}


def product_profile(
    revenue: Column,
    merged: DataFrame | None = None,
    detail: DataFrame | None = None,
    segments: DataFrame | None = None,
) -> DataFrame:
    """Everything the checks want to know of the tables by product, in one row.

    Each table is read once and grouped once: rows of all of them meet in one accumulator
    for each value that is compared, then for each key, instead of in a grouping for each
    check.  ``merged_``, ``detail_`` and ``segments_`` begin ``rows``, ``repeated`` and
    ``invalid``; the others are ``premium_count``, ``ordinary_count``, both kinds of
    ``mismatches``, and ``wrong`` and ``valid`` for the scores.
    """
    fact = None if detail is None or segments is None else _score_facts(detail)
    none, zero = F.lit(None), F.lit(False)

    def side(df: DataFrame | None, name: str, invalid: Column, score: Column) -> DataFrame | None:
        if df is None:
            return None
        values = {c: F.col(c) if c in df.columns else revenue for c in _PAYLOAD}
        category = F.col("category") if name == "segments" else none.cast("string")
        return df.select(
            F.col("product_id").alias("_key"),
            *(v.cast(_PAYLOAD[c]).alias(c) for c, v in values.items()),
            F.lit(name).alias("side"),
            F.coalesce(invalid, zero).alias("invalid"),
            category.alias("category"),
            score.cast("double").alias("score"),
        )

    sides = (
        side(merged, "merged", invalid_merged(), none),
        side(detail, "detail", zero, none if fact is None else _recomputed(fact)),
        side(segments, "segments", zero if segments is None else invalid_label(),
             F.col("z_score") if segments is not None else none),
    )
    rows = reduce(DataFrame.unionByName, [df for df in sides if df is not None])

    def of(name: str) -> Column:
        return F.col("side") == name

    # Rows of null keys take no part in the scores.
    scored = F.when(F.col("_key").isNotNull(), F.col("score"))
    stored, expected = (of(n) & F.col("_key").isNotNull() for n in ("segments", "detail"))
    counted = {
        **{f"{n}_rows": of(n) for n in ("merged", "detail", "segments")},
        **{f"{n}_invalid": of(n) & F.col("invalid") for n in ("merged", "segments")},
        "premium_count": F.col("category") == fv.PREMIUM,
        "ordinary_count": F.col("category") == fv.ORDINARY,
    }
    ends = {"z": F.min, "z_max": F.max, "expected": F.min, "expected_max": F.max}
    sizes = ("s", "unusable", "e", "all")

    def merged_up(extra: Sequence[Column] = ()) -> list[Column]:
        return [
            *(F.sum(c).alias(c) for c in (*counted, *sizes)),
            *(best(c).alias(c) for c, best in ends.items()), *extra,
        ]

    valid = is_finite(F.col("revenue"))
    by_value = rows.groupBy("_key", *_PAYLOAD).agg(
        *(F.count_if(flag).alias(c) for c, flag in counted.items()),
        *_score_sizes(scored, stored, expected),
    )
    by_source = by_value.groupBy("_key", "price", "id_web").agg(*merged_up([
        F.sum(F.when(valid, _product("merged_rows", "detail_rows")).otherwise(F.lit(0)))
        .alias("revenue_agree"),
    ]))
    by_key = by_source.groupBy("_key").agg(*merged_up([
        F.sum("revenue_agree").alias("revenue_agree"),
        F.sum(_product("detail_rows", "segments_rows")).alias("segment_agree"),
    ]))
    known = F.col("_key").isNotNull()
    nothing = F.lit(0).cast(_PAIRS)
    totals = by_key.agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted),
        F.count_if((F.col("merged_rows") > 1) & known).alias("merged_repeated"),
        F.count_if(F.col("detail_rows") > 1).alias("detail_repeated"),
        F.count_if(F.col("segments_rows") > 1).alias("segments_repeated"),
        _as_count(F.sum(_differing("merged_rows", "detail_rows", "revenue_agree")))
        .alias("revenue_mismatches"),
        _as_count(F.sum(_differing("detail_rows", "segments_rows", "segment_agree")))
        .alias("segment_mismatches"),
        F.coalesce(F.sum(F.when(known, _settled_pairs())), nothing).alias("_wrong"),
    )
    if fact is None:
        return totals.drop("_wrong")
    scores = rows.where(known & (F.col("side") != "merged")).select(
        "_key", "score", (F.col("side") == "detail").cast("int").alias("side")
    )
    ranges = scores.groupBy("_key").agg(
        *_score_sizes(F.col("score"), F.col("side") == 0, F.col("side") == 1)
    )
    close = _close_pairs(scores, ranges.where(_several()).select("_key")).scalar()
    return totals.withColumns({
        "wrong": _as_count(F.when(fact["valid"], F.col("_wrong") - close)),
        "valid": fact["valid"],
    }).drop("_wrong")


def revenue_totals(
    merged: DataFrame, detail: DataFrame, summary: DataFrame
) -> DataFrame:
    """Totals of the revenue tables and of their source, side by side in one row."""
    stated = summary.agg(
        F.count(F.lit(1)).alias("summary_rows"),
        F.min("product_count").alias("product_count"),
        F.min("bottles_sold").alias("bottles_sold"),
        F.min("total_revenue").alias("total_revenue"),
    )
    source = merged.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.sum("total_sales").alias("units")
        ).alias("source")
    ).scalar()
    single = F.col("summary_rows") == 1
    return stated.select(
        "summary_rows",
        *(
            F.when(single, F.col(name)).alias(name)
            for name in ("product_count", "bottles_sold", "total_revenue")
        ),
        detail.agg(exact_sum(F.col("revenue"))).scalar().alias("detail_revenue"),
        source["n"].alias("source_products"),
        source["units"].alias("source_units"),
    )
