"""Groups of near-duplicate texts: similarity sketches, banding, exact verification.

Texts of equal words are one node from the start.  Nodes whose sketches agree in a band
share a bucket.  Links are confirmed on full shingle sets, in two steps: first every node
against one centre of its largest bucket, which settles a group of copies in one pass
over its nodes; then, within buckets that still hold several groups, every node against
those of other groups.  Small buckets give pairs; large ones are compared block by block,
so that a task holds two blocks and gives out one link per pair of groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.arrays import NOT_BLANK, Words
from ledgerlink.llm.sketch import Sketcher, common
from ledgerlink.llm.support import (
    Scratch,
    batches_of,
    components,
    maybe_listed,
    packed,
    slices,
    unpacked,
    utf8,
    wider,
)

WORDS, PERCENT = 5, 85
#: A link of 0.85 is missed with a probability below 1e-6: (1 - 0.85 ** 5) ** 24.
BANDS, ROWS = 24, 5
#: Buckets of up to so many nodes give pairs; larger ones are cut into blocks.
SMALL, BLOCK = 16, 256
#: Elements of the sets of two blocks that are compared at once, and rows with two sets
#: that a task is handed at once: sets of long texts have tens of thousands of elements.
_RANGE, _PAIRS = 500_000, 128


def shingle_sets(texts: list[bytes], width: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words of each text.

    A-Z count as lower case; words end at blanks and \\x09 to \\x0D.  A text of fewer
    words is one shingle, one without words has none.
    """
    words = Words(texts, NOT_BLANK)
    by_width = {width: words.window_hashes(width)}
    sets = []
    for i in range(len(texts)):
        lo, n = words.first[i], words.first[i + 1] - words.first[i]
        k = min(int(n), width)
        if k and k not in by_width:
            by_width[k] = words.window_hashes(k)
        sets.append(
            np.unique(by_width[k][lo : lo + n - k + 1]) if k else np.empty(0, np.uint64)
        )
    return sets


def node_of(text: bytes) -> bytes | None:
    """What texts of equal words share; None without words."""
    words = text.lower().split()
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


def _sketch_task(bands: int, rows: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(bands, rows)
        for batch in batches:
            for part in slices(batch, 1):
                texts = utf8(part.column(1))
                nodes = [node_of(t) for t in texts]
                sets = shingle_sets(texts, width)
                some = [i for i, s in enumerate(sets) if len(s)]
                found = sketcher.band_hashes([sets[i] for i in some])
                lists: list[np.ndarray | None] = [None] * len(texts)
                for i, h in zip(some, found, strict=True):
                    lists[i] = h
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(nodes, pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
                    ["_id", "n", "node", "bands"],
                )

    return run


def _set_task(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                texts = utf8(part.column(0))
                sets = shingle_sets(texts, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(t) for t in texts], pa.binary()),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["node", "elements"],
                )

    return run


def _verify_task(percent: int):
    """Tasks that keep the pairs whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                good = []
                for a, b in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                    small, large = sorted((len(a), len(b)))
                    both = common(a, b) if 100 * small >= percent * large else 0
                    good.append(100 * both >= percent * (len(a) + len(b) - both))
                keep = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).filter(keep), part.column(1).filter(keep)], ["u", "v"]
                )

    return run


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``left`` shares with each of ``right``.

    Elements on both sides become columns of two 0/1 matrices, whose product is the count.
    The sorted sets are worked through range by range, so that long sets need no more
    memory than short ones.
    """
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    total = sum(map(len, left)) + sum(map(len, right))
    ranges = 1 << max(0, (total // _RANGE).bit_length())
    bounds = [np.uint64(i * (2**64 // ranges)) for i in range(ranges)]
    cuts = [[np.append(np.searchsorted(s, bounds), len(s)) for s in side]
            for side in (left, right)]
    for i in range(ranges):
        parts = [[s[c[i] : c[i + 1]] for s, c in zip(side, at, strict=True)]
                 for side, at in zip((left, right), cuts, strict=True)]
        _add_shared(out, *parts)
    return out


def _add_shared(out: np.ndarray, left: list[np.ndarray], right: list[np.ndarray]) -> None:
    a, b = np.concatenate(left), np.concatenate(right)
    known = np.intersect1d(a, b)
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    at = [np.searchsorted(known, x) for x in (a, b)]
    for i, x in enumerate((a, b)):
        inside = at[i] < len(known)
        inside[inside] = known[at[i][inside]] == x[inside]
        rows[i], at[i] = rows[i][inside], at[i][inside]
    for low in range(0, len(known), 8192):
        size = min(8192, len(known) - low)
        parts = []
        for i, n in enumerate((len(left), len(right))):
            here = (at[i] >= low) & (at[i] < low + size)
            m = np.zeros((n, size), dtype=np.float32)
            m[rows[i][here], at[i][here] - low] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T


def _spanning(links: np.ndarray, left: list, right: list) -> list[tuple]:
    """Of the links between groups those that connect what was not connected yet."""
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for i, j in links.tolist():
        a, b = find(left[i]), find(right[j])
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append((left[i], right[j]))
    return kept


def _block_task(percent: int):
    """Links between groups, for two blocks of a bucket; fewer than there are groups."""

    def run(table: pa.Table) -> pa.Table:
        query = np.array(table.column("query").to_pylist(), dtype=bool)
        group = table.column("group").to_pylist()
        elements = [np.frombuffer(e.as_buffer(), np.uint64) for e in table.column("elements")]
        left, right = np.flatnonzero(query), np.flatnonzero(~query)
        kept = []
        if len(left) and len(right):
            both = shared_counts([elements[i] for i in left], [elements[j] for j in right])
            size = np.array([len(e) for e in elements], dtype=np.float32)
            union = size[left][:, None] + size[right][None, :] - both
            kept = _spanning(
                np.argwhere(100 * both >= percent * union),
                [group[i] for i in left], [group[j] for j in right],
            )
        return pa.table({"u": pa.array([k[0] for k in kept], pa.binary()),
                         "v": pa.array([k[1] for k in kept], pa.binary())})

    return run


def _similar_sizes(percent: int) -> Column:
    """Whether sets of ``n`` and ``other_n`` elements can be similar enough at all."""
    return F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * percent


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links among ``pairs``, a written table, so that its size is known to the plan.

    Where sets are shuffled, both joins read one exchange.
    """
    a = sets.select(F.col("node").alias("u"), F.col("elements").alias("eu"))
    b = sets.select(F.col("node").alias("v"), F.col("elements").alias("ev"))
    return (
        pairs.join(a, "u").join(b, "v").select("u", "v", "eu", "ev")
        .mapInArrow(_verify_task(percent), "u binary, v binary")
    )


def _groups(scratch: Scratch, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node`` and ``label``: which nodes confirmed links connect; others are missing.

    The first step's groups are the nodes of the second step's links.
    """
    centres = members.groupBy("band").agg(
        F.min(F.struct(F.xxhash64("node", "band").alias("k"), "node", "n")).alias("centre")
    ).select("band", F.col("centre.node").alias("v"), F.col("centre.n").alias("other_n"))
    stars = scratch.store(
        members.join(centres, "band").where((F.col("node") != F.col("v")) & _similar_sizes(percent))
        .groupBy(F.col("node").alias("u"))
        .agg(F.max(F.struct("size", "v")).getField("v").alias("v"))
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    )
    groups = components(scratch, scratch.store(_verified(stars, sets, percent)))
    placed = members.join(groups, "node", "left").select(
        "band", "node", "size", "n", F.coalesce("label", "node").alias("group")
    )
    several = placed.groupBy("band").agg(
        F.min("group").alias("least"), F.max("group").alias("most")
    ).where("least <> most").select("band")
    open_members = scratch.store(placed.join(several, "band"))

    small = open_members.where(F.col("size") <= SMALL)
    other = small.select(
        "band", F.col("node").alias("v"), F.col("group").alias("other"),
        F.col("n").alias("other_n"),
    )
    pairs = scratch.store(
        small.select("band", F.col("node").alias("u"), "group", "n").join(other, "band")
        .where(F.expr("u < v AND group <> other") & _similar_sizes(percent))
        .select("u", "v").distinct()
        .join(stars, ["u", "v"], "left_anti")
    )
    of = groups.select("node", "label")
    second = (
        _verified(pairs, sets, percent)
        .join(of.withColumnRenamed("node", "u"), "u", "left")
        .select(F.coalesce("label", "u").alias("u"), "v")
        .join(of.withColumnRenamed("node", "v"), "v", "left")
        .select("u", F.coalesce("label", "v").alias("v"))
    )

    # In a large bucket the largest group is the hub: its nodes are not compared with
    # each other, only the nodes of other groups with all.
    large = open_members.where(F.col("size") > SMALL)
    counts = large.groupBy("band", "group").agg(F.count(F.lit(1)).alias("n"))
    hubs = counts.groupBy("band").agg(
        F.max(F.struct("n", "group")).getField("group").alias("hub"),
        (F.sum("n") - F.max("n")).alias("others"), F.sum("n").alias("all"),
    )
    blocks = large.join(hubs, "band").select(
        "band", "node", "group", (F.col("group") == F.col("hub")).alias("in_hub"),
        F.ceil(F.col("others") / BLOCK).cast("int").alias("rows"),
        F.ceil(F.col("all") / BLOCK).cast("int").alias("columns"),
        F.xxhash64("node", F.lit(7)).alias("h"),
    )
    queries = blocks.where("NOT in_hub").select(
        "band", F.expr("CAST(pmod(h, rows) AS INT)").alias("row"),
        F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"),
        F.lit(True).alias("query"), "node", "group",
    )
    targets = blocks.select(
        "band", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"),
        F.expr("CAST(pmod(h, columns) AS INT)").alias("column"),
        F.lit(False).alias("query"), "node", "group",
    )
    third = (
        queries.unionByName(targets).join(sets, "node").groupBy("band", "row", "column")
        .applyInArrow(_block_task(percent), "u binary, v binary")
    )
    merged = components(scratch, second.unionByName(third))
    known = merged.select(F.col("node").alias("label"), F.col("label").alias("most"))
    return (
        groups.unionByName(merged.select("node", F.col("node").alias("label")))
        .distinct().join(known, "label", "left")
        .select("node", F.coalesce("most", "label").alias("label"))
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    width: int = WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """For each row: its id, ``node``, ``n_shingles``, ``component_id`` and ``kept``.

    Two texts are linked if they share at least ``percent`` hundredths of their distinct
    shingles of ``width`` words; ``component_id`` is the smallest id reachable by links,
    and a row is kept if that is its own id.  Texts that are null or without words have
    no node and no links.  Null ids count for no smallest id; a row of null id is kept if
    all rows it is linked with have null ids.  Repeated rows are linked copies; of rows
    that agree in id and words all are kept or none.  Other columns are not read; no rows
    give no rows.
    """
    return _near_duplicates(
        Scratch(docs.sparkSession, "near"), docs, id_col, text_col, percent, width, bands, rows
    )


def _near_duplicates(
    scratch: Scratch,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    width: int = WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``near_duplicates`` with tables in ``scratch``; those of the search are deleted."""
    search = Scratch(docs.sparkSession, "near-search")
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = wider(slim.select("_id"), "n long, node binary, bands array<long>")
    sketched = search.store(slim.mapInArrow(_sketch_task(bands, rows, width), schema))
    rows_of = scratch.store(sketched.select("_id", "n", "node"))
    ids = rows_of.where("node IS NOT NULL").groupBy("node").agg(F.min("_id").alias("first"))
    banded = (
        sketched.where("node IS NOT NULL").groupBy("node")
        .agg(F.first("bands").alias("bands"), F.first("n").alias("n"))
        .select("node", "n", F.explode("bands").alias("band"))
    )
    # Counting n, which is never null, both sides need the same columns: one shuffle.
    shared = banded.groupBy("band").agg(F.count("n").alias("size")).where("size > 1")
    members = search.store(banded.join(shared, "band"))
    wanted = search.store(members.select("node").distinct())
    wanted_ids = search.store(
        wanted.join(ids, "node").select(F.col("first").alias("_wanted")).distinct()
    )
    sets = (
        slim.join(wanted_ids, F.col("_id").eqNullSafe(F.col("_wanted")), "left_semi")
        .select("_text").mapInArrow(_set_task(width), "node binary, elements binary")
    )
    # Where no id repeats, one row of each node was wanted, and sets need no shuffle.
    if not rows_of.groupBy("_id").count().where("count > 1").isEmpty():
        sets = sets.join(wanted, "node", "left_semi").dropDuplicates(["node"])
    with batches_of(docs.sparkSession, _PAIRS):
        groups = scratch.store(_groups(search, members, search.store(sets), percent))
    search.drop()
    smallest = (
        groups.join(ids, "node").groupBy("label").agg(F.min("first").alias("component_id"))
    )
    by_node = ids.join(groups.join(smallest, "label"), "node", "left").select(
        "node", F.coalesce("component_id", "first").alias("component_id")
    )
    found = rows_of.join(by_node, "node", "left").select(
        F.col("_id").alias(id_col), "node", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("_id")).otherwise(F.col("component_id"))
        .alias("component_id"),
    )
    return found.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _node_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            nodes = pa.array([node_of(t) for t in utf8(part.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*part.columns, nodes], [*part.schema.names, "_node"]
            )


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters: int
) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, that of the smallest id.

    Rows without words all stay.  Of rows that agree in id and words one stays.  Only rows
    whose id a bitmap knows, as dropped or repeated, are shuffled to meet the list.
    """
    search = Scratch(docs.sparkSession, "near")
    dropped = (
        _near_duplicates(search, docs, id_col, text_col, **parameters)
        .where("NOT kept").select(F.col(id_col).alias("_gone"), F.col("node").alias("_other"))
    )
    found = Scratch(docs.sparkSession, "kept").store(dropped.distinct())
    search.drop()
    repeated = Scratch(docs.sparkSession, "repeated").store(
        docs.groupBy(F.col(id_col).alias("_gone")).count().where("count > 1").select("_gone")
    )
    rows = packed(docs, text_col)
    key = F.col("_row").getField(f"c{docs.columns.index(id_col)}")
    named = found.select("_gone").unionByName(repeated)
    listed, others = maybe_listed(rows, F.xxhash64(key), named, F.xxhash64("_gone"))
    noded = listed.mapInArrow(_node_task, wider(rows, "_node binary")).withColumn("_id", key)
    kept = noded.join(
        found, F.col("_id").eqNullSafe(F.col("_gone")) & (F.col("_node") == F.col("_other")),
        "left_anti",
    )
    if not repeated.isEmpty():
        blank = kept.where("_node IS NULL")
        kept = kept.where("_node IS NOT NULL").dropDuplicates(["_id", "_node"]).unionByName(blank)
    return kept.select(*rows.columns).unionByName(others).select(*unpacked(docs.columns, text_col))
