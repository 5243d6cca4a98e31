"""Passages that documents share: count-min sketches of windows, then exact grouping.

A window is a run of words.  Each partition sketches its windows; merged, the sketches
say of every window how often it occurs at most.  Only windows whose estimate is above
one are grouped exactly, by 128-bit hashes, so none that repeats is lost.

A sketch counts windows by their anchors: the anchor of a window is the run of
``ANCHOR`` words in it whose hash is smallest.  Equal windows have equal anchors, at
equal distances from their starts, so the count of an anchor's places is no less than
that of any window it stands for, while neighbours mostly share a place: six windows
take one counter.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.arrays import NOT_BLANK, Words, odd_numbers
from ledgerlink.llm.sketch import mix
from ledgerlink.llm.support import (
    Scratch,
    maybe_listed,
    packed,
    slices,
    unpacked,
    utf8,
    wider,
)

WINDOW, ANCHOR = 20, 10
#: Counters of each row of the sketch are 2 ** COUNTER_BITS, in blocks.  A bit of each
#: is broadcast: 64 MB for two rows, whatever the number of documents.
COUNTER_BITS, ROWS = 28, 2
_BLOCK_BITS = 20
#: Places that a task gathers before it gives out their counts.
_GATHERED = 1_000_000
_OUT_ROWS = 65_536


class Windows:
    """The windows of a batch of texts: where they start, and their anchors."""

    def __init__(self, texts: list[bytes], window: int, anchor: int) -> None:
        self.words = Words(texts, NOT_BLANK, lower=False)
        self.window = window
        starts = np.arange(max(0, len(self.words.starts) - window + 1))
        self.text_of = np.searchsorted(self.words.first, starts, side="right") - 1
        whole = starts + window <= self.words.first[self.text_of + 1]
        self.starts, self.text_of = starts[whole], self.text_of[whole]
        anchors = self.words.window_hashes(anchor)
        n = len(starts)
        best, at = anchors[:n].copy(), np.zeros(n, dtype=np.int8)
        for j in range(1, window - anchor + 1):
            other = anchors[j : j + n]
            less = other < best
            best[less], at[less] = other[less], j
        self.anchors, self.places = best[whole], self.starts + at[whole]

    def anchor_places(self) -> np.ndarray:
        """The hash of each place that is an anchor of any window, once."""
        first = np.ones(len(self.places), dtype=bool)
        first[1:] = self.places[1:] != self.places[:-1]
        return self.anchors[first]

    def repeated(self, hot: Hot) -> np.ndarray:
        """Which windows occur more than once by the sketch."""
        first = np.ones(len(self.places), dtype=bool)
        first[1:] = self.places[1:] != self.places[:-1]
        return hot.holds(self.anchors[first])[np.cumsum(first) - 1]

    def hashes(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of the words of some windows."""
        starts = self.starts[which]
        words = self.words.hashes
        again = mix(words ^ np.uint64(0x9E3779B97F4A7C15))
        a = np.zeros(len(starts), dtype=np.uint64)
        b = np.ones(len(starts), dtype=np.uint64)
        for i, (x, y) in enumerate(zip(odd_numbers(self.window, 2), odd_numbers(self.window, 3),
                                       strict=True)):
            a += words[starts + i] * x
            b += again[starts + i] * y
        return mix(a).view(np.int64), mix(b).view(np.int64)


def counters(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The counter of each hash in a row of the sketch."""
    seeded = mix(hashes ^ odd_numbers(row + 1, 4)[row])
    return (seeded >> np.uint64(64 - bits)).astype(np.int64)


class Hot:
    """The bits of a merged sketch, row by row: which counters are above one."""

    def __init__(self, packed_bits: bytes, bits: int) -> None:
        self.bits = bits
        self.rows = np.frombuffer(packed_bits, dtype=np.uint8).reshape(ROWS, -1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), dtype=bool)
        for i, row in enumerate(self.rows):
            at = counters(hashes, i, self.bits)
            out &= (row[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        return out


def _counted(hashes: np.ndarray, bits: int, block_bits: int) -> pa.RecordBatch:
    """Sketch of some places: of each block the counters hit, and those hit repeatedly."""
    out = []
    for row in range(ROWS):
        at, n = np.unique(counters(hashes, row, bits), return_counts=True)
        block = at >> block_bits
        cuts = np.flatnonzero(np.diff(block, prepend=-1))
        for lo, hi in zip(cuts, np.append(cuts[1:], len(at)), strict=True):
            here = (at[lo:hi] & ((1 << block_bits) - 1)).astype(np.uint32)
            out.append((row, int(block[lo]), _coded(here), _coded(here[n[lo:hi] > 1])))
    columns = list(zip(*out, strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(
            columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
        ["row", "block", "hit", "again"],
    )


def _coded(sorted_numbers: np.ndarray) -> bytes:
    """Distinct ascending numbers as 16-bit steps; 65535 is a step without a number."""
    steps = np.diff(sorted_numbers.astype(np.int64), prepend=0)
    empty = steps // 65535
    out = np.full(len(steps) + int(empty.sum()), 65535, dtype="<u2")
    out[np.cumsum(empty + 1) - 1] = steps % 65535
    return out.tobytes()


def _decoded(coded: bytes) -> np.ndarray:
    steps = np.frombuffer(coded, dtype="<u2")
    return np.cumsum(steps, dtype=np.int64)[steps != 65535]


def _sketch_task(window: int, anchor: int, bits: int, block_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, 0):
                held.append(Windows(utf8(part.column(0)), window, anchor).anchor_places())
                size += len(held[-1])
                if size > _GATHERED:
                    yield _counted(np.concatenate(held), bits, block_bits)
                    held, size = [], 0
        if size:
            yield _counted(np.concatenate(held), bits, block_bits)

    return run


def _merge_task(block_bits: int):
    """Tasks that add up sketches that come by row and block, a block at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, current = np.zeros(1 << block_bits, dtype=np.uint8), None
        for batch in batches:
            done = []
            for row, block, hit, again in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if current != (row, block):
                    if current is not None:
                        done.append((*current, np.packbits(counts > 1, bitorder="little")))
                    current = row, block
                    counts[:] = 0
                at = _decoded(hit)
                counts[at] = np.minimum(counts[at] + 1, 2)
                counts[_decoded(again)] = 2
            yield _blocks(done)
        if current is not None:
            yield _blocks([(*current, np.packbits(counts > 1, bitorder="little"))])

    return run


def _blocks(done: list[tuple]) -> pa.RecordBatch:
    done = [(row, block, bits.tobytes()) for row, block, bits in done if bits.any()]
    columns = list(zip(*done, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in
         zip(columns, (pa.int32(), pa.int32(), pa.binary()), strict=True)],
        ["row", "block", "hot"],
    )


def _candidate_task(shared, bits: int, window: int, anchor: int):
    """Tasks that give out the windows that may repeat, and, at place -1 and under a hash
    of its own, each document that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = Hot(shared.value, bits)
        for batch in batches:
            for part in slices(batch, 2):
                found = Windows(utf8(part.column(2)), window, anchor)
                which = np.flatnonzero(found.repeated(hot))
                a, b = found.hashes(which)
                of = found.text_of[which]
                place = found.starts[which] - found.words.first[of]
                marked = np.unique(of)
                ids = [c.take(pa.array(marked)).to_pylist() for c in part.columns[:2]]
                marks = np.array(
                    [np.frombuffer(hashlib.blake2b(repr(i).encode(), digest_size=16).digest(),
                                   np.int64) for i in zip(*ids, strict=True)], dtype=np.int64
                ).reshape(-1, 2)
                a, b = np.append(a, marks[:, 0]), np.append(b, marks[:, 1])
                of = np.append(of, marked)
                place = np.append(place, np.full(len(marked), -1))
                for lo in range(0, len(a), _OUT_ROWS):
                    hi = lo + _OUT_ROWS
                    yield pa.RecordBatch.from_arrays(
                        [*(c.take(pa.array(of[lo:hi])) for c in part.columns[:2]),
                         pa.array(a[lo:hi]), pa.array(b[lo:hi]), pa.array(place[lo:hi])],
                        ["id", "version", "a", "b", "place"],
                    )

    return run


def _cut_task(shared, bits: int, window: int, anchor: int):
    """Tasks that take the windows out that may repeat and are not the first of theirs;
    ``_firsts`` lists those that are, and is null where no window may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                texts, firsts = utf8(part.column(1)), part.column(2)
                known = part.column(1).is_valid().to_pylist()
                split = [t.split() for t in texts]
                n_words = np.array([len(w) for w in split], dtype=np.int64)
                covered: dict[int, np.ndarray] = {}
                listed = [i for i, ok in enumerate(firsts.is_valid().to_pylist()) if ok]
                if listed:
                    covered = _covered(
                        [texts[i] for i in listed],
                        [firsts[i].values.to_numpy(zero_copy_only=False) for i in listed],
                        Hot(shared.value, bits), window, anchor,
                    )
                    covered = {listed[i]: c for i, c in covered.items()}
                kept, removed = [], np.zeros(len(texts), dtype=np.int64)
                for i, words in enumerate(split):
                    if i in covered:
                        removed[i] = covered[i].sum()
                        words = itertools.compress(words, (~covered[i]).tolist())
                    kept.append(b" ".join(words).decode() if known[i] else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words), pa.array(removed),
                     pa.array(kept, pa.string())],
                    ["_row", "n_words", "n_removed", "kept"],
                )

    return run


def _covered(
    texts: list[bytes], firsts: list[np.ndarray], hot: Hot, window: int, anchor: int
) -> dict[int, np.ndarray]:
    """For texts with anything to remove: which of their words are to go."""
    found = Windows(texts, window, anchor)
    first_word = found.words.first
    keep = np.concatenate([f[f >= 0] + first_word[i] for i, f in enumerate(firsts)])
    gone = np.zeros(len(found.words.starts) + 1, dtype=bool)
    gone[found.starts[found.repeated(hot)]] = True
    gone[keep.astype(np.int64)] = False
    change = np.zeros(len(gone) + window, dtype=np.int32)
    at = np.flatnonzero(gone)
    change[at] += 1
    change[at + window] -= 1
    inside = np.cumsum(change) > 0
    out = {}
    for i in range(len(texts)):
        here = inside[first_word[i] : first_word[i + 1]]
        if here.any():
            out[i] = here
    return out


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    counter_bits: int = COUNTER_BITS,
) -> DataFrame:
    """For each row: it with the kept text as ``row``, ``n_words``, ``n_removed``, ``kept``.

    Words end at blanks and \\x09 to \\x0D.  A word is removed if it is inside a window
    of ``window`` words whose word sequence also starts earlier: in a row of smaller id,
    or in the same row at a smaller word number.  ``kept`` has the other words,
    joined by one blank.

    Null and empty texts have no words and stay as they are; texts of fewer words than
    ``window`` lose none.  Rows of equal id are ordered by a hash of their text, and those
    of equal text too are one document: repeated rows are treated alike and don't remove
    each other.  Null ids come after all others.  No rows give no rows.  Of ``2 ** counter_bits`` counters
    a bit each is broadcast; with more distinct places than counters more windows are
    grouped than need be, and the result stays the same.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    block_bits = min(_BLOCK_BITS, counter_bits)
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    # Where no id repeats, which is the rule, ids alone name the documents.
    repeated = not docs.groupBy(id_).count().where("count > 1").isEmpty()
    version = F.xxhash64(text) if repeated else F.lit(0).cast("long")
    slim = docs.select(id_.alias("id"), version.alias("version"), text.alias("_text"))
    blocks = (
        slim.select("_text").mapInArrow(
            _sketch_task(window, anchor, counter_bits, block_bits),
            "row int, block int, hit binary, again binary")
        .repartition("row", "block").sortWithinPartitions("row", "block")
        .mapInArrow(_merge_task(block_bits), "row int, block int, hot binary").collect()
    )
    hot = bytearray(ROWS << max(0, counter_bits - 3))
    for found in blocks:
        at = (found["row"] << counter_bits) + (found["block"] << block_bits) >> 3
        hot[at : at + len(found["hot"])] = found["hot"]
    shared = spark.sparkContext.broadcast(bytes(hot))
    rows = packed(docs, text_col)
    firsts = (
        slim.mapInArrow(_candidate_task(shared, counter_bits, window, anchor),
                        wider(slim.select("id", "version"), "a long, b long, place long"))
        .groupBy("a", "b")
        .agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "version", "place"))
             .alias("first"))
        .groupBy(F.col("first.id").alias("_of"), F.col("first.version").alias("_in"))
        .agg(F.collect_list("first.place").alias("_firsts"))
    )
    firsts = scratch.store(firsts)
    id_of = F.col("_row").getField(f"c{docs.columns.index(id_col)}")
    version_of = F.xxhash64("_text") if repeated else F.lit(0).cast("long")
    hits, others = maybe_listed(
        rows, F.xxhash64(id_of, version_of), firsts, F.xxhash64("_of", "_in")
    )
    listed = hits.join(
        firsts, id_of.eqNullSafe(F.col("_of")) & (version_of == F.col("_in")), "left"
    ).select("_row", "_text", "_firsts")
    none = others.select("_row", "_text", F.lit(None).cast("array<long>").alias("_firsts"))
    more = wider(rows.select("_row"), "n_words long, n_removed long, kept string")
    found = listed.unionByName(none).mapInArrow(_cut_task(shared, counter_bits, window, anchor), more)
    columns = unpacked(docs.columns, text_col, "kept")
    return found.select(F.struct(*columns).alias("row"), "n_words", "n_removed", "kept")
