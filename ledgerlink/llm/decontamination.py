"""Passages of a benchmark in documents, by hashed windows of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.arrays import ALPHANUMERIC, Words, runs
from ledgerlink.llm.support import Scratch, packed, slices, unpacked, utf8, wider

WIDTH = 10
#: Windows that are broadcast at most; those of a larger benchmark are joined by hash.
BROADCAST_WINDOWS = 300_000
#: Bits of a hash by which windows of documents are left out before that join.
_BITS = 27

_WINDOWS = "width int, hash long, words string, items array<string>"


def _window_rows(width: int):
    """Tasks that list the windows of items: width, hash, words and the item's id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                ids, words = part.column(0).to_pylist(), Words(utf8(part.column(1)), ALPHANUMERIC)
                out = []
                for i, item in enumerate(ids):
                    lo, hi = int(words.first[i]), int(words.first[i + 1])
                    k = min(width, hi - lo)
                    if item is None or k == 0:
                        continue
                    text = [words.bytes_of(j).decode() for j in range(lo, hi)]
                    hashes = words.window_hashes(k)
                    for j in range(hi - lo - k + 1):
                        out.append((k, int(hashes[lo + j].view(np.int64)),
                                    " ".join(text[j : j + k]), item))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True),
                         (pa.int32(), pa.int64(), pa.string(), pa.string()), strict=True)],
                        ["width", "hash", "words", "item"],
                    )

    return run


def benchmark_windows(
    benchmark: DataFrame, width: int = WIDTH, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """Distinct windows with the ids, as text, of the items that have them.

    An item of fewer words than ``width`` is one window.  Items with null id, null text
    or no words have none.
    """
    rows = benchmark.select(
        F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")
    ).mapInArrow(_window_rows(width), "width int, hash long, words string, item string")
    return rows.groupBy("width", "hash", "words").agg(
        F.sort_array(F.collect_set("item")).alias("items")
    )


class _Index:
    """Windows by width: sorted hashes, and the windows of equal hash."""

    def __init__(self, windows: list[tuple[int, int, str, list[str]]]) -> None:
        self.by_width: dict[int, np.ndarray] = {}
        self.found: dict[tuple[int, int], dict[str, list[str]]] = {}
        hashes: dict[int, list[int]] = {}
        for k, h, words, items in windows:
            hashes.setdefault(k, []).append(h % 2**64)
            self.found.setdefault((k, h % 2**64), {})[words] = items
        # A bit per 16 bits of a hash: most windows of a text fail here.
        self.bits: dict[int, np.ndarray] = {}
        for k, listed in hashes.items():
            self.by_width[k] = np.unique(np.array(listed, dtype=np.uint64))
            bits = np.zeros(1 << 24, dtype=bool)
            bits[(self.by_width[k] >> np.uint64(40)).astype(np.int64)] = True
            self.bits[k] = bits

    def hits(self, words: Words, n_texts: int) -> tuple[np.ndarray, list[set[str]]]:
        """Which words are inside a window that occurs, and the items of each text."""
        inside = np.zeros(len(words.starts) + 1, dtype=np.int32)
        items: list[set[str]] = [set() for _ in range(n_texts)]
        for k, known in self.by_width.items():
            h = words.window_hashes(k)
            at = np.flatnonzero(self.bits[k][(h >> np.uint64(40)).astype(np.int64)])
            where = np.minimum(np.searchsorted(known, h[at]), len(known) - 1)
            at = at[known[where] == h[at]]
            text_of = np.searchsorted(words.first, at, side="right") - 1
            for i, t in zip(at.tolist(), text_of.tolist(), strict=True):
                if i + k > words.first[t + 1]:
                    continue
                # Equal hashes are not enough: the words themselves are compared.
                text = b" ".join(words.bytes_of(j) for j in range(i, i + k)).decode()
                same = self.found[k, int(h[i])].get(text)
                if same is not None:
                    inside[i] += 1
                    inside[i + k] -= 1
                    items[t].update(same)
        return np.cumsum(inside[:-1]) > 0, items


_INDEXES: dict[str, _Index] = {}


def _by_index(key: str, shared):
    """What an index finds in the words of a batch."""

    def hits(part: pa.RecordBatch, words: Words) -> tuple[np.ndarray, list[set[str]]]:
        if key not in _INDEXES:
            _INDEXES.clear()
            _INDEXES[key] = _Index(shared.value)
        return _INDEXES[key].hits(words, part.num_rows)

    return hits


def _by_join(part: pa.RecordBatch, words: Words) -> tuple[np.ndarray, list[set[str]]]:
    """What a join has found: the columns ``_places`` and ``_items``."""
    inside = np.zeros(len(words.starts) + 1, dtype=np.int32)
    for i, places in enumerate(part.column("_places").to_pylist()):
        for place in places or ():
            at = int(words.first[i]) + place["at"]
            inside[at] += 1
            inside[at + place["width"]] -= 1
    return np.cumsum(inside[:-1]) > 0, [set(x or ()) for x in part.column("_items").to_pylist()]


def _candidates(widths: list[int], shared):
    """Tasks that list the windows of texts whose hash may be one of the benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            for part in slices(batch, 1):
                keys, words = part.column(0), Words(utf8(part.column(1)), ALPHANUMERIC)
                for k in widths:
                    h = words.window_hashes(k)
                    bit = (h >> np.uint64(64 - _BITS)).astype(np.int64)
                    at = np.flatnonzero((bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                    text_of = np.searchsorted(words.first, at, side="right") - 1
                    whole = at + k <= words.first[text_of + 1]
                    at, text_of = at[whole], text_of[whole]
                    for lo in range(0, len(at), 65_536):
                        some, of = at[lo : lo + 65_536], text_of[lo : lo + 65_536]
                        yield pa.RecordBatch.from_arrays(
                            [keys.take(pa.array(of)),
                             pa.array(some - words.first[of], pa.int32()),
                             pa.array(np.full(len(some), k), pa.int32()),
                             pa.array(h[some].view(np.int64)),
                             pa.array([b" ".join(words.bytes_of(j) for j in range(i, i + k)).decode()
                                       for i in some.tolist()], pa.string())],
                            ["_key", "at", "width", "hash", "words"],
                        )

    return run


def _joined(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """``rows`` with ``_places`` and ``_items`` of the windows in its texts.

    What is found depends on the text alone, so equal texts share a key.  A bitmap of
    the hashes leaves most windows of documents out before any is shuffled; the join
    compares the words themselves.
    """
    windows = Scratch(rows.sparkSession, "windows").store(windows)
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())
    # Bitmaps that Spark builds have 32768 bits.
    block = F.shiftrightunsigned("hash", 64 - _BITS + 15).alias("block")
    bit = F.shiftrightunsigned("hash", 64 - _BITS) % 32768
    bitmaps = windows.groupBy(block).agg(F.bitmap_construct_agg(bit).alias("bits")).collect()
    bits = bytearray(1 << _BITS - 3)
    for r in bitmaps:
        bits[r["block"] * 4096 : r["block"] * 4096 + 4096] = r["bits"]
    shared = rows.sparkSession.sparkContext.broadcast(bytes(bits))
    keyed = rows.withColumn("_key", F.sha2("_text", 256))
    found = (
        keyed.where(F.col("_text").isNotNull()).select("_key", "_text")
        .mapInArrow(_candidates(widths, shared),
                    "_key string, at int, width int, hash long, words string")
        .join(windows, ["width", "hash", "words"])
        .groupBy("_key").agg(
            F.collect_set(F.struct("at", "width")).alias("_places"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("_items"),
        )
    )
    return keyed.join(found, "_key", "left").select("_row", "_text", "_places", "_items")


def _scan(hits, replace: str | None):
    """Tasks that mark, and cut if ``replace`` is given, what ``hits`` finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, part_text := batch.schema.get_field_index("_text")):
                texts = utf8(part.column(part_text))
                words = Words(texts, ALPHANUMERIC)
                inside, items = hits(part, words)
                part = part.select(["_row", "_text"])
                total = np.concatenate([[0], np.cumsum(inside)])
                first = words.first
                n_hit = total[first[1:]] - total[first[:-1]]
                spans = []
                begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
                for i in range(len(texts)):
                    lo, hi = int(first[i]), int(first[i + 1])
                    if not n_hit[i]:
                        spans.append([])
                        continue
                    starts, ends = runs(inside[lo:hi])
                    spans.append([
                        (int(words.starts[lo + a] - begin[i]), int(words.ends[lo + b - 1] - begin[i]))
                        for a, b in zip(starts, ends, strict=True)
                    ])
                columns = [part.column(j) for j in range(part.num_columns)]
                if replace is not None:
                    columns[part_text] = pa.array(
                        [None if x is None else _cut(t, s, replace) for x, t, s in
                         zip(part.column(part_text).to_pylist(), texts, spans, strict=True)],
                        pa.string(),
                    )
                columns += [
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    pa.array(
                        [[{"start": len(t[:a].decode()), "end": len(t[:b].decode())}
                          for a, b in s] for t, s in zip(texts, spans, strict=True)],
                        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                    ),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, [*part.schema.names, "words", "hit", "items", "spans"]
                )

    return run


def _cut(text: bytes, spans: list[tuple[int, int]], replace: str) -> str:
    out, at = [], 0
    for a, b in spans:
        out += [text[at:a], replace.encode()]
        at = b
    return b"".join([*out, text[at:]]).decode()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    replace: str | None = None,
) -> DataFrame:
    """For each row of ``docs``: it as ``row``, ``words``, ``hit``, ``items``, ``spans``.

    Words are runs of digits, a-z after lower-casing A-Z, and all characters beyond
    ASCII.  A word is hit inside any occurrence of a window of ``width`` words of an
    item; an item of fewer words is one window.  ``spans`` are the stretches of hit
    words as code points, end exclusive; with ``replace`` they are replaced in the text.

    Null and empty texts have no words; an empty benchmark hits nothing; items with
    null id are left out.  Repeated rows are treated alike.  The windows of the
    benchmark are broadcast if they are at most ``BROADCAST_WINDOWS``, which is counted
    first; those of a larger benchmark are joined with the windows of the documents.
    """
    spark = docs.sparkSession
    windows = benchmark_windows(benchmark, width, item_col, item_text_col)
    listed = windows.limit(BROADCAST_WINDOWS + 1).collect()
    rows_in = packed(docs, text_col)
    more = wider(rows_in, "words long, hit long, items array<string>, "
                          "spans array<struct<start:int,end:int>>")
    if len(listed) > BROADCAST_WINDOWS:
        found = _joined(rows_in, windows).mapInArrow(_scan(_by_join, replace), more)
    else:
        rows = [(r["width"], r["hash"], r["words"], list(r["items"])) for r in listed]
        shared = spark.sparkContext.broadcast(rows)
        key = f"{spark.sparkContext.applicationId}-{id(shared)}"
        found = rows_in.mapInArrow(_scan(_by_index(key, shared), replace), more)
    return found.select(
        F.struct(*unpacked(docs.columns, text_col)).alias("row"), "words", "hit", "items", "spans"
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    max_share: float = 0.5,
    **columns: str,
) -> DataFrame:
    """``docs`` without benchmark passages.

    A document of which more than ``max_share`` of the words are hit goes as a whole;
    from others the hit stretches are cut out.  All other rows stay as they are.
    """
    found = contamination(docs, benchmark, width, replace="", **columns)
    return found.where(F.col("hit") <= F.col("words") * F.lit(max_share)).select("row.*")
