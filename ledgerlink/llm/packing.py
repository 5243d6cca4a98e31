"""Sequences of bounded length with little padding: shortest-pack-first by histogram."""

from __future__ import annotations

import heapq
import itertools
import json
import os
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.llm.arrays import run_hashes
from ledgerlink.llm.support import packed, slices, unpacked, wider

MAX_TOKENS = 2048
#: Words whose ids a task remembers; it then starts anew.
KNOWN_WORDS = 400_000
_BLANK = "\t\n\x0b\x0c\r \x85\xa0"
#: Code points that the table of character kinds covers; other texts go to the
#: tokenizer whole.
_COVERED = 0x250


def _kinds() -> np.ndarray:
    """1 letter, 2 number, 3 white space, 4 anything else, by code point."""
    kinds = np.full(_COVERED, 4, dtype=np.int8)
    for c in range(_COVERED):
        kind = unicodedata.category(chr(c))[0]
        kinds[c] = 3 if chr(c) in _BLANK else 1 if kind == "L" else 2 if kind == "N" else 4
    return kinds


class FastTokenizer:
    """Ids of a byte-level BPE whose words are those of the public 50k vocabulary.

    BPE works on one word at a time, so a batch is cut into words with array operations
    and each distinct word is encoded once.  Texts with characters beyond Latin go to
    the tokenizer as they are.  Ids that are remembered are found by the word itself.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        # Spark runs one task per core; threads of their own would contend for them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # What looks like a special token in a text is ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.kinds = _kinds()
        self.words = self._word_encoder(path)
        self._forget()

    def _word_encoder(self, path: str):
        """Ids of one word: the same merges in a faster library, where ids follow the
        order of the merges, else the tokenizer itself."""
        import tiktoken

        # The printable characters that stand for bytes in the file.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab = model["vocab"]
        try:
            ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items()}
            merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")]
                      for m in model["merges"]]
        except KeyError:
            merged = [1, 0]
        if any(a >= b for a, b in itertools.pairwise(merged)):
            return lambda word: self.tokenizer.encode(word, add_special_tokens=False).ids
        return tiktoken.Encoding(
            "words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def _forget(self) -> None:
        self.row: dict[str, int] = {}
        self.pool = np.empty(1 << 20, dtype=np.uint32)
        self.start = np.zeros(1, dtype=np.int64)
        self.used = 0

    def encode_whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in found]

    def _cut(self, codes: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Where words start; ``last`` marks the final character of each text.

        The rule is that of the vocabulary: runs of letters, of numbers or of other
        signs, each with one blank before it; the rest of a run of white space is a
        word, and so is its last character if it is no blank and a word follows.
        """
        kind = self.kinds[codes]
        n = len(codes)
        new_text = np.ones(n, dtype=bool)
        new_text[1:] = last[:-1]
        start = new_text.copy()
        start[1:] |= kind[1:] != kind[:-1]
        white = kind == 3
        followed = np.zeros(n, dtype=bool)
        followed[:-1] = white[:-1] & ~white[1:] & ~last[:-1]
        start |= followed
        # A single blank before a run belongs to the run.
        blank = followed & (codes == 32)
        start[1:][blank[:-1]] = False
        # 's 't 're 've 'm 'll 'd at the start of a word are words of their own.
        for i in np.flatnonzero(start & (codes == 39)).tolist():
            if last[i]:
                continue
            two = chr(codes[i + 1])
            three = two + chr(codes[i + 2]) if i + 2 < n and not last[i + 1] else ""
            size = 2 if two in "stmd" else 3 if three in ("re", "ve", "ll") else 0
            if size:
                start[i + 1 : i + size] = False
                if i + size < n:
                    start[i + size] = True
        return np.flatnonzero(start)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as the tokenizer gives them."""
        out: list[np.ndarray | None] = [None] * len(texts)
        fast, arrays = [], []
        for i, text in enumerate(texts):
            codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
            if not len(codes):
                out[i] = np.empty(0, dtype=np.uint32)
            elif codes.max() < _COVERED:
                fast.append(i)
                arrays.append(codes)
        slow = [i for i in range(len(texts)) if out[i] is None and i not in set(fast)]
        for i, ids in zip(slow, self.encode_whole([texts[i] for i in slow]), strict=True):
            out[i] = ids
        if fast:
            for i, ids in zip(fast, self._encode_latin(arrays), strict=True):
                out[i] = ids
        return out

    def _encode_latin(self, arrays: list[np.ndarray]) -> list[np.ndarray]:
        codes = np.concatenate(arrays)
        ends = np.cumsum([len(a) for a in arrays])
        last = np.zeros(len(codes), dtype=bool)
        last[ends - 1] = True
        starts = self._cut(codes, last)
        stops = np.append(starts[1:], len(codes))
        first, inverse = self._distinct(codes, starts, stops)
        if len(self.row) > KNOWN_WORDS:
            self._forget()
        text = codes.astype("<u4").tobytes().decode("utf-32-le")
        words = [text[a:b] for a, b in
                 zip(starts[first].tolist(), stops[first].tolist(), strict=True)]
        row = self.row
        new = [w for w in dict.fromkeys(words) if w not in row]
        if new:
            self._learn(new)
        rows = np.fromiter(map(row.__getitem__, words), np.int64, len(words))[inverse]
        begin, size = self.start[rows], self.start[rows + 1] - self.start[rows]
        offsets = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])]
        cuts = offsets[np.searchsorted(starts, ends[:-1])]
        return np.split(ids, cuts)

    @staticmethod
    def _distinct(codes, starts, stops) -> tuple[np.ndarray, np.ndarray]:
        """A place of each distinct word, and which of them each word is.

        Words of equal hash are compared letter by letter; if any differ, each word is
        taken for one of its own.
        """
        hashes = run_hashes(codes, starts, stops)
        _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        sizes, shown = stops - starts, starts[first][inverse]
        same = (sizes == sizes[first][inverse]).all()
        if same:
            letters = np.repeat(shown - starts, sizes) + np.arange(len(codes))
            same = (codes[letters] == codes).all()
        if same:
            return first, inverse
        return np.arange(len(starts)), np.arange(len(starts))

    def _learn(self, words: list[str]) -> None:
        found = list(map(self.words, words))
        base = len(self.start) - 1
        self.row.update(zip(words, range(base, base + len(words)), strict=True))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        total = int(sizes.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + total] = np.fromiter(
            itertools.chain.from_iterable(found), np.uint32, total
        )
        self.start = np.concatenate([self.start, self.used + np.cumsum(sizes)])
        self.used += total


_TOKENIZERS: dict[str, FastTokenizer] = {}


def _tokenizer(path: str) -> FastTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = FastTokenizer(path)
    return _TOKENIZERS[path]


def _pieces(path: str, end_id: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            for part in slices(batch, 1):
                texts = [x or "" for x in part.column(1).to_pylist()]
                row, start, length, total, ids = [], [], [], [], []
                for i, found in enumerate(tokenizer.encode(texts)):
                    found = np.append(found, np.uint32(end_id)).astype("<u4")
                    for at in range(0, len(found), limit):
                        piece = found[at : at + limit]
                        row.append(i)
                        start.append(at)
                        length.append(len(piece))
                        total.append(len(found))
                        ids.append(piece.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int32())), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(total, pa.int64()),
                     pa.array(ids, pa.binary())],
                    ["_row", "start", "length", "doc_tokens", "ids"],
                )

    return run


def tokenize(
    docs: DataFrame, path: str, end_id: int = 1, limit: int = MAX_TOKENS, text_col: str = "text"
) -> DataFrame:
    """The pieces of each row: ``row`` (its other columns), ``start``, ``length``,
    ``doc_tokens`` and ``ids``, little-endian unsigned 32-bit numbers.

    A row's ids are those of its text and ``end_id``; they are cut after every ``limit``
    ids.  Null and empty texts are the one id ``end_id``.  Repeated rows give pieces
    each; no rows give none.
    """
    rows = packed(docs, text_col)
    others = [c for c in docs.columns if c != text_col]
    schema = wider(rows.select("_row"), "start long, length long, doc_tokens long, ids binary")
    columns = [x for c, x in zip(docs.columns, unpacked(docs.columns, text_col, "ids"),
                                 strict=True) if c in others]
    return rows.mapInArrow(_pieces(path, end_id, limit), schema).select(
        F.struct(*columns).alias("row"), "start", "length", "doc_tokens", "ids"
    )


class Patterns:
    """Shortest-pack-first over a histogram of lengths.

    Lengths are placed longest first.  The pieces of a length join the shortest packs,
    those with the most room, as many as there are packs of a pattern; where the shortest
    has too little room, what is left fills new packs.  Only counts are kept, so the work
    depends on the limit and on the number of patterns, not on that of the pieces.

    ``counts`` has the packs of each pattern: its lengths, each with how often it occurs.
    ``slots[length]`` lists (first rank, packs, first sequence, offset): the pieces of
    that length from the first rank on lie in successive sequences at that offset.
    """

    def __init__(self, histogram: dict[int, int], limit: int = MAX_TOKENS) -> None:
        self.counts: Counter[tuple[tuple[int, int], ...]] = Counter()
        self.slots: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        self.sequences = 0
        # Room left -> pattern -> stretches of successive sequences of that pattern.
        free: dict[int, dict[tuple, list[tuple[int, int]]]] = defaultdict(dict)
        shortest: list[int] = []

        def put(pattern: tuple, room: int, first: int, packs: int) -> None:
            self.counts[pattern] += packs
            if room:
                if not free[room]:
                    heapq.heappush(shortest, -room)
                free[room].setdefault(pattern, []).append((first, packs))

        for length in sorted(histogram, reverse=True):
            rank, left = 0, histogram[length]
            while left and shortest and -shortest[0] >= length:
                room = -shortest[0]
                pattern, stretches = next(iter(free[room].items()))
                first, packs = stretches.pop()
                take = min(left, packs)
                if take < packs:
                    stretches.append((first + take, packs - take))
                if not stretches:
                    del free[room][pattern]
                if not free[room]:
                    heapq.heappop(shortest)
                self.counts[pattern] -= take
                self.slots[length].append((rank, take, first, limit - room))
                put(_with(pattern, length, 1), room - length, first, take)
                rank, left = rank + take, left - take
            # A new pack is the shortest until no piece of this length fits any more.
            most = limit // length
            for pieces, packs in ((most, left // most), (left % most, 1)):
                if pieces and packs:
                    for i in range(pieces):
                        self.slots[length].append((rank, packs, self.sequences, i * length))
                        rank += packs
                    put(((length, pieces),), limit - pieces * length, self.sequences, packs)
                    self.sequences += packs
        self.counts = +self.counts


def _with(pattern: tuple, length: int, pieces: int) -> tuple[tuple[int, int], ...]:
    """A pattern with more pieces of a length; lengths come in descending order."""
    if pattern and pattern[-1][0] == length:
        return (*pattern[:-1], (length, pattern[-1][1] + pieces))
    return (*pattern, (length, pieces))


def _assign(shared, length_at: int, rank_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {}
        for length, slots in shared.value.items():
            tables[length] = np.array(slots, dtype=np.int64)
        for batch in batches:
            length = batch.column(length_at).to_numpy(zero_copy_only=False)
            rank = batch.column(rank_at).to_numpy(zero_copy_only=False)
            sequence = np.empty(len(length), dtype=np.int64)
            offset = np.empty(len(length), dtype=np.int64)
            for n in np.unique(length).tolist():
                here, table = length == n, tables[n]
                slot = np.searchsorted(table[:, 0], rank[here], side="right") - 1
                sequence[here] = table[slot, 2] + rank[here] - table[slot, 0]
                offset[here] = table[slot, 3]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence), pa.array(offset)],
                [*batch.schema.names, "sequence_id", "offset"],
            )

    return run


def pack(
    pieces: DataFrame, order: list[str], limit: int = MAX_TOKENS, groups: int | None = None
) -> DataFrame:
    """``pieces`` (with ``length``, 1 to ``limit``) with ``sequence_id`` and ``offset``.

    Pieces of a length are ranked by ``order``, in groups by hash, so that a length with
    most of the pieces is spread; only counts per length reach the driver, ``limit`` of
    them at most.  Pieces that agree in ``order`` are taken in any order.  ``pieces``
    must give the same rows each time it is read: a written table.
    """
    spark = pieces.sparkSession
    groups = groups or max(1, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    hashed = pieces.withColumn("_group", F.pmod(F.xxhash64(*order), F.lit(groups)))
    counts = hashed.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("_n"))
    by_length = counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()
    patterns = Patterns({r["length"]: r["n"] for r in by_length}, limit)
    shared = spark.sparkContext.broadcast(dict(patterns.slots))
    earlier = Window.partitionBy("length").orderBy("_group")
    offsets = counts.select(
        F.col("length").alias("_length"), F.col("_group").alias("_in"),
        (F.sum("_n").over(earlier) - F.col("_n")).alias("_before"),
    )
    local = F.row_number().over(Window.partitionBy("length", "_group").orderBy(*order))
    ranked = (
        hashed.withColumn("_local", local)
        .join(offsets, (F.col("length") == F.col("_length")) & (F.col("_group") == F.col("_in")))
        .withColumn("_rank", F.col("_before") + F.col("_local") - 1)
        .drop("_local", "_length", "_in", "_before", "_group")
    )
    names = ranked.columns
    return ranked.mapInArrow(
        _assign(shared, names.index("length"), names.index("_rank")),
        wider(ranked, "sequence_id long, offset long"),
    ).drop("_rank")


def sequences(packed_pieces: DataFrame, limit: int = MAX_TOKENS, pad_id: int = 0) -> DataFrame:
    """Sequences of packed pieces that still have ``ids``: ``sequence_id``, ``ids`` and
    ``used``; padded to ``limit`` unless the used length is a power of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column(1).to_pylist():
                ids = np.frombuffer(b"".join(p["ids"] for p in parts), dtype="<u4")
                used = len(ids)
                if used & (used - 1):
                    ids = np.append(ids, np.full(limit - used, pad_id, dtype="<u4"))
                out.append((ids.tolist(), used))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o[0] for o in out], pa.list_(pa.int64())),
                 pa.array([o[1] for o in out], pa.int64())],
                ["sequence_id", "ids", "used"],
            )

    grouped = packed_pieces.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    return grouped.mapInArrow(run, "sequence_id long, ids array<long>, used long")
