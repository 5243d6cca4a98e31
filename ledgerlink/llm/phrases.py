"""Collocations: an FM-index over word ids per shard, counts summed across shards.

A shard is a stretch of the texts of one language that a task holds at once.  Its index
is the Burrows-Wheeler transform of its words in both directions; runs of words are
intervals in both, extended by a word to the right or to the left for all runs of a
length at a time.  Shards list the counts of all their runs by hash, buckets of hashes
are summed across shards, and what is frequent in all together comes back to the shards
that have it, to be spelled and counted exactly.  Sums by hash are never too small, so no
frequent phrase is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.llm.arrays import Words, byte_class, odd_numbers, run_hashes
from ledgerlink.llm.sketch import mix
from ledgerlink.llm.support import Scratch, slices, utf8

LEAST, DEPTH, TOP, COVERED = 30, 4, 2000, 80
UNKNOWN = "und"
#: Bytes of text that become one shard, or one longer text.
SHARD_BYTES = 8_000_000
#: Bytes of texts of all languages that a task gathers.
_GATHERED = 16_000_000
#: Words of the corpus for each bucket in which counts are summed.
BUCKET = 500_000
_ENDS = b".,;:!?\n\x0b\x0c\r"
_INSIDE = byte_class(lambda b: b not in (0x20, 0x09) and b not in _ENDS)
_END = byte_class(lambda b: b in _ENDS)
_OUT_ROWS = 65_536


class Shard:
    """Words of some texts as numbers from 1 on; 0 ends a piece."""

    def __init__(self, texts: list[bytes]) -> None:
        words = Words(texts, _INSIDE)
        n = len(words.starts)
        _, first, ids = np.unique(words.hashes, return_index=True, return_inverse=True)
        again = run_hashes(words.codes, words.starts, words.ends, seed=2)
        if (again != again[first][ids]).any():
            # Two words with one hash: tell them apart by the words themselves.
            listed = [words.bytes_of(i) for i in range(n)]
            _, first, ids = np.unique(np.array(listed, dtype=object), return_index=True,
                                      return_inverse=True)
        self.vocabulary = [words.bytes_of(i).decode() for i in first.tolist()]
        ends = np.concatenate([[0], np.cumsum(_END[words.codes])])
        new = np.zeros(n + 1, dtype=np.int64)
        if n:
            new[1:n] = ends[words.starts[1:]] != ends[words.ends[:-1]]
            new[words.first[:-1]] = 1
            new[0], new[n] = 1, 1
        at = np.arange(n) + np.cumsum(new[:n])
        self.words = np.zeros(int(n + new.sum()), dtype=np.uint32)
        self.words[at] = ids + 1


def _order(keys: np.ndarray, bound: int) -> np.ndarray:
    """The stable order of numbers from 0 to ``bound``.

    Where number and place fit into 63 bits, both are sorted as one, which is faster.
    """
    bits = len(keys).bit_length()
    if bound.bit_length() + bits > 63:
        return np.argsort(keys, kind="stable")
    both = (keys.astype(np.int64) << bits) | np.arange(len(keys))
    both.sort()
    return both & ((1 << bits) - 1)


def _transform(words: np.ndarray) -> np.ndarray:
    """The word before each rotation, rotations in the order of their first four words."""
    rank = words.astype(np.int64)
    for step in (1, 2):
        base = int(rank.max(initial=0)) + 1
        pairs = rank * base + np.roll(rank, -step)
        order = _order(pairs, base * base)
        if step == 1:
            new = np.diff(pairs[order], prepend=-1) > 0
            rank = np.empty(len(words), dtype=np.int64)
            rank[order] = np.cumsum(new) - 1
    return words[order - 1]


def _inverse(order: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), dtype=np.int32)
    out[order] = np.arange(len(order), dtype=np.int32)
    return out


class Runs:
    """Runs of words: intervals in both transforms, counts and words."""

    def __init__(self, forward, backward, size, spelt) -> None:
        self.forward, self.backward, self.size, self.spelt = forward, backward, size, spelt

    def only(self, which: np.ndarray) -> Runs:
        return Runs(self.forward[which], self.backward[which], self.size[which], self.spelt[which])


class Index:
    """The transforms of a shard, forward and backward, and runs as intervals in them."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray, n_words: int) -> None:
        self.before, self.after = forward, backward
        self.counts = np.bincount(forward, minlength=n_words + 1)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.base = n_words + 1
        self._steps = [_inverse(_order(t, n_words)) for t in (forward, backward)]

    @classmethod
    def of(cls, shard: Shard) -> Index:
        return cls(_transform(shard.words), _transform(shard.words[::-1]), len(shard.vocabulary))

    def words(self) -> Runs:
        """All runs of one word."""
        some = (np.flatnonzero(self.counts[1:]) + 1).astype(np.int32)
        first = self.first[some].astype(np.int32)
        return Runs(first, first, self.counts[some].astype(np.int32), some[:, None])

    def extended(self, runs: Runs, left: bool) -> Runs:
        """Every run with every word that stands before it, or after it, somewhere."""
        here, there = (runs.forward, runs.backward) if left else (runs.backward, runs.forward)
        text = self.before if left else self.after
        begins = np.cumsum(runs.size, dtype=np.int64) - runs.size
        total = int(runs.size.sum(dtype=np.int64))
        owner = np.repeat(np.arange(len(here), dtype=np.int32), runs.size)
        row = np.repeat((here - begins).astype(np.int32), runs.size)
        row += np.arange(total, dtype=np.int32)
        # Rows of a run by the word they are extended with, each in their order.
        keys = owner.astype(np.int64) * self.base + text[row]
        order = _order(keys, len(here) * self.base)
        keys, row = keys[order], row[order]
        del order, owner
        new = np.ones(total, dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, total)).astype(np.int32)
        owner, word = np.divmod(keys[at], self.base)
        # In the other direction a run's extensions follow each other by word.
        far = (there[owner] + (at - begins[owner])).astype(np.int32)
        near = self._steps[0 if left else 1][row[at]]
        del keys, row, new, at
        keep = word > 0
        owner, word, near, far, size = (x[keep] for x in (owner, word, near, far, size))
        spelt, word = runs.spelt[owner], word.astype(np.int32)[:, None]
        both = [word, spelt] if left else [spelt, word]
        forward, backward = (near, far) if left else (far, near)
        return Runs(forward, backward, size, np.concatenate(both, axis=1))


def _compressed(array: np.ndarray) -> bytes:
    return pa.compress(array.tobytes(), codec="zstd", asbytes=True)


def _shard_task(shard_bytes: int):
    """Tasks that gather texts by language and give out an index for each shard."""

    def row(lang: str, texts: list[bytes], number: int) -> pa.RecordBatch:
        shard = Shard(texts)
        index = Index.of(shard)
        vocabulary = " ".join(shard.vocabulary).encode()
        values = (
            (TaskContext.get().partitionId() << 32) + number, lang, int((shard.words > 0).sum()),
            len(vocabulary), pa.compress(vocabulary, codec="zstd", asbytes=True),
            len(shard.words), _compressed(index.before), _compressed(index.after),
        )
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(),
                 pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, kinds, strict=True)], _SHARD_COLUMNS
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        number = 0
        for batch in batches:
            for part in slices(batch, 1):
                for lang, text in zip(part.column(0).to_pylist(), utf8(part.column(1)),
                                      strict=True):
                    held.setdefault(lang, []).append(text)
                    sizes[lang] = sizes.get(lang, 0) + len(text)
                    largest = lang
                    if sizes[lang] <= shard_bytes:
                        if sum(sizes.values()) <= _GATHERED:
                            continue
                        largest = max(sizes, key=sizes.__getitem__)
                    del sizes[largest]
                    yield row(largest, held.pop(largest), number)
                    number += 1
        for lang, texts in held.items():
            yield row(lang, texts, number)
            number += 1

    return run


_SHARD_COLUMNS = ["shard", "lang", "n", "spelt", "vocabulary", "length", "before", "after"]
_SHARDS = ("shard long, lang string, n long, spelt long, vocabulary binary, length long, "
           "before binary, after binary")


def _read(row: dict) -> tuple[list[str], Index]:
    """Vocabulary and index of a stored shard."""
    spelt = pa.decompress(row["vocabulary"], row["spelt"], codec="zstd", asbytes=True)
    vocabulary = spelt.decode().split(" ") if spelt else []
    before, after = (
        np.frombuffer(pa.decompress(row[c], 4 * row["length"], codec="zstd", asbytes=True), np.uint32)
        for c in ("before", "after")
    )
    return vocabulary, Index(before, after, len(vocabulary))


def _keys(lang: str, vocabulary: list[str], spelt: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run and its language."""
    names = [w.encode() for w in [*vocabulary, lang]]
    ends = np.cumsum([len(w) for w in names])
    codes = np.frombuffer(b"".join(names), np.uint8)
    hashes = run_hashes(codes, ends - [len(w) for w in names], ends)
    out = np.full(len(spelt), hashes[-1], dtype=np.uint64)
    for i, odd in enumerate(odd_numbers(spelt.shape[1], 10 + spelt.shape[1])):
        out += hashes[spelt[:, i] - 1] * odd
    return mix(out)


def _deeper(index: Index, runs: Runs | None) -> Runs:
    """Runs of one word more: to the right, to the left, and so on."""
    if runs is None:
        return index.words()
    return index.extended(runs, left=runs.spelt.shape[1] % 2 == 0)


def _count_task(least: int, depth: int, bucket_bits: int):
    """Tasks that list the counts of the runs of each shard, by key.

    A row holds those of a bucket of keys, as the 32 bits of each key that follow those
    of the bucket, in order, and its count, ``least`` at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                vocabulary, index = _read(row)
                runs, keys, counts = None, [], []
                for _ in range(depth):
                    runs = _deeper(index, runs)
                    keys.append(_keys(row["lang"], vocabulary, runs.spelt) >> np.uint64(
                        32 - bucket_bits))
                    counts.append(np.minimum(runs.size, least))
                keys, counts = np.concatenate(keys), np.concatenate(counts)
                order = np.argsort(keys)
                keys, counts = keys[order], counts[order].astype(_count_type(least))
                bucket, low = (keys >> np.uint64(32)).astype(np.int64), keys.astype(np.uint32)
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = np.append(cuts[1:], len(keys))
                for at in range(0, len(cuts), 1024):
                    some = list(zip(cuts[at : at + 1024].tolist(), ends[at : at + 1024].tolist(),
                                    strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket[cuts[at : at + 1024]]),
                         pa.array([row["shard"]] * len(some), pa.int64()),
                         pa.array([j - i for i, j in some], pa.int64()),
                         pa.array([_planes(low[i:j]) for i, j in some], pa.binary()),
                         pa.array([_planes(counts[i:j]) for i, j in some], pa.binary())],
                        ["bucket", "shard", "size", "keys", "counts"],
                    )

    return run


def _count_type(least: int) -> str:
    return "u1" if least < 256 else "<u4"


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers with all their first bytes together, and so on: those of sorted ones
    repeat."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T)
    return _compressed(planes)


def _numbers(planes: bytes, size: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    plain = pa.decompress(planes, size * width, codec="zstd", asbytes=True)
    by_place = np.frombuffer(plain, np.uint8).reshape(width, size).T
    return np.ascontiguousarray(by_place).view(kind).ravel()


def _sum_task(least: int):
    """Sums the counts of a bucket over all shards; gives each shard its frequent keys."""

    def run(table: pa.Table) -> pa.Table:
        sizes = table.column("size").to_pylist()
        keys, counts = (
            np.concatenate([
                _numbers(planes, size, kind)
                for planes, size in zip(table.column(name).to_pylist(), sizes, strict=True)
            ]) for name, kind in (("keys", "<u4"), ("counts", _count_type(least)))
        )
        order = np.argsort(keys)
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[order][1:] != keys[order][:-1]
        totals = np.add.reduceat(counts[order].astype(np.int64), np.flatnonzero(new))
        frequent = np.empty(len(keys), dtype=bool)
        frequent[order] = totals[np.cumsum(new) - 1] >= least
        ends = np.cumsum(sizes)
        found = [keys[j - n : j][frequent[j - n : j]].tobytes()
                 for n, j in zip(sizes, ends.tolist(), strict=True)]
        return pa.table({"shard": table.column("shard"), "bucket": table.column("bucket"),
                         "frequent": pa.array(found, pa.binary())})

    return run


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one at a time: a shard's row is large."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _phrase_task(depth: int, bucket_bits: int):
    """Tasks that spell the runs of each shard whose keys are frequent, by bucket.

    Only those of which all but the last word is such a run are looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                vocabulary, index = _read(row)
                frequent = np.sort(np.concatenate([
                    np.frombuffer(x["frequent"], "<u4") | np.uint64(x["bucket"] << 32)
                    for x in row["found"]
                ]))
                names = np.array(["", *vocabulary], dtype=object)
                runs, listed = None, []
                for _ in range(depth):
                    runs = _deeper(index, runs)
                    keys = _keys(row["lang"], vocabulary, runs.spelt) >> np.uint64(32 - bucket_bits)
                    at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
                    some = np.flatnonzero(frequent[at] == keys)
                    runs = runs.only(some)
                    listed += zip(
                        (keys[some] >> np.uint64(32)).tolist(),
                        map(" ".join, names[runs.spelt].tolist()), runs.size.tolist(), strict=True,
                    )
                listed.sort()
                out = []
                for bucket, group in itertools.groupby(listed, key=lambda x: x[0]):
                    phrases, counts = zip(*((p, n) for _, p, n in group), strict=True)
                    text = "\n".join(phrases).encode()
                    out.append((bucket, row["lang"], len(text),
                                pa.compress(text, codec="zstd", asbytes=True),
                                len(counts), _planes(np.array(counts, dtype="<u4"))))
                for lo in range(0, len(out), 1024):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(
                            zip(*out[lo : lo + 1024], strict=True),
                            (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64(),
                             pa.binary()), strict=True)],
                        ["bucket", "lang", "spelt", "phrases", "size", "counts"],
                    )

    return run


def _add_task(least: int):
    """Adds up what the shards have spelled of a bucket, phrase by phrase."""

    def run(table: pa.Table) -> pa.Table:
        totals: dict[tuple[str, str], int] = {}
        for _, lang, spelt, phrases, size, counts in zip(
            *(c.to_pylist() for c in table.columns), strict=True
        ):
            text = pa.decompress(phrases, spelt, codec="zstd", asbytes=True).decode()
            for phrase, n in zip(text.split("\n"), _numbers(counts, size, "<u4").tolist(),
                                 strict=True):
                key = lang, phrase
                totals[key] = totals.get(key, 0) + n
        found = [(*key, n) for key, n in totals.items() if n >= least]
        return pa.table({
            "lang": pa.array([x[0] for x in found], pa.string()),
            "words": pa.array([x[1].count(" ") + 1 for x in found], pa.int32()),
            "phrase": pa.array([x[1] for x in found], pa.string()),
            "a": pa.array([x[2] for x in found], pa.int64()),
        })

    return run


def _part(start: Column | int, size: Column | int) -> Column:
    """Some words of ``phrase``."""
    return F.array_join(F.slice(F.split("phrase", " "), start, size), " ")


def counted_phrases(
    shards: DataFrame, scratch: Scratch, least: int = LEAST, depth: int = DEPTH
) -> DataFrame:
    """``lang``, ``words``, ``phrase`` and ``a`` of all runs of up to ``depth`` words that
    occur ``least`` times in the shards of their language.

    Hashes only choose what comes back to the shards; counts are those of the words.
    """
    total = shards.agg(F.sum("n")).first()[0] or 0
    bucket_bits = min(32, (total // BUCKET).bit_length())
    wanted = (
        shards.mapInArrow(_count_task(least, depth, bucket_bits),
                          "bucket long, shard long, size long, keys binary, counts binary")
        .groupBy("bucket").applyInArrow(_sum_task(least), "shard long, bucket long, frequent binary")
        .where(F.length("frequent") > 0)
        .groupBy("shard").agg(F.collect_list(F.struct("bucket", "frequent")).alias("found"))
    )
    return scratch.store(
        shards.join(wanted, "shard").mapInArrow(
            _phrase_task(depth, bucket_bits),
            "bucket long, lang string, spelt long, phrases binary, size long, counts binary")
        .groupBy("bucket")
        .applyInArrow(_add_task(least), "lang string, words int, phrase string, a long")
    )


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    depth: int = DEPTH,
    top: int = TOP,
    covered: int = COVERED,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The ``top`` phrases of each language that hold together best.

    A-Z count as lower case; texts are cut at ``.,;:!?`` and \x0A to \x0D into pieces,
    and those at blanks and \x09 into words.  Phrases are runs of 2 to ``depth`` words of
    a piece that occur ``least`` times in their language, overlaps included.  Each is cut
    where its parts, of counts ``l`` and ``r``, make the smallest ``score``, the whole
    part of 2,000,000 a / (l + r); of equal ones at the first.  Phrases inside a longer
    one that has ``covered`` hundredths of their count are left out.

    Columns ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` (all words of the
    language) and ``score``.  Null and empty texts have no words; null languages are
    ``und``; repeated rows count each; other columns are not read.  No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    rows = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col(f"`{text_col}`").cast("string").alias("_text"),
    )
    shards = scratch.store(rows.mapInArrow(_shard_task(shard_bytes), _SHARDS))
    found = counted_phrases(shards, scratch, least, depth)
    phrases = found.where("words > 1")

    count = F.col("a").cast("decimal(20,0)")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumns(
        {"head": _part(1, F.col("k")), "tail": _part(F.col("k") + 1, F.col("words") - F.col("k"))}
    )
    heads = found.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = found.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    scored = (
        cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
        .withColumn("a_", count)
        .withColumn("score", F.expr(
            "(CAST(2000000 AS DECIMAL(10,0)) * a_) DIV CAST(l + r AS DECIMAL(20,0))"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    inner = (
        phrases.where("words > 2")
        .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
        .select("lang", _part(F.col("start"), F.col("size")).alias("phrase"),
                F.col("a").alias("longer"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    hidden = F.col("longer").cast("decimal(20,0)") * 100 >= count * covered
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = (
        scored.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(hidden, F.lit(False)))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    )
    sizes = shards.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
