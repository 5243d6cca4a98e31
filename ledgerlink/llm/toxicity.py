"""Toxic texts by a support vector machine over a subsequence string kernel on sentences.

The kernel of two words counts the subsequences of three to five characters that they
share, ends of words included; each skipped character costs a factor, so an insult with
inserted or missing letters stays close to itself.  Blanks and signs within a word do
not count, and letters that stand apart ("l i k e") form a word.  The kernel of two
stretches is the sum of those of their words, over the root of the numbers of words.

A label belongs to a text, not to a sentence, so the machine chooses: of each toxic text
the stretch of a sentence, of one, two or four words, that it takes for the most toxic
one is a positive example, stretches of clean texts are negative ones, and training and
choice alternate.  Nyström landmarks,
examples of both classes, turn the kernel into vectors for a linear machine.  Because the
features of the kernel are known, the landmarks are folded into one weight per feature
afterwards: ``f(stretch)`` is the same function, at the cost of a table lookup.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.arrays import run_hashes, runs
from ledgerlink.llm.language_id import letters
from ledgerlink.llm.sketch import mix
from ledgerlink.llm.support import Scratch, packed, slices, unpacked, wider

#: Bounds of the training: labelled rows, landmarks of either class, stretches of clean
#: texts in each round, and rounds.
MAX_TRAINING_ROWS, LANDMARKS, NEGATIVES, ROUNDS = 8_000, 160, 1_000, 3
#: Words of the stretches of sentences that are looked at; letters of a word that trains.
STRETCHES, LONGEST = (1, 2, 4), 64

_BUCKETS = 1 << 16
#: Counters of whole words, by hash, for the first choice.
_WORD_BUCKETS = 1 << 20
_FIGURES = ("worst", "next", "bad", "words", "long")
_FIGURE_COLUMNS = ", ".join(f"{c} double" for c in (*_FIGURES, "score"))
_DECAY = 0.5
#: Skipped characters between the characters of a subsequence.
_GAPS = [
    *((a, b) for a in range(3) for b in range(3 - a)),
    *((a, b, c) for a in range(2) for b in range(2 - a) for c in range(2 - a - b)),
    (0, 0, 0, 0), (1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1),
]
# Signs that stand for letters between letters.
_LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


class PlainWords:
    """Words of a batch of texts as lower-case letters only, and the distinct ones.

    Words of text i are ``first[i]`` to ``first[i + 1]``; ``row`` is each one's number
    among the distinct words, whose letters stand in ``codes`` between zeros.
    """

    def __init__(self, texts: list[str]) -> None:
        lower = letters()[0]
        codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), dtype=np.uint32)
        begin = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
        low = lower[np.minimum(codes, len(lower) - 1)].copy()
        is_letter = low != 0
        between = np.zeros(len(codes), dtype=bool)
        between[1:-1] = is_letter[:-2] & is_letter[2:]
        for sign, letter in _LOOKALIKES.items():
            low[between & (codes == ord(sign))] = ord(letter)
        is_letter = low != 0
        blank = (codes <= 32) | (codes == 0x85) | (codes == 0xA0)
        start, end = runs(~blank)
        before = np.concatenate([[0], np.cumsum(is_letter)])
        plain = low[is_letter]
        a, b = before[start], before[end]
        some = b > a
        start, a, b = start[some], a[some], b[some]
        a, b, start = self._with_spelled(a, b, start, begin)
        self.start, self.first = start, np.searchsorted(start, begin)
        hashes = run_hashes(plain, a, b)
        self.hashes, at, self.row = np.unique(hashes, return_index=True, return_inverse=True)
        self.n = len(at)
        size, first = (b - a)[at], a[at]
        self.place = np.concatenate([[0], np.cumsum(size + 1)])
        self.codes = np.zeros(self.place[-1] + 1, dtype=np.uint64)
        self.word = np.repeat(np.arange(self.n), size + 1)
        head = np.zeros(self.place[-1], dtype=bool)
        head[self.place[:-1]] = True
        inner = np.repeat(first - self.place[:-1] - 1, size + 1) + np.arange(self.place[-1])
        self.codes[:-1][~head] = plain[inner[~head]]

    @staticmethod
    def _with_spelled(a, b, start, begin):
        """The words with those that runs of three or more single letters spell."""
        single = b - a == 1
        text = np.searchsorted(begin, start, side="right")
        lo, hi = runs(single)
        extra = []
        for x, y in zip(lo.tolist(), hi.tolist(), strict=True):
            cuts = np.flatnonzero(np.diff(text[x:y])) + x + 1
            for p, q in zip([x, *cuts], [*cuts, y], strict=True):
                if q - p >= 3:
                    extra.append((a[p], b[q - 1], start[p]))
        if not extra:
            return a, b, start
        ea, eb, es = (np.array(c, dtype=a.dtype) for c in zip(*extra, strict=True))
        a, b, start = np.append(a, ea), np.append(b, eb), np.append(start, es)
        order = np.argsort(start, kind="stable")
        return a[order], b[order], start[order]

    def text(self, i: int) -> str:
        part = self.codes[self.place[i] + 1 : self.place[i + 1]]
        return part.astype("<u4").tobytes().decode("utf-32-le")

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Bucket, word and weight of the subsequences, for each pattern of gaps."""
        stop = self.place[1:][self.word]
        for gaps in _GAPS:
            reach = len(gaps) + sum(gaps)
            at = np.flatnonzero(np.arange(len(self.word)) + reach <= stop)
            h = mix(self.codes[at] + np.uint64(len(gaps)))
            step = at
            for g in gaps:
                step = step + 1 + g
                h = mix(h + self.codes[step])
            bucket = (h & np.uint64(_BUCKETS - 1)).astype(np.int64)
            yield bucket, self.word[at], _DECAY ** sum(gaps)

    def norms(self) -> np.ndarray:
        total = np.zeros(self.n)
        for _, word, weight in self.features():
            total += np.bincount(word, minlength=self.n) * weight**2
        return np.sqrt(np.maximum(total, 1e-12))

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """For each distinct word the sum of its features' weights, over its norm."""
        total, square = np.zeros(self.n), np.zeros(self.n)
        for bucket, word, weight in self.features():
            total += np.bincount(word, weights[bucket] * weight, self.n)
            square += np.bincount(word, minlength=self.n) * weight**2
        return total / np.sqrt(np.maximum(square, 1e-12))

    def kernel(self, table: np.ndarray) -> np.ndarray:
        """Scores of each distinct word for every row of weights in ``table``."""
        parts = list(self.features())
        bucket = np.concatenate([p[0] for p in parts])
        word = np.concatenate([p[1] for p in parts])
        weight = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
        norm = np.sqrt(np.maximum(np.bincount(word, weight**2, self.n), 1e-12))
        return np.stack(
            [np.bincount(word, row[bucket] * weight, self.n) / norm for row in table], axis=1
        )


class Sentences(PlainWords):
    """Words of a batch of texts, and the stretches of the sentences that they form.

    Sentences end at ``.``, ``!``, ``?`` and line ends.  ``stretches`` has the first words
    of all stretches of each size, and the texts that they are in.
    """

    def __init__(self, texts: list[str]) -> None:
        super().__init__(texts)
        codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), dtype=np.uint32)
        ends = np.concatenate([[0], np.cumsum(np.isin(codes, [0, 10, 33, 46, 63]))])
        sentence = ends[self.start]
        self.of = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.stretches = []
        for size in STRETCHES:
            n = max(0, len(sentence) - size + 1)
            begins = np.flatnonzero(sentence[:n] == sentence[size - 1 : size - 1 + n])
            self.stretches.append((size, begins, self.of[begins]))

    def values(self, by_word: np.ndarray) -> list[np.ndarray]:
        """What each stretch is worth, from the worth of the words."""
        sums = np.concatenate([[0.0], np.cumsum(by_word)])
        return [(sums[at + size] - sums[at]) / math.sqrt(size) for size, at, _ in self.stretches]

    def worst(self, values: list[np.ndarray], n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per size and text: the largest value, and the stretch that has it, or -1."""
        out = []
        for (_, begins, of), value in zip(self.stretches, values, strict=True):
            best, which = np.full(n, -np.inf), np.full(n, -1)
            order = np.lexsort((-begins, value, of))
            last = order[np.flatnonzero(np.diff(of[order], append=-1))]
            best[of[last]], which[of[last]] = value[last], begins[last]
            out.append((best, which))
        return out

    def spelled(self, begin: int, size: int) -> str:
        """The words of a stretch that can train."""
        rows = self.row[begin : begin + size]
        return " ".join(w for w in map(self.text, rows.tolist()) if len(w) <= LONGEST)


@dataclass
class ToxicityModel:
    """Weights of the kernel's features, and how a text's figures become a score."""

    weights: np.ndarray
    bias: float
    scale: np.ndarray

    def figures(self, words: Sentences) -> np.ndarray:
        """Per text: value of the worst stretch, of the next worst word, logs of 1 plus
        the numbers of words that the machine takes for toxic and of all, and the value
        of the worst stretch of the largest size."""
        n = len(words.first) - 1
        by_word = words.scores(self.weights)[words.row]
        best = [found for found, _ in words.worst(words.values(by_word), n)]
        out = np.full((n, len(_FIGURES)), -3.0)
        out[:, 0], out[:, 4] = np.max(best, axis=0) + self.bias, best[-1] + self.bias
        for i in range(n):
            part = by_word[words.first[i] : words.first[i + 1]] + self.bias
            out[i, 2:4] = np.log1p((part > 0).sum()), np.log1p(len(part))
            if len(part) > 1:
                out[i, 1] = np.partition(part, -2)[-2]
        return np.clip(out, -3, None)

    def probability(self, figures: np.ndarray) -> np.ndarray:
        z = figures @ self.scale[:-1] + self.scale[-1]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps; last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(len(w))
    keep[-1, -1] = 1e-6
    for _ in range(30):
        margin = 1 - y * (x @ w)
        active = margin > 0
        xa, ca = x[active], cost[active]
        gradient = keep @ w - 2 * xa.T @ (ca * y[active] * margin[active])
        step = np.linalg.solve(keep + 2 * xa.T @ (xa * ca[:, None]), gradient)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sentence_vectors(sentences: list[str]) -> np.ndarray:
    """The features of stretches whose inner product is the kernel, a row each."""
    out = np.zeros((len(sentences), _BUCKETS), dtype=np.float32)
    for i, sentence in enumerate(sentences):
        words = PlainWords([sentence])
        if words.n:
            times = np.bincount(words.row, minlength=words.n) / words.norms()
            for bucket, word, weight in words.features():
                out[i] += np.bincount(bucket, times[word] * weight, _BUCKETS)
            out[i] /= math.sqrt(len(words.row))
    return out


def fit_sentences(positive: list[str], negative: list[str], landmarks: int = LANDMARKS):
    """Feature weights and bias from labelled sentences.

    Landmarks are the first ``landmarks`` sentences of either list.
    """
    words = PlainWords([*positive, *negative])
    y = np.repeat([1.0, -1.0], [len(positive), len(negative)])
    cost = np.where(y > 0, 0.5 / len(positive), 0.5 / len(negative)) * len(y)
    table = sentence_vectors([*positive[:landmarks], *negative[:landmarks]])
    values, vectors = np.linalg.eigh((table @ table.T).astype(float))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    by_word = words.kernel(table) @ root
    sizes = np.diff(words.first)
    x = np.zeros((len(y), by_word.shape[1]))
    some = np.flatnonzero(sizes)
    x[some] = np.add.reduceat(by_word[words.row], words.first[:-1][some]) / np.sqrt(
        sizes[some])[:, None]
    w = _machine(x, y, cost)
    return (root @ w[:-1]) @ table.astype(float), float(w[-1])


def _word_places(words: PlainWords) -> np.ndarray:
    return (words.hashes & np.uint64(_WORD_BUCKETS - 1)).astype(np.int64)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and how many clean texts have each word, by hash."""
    counts = np.zeros((2, _WORD_BUCKETS))
    for batch in batches:
        for part in slices(batch, 1):
            words = PlainWords([x or "" for x in part.column(1).to_pylist()])
            places = _word_places(words)
            for i, label in enumerate(part.column(0).to_pylist()):
                counts[label][places[np.unique(words.row[words.first[i] : words.first[i + 1]])]] += 1
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(at), pa.array(counts[1, at]), pa.array(counts[0, at])],
        ["at", "toxic", "clean"],
    )


def _pick_task(shared):
    """Tasks that give stretches of each text with their values: of a toxic text the worst
    one, of a clean one the worst of each size, and others as ``plain``.

    ``shared`` has the worth of words, by hash, or the weights of features.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                labels = part.column(0).to_pylist()
                words = Sentences([x or "" for x in part.column(1).to_pylist()])
                by_word = (weights[_word_places(words)] if len(weights) == _WORD_BUCKETS
                           else words.scores(weights))[words.row]
                found = words.worst(words.values(by_word), len(labels))
                out = []
                for i, label in enumerate(labels):
                    some = [(float(best[i]), size, int(at[i]))
                            for (best, at), size in zip(found, STRETCHES, strict=True) if at[i] >= 0]
                    if label:
                        some = [max(some, key=lambda x: (x[0], -x[1]))] if some else []
                    out += [(label, v, words.spelled(at, size), False) for v, size, at in some]
                    if not label:
                        lo, n = words.first[i], words.first[i + 1] - words.first[i]
                        for j, size in enumerate(STRETCHES):
                            _, begins, of = words.stretches[j]
                            own = begins[np.searchsorted(of, i) : np.searchsorted(of, i + 1)]
                            if n and len(own):
                                pick = int(words.hashes[words.row[lo]] % np.uint64(len(own)))
                                out.append((label, 0.0, words.spelled(int(own[pick]), size), True))
                columns = list(zip(*out, strict=True)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        columns, (pa.int32(), pa.float64(), pa.string(), pa.bool_()), strict=True)],
                    ["label", "value", "words", "plain"],
                )

    return run


def _figure_task(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ToxicityModel = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                found = model.figures(Sentences([x or "" for x in part.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(found[:, i]) for i in range(len(_FIGURES))),
                     pa.array(model.probability(found))],
                    [*part.schema.names, *_FIGURES, "score"],
                )

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_TRAINING_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicityModel | None:
    """Fit on labelled texts: about ``max_rows`` of them at most, chosen by a hash.

    The first choice of sentences follows from how often features occur in toxic and in
    clean texts; all features and all sentences of the chosen texts take part.  Rows
    without label or text are left out, and so are texts whose labels contradict each
    other; without both classes the result is None.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")
    ).agg(F.min(label_col).cast("int").alias("_label"), F.max(label_col).alias("_other")).where(
        "_label = _other").drop("_other")
    share = min(1.0, max_rows / max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = scratch.store(
        docs.where(F.col(text_col).isNotNull())
        .select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .join(F.broadcast(sample), "_id").select("_label", "_text")
    )
    try:
        return _trained(scratch, texts)
    finally:
        scratch.drop()


def _trained(scratch: Scratch, texts: DataFrame) -> ToxicityModel | None:
    spark = scratch.spark
    sizes = {r["_label"]: r["count"] for r in texts.groupBy("_label").count().collect()}
    if len(sizes) < 2:
        return None
    counts = (
        texts.mapInArrow(_count_task, "at long, toxic double, clean double")
        .groupBy("at").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toPandas()
    )
    few = sizes[0] / sizes[1]
    odds = np.zeros(_WORD_BUCKETS)
    odds[counts["at"]] = np.log((counts["toxic"] + 0.5) / (sizes[1] + 1)) - np.log(
        (counts["clean"] + few) / (sizes[0] + 2 * few)
    )
    weights, bias = odds, 0.0
    negative: dict[str, None] = {}
    for _ in range(ROUNDS):
        picked = texts.mapInArrow(
            _pick_task(spark.sparkContext.broadcast(weights)),
            "label int, value double, words string, plain boolean",
        ).where("words <> ''")
        positive = [
            r["words"] for r in picked.where("label = 1").select("words").distinct()
            .orderBy(F.xxhash64("words"), "words").collect()
        ]
        clean = picked.where("label = 0").groupBy("words", "plain").agg(F.max("value").alias("value"))
        if not negative:
            first = clean.where("plain").orderBy(F.xxhash64("words"), "words")
            negative = dict.fromkeys(r["words"] for r in first.limit(3 * NEGATIVES).collect())
        hard = clean.where("NOT plain").orderBy(F.desc("value"), "words").limit(NEGATIVES)
        negative |= dict.fromkeys(r["words"] for r in hard.collect())
        positive = [w for w in positive if w not in negative]
        if not positive or not negative:
            return None
        weights, bias = fit_sentences(positive, list(negative))
    model = ToxicityModel(weights, bias, np.zeros(len(_FIGURES) + 1))
    seen = texts.mapInArrow(
        _figure_task(spark.sparkContext.broadcast(model)), wider(texts, _FIGURE_COLUMNS)
    ).select("_label", *_FIGURES).toPandas()
    model.scale = _logistic(
        seen[list(_FIGURES)].to_numpy(float), seen["_label"].to_numpy(float)
    )
    return model


def toxicity(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text") -> DataFrame:
    """For each row of ``docs``: it as ``row``, and ``score``, 0 to 1.

    Null and empty texts, and texts without letters, are scored as texts without any
    suspicious word; without a model every score is 0.  Only the text is looked at;
    repeated rows are treated alike; other columns are handed on.
    """
    if model is None:
        return docs.select(F.struct("*").alias("row"), F.lit(0.0).alias("score"))
    rows = packed(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = rows.mapInArrow(
        _figure_task(shared), wider(rows, _FIGURE_COLUMNS)
    )
    return found.select(F.struct(*unpacked(docs.columns, text_col)).alias("row"), "score")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows of which the classifier learns nothing."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1
