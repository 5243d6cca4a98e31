"""Language of texts and of spans in them: scores per word, joined by Viterbi."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.arrays import run_hashes, runs
from ledgerlink.llm.sketch import mix
from ledgerlink.llm.support import ROWS_AT_ONCE, batches_of, packed, slices, unpacked, wider

UNKNOWN = "und"
#: Cost of a change of language between two words, and the lowest score of a word.
SWITCH, FLOOR = 12.0, -8.0
#: A language is a candidate for a script in which it has this share of its words.
SCRIPT_SHARE = 0.005

_BUCKETS = 1 << 16
_ORDERS = 4
# First and last code point of scripts; all other letters are one more.
_SCRIPTS = [
    (0x41, 0x24F), (0x1E00, 0x1EFF),
    (0x370, 0x3FF),
    (0x400, 0x52F),
    (0x530, 0x58F),
    (0x590, 0x5FF),
    (0x600, 0x77F),
    (0x900, 0x97F),
    (0x980, 0x9FF),
    (0xE00, 0xE7F),
    (0x10A0, 0x10FF),
    (0xAC00, 0xD7AF),
    (0x3040, 0x30FF),
    (0x4E00, 0x9FFF),
]
_N_SCRIPTS = len(_SCRIPTS) + 1
_TABLE = 0x20000
_tables: list[np.ndarray] = []


def letters() -> list[np.ndarray]:
    """By code point: the letter in lower case, or 0, and the script."""
    if not _tables:
        lower = np.zeros(_TABLE, dtype=np.uint32)
        script = np.full(_TABLE, _N_SCRIPTS - 1, dtype=np.uint8)
        for c in range(_TABLE):
            if unicodedata.category(chr(c))[0] == "L":
                low = chr(c).lower()
                lower[c] = ord(low) if len(low) == 1 else c
        for i, (first, last) in enumerate(_SCRIPTS):
            script[first : last + 1] = 0 if i < 2 else i
        _tables.extend([lower, script])
    return _tables


class LetterWords:
    """The runs of letters of a batch of texts, and its distinct ones."""

    def __init__(self, texts: list[str]) -> None:
        lower, script = letters()
        codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), dtype=np.uint32)
        self.begin = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=self.begin[1:])
        low = lower[np.minimum(codes, _TABLE - 1)]
        # Beyond the table only the planes of ideographs hold letters.
        low = np.where((codes >= _TABLE) & (codes < 0x40000), codes, low)
        self.starts, self.ends = runs(low != 0)
        self.first = np.searchsorted(self.starts, self.begin)
        hashes = run_hashes(low, self.starts, self.ends)
        _, at, self.row = np.unique(hashes, return_index=True, return_inverse=True)
        self.size = self.ends - self.starts
        first, length = self.starts[at], self.size[at]
        self.n = len(at)
        # Distinct words, each after a zero, and a zero at the end.
        place = np.concatenate([[0], np.cumsum(length + 1)])
        self.codes = np.zeros(place[-1] + 1, dtype=np.uint64)
        inner = np.repeat(first - place[:-1] - 1, length + 1) + np.arange(place[-1])
        head = np.zeros(place[-1], dtype=bool)
        head[place[:-1]] = True
        self.codes[:-1][~head] = low[inner[~head]]
        self.word = np.repeat(np.arange(self.n), length + 1)
        self.script = script[np.minimum(codes[first], _TABLE - 1)] if self.n else script[:0]

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each order: bucket and word of the n-grams, ends of words included."""
        for order in range(1, _ORDERS + 1):
            n = len(self.codes) - order + 1
            if n <= 0:
                return
            h = np.full(n, order, dtype=np.uint64)
            good = np.ones(n, dtype=bool)
            for i in range(order):
                part = self.codes[i : i + n]
                h = mix(h + part)
                if order == 1 or 0 < i < order - 1:
                    good &= part != 0
            good[len(self.word):] = False
            at = np.flatnonzero(good)
            yield (h[at] & np.uint64(_BUCKETS - 1)).astype(np.int64), self.word[at]


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-gram buckets and, after them, of scripts, by language."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, 1):
            langs = part.column(0).to_pylist()
            texts = [x or "" for x in part.column(1).to_pylist()]
            for lang in sorted(set(langs)):
                words = LetterWords([t for t, x in zip(texts, langs, strict=True) if x == lang])
                if not words.n:
                    continue
                times = np.bincount(words.row, minlength=words.n)
                into = counts.setdefault(lang, np.zeros(_BUCKETS + _N_SCRIPTS))
                for bucket, word in words.grams():
                    into[:_BUCKETS] += np.bincount(bucket, times[word], _BUCKETS)
                into[_BUCKETS:] += np.bincount(words.script, times, _N_SCRIPTS)
    for lang, values in counts.items():
        at = np.flatnonzero(values)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
             pa.array(values[at].astype(np.int64))],
            ["lang", "at", "n"],
        )


class LanguageModel:
    """Languages, log-probabilities of n-gram buckets, and candidates by script."""

    def __init__(self, langs: list[str], table: np.ndarray, candidate: np.ndarray) -> None:
        self.langs, self.table, self.candidate = langs, table, candidate

    def word_scores(self, words: LetterWords) -> np.ndarray:
        """For each distinct word and language, 0 for the best and ``FLOOR`` at least."""
        scores = np.zeros((words.n, len(self.langs)))
        for bucket, word in words.grams():
            for i in range(len(self.langs)):
                scores[:, i] += np.bincount(word, self.table[i][bucket], words.n)
        allowed = self.candidate[words.script]
        scores = np.where(allowed, scores / _ORDERS, -np.inf)
        best = scores.max(axis=1, keepdims=True)
        scores = np.maximum(scores - np.where(np.isfinite(best), best, 0), FLOOR)
        scores[~allowed.any(axis=1)] = 0
        return scores


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fit on the whole texts of all ``rows``; those of null language are left out.

    Tasks count; the driver gets one number per n-gram bucket and language.
    """
    rows = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counted = (
        rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
        .mapInArrow(_count_task, "lang string, at int, n long")
        .groupBy("lang", "at").agg(F.sum("n").alias("n"))
    )
    with batches_of(rows.sparkSession, ROWS_AT_ONCE):
        counted = counted.toPandas()
    langs = sorted(counted["lang"].unique())
    counts = np.zeros((len(langs), _BUCKETS + _N_SCRIPTS))
    counts[counted["lang"].map(langs.index).to_numpy(int), counted["at"].to_numpy(int)] = counted["n"]
    grams, scripts = counts[:, :_BUCKETS], counts[:, _BUCKETS:]
    grams = grams + 0.5
    table = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)
    share_of = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return LanguageModel(langs, table, (share_of >= SCRIPT_SHARE).T)


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """The best path of each text; ``scores`` are those of the words of all texts, one
    after the other.  Texts are worked on side by side, word by word."""
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    starts = (np.cumsum(lengths) - lengths)[order]
    n, k = scores.shape
    best_before = np.zeros(n, dtype=np.int16)
    stay = np.zeros((n, k), dtype=bool)
    value = scores[starts].copy()
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    for t in range(1, longest):
        m = active[t]
        at = starts[:m] + t
        now = value[:m]
        top = now.max(axis=1)
        best_before[at] = now.argmax(axis=1)
        hold = now >= top[:, None] - switch
        stay[at] = hold
        value[:m] = np.where(hold, now, top[:, None] - switch) + scores[at]
    path = np.zeros(n, dtype=np.int16)
    state = value.argmax(axis=1).astype(np.int16)
    path[starts + sizes - 1] = state
    for t in range(longest - 1, 0, -1):
        m = active[t]
        at = starts[:m] + t
        ended = np.flatnonzero(sizes[:m] == t + 1)
        current = path[at]
        if len(ended):
            current[ended] = state[ended]
        path[at] = current
        held = stay[at, current]
        path[at - 1] = np.where(held, current, best_before[at])
    return path


def best_paths(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Viterbi paths of all texts.

    One language throughout is the best path if no stretch of words gains as much as
    one change costs by all other languages together; most texts are settled so.
    """
    path = np.zeros(len(scores), dtype=np.int16)
    open_texts = []
    for i in range(len(first) - 1):
        lo, hi = first[i], first[i + 1]
        if lo == hi:
            continue
        s = scores[lo:hi]
        k = int(s.sum(axis=0).argmax())
        others = np.delete(s, k, axis=1)
        path[lo:hi] = k
        if not others.shape[1]:
            continue
        gain = others.max(axis=1) - s[:, k]
        sums = np.concatenate([[0.0], np.cumsum(gain)])
        if (sums - np.minimum.accumulate(sums)).max() > switch:
            open_texts.append(i)
    if open_texts:
        at = np.concatenate([np.arange(first[i], first[i + 1]) for i in open_texts])
        lengths = np.array([first[i + 1] - first[i] for i in open_texts])
        path[at] = viterbi(scores[at], lengths, switch)
    return path


def _predict_task(shared, switch: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: LanguageModel = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                texts = [x or "" for x in part.column(1).to_pylist()]
                words = LetterWords(texts)
                scores = (
                    model.word_scores(words)[words.row]
                    if model.langs else np.zeros((len(words.row), 1))
                )
                path = best_paths(scores, words.first, switch)
                langs, score, spans = [], [], []
                for i in range(len(texts)):
                    lo, hi = words.first[i], words.first[i + 1]
                    if lo == hi or not model.langs:
                        langs.append(UNKNOWN)
                        score.append(0.0)
                        spans.append([])
                        continue
                    p, size = path[lo:hi], words.size[lo:hi]
                    letters = np.bincount(p, size, len(model.langs))
                    k = int(letters.argmax())
                    total = scores[lo:hi].sum(axis=0)
                    rest = np.delete(total, k)
                    sure = total[k] - rest.max() if len(rest) else 50.0
                    langs.append(model.langs[k])
                    share = letters[k] / letters.sum()
                    score.append(float(share / (1 + np.exp(-np.clip(sure, -50, 50)))))
                    cut = np.concatenate([[0], np.flatnonzero(np.diff(p)) + 1, [hi - lo]])
                    spans.append([
                        {"start": int(words.starts[lo + a] - words.begin[i]),
                         "end": int(words.ends[lo + b - 1] - words.begin[i]),
                         "lang": model.langs[p[a]]}
                        for a, b in zip(cut[:-1], cut[1:], strict=True)
                    ])
                kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(langs, pa.string()), pa.array(score, pa.float64()),
                     pa.array(spans, pa.list_(kind))],
                    [*part.schema.names, "lang_pred", "score", "spans"],
                )

    return run


def identify(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", switch: float = SWITCH
) -> DataFrame:
    """For each row of ``docs``: it as ``row``, ``lang_pred``, ``score`` and ``spans``.

    ``spans`` are stretches of one language (code points, end exclusive); the prediction
    is the language with most letters in them, its score (0 to 1) their share, lowered
    where another language fits nearly as well.  A text that is null, empty or without
    letters is ``und`` with score 0 and no spans, and so is every text if the model knows
    no language.  Words of a script that no language uses count for none.  Only the text
    is looked at; repeated rows are treated alike; other columns are handed on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = packed(docs, text_col)
    found = rows.mapInArrow(
        _predict_task(shared, switch),
        wider(rows, "lang_pred string, score double, "
                    "spans array<struct<start:int,end:int,lang:string>>"),
    )
    return found.select(
        F.struct(*unpacked(docs.columns, text_col)).alias("row"), "lang_pred", "score", "spans"
    )


def calibrate(
    found: DataFrame,
    keep: float = 0.999,
    margin: float = 0.5,
    text_col: str = "text",
    lang_col: str = "lang",
) -> float:
    """The score below which a text is in no language that the model knows.

    ``found`` are rows of ``identify``.  All but ``1 - keep`` of those that are labelled
    and have a letter score above the one found; ``margin`` of it is the threshold, which
    leaves clean texts of other kinds room.  Without labelled rows it is 0.  Scores count
    to six decimals, so that however many rows have a bounded number of them.
    """
    text, lang = F.col("row").getField(text_col), F.col("row").getField(lang_col)
    known = found.where(lang.isNotNull() & text.rlike(r"\p{L}"))
    least = known.agg(F.percentile(F.round("score", 6), 1 - keep)).first()[0]
    return margin * (least or 0.0)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows of which the classifier learns nothing."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2
