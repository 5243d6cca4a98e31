"""Repeated passages and phrases against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlink.llm import substring_dedup
from ledgerlink.llm.support import Scratch, maybe_listed

BLANKS = " \t\n\x0b\x0c\r"


def _words(text):
    return (text or "").encode().split()


def brute_force(rows, window=20):
    """``rows`` of id and text; n_words, n_removed, kept of each."""
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, text in rows:
        w = _words(text)
        for at in range(len(w) - window + 1):
            key = tuple(w[at : at + window])
            first[key] = min(first.get(key, (order(i), at)), (order(i), at))
    out = []
    for i, text in rows:
        w = _words(text)
        gone = set()
        for at in range(len(w) - window + 1):
            if first[tuple(w[at : at + window])] < (order(i), at):
                gone.update(range(at, at + window))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone).decode()
        out.append((len(w), len(gone), None if text is None else kept))
    return out


def _documents(rng, n=150, vocabulary=6):
    """Few words, so that windows repeat in and across documents; passages and copies."""
    passages = [" ".join(f"p{k}w{j}" for j in range(rng.randint(15, 60))) for k in range(5)]
    texts = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.randint(0, 3)
            if kind == 0:
                parts.append(rng.choice(passages))
            elif kind == 1:
                parts.append(" ".join(rng.choices("abcdef"[:vocabulary], k=rng.randint(1, 40))))
            elif kind == 2:
                parts.append(" ".join(f"u{i}x{j}" for j in range(rng.randint(1, 30))))
            else:
                parts.append(" ".join(["same"] * rng.randint(1, 70)))
        texts.append(rng.choice([" ", "\n", "\t \x0b"]).join(parts))
    texts += [texts[0], texts[1], "", None, "  \n", "x" * 5000, "é " * 50, "A b " * 15, "a b " * 15]
    return texts


@pytest.mark.parametrize("bits", [4, 12, 20])
def test_removed_words_equal_brute_force(spark, bits):
    rng = random.Random(bits)
    texts = _documents(rng)
    rows = [(i, t) for i, t in zip(rng.sample(range(10_000), len(texts)), texts, strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = substring_dedup.remove_repeats(df, counter_bits=bits).collect()
    out = {r["row"]["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in found}
    assert len(found) == len(rows)
    for (i, text), expected in zip(rows, brute_force(rows), strict=True):
        assert out[i] == expected, text
    assert sum(r["n_removed"] for r in found) > 500


def test_other_windows_and_ids(spark):
    """Ids may be text, null, or repeated; rows of equal id are ordered by a hash."""
    rng = random.Random(8)
    ids = ["a", "a", "b", None, None, "c", "c", "d"]
    rows = [(i, " ".join(rng.choices("ab", k=25))) for i in ids] * 2
    df = spark.createDataFrame(rows, "doc_id string, text string")
    hashes = dict(df.select("text", F.xxhash64("text")).collect())
    names = sorted({(i is None, i or "", hashes[t]) for i, t in rows})
    numbered = [(names.index((i is None, i or "", hashes[t])), t) for i, t in rows]
    found = substring_dedup.remove_repeats(df, window=4, anchor=2, counter_bits=10)
    expected = [(i, *rest) for (i, _), rest in zip(rows, brute_force(numbered, 4), strict=True)]
    assert sorted(map(str, expected)) == sorted(
        str((r["row"]["doc_id"], r["n_words"], r["n_removed"], r["kept"]))
        for r in found.collect()
    )


def test_estimates_are_never_too_small():
    """Every window that occurs twice is above one in a sketch, however small."""
    texts = [t.encode() for t in _documents(random.Random(1)) if t]
    for bits in (3, 8, 16):
        windows = substring_dedup.Windows(texts, 20, 10)
        places = windows.anchor_places()
        shared = b""
        for row in range(substring_dedup.ROWS):
            n = np.bincount(substring_dedup.counters(places, row, bits), minlength=2**bits)
            shared += np.packbits(n > 1, bitorder="little").tobytes()
        hot = windows.repeated(substring_dedup.Hot(shared, bits))
        a, _ = windows.hashes(np.arange(len(windows.starts)))
        _, back, count = np.unique(a, return_inverse=True, return_counts=True)
        assert hot[count[back] > 1].all()
        assert bits == 3 or not hot.all()


def test_steps_of_counters_round_trip():
    rng = np.random.default_rng(2)
    for numbers in ([], [0], [65535], [65534, 65535, 65536, 2**20 - 1], [0, 2**20 - 1],
                    np.unique(rng.integers(0, 2**20, 500))):
        numbers = np.array(numbers, dtype=np.uint32)
        back = substring_dedup._decoded(substring_dedup._coded(numbers))
        assert back.tolist() == numbers.tolist()


def test_odd_tables(spark, odd, clashing, empty):
    assert substring_dedup.remove_repeats(empty).collect() == []
    for df in (odd, clashing):
        found = substring_dedup.remove_repeats(df).collect()
        hashes = dict(df.select("text", F.xxhash64("text")).collect())
        key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, hashes[r["text"]])
        rows = df.collect()
        names = sorted({key(r) for r in rows})
        rows = [(names.index(key(r)), r["text"]) for r in rows]
        expected = sorted(map(str, brute_force(rows)))
        assert sorted(str((r["n_words"], r["n_removed"], r["kept"])) for r in found) == expected


def test_rows_off_the_bitmap_are_not_listed(spark):
    rows = spark.range(5000).select("id", F.lit("x").alias("_bits"), F.lit(1).alias("_listed"))
    listed = Scratch(spark, "listed").store(spark.range(0, 5000, 7).select(F.col("id").alias("n")))
    for bits in (16, 27):
        hits, rest = maybe_listed(rows, F.xxhash64("id"), listed, F.xxhash64("n"), bits)
        got, off = ({r["id"] for r in part.collect()} for part in (hits, rest))
        assert got | off == set(range(5000)) and not got & off
        assert set(range(0, 5000, 7)) <= got and len(got) < 900


def _pieces(text):
    import re

    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w]
            for p in re.split(r"[.,;:!?\x0a-\x0d]", lowered)]


def brute_phrases(rows, least, depth=4, top=2000, covered=80):
    out = []
    for lang in sorted({r[0] or "und" for r in rows}):
        f, n = {}, 0
        for of, text in rows:
            if (of or "und") != lang:
                continue
            for w in _pieces(text):
                n += len(w)
                for k in range(1, depth + 1):
                    for i in range(len(w) - k + 1):
                        key = tuple(w[i : i + k])
                        f[key] = f.get(key, 0) + 1
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in some.items():
            if any(len(q) > len(p) and 100 * b >= covered * a
                   and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in some.items()):
                continue
            score, _, left, right = min(
                (2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]])
                for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return out


def _prose(rng, n):
    names = ["new york", "New York City", "a b c d", "of the", "é ü ß"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(rng.choice(names) if rng.random() < 0.5
                         else " ".join(rng.choices("abcdefgh", k=rng.randint(1, 6))))
            parts.append(rng.choice([" ", "  ", "\t", ". ", ",", "\n", "!?"]))
        rows.append((rng.choice(["en", "en", "de", None, "und"]), "".join(parts)))
    return [*rows, ("en", None), ("fr", ""), ("en", "same " * 50), ("de", "..,;")]


@pytest.mark.parametrize("shard_bytes", [1, 300, 8_000_000])
def test_phrases_equal_brute_force(spark, monkeypatch, shard_bytes):
    from ledgerlink.llm import phrases

    monkeypatch.setattr(phrases, "BUCKET", {1: 20, 300: 100}.get(shard_bytes, 500_000))
    rows = _prose(random.Random(shard_bytes), 120)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    df = df.withColumns({c: F.lit(1) for c in ("phrase", "words", "shard", "n")})
    found = phrases.collocations(df, least=5, shard_bytes=shard_bytes).collect()
    expected = brute_phrases(rows, 5)
    assert len(expected) > 60
    assert sorted(tuple(r) for r in found) == expected
    few = phrases.collocations(df, least=5, top=3, covered=50).collect()
    assert sorted(tuple(r) for r in few) == brute_phrases(rows, 5, top=3, covered=50)


def test_intervals_count_every_run():
    """Left and right extensions agree with the runs counted one by one."""
    from ledgerlink.llm import phrases

    rng = random.Random(4)
    texts = [" ".join(rng.choices("abc", k=rng.randint(0, 30))) + rng.choice([".", " ", ", d"])
             for _ in range(40)]
    shard = phrases.Shard([t.encode() for t in texts])
    index = phrases.Index.of(shard)
    expected = {}
    for t in texts:
        for w in _pieces(t):
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    expected[tuple(w[i : i + k])] = expected.get(tuple(w[i : i + k]), 0) + 1
    for order in ((False, True, False), (True, True, True), (False, False, False), (True, False, True)):
        runs, got = index.words(), {}
        for left in (None, *order):
            runs = runs if left is None else index.extended(runs, left)
            for spelt, n in zip(runs.spelt.tolist(), runs.size.tolist(), strict=True):
                got[tuple(shard.vocabulary[w - 1] for w in spelt)] = n
        assert got == expected


def test_phrases_of_odd_tables(spark, odd, empty):
    from ledgerlink.llm import phrases

    assert phrases.collocations(empty).collect() == []
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    found = phrases.collocations(odd, least=2, top=50).collect()
    expected = brute_phrases([r for r in rows if len(r[1] or "") < 1000], 2)
    assert {tuple(r)[2] for r in found if r["lang"] == "und"} == {
        e[2] for e in expected if e[0] == "und"}
    assert max(r["rank"] for r in found) <= 50
