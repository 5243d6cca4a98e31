"""Near-duplicate texts and vectors against all pairs; the pipeline."""

import random
import re
import subprocess
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlink.llm import embedding_dedup, near_dedup
from ledgerlink.llm.sketch import Sketcher, mix
from ledgerlink.llm.support import Scratch, components
from ledgerlink.sources.store import scratch_root

SYLLABLES = ["ka", "lo", "mi", "ter", "un", "das", "pre", "vo", "shi", "ran", "el", "qu"]


def words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def _labels(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def _set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_force(texts, percent=85):
    sets = [_set(t) for t in texts]
    links = [(i, j) for j in range(len(sets)) for i in range(j) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return [len(s) for s in sets], _labels(len(sets), links)


def _copies():
    """Groups of copies with a few words changed, larger than a small bucket."""
    rng = random.Random(9)
    texts = []
    for size, length in ((40, 120), (30, 60), (3, 400), (60, 200)):
        base = words(rng, length)
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(length)] = "".join(words(rng, 1))
            texts.append(" ".join(copy))
    texts += [texts[0]] * 20 + ["", "  ", "a b", "A  b", "a b c", None, "x\0y z"]
    return texts


def test_words_of_mirrored_letters_are_no_copies(spark):
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba")))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_duplicates(df).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in found) == [
        (1, 1, True), (2, 2, True)]


def test_deduplicate_keeps_the_rows_that_are_kept(spark):
    """Repeated and null ids, rows off the bitmap: the rows that brute force keeps."""
    texts = _copies()
    rows = [(i % 90 if i % 11 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_id", F.lit("x"))
    found = near_dedup.near_duplicates(df).where("kept").select("doc_id", "node").collect()
    kept = near_dedup.deduplicate(df)
    assert kept.columns == ["doc_id", "text", "_id"]
    blank = [r for r in found if r["node"] is None]
    others = {(r["doc_id"], bytes(r["node"])) for r in found if r["node"] is not None}
    got = [(r["doc_id"], near_dedup.node_of((r["text"] or "").encode())) for r in kept.collect()]
    assert sorted(map(str, (g for g in got if g[1]))) == sorted(map(str, others))
    assert sum(g[1] is None for g in got) == len(blank)


def test_components_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    texts = _copies()
    rng = random.Random(2)
    ids = rng.sample(range(1000), len(texts))
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    sizes, labels = brute_force(texts)
    least = {}
    for i, label in enumerate(labels):
        least[label] = min(least.get(label, 10**9), ids[i])
    out = {r["doc_id"]: r for r in near_dedup.near_duplicates(df.repartition(3)).collect()}
    for i, label in enumerate(labels):
        row = out[ids[i]]
        assert (row["n_shingles"], row["component_id"]) == (sizes[i], least[label]), texts[i]
        assert row["kept"] == (ids[i] == least[label])
    kept = near_dedup.deduplicate(df).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(least.values()))


def test_near_dedup_odd_rows(odd, clashing, empty):
    rows = near_dedup.near_duplicates(clashing).collect()
    assert len(rows) == odd.count()
    kept = near_dedup.deduplicate(clashing)
    assert kept.columns == clashing.columns
    ids = sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect())
    # 4, 4, 5 and one null id have equal words; 6 and 7 nearly.
    assert ids == sorted(map(str, [1, 2, 3, 4, 6, 8, 9, 10, None]))
    assert near_dedup.deduplicate(empty).collect() == []


def test_coordinates_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(1)
    sketcher = Sketcher(24, 5)
    found, true = [], []
    for _ in range(60):
        common, own = rng.integers(1, 400), rng.integers(0, 80, 2)
        numbers = mix(rng.integers(1, 2**62, common + own.sum()).astype(np.uint64))
        a, b = numbers[: common + own[0]], np.r_[numbers[:common], numbers[common + own[0]:]]
        ca, cb = sketcher.coordinates([np.unique(a), np.unique(b)])
        found.append((ca == cb).mean())
        true.append(common / (common + own.sum()))
    assert np.abs(np.array(found) - np.array(true)).max() < 0.2
    assert abs(np.mean(np.array(found) - np.array(true))) < 0.02
    one = sketcher.coordinates([np.array([5], dtype=np.uint64)])[0]
    assert (one != np.uint64(2**64 - 1)).all()


def test_components_of_a_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    labels = components(Scratch(spark, "test"), edges).collect()
    assert len(labels) == 301 and {r["label"] for r in labels} == {0}


def _vectors(seed, n=400, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for centre in range(0, 60, 3):
        for k in range(rng.integers(1, 12)):
            x[60 + (centre * 12 + k) % (n - 60)] = x[centre] + rng.normal(size=dim) * rng.choice(
                [0.0, 0.02, 0.1, 0.25])
    return x.astype(np.float32)


@pytest.mark.parametrize("seed, block", [(0, 64), (1, 1000), (2, 37)])
def test_links_equal_all_pairs(spark, seed, block):
    x = _vectors(seed)
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16,
           [None] + [1.0] * 15, [1.0] * 8, [2.0] * 8]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, v) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    unit = x.astype(float)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    labels = _labels(len(x), [(i, j) for i, j in np.argwhere(near) if i < j])
    out = {r["vec_id"]: r for r in embedding_dedup.near_vectors(df, block=block).collect()}
    assert len(out) == len(rows)
    for i in range(len(x)):
        assert (out[i]["n_links"], out[i]["component_id"]) == (near[i].sum(), labels[i])
    assert [out[1000 + i]["n_links"] for i in range(8)] == [0] * 6 + [1, 1]
    assert out[1007]["component_id"] == 1006 and not out[1007]["kept"]


@pytest.mark.parametrize("max_pivots", [1, 2, 512])
def test_more_lengths_than_pivots(spark, max_pivots):
    """Every length is compared within itself, whether it has a pivot or not."""
    rng = np.random.default_rng(4)
    rows, expected = [], {}
    for dim in range(1, 30):
        x = rng.normal(size=(12, dim))
        x[6:] = x[:6] + rng.normal(size=(6, dim)) * 0.1
        unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        near = unit @ unit.T >= 0.9
        np.fill_diagonal(near, False)
        labels = _labels(12, [(i, j) for i, j in np.argwhere(near) if i < j])
        for i, v in enumerate(x):
            rows.append((100 * dim + i, v.tolist(), "x", 1))
            expected[100 * dim + i] = int(near[i].sum()), 100 * dim + labels[i]
    # Columns with the names that the operator uses inside.
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, k string, cell int")
    df = df.withColumns({c: F.lit(2) for c in ("id", "dim", "vector", "part", "n_links")})
    for block in (4, 4096):
        found = embedding_dedup.near_vectors(df, block=block, max_pivots=max_pivots).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == expected


def test_tree_covers_its_rows():
    x = _vectors(3)
    tree = embedding_dedup.CoverTree(x)
    unit = embedding_dedup.unit(x)[tree.order]
    assert sorted(tree.order) == list(range(len(x)))
    for lo, hi, radius in zip(tree.lo, tree.hi, tree.radius, strict=True):
        for a, b, r in zip(lo, hi, radius, strict=True):
            assert embedding_dedup.chord(unit[a:b] @ unit[a]).max() <= r + 1e-7


def test_forest_covers_its_rows():
    x = [_vectors(3), _vectors(4, n=90), _vectors(5, n=61)]
    trees = [embedding_dedup.CoverTree(v) for v in x]
    forest = embedding_dedup.Forest(trees)
    unit = np.concatenate([embedding_dedup.unit(v)[t.order] for v, t in zip(x, trees)])
    for level in range(8):
        lo, radius, child = forest.level(level)
        assert lo[0] == 0 and lo[-1] == len(unit) and len(lo) == len(radius) + 1 == len(child)
        for a, b, r in zip(lo[:-1], lo[1:], radius, strict=True):
            assert embedding_dedup.chord(unit[a:b] @ unit[a]).max() <= r + 1e-7
        below = forest.level(level + 1)[0]
        assert (below[child] == lo).all()


@pytest.mark.parametrize("directions", [None, 1, 7, 15])
@pytest.mark.parametrize("spread", [0.02, 0.1, 0.25])
def test_dual_equals_all_pairs(directions, spread, monkeypatch):
    """Whatever the directions are, and with nodes of several tiles and slices."""
    monkeypatch.setattr(embedding_dedup, "_TILE", 16)
    monkeypatch.setattr(embedding_dedup, "_PAIRS", 50)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 16))
    x[100:220] = x[0] + rng.normal(size=(120, 16)) * spread
    x[220:260] = x[:40]
    x = rng.permutation(x).astype(np.float32)
    basis = None if directions is None else np.linalg.qr(rng.normal(size=(16, 16)))[0][:, :directions]
    sides, order = [], []
    for part in (np.arange(170), np.arange(170, 300)):
        trees = [embedding_dedup.CoverTree(x[p]) for p in np.array_split(part, 3)]
        rows = np.concatenate([p[t.order] for p, t in zip(np.array_split(part, 3), trees)])
        sides.append(embedding_dedup.Side(
            embedding_dedup.Forest(trees), embedding_dedup.unit(x[rows]), basis))
        order.append(rows)
    unit = embedding_dedup.unit(x)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    for one, rows in zip(sides, order, strict=True):
        counts, labels = embedding_dedup.Dual(one, None, 0.9).result()
        assert (counts[0] == near[np.ix_(rows, rows)].sum(axis=1)).all()
        links = np.argwhere(near[np.ix_(rows, rows)]).tolist()
        assert labels[0].tolist() == _labels(len(rows), links)
    counts, labels = embedding_dedup.Dual(*sides, 0.9).result()
    across = near[np.ix_(*order)]
    assert (counts[0] == across.sum(axis=1)).all() and (counts[1] == across.sum(axis=0)).all()
    found = np.concatenate(labels)
    for i, j in np.argwhere(across):
        assert found[i] == found[170 + j]
    whole = np.array(_labels(300, np.argwhere(near[np.ix_(*[np.concatenate(order)] * 2)]).tolist()))
    assert (whole[found] == whole).all()


def test_cells_make_groups():
    share = {3: 0.5, 0: 0.5, 1: 2.5, 2: 0.1, -1: 0.2, -2: 0.8}
    layout, groups = embedding_dedup._layout(share, [3, 0, 2, 1])
    assert layout == {3: (0, 1), 0: (0, 1), 2: (1, 1), 1: (2, 3), -2: (5, 1), -1: (5, 1)}
    assert groups == 6
    assert embedding_dedup._layout({}, []) == ({}, 0)


def test_groups_far_apart_are_not_compared():
    """Cells on axes are 1.41 apart: near if 0.45 and both radii are more."""
    by_dim = {4: (np.array([0, 2, 3]), np.eye(4)[[0, 1, 2]]), 5: (np.array([1]), np.eye(5)[:1])}
    assert sorted(embedding_dedup._in_order(by_dim)) == [0, 1, 2, 3]
    entries = [(0, 0, 0.1), (1, 0, 0.2), (2, 2, 0.1), (3, 3, 0.9), (3, 1, 2.0), (4, -1, 2.0),
               (5, -1, 2.0), (6, -2, 2.0)]
    near = embedding_dedup._near_cells(by_dim, entries, 0.45, 7)
    pairs = {(i, j) for i, j in np.argwhere(near).tolist() if i < j}
    assert near.diagonal().all() and pairs == {(0, 1), (0, 3), (1, 3), (2, 3), (4, 5)}


def _most_on_disk(spark, vectors, **sizes):
    """Bytes that shuffles and scratch tables of a call take at most, and its links."""
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    folders = [d.getPath() for d in env.blockManager().diskBlockManager().localDirs()]
    folders.append(scratch_root(spark))

    def held():
        found = subprocess.run(["du", "-scb", *folders], capture_output=True, text=True)
        return int(found.stdout.split()[-2])

    before, seen, over = held(), [], threading.Event()

    def watch():
        while not over.wait(0.05):
            seen.append(held())

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        rows = embedding_dedup.near_vectors(vectors, **sizes).collect()
    finally:
        over.set()
        watcher.join()
    return max(seen) - before, sum(r["n_links"] for r in rows)


def test_disk_follows_the_vectors(spark):
    """Vectors far apart, where each block is compared with each other."""
    x = np.random.default_rng(9).normal(size=(6000, 48)).astype(np.float32)
    x[3000:3100] = x[:100] * 2
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                               "vec_id long, embedding array<float>")
    held, links = _most_on_disk(spark, df, block=64)
    assert links == 200
    assert held < 8 * x.nbytes


def test_groups_of_several_jobs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "_JOB_GROUPS", 2)
    monkeypatch.setattr(embedding_dedup, "_JOB_PAIRS", 3)
    x = _vectors(6)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                               "vec_id long, embedding array<float>")
    unit = embedding_dedup.unit(x)
    links = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    found = embedding_dedup.near_vectors(df, block=16).collect()
    assert {r["vec_id"]: r["n_links"] for r in found} == dict(enumerate(links.tolist()))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [spark.conf.get(n) for n in names] == ["134217728b", "1000"]


def test_vectors_without_rows(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, k int, id int")
    assert embedding_dedup.near_vectors(df).collect() == []
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.1])],
                                  "vec_id long, embedding array<double>")
    rows = embedding_dedup.near_vectors(twice).collect()
    assert [r["n_links"] for r in rows] == [2, 2, 2]
    assert {r["component_id"] for r in rows} == {1}


def test_pipeline_stages(spark, docs, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "line dedup", "MinHash near-dedup",
                     "benchmark decontamination", "packing"]
    sf_dir = "/root/testdata/sf0.001"
    frames = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, frames[-1], sf_dir).write.parquet(f"{tmp_path}/{i}")
        frames.append(spark.read.parquet(f"{tmp_path}/{i}"))
        assert frames[-1].columns == docs.columns
    texts = [{r["doc_id"]: r["text"] for r in f.collect()} for f in frames]
    assert set(texts[1]) == {i for i, t in texts[0].items() if any(c.isalpha() for c in t or "")}
    assert set(texts[2]) == set(texts[1])
    order = sorted(texts[2])
    _, labels = brute_force([texts[2][i] for i in order], 80)
    assert sorted(texts[3]) == [i for at, i in enumerate(order) if labels[at] == at]
    assert set(texts[4]) <= set(texts[3])
    assert frames[4].where("n_chars <> length(text)").isEmpty()
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == set(texts[4])


def test_pipeline_odd_rows(spark, odd, empty, tmp_path):
    for name, frame in (("odd", odd), ("none", empty)):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, frame, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{name}{i}")
            frame = spark.read.parquet(f"{tmp_path}/{name}{i}")
        if name == "none":
            assert frame.isEmpty()


def test_documents_stay_where_no_language_is_known(spark, odd, sf_dir):
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.keep_known_languages(spark, unlabelled, sf_dir).collect()
    expected = [r for r in unlabelled.collect() if r["text"] and any(c.isalpha() for c in r["text"])]
    assert expected and sorted(map(str, kept)) == sorted(map(str, expected))
