"""Language ID, toxicity, secrets, packing and decontamination against brute force."""

import base64
import bz2
import gzip
import io
import lzma
import random
import re
import tarfile
import urllib.parse
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlink.llm import decontamination, language_id, packing, secret_scan, toxicity
from ledgerlink.llm.queries import op3_language_id, op5_toxicity, tokenizer_path
from ledgerlink.llm.support import Scratch

SF = "/root/testdata/sf0.01"


def test_held_out_languages_are_found(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = op3_language_id(spark, SF).where("held_out").join(truth, "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_spans_of_mixed_text(spark, docs):
    model = language_id.train(docs)
    pick = {r["lang"]: r["text"] for r in docs.where("n_chars BETWEEN 400 AND 900").collect()}
    parts = [pick["en"], pick["de"], pick["fr"]]
    text = "\n".join(parts)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = language_id.identify(df, model).first()["spans"]
    share = 0
    at = 0
    for part, lang in zip(parts, ("en", "de", "fr"), strict=True):
        share += sum(max(0, min(s["end"], at + len(part)) - max(s["start"], at))
                     for s in spans if s["lang"] == lang)
        at += len(part) + 1
    assert share > 0.9 * len(text)


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(60):
        lengths = rng.integers(1, 6, rng.integers(1, 5))
        scores = -rng.random((lengths.sum(), 3)) * 4
        first = np.concatenate([[0], np.cumsum(lengths)])
        for switch in (0.5, 2.0):
            path = language_id.best_paths(scores, first, switch)
            slow = language_id.viterbi(scores, lengths, switch)
            for a, b in zip(first[:-1], first[1:], strict=True):
                value = lambda p: scores[np.arange(a, b), p].sum() - switch * (
                    np.diff(p) != 0).sum()
                grid = np.stack(np.meshgrid(*[range(3)] * (b - a), indexing="ij"), -1)
                best = max(value(p) for p in grid.reshape(-1, b - a))
                assert value(path[a:b]) == pytest.approx(best)
                assert value(slow[a:b]) == pytest.approx(best)


def test_languages_are_learned_from_all_rows(spark):
    # Of 45,000 rows a sample of 20,000 by hash knew no more than half of the rare languages.
    rows = spark.range(45_000).selectExpr(
        "id AS doc_id", "'the cat sat' AS text",
        "CASE WHEN id < 40 THEN concat('l', id) ELSE 'en' END AS lang")
    langs = language_id.train(rows).langs
    assert sorted(langs) == sorted(["en", *(f"l{i}" for i in range(40))])


def test_least_score_is_taken_from_all_labelled_rows(spark):
    found = spark.range(20_000).selectExpr(
        "struct(id AS doc_id, 'a word' AS text, 'en' AS lang) AS row", "id / 20000 AS score")
    others = spark.range(9_000).selectExpr(
        "struct(id AS doc_id, if(id % 2 = 0, 'a word', '1 2') AS text, "
        "if(id % 2 = 0, null, 'en') AS lang) AS row", "0D AS score")
    assert language_id.calibrate(found.unionByName(others)) == pytest.approx(0.5 * 19.999 / 20_000)
    assert language_id.calibrate(others) == 0


def test_language_odd_rows(odd, clashing, empty):
    model = language_id.train(odd)
    rows = language_id.identify(clashing, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        text = r["row"]["text"] or ""
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text))
        assert 0 <= r["score"] <= 1
    assert language_id.identify(empty, language_id.train(empty)).collect() == []


def test_held_out_toxicity(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op5_toxicity(spark, SF).where("held_out").join(labels, "doc_id").collect()
    bad = [r["score"] for r in rows if r["toxic"] == 1]
    good = [r["score"] for r in rows if r["toxic"] == 0]
    wins = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert wins > 0.8


def test_inserted_and_spaced_letters_stay_close():
    rng = random.Random(3)
    letters = "abcdeghiklmnoprstu"
    clean = list({"".join(rng.choices(letters, k=rng.randint(3, 10))) for _ in range(800)})
    weights, bias = toxicity.fit_sentences(["idiot", "stupid", "loser"], clean)

    def value(text):
        words = toxicity.PlainWords([text])
        return (words.scores(weights)[words.row] + bias).max()

    usual = np.quantile([value(w) for w in clean], 0.99)
    for form in ("IDIOT", "i.d.i.o.t", "id1ot", "i d i o t", "idxiot", "stuupid", "l0ser***"):
        assert value(form) > usual, form


def test_toxicity_odd_rows(spark, odd, clashing, empty):
    rows = [(i, i % 2) for i in range(1, 11)] + [(None, 1), (4, None)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    scored = toxicity.toxicity(clashing, model).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.train(empty, labels) is None
    assert toxicity.toxicity(empty, None).collect() == []


def _gap_kernel(one, other):
    """The kernel of two stretches of words, from the subsequences themselves."""
    import itertools

    def features(word):
        padded, out = f"^{word}^", {}
        for size, most in ((3, 2), (4, 1), (5, 1)):
            for span in range(size, size + most + 1):
                for at in range(len(padded) - span + 1):
                    part = padded[at : at + span]
                    for inner in itertools.combinations(range(1, span - 1), size - 2):
                        key = part[0] + "".join(part[i] for i in inner) + part[-1]
                        out[size, key] = out.get((size, key), 0) + 0.5 ** (span - size)
        return out

    def plain(word):
        """The norm takes each occurrence by itself, as the operator does."""
        padded, total = f"^{word}^", 0
        for size, most in ((3, 2), (4, 1), (5, 1)):
            for span in range(size, size + most + 1):
                gaps = len(list(itertools.combinations(range(1, span - 1), size - 2)))
                total += gaps * max(0, len(padded) - span + 1) * 0.25 ** (span - size)
        return total**0.5

    total = 0
    for a in one.split():
        for b in other.split():
            fa, fb = features(a), features(b)
            dot = sum(v * fb.get(k, 0) for k, v in fa.items())
            total += dot / (plain(a) * plain(b))
    return total / (len(one.split()) * len(other.split())) ** 0.5


def test_folded_landmarks_are_the_gap_kernel():
    stretches = ["stupid", "stxupid fool", "you are a stupid fool", "kind words", "idiot idiot",
                 "st upid", "wonderful"]
    vectors = toxicity.sentence_vectors(stretches).astype(float)
    for i, one in enumerate(stretches):
        for j, other in enumerate(stretches):
            # Features share 65,536 buckets, so a little more may agree.
            assert abs(vectors[i] @ vectors[j] - _gap_kernel(one, other)) < 0.02, (one, other)
    # The weights that the machine is folded into give the value of the kernel machine.
    weights, bias = toxicity.fit_sentences(stretches[:3], stretches[3:4] + ["good day to you"])
    words = toxicity.Sentences([" ".join(stretches)])
    by_word = words.scores(weights)[words.row]
    sizes = dict(zip(toxicity.STRETCHES, words.values(by_word), strict=True))
    direct = toxicity.sentence_vectors(["stupid", "stxupid fool"]) @ weights
    assert abs(sizes[1][0] - direct[0]) < 1e-4 and abs(sizes[2][1] - direct[1]) < 1e-4


def test_labels_that_contradict_each_other_teach_nothing(spark):
    docs = spark.createDataFrame(
        [(i, ("you idiot" if i % 2 else "good day") + f" word{i % 7}.") for i in range(40)],
        "doc_id long, text string")
    rows = [(i, i % 2) for i in range(40)]
    wrong = [(i, 1 - i % 2) for i in range(0, 40, 4)]
    both = spark.createDataFrame(rows + rows[:5] + wrong, "doc_id long, toxic int")
    agreed = spark.createDataFrame([r for r in rows if r[0] % 4], "doc_id long, toxic int")
    one, other = (toxicity.train(docs, labels) for labels in (both, agreed))
    assert (one.weights == other.weights).all() and (one.scale == other.scale).all()
    contradicted = spark.createDataFrame(rows + [(i, 1 - y) for i, y in rows], "doc_id long, toxic int")
    assert toxicity.train(docs, contradicted) is None


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A)


def test_base_secrets_equal_the_definition(docs):
    texts = [r["text"] for r in docs.collect()] + [
        'Token: "abcdefgh12" api_key=short PASSWORD = x secret=token:abcdefgh',
        "AKIAABCDEFGHIJKL AKIA123 " + "0123456789abcdef" * 3 + "ß passwd=longenough", "", "ſecret=abcdefghi",
    ]
    for text in texts:
        expected = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        expected += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
                     if len(m[0]) >= 16]
        expected += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text)
                     if len(m[0]) >= 32]
        order = sorted(expected, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))
        spans, complete = secret_scan.scan_text(text)
        assert [s[:3] for s in spans if s[3] == ""] == order and complete


def _wrap(how, text):
    if how == "base64":
        return base64.b64encode(text.encode()).decode()
    if how == "gzip":
        return base64.b64encode(gzip.compress(text.encode())).decode()
    if how == "zlib":
        return base64.urlsafe_b64encode(zlib.compress(text.encode())).decode()
    if how == "percent":
        return "".join(f"%{b:02X}" for b in text.encode())
    return "".join(f"\\u{ord(c):04x}" for c in text)


@pytest.mark.parametrize("layers", [
    ["base64"], ["percent"], ["unicode"], ["gzip"], ["zlib"], ["base64", "percent"],
    ["unicode", "gzip"], ["base64", "base64", "base64"], ["percent", "unicode", "base64"],
])
def test_nested_layers_are_unwrapped_and_mapped(layers):
    inner = "token = abcdefgh12345678"
    for how in layers:
        inner = _wrap(how, inner)
    text = f"ünrelated wörds {inner} and more"
    spans, complete = secret_scan.scan_text(text)
    assert complete
    found = [s for s in spans if s[0] == "assign"]
    assert found, spans
    start, end = text.index(inner), text.index(inner) + len(inner)
    assert start <= found[0][1] < found[0][2] <= end


@pytest.mark.parametrize("layers", [["base64"], ["gzip"], ["base64", "base64"], ["zlib", "percent"]])
def test_every_place_of_a_repeated_layer_is_found(layers):
    inner = "token = abcdefgh12345678"
    for how in layers:
        inner = _wrap(how, inner)
    text = f"first {inner} then {inner} and 100% {inner} end"
    spans, complete = secret_scan.scan_text(text)
    starts = [m.start() for m in re.finditer(re.escape(inner), text)]
    assert complete and len(starts) == 3
    for start in starts:
        assert any(start <= a < b <= start + len(inner) for _, a, b, _ in spans), spans
    assert secret_scan._redacted(text, spans, "*").count(inner) == 0


SECRET = "token = abcdefgh12345678"


@pytest.mark.parametrize("pack", [bz2.compress, zlib.compress, lambda b: gzip.compress(bz2.compress(b))])
@pytest.mark.parametrize("extra", ["", " 100% "])
def test_a_bomb_hides_no_other_secret(pack, extra):
    bomb = base64.b64encode(pack(bytes(70_000_000))).decode()
    text = f"{extra}{_wrap('base64', SECRET)} {bomb} {_wrap('gzip', SECRET)}"
    spans, complete = secret_scan.scan_text(text)
    assert complete and [s[0] for s in spans] == ["assign", "assign"]


def test_long_packed_layers_are_scanned_to_their_end():
    filler = "just a line of words, and one more\n" * 1_900_000
    inner = _wrap("base64", SECRET)
    blob = base64.b64encode(bz2.compress(f"{filler}{inner}\n{filler[:500]}".encode())).decode()
    spans, complete = secret_scan.scan_text(f"see {blob} twice {blob} end")
    assert complete and [s[:3] for s in spans] == [
        ("assign", 4, 4 + len(blob)), ("assign", 11 + len(blob), 11 + 2 * len(blob))]


def test_windows_cut_nothing(monkeypatch):
    for name, value in (("MAX_UNPACKED", 4000), ("WINDOW", 500), ("OVERLAP", 60)):
        monkeypatch.setattr(secret_scan, name, value)
    for at in range(4300, 5400, 7):
        for inner in (SECRET, _wrap("percent", SECRET), _wrap("base64", SECRET + "." * 900)):
            long = "so it, goes " * (at // 12) + "." * (at % 12) + f" {inner} " + "it, goes " * 90
            blob = base64.b64encode(zlib.compress(long.encode())).decode()
            assert [s[:3] for s in secret_scan.scan_text(blob)[0]] == [("assign", 0, len(blob))], at


def test_endless_unpacking_is_marked(monkeypatch):
    monkeypatch.setattr(secret_scan, "MAX_UNPACKED", 4000)
    monkeypatch.setattr(secret_scan, "MAX_STREAMED", 50_000)
    bomb = base64.b64encode(zlib.compress(b"all the same, " * 10_000)).decode()
    spans, complete = secret_scan.scan_text(f"{bomb} {_wrap('gzip', SECRET)}")
    assert not complete and [s[0] for s in spans] == ["assign"]


def test_many_packings_are_opened():
    data = SECRET.encode()
    for _ in range(150):
        data = gzip.compress(data)
    spans, complete = secret_scan.scan_text(base64.b64encode(data).decode())
    assert complete and [s[0] for s in spans] == ["assign"]


def _lines_of(blob, width, end="\n"):
    return end.join(blob[i : i + width] for i in range(0, len(blob), width))


@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
@pytest.mark.parametrize("frame", [
    "{}", "-----BEGIN CERTIFICATE-----\n{}\n-----END CERTIFICATE-----", "AttachmentFollowsHere\n{}\nThanks for all"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress, bz2.compress, lzma.compress])
def test_wrapped_base64_is_joined(end, frame, pack):
    long = "".join(f"line {i * 7919 % 1000}\n" for i in range(30))
    for encode, n in ((base64.b64encode, 76), (base64.b64encode, 64), (base64.urlsafe_b64encode, 20)):
        for size in (0, 1, 2, 3):
            data = pack((long + "." * size + SECRET * 3).encode())
            blob = _lines_of(encode(data).decode().rstrip("="), n, end)
            text = "see\n" + frame.format(blob)
            spans, complete = secret_scan.scan_text(text)
            start = text.index(blob)
            whole = [s for s in spans if s[1] <= start + 4 and s[2] >= start + len(blob) - n]
            assert complete and whole and whole[0][0] == "assign", (n, size, spans)


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress])
@pytest.mark.parametrize("quote", [
    urllib.parse.quote, urllib.parse.quote_plus, lambda b: "".join(f"%{x:02x}" for x in b)])
def test_packed_bytes_in_percent_signs_are_opened(pack, quote):
    data = quote(pack(f"some words and {SECRET}".encode()))
    text = f"see http://a.b/c?q={data} end"
    spans, complete = secret_scan.scan_text(text)
    start = text.index(data)
    assert complete and any(s[3] == "percent>packed" for s in spans), spans
    assert all(s[0] == "assign" and start <= s[1] < s[2] <= start + len(data) for s in spans)


def test_bytes_that_are_not_utf8_hide_nothing():
    for raw in (b"\xe4", b"\xff\xfe", b"\xc3", "ä".encode() + b"\xe4"):
        run = "".join(f"%{x:02X}" for x in raw + SECRET.encode() + raw)
        spans, complete = secret_scan.scan_text(f"so {run} end")
        assert complete and [s[:3] for s in spans] == [("assign", 3, 3 + len(run))]


def _tar_gz(data):
    held = io.BytesIO()
    with tarfile.open(fileobj=held, mode="w:gz") as tar:
        info = tarfile.TarInfo("config/settings.ini")
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))
    return held.getvalue()


_WORDS = b" ".join(b"word%d" % (i * 7919 % 1000) for i in range(400))
_BINARY = {
    "latin-1": b"caf\xe9 " + SECRET.encode(),
    "tar.gz": _tar_gz(SECRET.encode()),
    "padded with nulls": SECRET.encode() + bytes(200),
    "utf-16": SECRET.encode("utf-16"),
    "utf-16 big-endian": SECRET.encode("utf-16-be"),
    "cut gzip": gzip.compress(SECRET.encode() + b" " + _WORDS)[:-30],
    "broken gzip": gzip.compress(SECRET.encode() + b" " + _WORDS)[:-300] + b"\0" * 50,
    "second member": gzip.compress(b"nothing here") + gzip.compress(SECRET.encode()),
    "third member": b"".join(gzip.compress(x) for x in (b"a", b"", SECRET.encode())),
    "second bzip2 stream": bz2.compress(b"nothing") + bz2.compress(SECRET.encode()),
    "second xz stream": lzma.compress(b"nothing") + lzma.compress(SECRET.encode()),
    "bytes around": bytes(range(128, 256)) + SECRET.encode() + bytes(range(128, 256)),
}


@pytest.mark.parametrize("name", _BINARY)
def test_layers_that_are_no_plain_text_are_scanned(name):
    blob = base64.b64encode(_BINARY[name]).decode()
    spans, complete = secret_scan.scan_text(f"see {blob} end")
    assert complete and [s[:3] for s in spans] == [("assign", 4, 4 + len(blob.rstrip("=")))] or [
        s[:3] for s in spans] == [("assign", 4, 4 + len(blob))], spans


@pytest.mark.parametrize("before", ["https://x.io/a/", "cfg_", "x/", "k=", "abc", "ab/cd_", "a-b-c-"])
@pytest.mark.parametrize("data", [SECRET.encode(), gzip.compress(SECRET.encode())])
def test_base64_is_found_behind_letters_it_could_have(before, data):
    for more in range(4):
        blob = base64.b64encode(data).decode()
        text = f"so {before}{'q' * more}{blob} end"
        spans, complete = secret_scan.scan_text(text)
        start = text.index(blob)
        assert complete and spans, (before, more)
        assert all(s[1] <= start and s[2] >= start + len(blob.rstrip("=")) for s in spans)


def test_members_of_long_packed_layers(monkeypatch):
    for name, value in (("MAX_UNPACKED", 4000), ("WINDOW", 500), ("OVERLAP", 60)):
        monkeypatch.setattr(secret_scan, name, value)
    for first in (b"so it, goes " * 900, b"\xe9\0, " * 2000):
        for data in (gzip.compress(first) + gzip.compress(SECRET.encode()),
                     gzip.compress(first + SECRET.encode() + b", " * 400)[:-12]):
            blob = base64.b64encode(data).decode()
            assert [s[0] for s in secret_scan.scan_text(blob)[0]] == ["assign"]


def test_a_long_text_with_one_escape_needs_little_memory():
    import tracemalloc

    text = "some, words " * 3_400_000 + "%41 " + SECRET
    tracemalloc.start()
    spans, complete = secret_scan.scan_text(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert complete and [s[1:3] for s in spans] == [(len(text) - len(SECRET), len(text))]
    assert peak < 12 * len(text)


def test_layers_that_contain_themselves_end():
    text = "%25" * 50 + "%2525" + base64.b64encode(b"%41%41" * 40).decode()
    assert secret_scan.scan_text(text)[1]


def test_secrets_odd_rows(odd, clashing, empty):
    rows = secret_scan.scan(clashing, replace="*").collect()
    assert len(rows) == odd.count() and all(r["complete"] for r in rows)
    assert sorted(map(str, (r["row"]["text"] for r in rows))) == sorted(
        map(str, (r["text"] for r in odd.collect())))
    assert secret_scan.scan(empty).collect() == []


def test_fast_tokenizer_equals_the_library():
    fast = packing.FastTokenizer(tokenizer_path())
    rng = random.Random(1)
    texts = ["it's 'start they'll we've''s", "a  b\n\nc \n d\t e  ", "x\xa0 y\x85z", "½ 12ab² ª",
             "日本語 text's", "<|endoftext|> hi", "", "  ", "'", "don'twe'rell 'll'"]
    texts += ["".join(rng.choices("ab's tdrevlm12 \n.,'é½\t!", k=rng.randrange(40)))
              for _ in range(2000)]
    for text, a, b in zip(texts, fast.encode(texts), fast.encode_whole(texts), strict=True):
        assert a.tolist() == b.tolist(), text


def mirrored(n):
    """Two words of n letters that hashes of powers modulo 2 ** 64 can't tell apart."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_ids_follow_the_word_itself():
    fast = packing.FastTokenizer(tokenizer_path())
    for n in (64, 1024, 4096):
        for text in mirrored(n):
            assert fast.encode([text])[0].tolist() == fast.encode_whole([text])[0].tolist()


def test_hashes_tell_mirrored_words_apart():
    from ledgerlink.llm.arrays import NOT_BLANK, Words, run_hashes

    for n in (8, 64, 1024, 2048):
        words = Words([" ".join(mirrored(n)).encode()], NOT_BLANK)
        assert len(set(words.hashes.tolist())) == 2
        both = np.frombuffer("".join(mirrored(n)).encode("utf-32-le"), np.uint32)
        assert len(set(run_hashes(both, np.array([0, n]), np.array([n, 2 * n])).tolist())) == 2
    # Windows of two words in mirrored order.
    first, second = mirrored(16)
    pair = [" ".join(w).encode() for w in (first, second)]
    assert len({int(Words([t], NOT_BLANK).window_hashes(16)[0]) for t in pair}) == 2


def test_packing_round_trip(spark, docs):
    frame = docs.select("doc_id", "text")
    tokens = Scratch(spark, "test").store(packing.tokenize(frame, tokenizer_path(), limit=256))
    placed = packing.pack(
        tokens.select(F.col("row.doc_id").alias("doc_id"), "start", "length", "ids"),
        ["doc_id", "start"], 256, groups=5)
    fast = packing.FastTokenizer(tokenizer_path())
    truth = {r["doc_id"]: fast.encode_whole([r["text"]])[0].tolist() + [1] for r in frame.collect()}
    rows = placed.collect()
    built = {r["sequence_id"]: r for r in packing.sequences(placed, 256).collect()}
    pieces, used = {}, {}
    for r in rows:
        ids = built[r["sequence_id"]]["ids"][r["offset"] : r["offset"] + r["length"]]
        pieces.setdefault(r["doc_id"], {})[r["start"]] = ids
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    for doc, ids in truth.items():
        assert sum((pieces[doc][s] for s in sorted(pieces[doc])), []) == ids
    for s, row in built.items():
        assert row["used"] == used[s] <= 256
        assert len(row["ids"]) == (used[s] if used[s] & (used[s] - 1) == 0 else 256)
    total = sum(used.values())
    assert len(built) <= 1.06 * total / 256 + 1


def test_patterns_place_every_piece():
    rng = random.Random(4)
    for _ in range(30):
        histogram = {rng.randint(1, 64): rng.randint(1, 50) for _ in range(rng.randint(1, 30))}
        plan = packing.Patterns(histogram, 64)
        rows = [(seq + i, offset, length) for length, slots in plan.slots.items()
                for _, packs, seq, offset in slots for i in range(packs)]
        assert len(rows) == sum(histogram.values())
        by_sequence = {}
        for seq, offset, length in sorted(rows):
            assert by_sequence.get(seq, 0) == offset
            by_sequence[seq] = offset + length
        assert max(by_sequence.values()) <= 64 and len(by_sequence) == plan.sequences


def plain_packs(histogram, limit):
    """Shortest-pack-first, piece by piece: what each pack holds in total."""
    packs = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            shortest = min(range(len(packs)), key=packs.__getitem__, default=None)
            if shortest is None or packs[shortest] + length > limit:
                packs.append(length)
            else:
                packs[shortest] += length
    return sorted(packs)


def test_patterns_equal_shortest_pack_first():
    rng = random.Random(6)
    cases = [{60: 1, 50: 1, 10: 1}, {1: 1000}, {33: 7, 1: 5}, {100: 3}]
    cases += [{rng.randint(1, 100): rng.randint(1, 40) for _ in range(rng.randint(1, 25))}
              for _ in range(40)]
    for histogram in cases:
        plan = packing.Patterns(histogram, 100)
        sizes = sorted(sum(size * n for size, n in pattern)
                       for pattern, packs in plan.counts.items() for _ in range(packs))
        assert sizes == plain_packs(histogram, 100)
        held = {}
        for pattern, packs in plan.counts.items():
            for size, n in pattern:
                held[size] = held.get(size, 0) + n * packs
        assert held == histogram


def test_packing_odd_rows(spark, odd, clashing, empty):
    tokens = Scratch(spark, "test").store(packing.tokenize(clashing, tokenizer_path()))
    pieces = tokens.select(F.col("row.doc_id").alias("doc_id"), "start", "length", "doc_tokens")
    rows = packing.pack(pieces, ["doc_id", "start"]).collect()
    assert sum(r["start"] == 0 for r in rows) == odd.count()
    assert [r["doc_tokens"] for r in rows if r["doc_id"] == 1] == [1]
    none = packing.tokenize(empty, tokenizer_path())
    assert packing.pack(none.select("start", "length"), ["start"]).collect() == []


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_contamination_equals_brute_force(spark, docs):
    rng = random.Random(7)
    vocab = ["un", "deux", "trois", "vier", "cinq"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 3, 10, 12, 15])))) for i in range(20)]
    items += [(None, "un deux"), (99, None)]
    texts = [(i, " ".join(rng.choices(vocab + ["Ä", "x-y"], k=rng.randint(0, 60)))) for i in range(80)]
    texts += [(200, None), (201, items[5][1].upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    windows = {}
    for i, t in items:
        w = _words(t)
        for j in range(len(w) - min(10, len(w)) + 1 if w and i is not None else 0):
            windows.setdefault(tuple(w[j : j + min(10, len(w))]), set()).add(str(i))
    for r in decontamination.contamination(frame, bench).collect():
        w = _words(dict(texts)[r["row"]["doc_id"]])
        hit, found = set(), set()
        for k in set(map(len, windows)):
            for j in range(len(w) - k + 1):
                if tuple(w[j : j + k]) in windows:
                    hit |= set(range(j, j + k))
                    found |= windows[tuple(w[j : j + k])]
        assert (r["words"], r["hit"], r["items"]) == (len(w), len(hit), sorted(found))
        text = dict(texts)[r["row"]["doc_id"]] or ""
        assert sum(len(_words(text[s["start"] : s["end"]])) for s in r["spans"]) == len(hit)


def test_large_benchmarks_are_joined(spark, docs, clashing, monkeypatch):
    rng = random.Random(8)
    vocab = ["un", "deux", "trois", "vier", "cinq", "Ä"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 3, 10, 12, 15])))) for i in range(20)]
    passages = [r["text"][40:400] for r in docs.limit(5).collect()]
    items += [(100 + i, t) for i, t in enumerate(passages)]
    items += [(None, "un deux"), (99, None), (98, "two three four")]
    texts = [(i, " ".join(rng.choices(vocab + ["x-y"], k=rng.randint(0, 60)))) for i in range(60)]
    texts += [(200, None), (201, ""), (201, ""), (202, items[5][1]), (203, items[5][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    own = spark.createDataFrame(texts, "doc_id long, text string")

    def results():
        out = []
        for frame in (own, docs, clashing):
            for replace in (None, "*"):
                out.append(sorted(map(str, decontamination.contamination(
                    frame, bench, replace=replace).collect())))
            out.append(sorted(map(str, decontamination.decontaminate(frame, bench).collect())))
        return out

    expected = results()
    assert any("end=" in r for r in expected[3])
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 5)
    assert results() == expected


def test_decontaminate_cuts_or_drops(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    own = " ".join(f"own{i}" for i in range(30))
    frame = spark.createDataFrame(
        [(1, f"{own} {passage}, tail", 5), (2, passage, 6), (3, own, 7), (4, None, 8)],
        "doc_id long, text string, hit long")
    out = {r["doc_id"]: r for r in decontamination.decontaminate(frame, bench).collect()}
    assert set(out) == {1, 3, 4} and out[1]["text"] == f"{own} , tail" and out[1]["hit"] == 5


def test_contamination_odd_rows(spark, odd, clashing, empty):
    bench = spark.createDataFrame([(1, "two three four")], "item_id long, text string")
    assert decontamination.contamination(clashing, bench).where("hit = 3").count() == 4
    assert decontamination.contamination(clashing, bench.where("item_id < 0")).where("hit > 0").isEmpty()
    assert decontamination.contamination(empty, bench).collect() == []
