"""Sharding, line dedup and personal data: DataFrame expressions only."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ledgerlink.llm import line_dedup, pii, sharding


def _no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_every_stretch_of_shards_has_the_mixture(spark):
    docs = spark.range(1000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 4, F.concat(F.lit("s"), F.col("id")))
        .when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "warm").alias("source"),
    )
    placed = sharding.shard(docs, 7, group_rows=50)
    _no_python(placed)
    rows = placed.collect()
    for source in ("hot", "warm", None):
        counts = [sum(r["source"] == source and r["shard"] == s for r in rows) for s in range(7)]
        assert max(counts) - min(counts) <= 2
    for s in range(7):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots))) and len(slots) in (142, 143)
    again = sharding.shard(docs.repartition(5), 7, group_rows=50).collect()
    assert sorted(again) == sorted(rows)


def test_sharding_odd_rows(odd, clashing, empty):
    rows = sharding.shard(clashing, 4).collect()
    assert len(rows) == odd.count()
    assert sorted(r["slot"] for r in rows if r["shard"] == 0) == [0, 1, 2, 3][: sum(
        r["shard"] == 0 for r in rows)]
    assert sharding.shard(empty, 4).collect() == []


def test_frequent_lines_of_a_site_go(spark):
    rows = [(i, "a", f"menu\nown line {i}\n  menu \nfooter") for i in range(8)]
    rows += [(20 + i, "a", "menu\nfooter") for i in range(3)]  # copies are one page
    rows += [(40 + i, "b", f"menu\nb{i}") for i in range(2)]
    rows += [(50, "c", "menu\nfooter"), (51, "c", "menu\nfooter")]  # one page, twice
    rows += [(60, None, "menu"), (61, "a", None), (62, "a", "")]
    pages = spark.createDataFrame(rows, "page_id long, host string, text string")
    found = line_dedup.drop_site_lines(pages, ratio=0.5)
    _no_python(found)
    out = {r["page_id"]: r for r in found.collect()}
    assert out[0]["text"] == "own line 0"
    assert (out[0]["n_lines"], out[0]["n_dropped"]) == (4, 3)
    assert (out[20]["text"], out[20]["n_dropped"], out[20]["emptied"]) == ("", 2, True)
    assert not any(out[i]["emptied"] for i in (0, 40, 50, 60, 61, 62))
    assert out[40]["text"] == "b0"
    assert out[50]["text"] == "menu\nfooter"
    assert (out[60]["text"], out[61]["text"], out[62]["text"]) == ("menu", None, "")
    assert (out[61]["n_lines"], out[62]["n_lines"]) == (0, 1)


def test_line_dedup_odd_rows(odd, clashing, empty):
    out = line_dedup.drop_site_lines(clashing, host_col="source")
    assert out.columns == [*clashing.columns, "n_lines_", "n_dropped_", "emptied"]
    texts = lambda df: sorted(map(str, (r["text"] for r in df.select("text").collect())))
    assert texts(out) == texts(odd)
    assert line_dedup.drop_site_lines(empty, host_col="source").collect() == []


def test_pages_become_lines(spark):
    html = ("<!DOCTYPE html><style>p{}</style><script>var t='</p>';</script><body><h1>A &amp; B"
            "</h1><p>one <b>two</b>\nthree<!-- no --><br>four</p></body>")
    df = spark.createDataFrame([("HTTP://u@Host.Example:80/x", html)], "url string, html string")
    row = df.select(line_dedup.page_lines("html").alias("t"), line_dedup.host_of("url").alias("h"))
    assert row.first()["h"] == "host.example"
    lines = [x.strip() for x in row.first()["t"].split("\n")]
    assert [x for x in lines if x] == ["A & B", "one  two  three", "four"]


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _good(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(part) <= 255 for part in hit.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute_force_spans(text):
    found = [
        (m.start(), list(KINDS).index(k), m.end(), k)
        for k, pattern in KINDS.items() for m in re.finditer(pattern, text or "")
        if _good(k, m[0])
    ]
    return [(k, a, b) for a, _, b, k in sorted(found)]


CASES = [
    "mail ä@b a.b@c.de, x@y.z%w@v.u and 1.2.3.4.5.6.7.8 or 256.1.1.1 001.2.3.4",
    "call +1 (017) 555-7713 or +49-30.1234 5678 9 +1 2 +123456789012345678",
    "card 4111 1111 1111 1111, 4111111111111112 5500-0000-0000-0004x",
    "é" * 50 + "a@b.c" + "日本" + " 10.0.0.1 " + "+" * 20 + "+12345678901",
    "0.0.0.0 00.1.020.255 1.2.3.256 0255.1.1.00", "", None, "@", "a@b", "1.1.1", "....@....", "0" * 5000, "a.b.c" * 3000, "1 " * 3000,
    " ".join(f"u{i}@h{i % 7}.org 10.0.{i % 300}.1" for i in range(700)),
]


@pytest.mark.parametrize("part", [0])
def test_base_spans_equal_python(spark, docs, part):
    texts = CASES + [r["text"] for r in docs.limit(100).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.find(df, None)
    _no_python(found)
    for row in found.collect():
        spans = [tuple(s) for s in row["base"]]
        assert spans == brute_force_spans(row["row"]["text"]), row["row"]["text"]


DISGUISED = [
    ("email", x) for x in (
        "john at example.com", "jo@mail dot com", "jo@mail.example dot com", "jo at mail dot com",
        "jo [at] mail.com", "jo(at)mail(dot)com", "jo@mail[dot]co.uk", "JO AT MAIL DOT COM")
] + [
    ("ip", x) for x in (
        "10.0.0[.]1", "10[.]0.0.1", "10[.]0[.]0[.]1", "10.0 dot 0.1", "2001:db8::8a2e:370:7334",
        "fe80::1", "::1", "dead:beef::", "ab:cd:ef:ab:cd:ef:ab:cd", "2001:0db8:0:0:0:8a2e:0370:7334")
] + [("card", "4111.1111.1111.1111"), ("phone", "0049 171 5557713"), ("phone", "(030) 1234 5678")]


def test_each_disguise_alone_is_proposed(spark):
    texts = [(i, f"so {x}, then") for i, (_, x) in enumerate(DISGUISED)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = df.select("doc_id", "text", pii.proposals("text").alias("p")).collect()
    for row in rows:
        kind, span = DISGUISED[row["doc_id"]]
        assert (kind, 3, 3 + len(span)) in {(p["kind"], p["start"], p["end"]) for p in row["p"]}, row
    plain = [(0, "jo@mail.com 10.0.0.1 1.2.3.4.5 at 12:30:45, std::map 10:20")]
    df = spark.createDataFrame(plain, "doc_id long, text string")
    assert df.select(pii.proposals("text").alias("p")).first()["p"] == []


def test_announcing_words_are_no_features(spark):
    df = spark.createDataFrame([(0, "mail jo [at] b.org"), (1, "frog jo [at] b.org")],
                               "doc_id long, text string")
    a, b = (r["p"] for r in df.select(pii.proposals("text").alias("p")).collect())
    assert a == b and len(a) == 1


def test_added_spans_keep_base_ones(spark, docs):
    model = pii.train(docs)
    probe = [(9001, "write to jo.doe [at] mail [dot] example [dot] com now"),
             (9002, "host 10[.]0[.]0[.]7 down"), (9003, "plain words and 12 numbers 345")]
    df = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame(probe, "doc_id long, text string"))
    found = pii.find(df, model)
    _no_python(found)
    rows = found.collect()
    for row in rows:
        assert {tuple(s) for s in row["base"]} <= {tuple(s) for s in row["spans"]}
    clean = pii.redact(found.where("row.doc_id = 9003")).first()
    assert clean["text"] == probe[2][1]


def test_personal_data_is_learned_from_all_texts(spark):
    # Of 100,000 rows a sample of 50,000 by hash left out all that hold anything.
    told = "pmod(xxhash64(id), 1048576) >= 524288 AND id < 4000"
    docs = spark.range(100_000).selectExpr(
        "id AS doc_id",
        f"CASE WHEN {told} THEN concat('so ', repeat('u', CAST(id % 37 AS INT) + 1), '@h', id, "
        "'.org met ', 300 + id % 600, '.', id % 999, '.1.', id % 7) END AS text",
    )
    model = pii.train(docs)
    probe = spark.createDataFrame([(1, "so uuuuu [at] h123 [dot] org, then 310[.]4[.]1[.]2")],
                                  "doc_id long, text string")
    assert [s["kind"] for s in pii.find(probe, model).first()["spans"]] == ["email"]


def test_personal_data_odd_rows(odd, clashing, empty):
    rows = pii.find(clashing, pii.train(clashing)).collect()
    assert len(rows) == odd.count()
    assert rows[0]["row"].asDict().keys() == set(clashing.columns)
    assert pii.find(empty, pii.train(empty)).collect() == []
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
