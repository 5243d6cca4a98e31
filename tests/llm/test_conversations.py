"""Repair of conversations against an enumeration of all edits."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerlink.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def _all_edits(rows, faults):
    """Every sequence of edits with at most two insertions in a row: cost, audit, lines."""
    inserts = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    options = []
    for (_, role, text), fault in zip(rows, faults, strict=True):
        more = 5 if fault == "truncated" else 0
        own = [(2, "D", [])]
        if fault not in ("blank", "duplicate"):
            own.append((more, "K", [(role, text)]))
            own += [(1 + more, "R", [(r, text)]) for r in ("user", "assistant")]
        options.append([
            (5 * len(i) + cost, "I" * len(i) + edit, [(r, "") for r in i] + said)
            for i in inserts for cost, edit, said in own
        ])
    options.append([(5 * len(i), "I" * len(i), [(r, "") for r in i]) for i in inserts])
    for chosen in itertools.product(*options):
        said = [line for _, _, lines in chosen for line in lines]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in said)):
            yield sum(c for c, _, _ in chosen), "".join(a for _, a, _ in chosen), said


def brute_force(rows):
    rows = sorted(
        ((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
        key=lambda y: (y[0] is not None, y[0] or 0, y[1].encode(),
                       hashlib.sha256(y[2].encode()).digest()[:16]),
    )
    faults = _faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, said = min(_all_edits(rows, faults), key=lambda e: e[:2])
    text = "\n".join(f"{r}:{x}" for r, x in said)
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost,
            audit, hashlib.sha256(text.encode()).hexdigest())


def _random_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Yes.", "no", "What?\n", " \t", "", None, "Yes. ", "é!"]
    return [(rng.choice([None, 0, 1, 2, 3, 9]), rng.choice(roles[: rng.choice([2, 3, 7])]),
             rng.choice(texts[: rng.choice([3, 8])])) for _ in range(n)]


@pytest.mark.parametrize("stretch", [1, 2, 65_536])
def test_cheapest_edits_equal_enumeration(spark, stretch):
    rng = random.Random(stretch)
    by_conv = {(None if c == 0 else c): _random_rows(rng, rng.choice([1, 2, 3, 3, 4]))
               for c in range(25)}
    rows = [(c, *r) for c, of in by_conv.items() for r in of]
    rng.shuffle(rows)
    out = conversations.summaries(spark.createDataFrame(rows, SCHEMA), stretch=stretch).collect()
    assert len(out) == len(by_conv)
    for r in out:
        assert tuple(r)[1:] == brute_force(by_conv[r["conv"]]), by_conv[r["conv"]]


def test_long_conversations_keep_their_order_over_stretches():
    """Backpointers given out in stretches lead to the edits of the whole."""
    rng = random.Random(3)
    facts = [(rng.choice("usa-"), rng.choice(["", "", "truncated", "duplicate"]))
             for _ in range(5000)]
    costs = conversations.Costs()
    pointers = [costs.step(i, f) for i, f in reversed(facts)][::-1]
    edits = conversations.Edits()
    done = [edits.of_row(p, i) for p, (i, _) in zip(pointers, facts, strict=True)]
    done.append(edits.to_end())
    total = sum(conversations._COST[e] for row in done for e, _ in row)
    total += sum(5 for row, (_, f) in zip(done, facts, strict=False)
                 if f == "truncated" and row[-1][0] != conversations._DELETE)
    assert total == costs.total()


def test_a_conversation_of_many_batches(spark):
    """One conversation longer than batches and stretches, rows repeated and shuffled."""
    n = 40_000
    turns = spark.range(n).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("Row "), F.col("id"), F.lit(".")).alias("text"),
    )
    twice = turns.unionByName(turns.where("turn % 100 = 0")).orderBy(F.rand(1))
    row = conversations.summaries(twice, stretch=1000).first()
    assert (row["gaps"], row["duplicate"], row["cost"]) == (0, 400, 800)
    assert row["audit"].count("D") == 400 and row["audit"].count("K") == n
    text = "\n".join(f"{'user' if i % 2 == 0 else 'assistant'}:Row {i}." for i in range(n))
    assert row["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    kept = conversations.repair(twice).where("edit <> 'D'")
    assert kept.count() == n


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversations.summaries(none).collect() == []
    assert conversations.repair(none).collect() == []
    clash = spark.createDataFrame(
        [(1, 0, "user", "x" * 300_000 + ".", "a"), (1, 1, "assistant", "Ok.", "b")],
        SCHEMA + ", digest string",
    ).withColumns({c: F.lit(1) for c in ("conv", "seq", "pointers", "place", "audit", "cost")})
    row = conversations.summaries(clash).first()
    assert (row["conv"], row["audit"], row["cost"]) == (1, "KK", 0)


def test_damage_and_query(spark):
    from ledgerlink.llm.queries import op11_conversation_repair as query

    import zlib

    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    by_conv = {}
    for r in turns:
        hit = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text, role = r["text"], r["role"]
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        rows = by_conv.setdefault(r["conv_id"], [])
        if hit != 0:
            rows += [(r["turn"], "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    out = query(spark, "/root/testdata/sf0.001").collect()
    assert {r["conv_id"] for r in out} == set(by_conv) and len(out) == len(by_conv)
    for r in out:
        rows = by_conv[r["conv_id"]]
        if not rows:
            assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", EMPTY)
        elif len(rows) <= 4:
            assert tuple(r)[1:] == brute_force(rows)
