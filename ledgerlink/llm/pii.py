"""Personal data in texts: generators propose spans, boosted trees choose among them.

Everything here is a DataFrame expression.  Spans of the base patterns always stay.
Wider generators propose further spans, which may overlap; gradient-boosted trees score
them by the format of the match and by the characters beside it, and those above a
calibrated threshold are added.  The trees become one expression over the features, so
that finding reads a text once and shuffles nothing; training reads all texts, too, and
shuffles numbers only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.support import Scratch, packed, unpacked

KINDS = ("email", "ip", "card", "phone")
#: Bins of a feature's values, for the trees.
BINS = 32
#: A proposal is added if its calibrated precision reaches this.
PRECISION = 0.99

# The base patterns.  Repetitions are possessive, and a run of characters
# is tried from its start or from the end of the previous match only; both leave the
# matches as they are and keep long runs linear.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must contain for a pattern to be tried.
_GATES = {"email": "@", "phone": "+"}
_DIGIT = "[0-9]"

_AT = r"(?: ?\[ ?(?i:at) ?\] ?| ?\( ?(?i:at) ?\) ?| (?i:at) )"
_DOT = r"(?: ?\[ ?(?i:dot) ?\] ?| ?\( ?(?i:dot) ?\) ?| (?i:dot) |\.)"
_DISGUISED_DOT = _DOT.removesuffix(r"|\.)") + ")"
_DEFANGED = r"(?:\[\.\]|\(\.\)| \. |\[dot\]| dot )"
_HEX = "[0-9A-Fa-f]{1,4}+"
#: Wider patterns that propose spans, and what a text must match for them to be tried: a
#: necessary condition of the pattern itself.  Plain and disguised signs may be mixed, but
#: what has plain signs only is a base match.
GENERATORS = {
    "email": (
        rf"(?<!{_LOCAL}){_LOCAL}++(?:{_AT}{_LABEL}++(?:{_DOT}{_LABEL}++)++"
        rf"|@{_LABEL}++(?:\.{_LABEL}++)*+{_DISGUISED_DOT}{_LABEL}++(?:{_DOT}{_LABEL}++)*+)",
        rf"{_AT}|@",
    ),
    "ip": (
        r"(?<![0-9.])(?![0-9]++(?:\.[0-9]++){3})"
        rf"[0-9]{{1,3}}+(?:(?:{_DEFANGED}|\.)[0-9]{{1,3}}+){{3}}(?![0-9]|\.[0-9])"
        rf"|(?<![0-9A-Za-z:.])(?!(?:[0-9A-Fa-f]*+:){{8}}[0-9A-Fa-f])(?:(?:{_HEX}:){{7}}{_HEX}"
        rf"|(?:{_HEX}(?::{_HEX})*+)?::{_HEX}(?::{_HEX})*+|{_HEX}(?::{_HEX})*+::)(?![0-9A-Za-z:])",
        "[0-9]|:[0-9A-Fa-f]*+:",
    ),
    "card": (r"(?<![0-9])[0-9]{4}(?:[._/][0-9]{4}){2,3}(?:[._/][0-9]{1,4})?(?![0-9])", _DIGIT),
    "phone": (
        r"(?<![0-9+])(?:00[1-9][0-9]{0,2}[ ./-]?|\([0-9]{2,5}\) ?|0[0-9]{1,4}[ ./-]"
        r"|[0-9]{3}[ .-])[0-9]{2,4}(?:[ ./-]?[0-9]{2,4}){1,3}(?![0-9])",
        _DIGIT,
    ),
}
_CUES = {
    "email": "mail|contact|write|kontakt|courriel|correo",
    "ip": "ip|host|server|address|adresse",
    "card": "card|visa|master|amex|karte|carte|tarjeta|credit",
    "phone": "phone|tel|call|mobile|fax|ruf|appel|llam",
}
FEATURES = (
    "kind", "length", "digits", "letters", "signs", "groups", "first_group", "last_group",
    "checksum", "largest", "letter_before", "letter_after", "digit_near", "wrapped",
)
#: Sums of matches are taken by blocks of so many, so that many matches stay cheap.
_SUM_BLOCK = 256


def _matches(text: str, pattern: str) -> str:
    """SQL for the matches of a pattern: array of (start, end, hit, before, after).

    The pieces between matches are what ``split`` leaves, so that lengths add up to
    positions in code points.  Sums are taken over blocks of matches and within them.
    """
    quoted = "r'" + pattern + "'"
    gaps = f"split({text}, {quoted}, -1)"
    hits = f"regexp_extract_all({text}, {quoted}, 0)"
    found = (
        f"transform(arrays_zip({hits}, {gaps}), x -> named_struct('hit', x.`0`, 'gap', x.`1`, "
        "'step', length(x.`1`) + coalesce(length(x.`0`), 0)))"
    )
    block = _SUM_BLOCK
    add = "(s, y) -> s + y.step"
    summed = (
        f"transform(array({found}), m -> named_struct('m', m, 'sums', "
        f"transform(sequence(0, (size(m) - 1) DIV {block}), b -> "
        f"aggregate(slice(m, 1, CAST(b AS INT) * {block}), 0, {add}))))[0]"
    )
    # One-element arrays name a value, so that it is worked out once.
    return (
        f"flatten(transform(array({summed}), z -> transform(sequence(1, size(z.m) - 1), i -> "
        "named_struct('at', z.sums[(i - 1) DIV " + str(block) + "] + "
        f"aggregate(slice(z.m, ((i - 1) DIV {block}) * {block} + 1, (i - 1) % {block}), 0, {add})"
        " + length(z.m[i - 1].gap), 'hit', z.m[i - 1].hit, 'before', right(z.m[i - 1].gap, 24),"
        " 'after', left(z.m[i].gap, 8)))))"
    )


def _guarded(text: str, gate: str, pattern: str) -> str:
    """``_matches`` where the text passes the gate and has a match, else none."""
    empty = ("CAST(array() AS array<struct<at:int,hit:string,before:string,after:string>>)")
    return (
        f"CASE WHEN {text} IS NULL OR NOT ({gate}) THEN {empty} "
        f"WHEN NOT rlike({text}, r'{pattern}') THEN {empty} ELSE {_matches(text, pattern)} END"
    )


def _digits(hit: str) -> str:
    return f"regexp_replace({hit}, '[^0-9]+', '')"


def _luhn(hit: str) -> str:
    """SQL for whether the digits of a match pass the checksum of card numbers."""
    return (
        f"(aggregate(transform(array(reverse({_digits(hit)})), d -> named_struct('d', d, 'e', "
        "translate(d, '0123456789', '0246813579'))), 0, (s, p) -> "
        "aggregate(sequence(1, greatest(length(p.d), 1)), s, (t, i) -> t + coalesce(CAST("
        "substring(if(i % 2 = 1, p.d, p.e), CAST(i AS INT), 1) AS INT), 0))) % 10 = 0)"
    )


def _valid(kind: str, hit: str) -> str:
    """SQL for whether a base match passes the test of its kind."""
    if kind == "ip":
        part = "(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9][0-9]?)|0++)"
        return rf"rlike({hit}, r'^{part}(?:\.{part}){{3}}$')"
    if kind == "card":
        return f"(length({_digits(hit)}) BETWEEN 12 AND 19 AND {_luhn(hit)})"
    if kind == "phone":
        return f"(length({_digits(hit)}) BETWEEN 9 AND 15)"
    return "true"


def _base_gate(kind: str, text: str) -> str:
    sign = _GATES.get(kind)
    return f"contains({text}, '{sign}')" if sign else f"rlike({text}, '{_DIGIT}')"


def _span(kind: str, x: str = "x") -> str:
    return f"named_struct('kind', '{kind}', 'start', {x}.at, 'end', {x}.at + length({x}.hit))"


def base_spans(text: str) -> Column:
    """All base spans of a text column, by start and kind."""
    arrays = [
        f"transform(filter({_guarded(text, _base_gate(k, text), BASE[k])}, "
        f"x -> {_valid(k, 'x.hit')}), x -> {_span(k)})"
        for k in KINDS
    ]
    return _ordered(f"concat({', '.join(arrays)})")


def _ordered(spans: str) -> Column:
    number = "CASE x.kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
    keyed = (f"transform({spans}, x -> named_struct('s', x.start, 'n', {number}, 'e', x.end, "
             "'span', x))")
    return F.expr(f"transform(array_distinct(array_sort({keyed})), y -> y.span)")


def _features(kind: str, x: str) -> str:
    """SQL for the struct of features of a proposal."""
    hit, digits = f"{x}.hit", _digits(f"{x}.hit")
    groups = f"filter(split({hit}, '[^0-9]+'), g -> g <> '')"
    values = {
        "kind": str(KINDS.index(kind)),
        "length": f"length({hit})",
        "digits": f"length({digits})",
        "letters": f"length(regexp_replace({hit}, '[^A-Za-z]+', ''))",
        "signs": f"length(regexp_replace({hit}, '[A-Za-z0-9 ]+', ''))",
        "groups": f"size({groups})",
        "first_group": f"coalesce(length(try_element_at({groups}, 1)), 0)",
        "last_group": f"coalesce(length(try_element_at({groups}, -1)), 0)",
        "checksum": f"if(length({digits}) BETWEEN 12 AND 19, CAST({_luhn(hit)} AS INT), 0)",
        "largest": f"coalesce(array_max(transform({groups}, g -> least(try_cast(g AS DOUBLE), 1e6))), 0)",
        "letter_before": f"CAST(rlike({x}.before, r'[\\p{{L}}]$') AS INT)",
        "letter_after": f"CAST(rlike({x}.after, r'^[\\p{{L}}]') AS INT)",
        "digit_near": f"CAST(rlike({x}.before, '[0-9][^0-9]{{0,2}}$') OR "
                      f"rlike({x}.after, '^[^0-9]{{0,2}}[0-9]') AS INT)",
        "wrapped": f"CAST(rlike({hit}, '[\\\\[(]') AS INT)",
    }
    inner = ", ".join(f"'{name}', CAST({values[name]} AS DOUBLE)" for name in FEATURES)
    return f"named_struct({inner})"


def proposals(text: str) -> Column:
    """Spans of the wider generators, with their features."""
    arrays = []
    for kind, (pattern, gate) in GENERATORS.items():
        found = _guarded(text, f"rlike({text}, r'{gate}')", pattern)
        arrays.append(
            f"transform({found}, x -> named_struct('kind', '{kind}', 'start', x.at, "
            f"'end', x.at + length(x.hit), 'f', {_features(kind, 'x')}))"
        )
    return F.expr(f"concat({', '.join(arrays)})")


def _weak_examples(text: str) -> Column:
    """Proposals with labels that follow from the base patterns.

    Base spans that are rewritten the way people disguise them are positive; base
    matches that fail the test of their kind, rewritten alike, are negative.  Proposals
    of the text itself are labelled by a word before them that announces their kind; that
    word is no feature, so the trees cannot learn the rule instead of the format.
    """
    def one_of(*ways: str) -> str:
        """SQL for the rewriting that the hash of a match picks."""
        return "CASE pmod(xxhash64(x.hit), {}) {} END".format(
            len(ways), " ".join(f"WHEN {i} THEN {way}" for i, way in enumerate(ways)))

    disguise = {
        "email": one_of(
            "replace(replace(x.hit, '@', ' [at] '), '.', ' [dot] ')",
            "replace(replace(x.hit, '@', '(at)'), '.', '(dot)')",
            "replace(replace(x.hit, '@', ' at '), '.', ' dot ')",
            "replace(x.hit, '@', ' at ')", "replace(x.hit, '@', ' [at] ')",
            "regexp_replace(x.hit, '(?<=@[^.]{1,200})[.]', ' dot ')",
        ),
        "ip": one_of("replace(x.hit, '.', '[.]')", "replace(x.hit, '.', ' dot ')",
                     "regexp_replace(x.hit, '[.](?=[0-9]+$)', '[.]')"),
        "card": "regexp_replace(x.hit, '[ -]', '.')",
        "phone": "regexp_replace(replace(x.hit, '+', '00'), '[()]', '')",
    }
    arrays = []
    for kind in KINDS:
        found = _guarded(text, _base_gate(kind, text), BASE[kind])
        changed = (f"transform({found}, x -> named_struct('good', {_valid(kind, 'x.hit')}, 'y', "
                   f"named_struct('at', x.at, 'hit', {disguise[kind]}, 'before', x.before, "
                   "'after', x.after)))")
        arrays.append(
            f"transform({changed}, z -> named_struct('label', CAST(z.good AS DOUBLE), "
            f"'f', {_features(kind, 'z.y')}))"
        )
    for kind, (pattern, gate) in GENERATORS.items():
        found = _guarded(text, f"rlike({text}, r'{gate}')", pattern)
        cue = f"rlike(x.before, '(?i)(?:{_CUES[kind]})[^A-Za-z]*$')"
        arrays.append(
            f"transform({found}, x -> named_struct('label', CAST({cue} AS DOUBLE), "
            f"'f', {_features(kind, 'x')}))"
        )
    return F.expr(f"concat({', '.join(arrays)})")


@dataclass(frozen=True)
class SpanModel:
    """Boosted trees as SQL over a struct of features, and the margin to be reached."""

    margin: Callable[[str], str]
    threshold: float


def _tree_sql(debug: str, x: str) -> str:
    """One tree's text as nested conditions."""
    lines = [line.strip() for line in debug.splitlines() if line.strip()]
    at = 0

    def node() -> str:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict:"):
            return repr(float(line.removeprefix("Predict:")))
        feature, value = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        yes = node()
        at += 1  # the matching Else
        return f"if({x}.{FEATURES[int(feature)]} <= {float(value)!r}, {yes}, {node()})"

    return node()


def train(
    docs: DataFrame, text_col: str = "text", rounds: int = 8, depth: int = 3
) -> SpanModel | None:
    """Fit the trees on the weakly labelled proposals of all texts.

    Equal examples are one row with their number as weight.  Four fifths of the different
    ones are fitted on; on the rest the least margin is chosen above which the share of
    positives reaches ``PRECISION``.  Without both labels, or without such a margin,
    there is no model and only base spans are found.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    examples = scratch.store(
        docs.select(F.col(text_col).cast("string").alias("_text"))
        .select(F.explode(_weak_examples("_text")).alias("e"))
        .groupBy("e").agg(F.count(F.lit(1)).cast("double").alias("times"))
        .select("e.label", "e.f.*", "times",
                (F.xxhash64("e.f", "e.label") % 5 == 0).alias("kept"))
    )
    counts = examples.groupBy("kept", "label").count().collect()
    found = {(r["kept"], r["label"]): r["count"] for r in counts}
    if any(not found.get((part, label)) for part in (False, True) for label in (0.0, 1.0)):
        scratch.drop()
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        examples.where("NOT kept")
    )
    # Spark looks for bins in 10,000 rows or in the square of maxBins: here in all of them.
    fitted = found[False, 0.0] + found[False, 1.0]
    bins = BINS if fitted <= 10_000 else min(math.isqrt(fitted) + 1, 46_340)
    model = GBTClassifier(
        maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=1, checkpointInterval=-1,
        maxBins=bins, cacheNodeIds=False, weightCol="times",
    ).fit(vectors.select("label", "features", "times"))
    trees = [(w, t.toDebugString.split("\n", 1)[1])
             for w, t in zip(model.treeWeights, model.trees, strict=True)]

    def margin(x: str) -> str:
        return " + ".join(f"{w!r} * {_tree_sql(t, x)}" for w, t in trees)

    scored = examples.where("kept").select(F.struct(*FEATURES).alias("f"), "label", "times").select(
        F.expr(margin("f")).alias("margin"), "label", "times"
    )
    # Margins are small numbers and rounded, so they take a bounded number of values.
    steps = scored.groupBy(F.round("margin", 3).alias("margin")).agg(
        F.sum(F.col("label") * F.col("times")).alias("good"), F.sum("times").alias("all")
    ).orderBy(F.desc("margin")).collect()
    scratch.drop()
    good = total = 0
    threshold = None
    for step in steps:
        good, total = good + step["good"], total + step["all"]
        if good >= PRECISION * total:
            threshold = float(step["margin"])
    return None if threshold is None else SpanModel(margin, threshold - 5e-4)


def find(docs: DataFrame, model: SpanModel | None, text_col: str = "text") -> DataFrame:
    """For each row of ``docs``: it as ``row``, ``base`` and ``spans``.

    Both are arrays of kind, start and end (code points, end exclusive) by start and
    kind; ``spans`` are the base ones and the proposals that the model accepts, unless
    they overlap a base span.  Null and empty texts have none.  Repeated rows are
    treated alike; other columns are handed on, whatever their names.
    """
    rows = packed(docs, text_col).withColumn("base", base_spans("_text"))
    if model is None:
        rows = rows.withColumn("spans", F.col("base"))
    else:
        rows = rows.withColumn("_proposed", proposals("_text")).withColumn(
            "_proposed",
            F.expr(
                f"transform(filter(_proposed, x -> ({model.margin('x.f')}) >= {model.threshold!r} "
                "AND NOT exists(base, b -> b.start < x.end AND x.start < b.end)), x -> "
                "named_struct('kind', x.kind, 'start', x.start, 'end', x.end))"
            ),
        ).withColumn("spans", _ordered("concat(base, _proposed)"))
    return rows.select(
        F.struct(*unpacked(docs.columns, text_col)).alias("row"), "base", "spans"
    )


def redact(found: DataFrame, text_col: str = "text", sign: str = "█") -> DataFrame:
    """The rows of ``find`` with every character of a span replaced by ``sign``."""
    text = f"row.`{text_col}`"
    covered = (
        f"CASE WHEN size(spans) = 0 THEN {text} ELSE "
        f"aggregate(spans, {text}, (t, s) -> overlay(t PLACING repeat('{sign}', s.end - s.start) "
        "FROM s.start + 1 FOR s.end - s.start)) END"
    )
    return found.select(F.col("row").withField(text_col, F.expr(covered)).alias("row")).select("row.*")
