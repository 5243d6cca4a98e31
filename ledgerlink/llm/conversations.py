"""Repair of conversations: secondary-sorted streams that carry states across batches.

Rows are laid out by conversation and sorted by turn.  A first stream walks each
conversation from its last row to its first and carries the cheapest cost of all that
follows; which edit is best in which state is one byte a row, and these backpointers are
given out in stretches, as rows of a written table.  A second stream walks forward, meets
each stretch before the rows it is for, and applies the edits.  A task holds a stretch
and a batch, however long a conversation is.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.llm.support import Scratch, wider

#: Backpointers that are given out as one row.
STRETCH = 65_536
_BLANKS = " \t\n\x0b\x0c\r"

# States: nothing said yet; system has spoken; user has; assistant has.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: Where an inserted or rewritten row leads: a user speaks, then an assistant.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_SPEAKER = ("user", "user", "assistant", "user")
#: Where a row leads that stays as it is, by state and initial of its role.
_KEPT = {
    (_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER,
    (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER,
}
#: Costs until the end of a conversation without further rows: insertions only.
_END = (0, 10, 5, 0)
#: Edits in the order in which equally cheap ones are taken.
_EDITS = "DIKR"
_DELETE, _INSERT, _KEEP, _REROLE = range(4)
_COST = {_DELETE: 2, _INSERT: 5, _KEEP: 0, _REROLE: 1}
_CUT_COST = 5
_LEGAL = {"su", "ua", "au"}


class Costs:
    """Cheapest costs to the end from each state, one row further to the front a step."""

    def __init__(self) -> None:
        self.base, self.after = 0, _END
        self._known: dict[tuple, tuple] = {}

    def restart(self) -> None:
        self.base, self.after = 0, _END

    def step(self, initial: str, fault: str) -> int:
        """Take in a row; returns its backpointers, two bits for each state."""
        key = (initial, fault, self.after)
        if key not in self._known:
            self._known[key] = _before(*key)
        self.after, least, choice = self._known[key]
        self.base += least
        return choice

    def total(self) -> int:
        return self.base + self.after[_START]


def _before(initial: str, fault: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], int, int]:
    """Costs before a row, less their least, that least, and the backpointers."""
    by_edit = []
    for state in range(4):
        of = {_DELETE: _COST[_DELETE] + after[state]}
        if fault not in ("blank", "duplicate"):
            more = _CUT_COST if fault == "truncated" else 0
            if (state, initial) in _KEPT:
                of[_KEEP] = _COST[_KEEP] + more + after[_KEPT[state, initial]]
            of[_REROLE] = _COST[_REROLE] + more + after[_NEXT[state]]
        by_edit.append(of)
    costs = [min(of.values()) for of in by_edit]
    for _ in range(3):
        costs = [min(c, _COST[_INSERT] + costs[_NEXT[s]]) for s, c in enumerate(costs)]
    choice = 0
    for state, of in enumerate(by_edit):
        of[_INSERT] = _COST[_INSERT] + costs[_NEXT[state]]
        best = min(edit for edit, cost in of.items() if cost == costs[state])
        choice |= best << 2 * state
    least = min(costs)
    return tuple(c - least for c in costs), least, choice


class Edits:
    """The walk forward: edits of each row, from its backpointers."""

    def __init__(self) -> None:
        self.state = _START

    def of_row(self, choice: int, initial: str) -> list[tuple[int, str]]:
        """Edits up to and including the row's own, with the role that each writes."""
        out = []
        while True:
            edit = choice >> 2 * self.state & 3
            out.append((edit, _SPEAKER[self.state]))
            if edit == _KEEP:
                self.state = _KEPT[self.state, initial]
            elif edit != _DELETE:
                self.state = _NEXT[self.state]
            if edit != _INSERT:
                return out

    def to_end(self) -> list[tuple[int, str]]:
        out = []
        while self.state in (_SYSTEM, _USER):
            out.append((_INSERT, _SPEAKER[self.state]))
            self.state = _NEXT[self.state]
        return out


def _digested(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows without nulls in role and text, and a digest of each text."""
    role_, text_ = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role, text))
    return turns.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        role_.alias("role"), text_.alias("text"),
        F.unhex(F.substring(F.sha2(text_.cast("binary"), 256), 1, 32)).alias("digest"),
    )


#: Rows at equal places of two runs are equal.
_ORDER = ("turn", "role", "digest")


def _fault(text: Column) -> Column:
    """The fault of a row by itself; being a copy comes before being truncated."""
    bare = F.rtrim(text, F.lit(_BLANKS))
    return (
        F.when(bare == "", "blank")
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    )


_SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _frame(columns: list[tuple], schema: dict[str, pa.DataType]) -> pa.RecordBatch:
    """Rows, given as tuples, of the given columns."""
    lists = list(zip(*columns, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(lists, schema.values(), strict=True)], list(schema)
    )


class _Backward:
    """Costs and counts of one conversation, from its last row to its first."""

    def __init__(self, costs: Costs, conv) -> None:
        self.costs, self.conv, self.seq = costs, conv, 0
        costs.restart()
        self.pointers = bytearray()
        self.of = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.later: str | None = None
        self.least: int | None = None
        self.most: int | None = None
        self.turns = 0

    def take(self, key: list, fault: str) -> None:
        self.key = key
        turn, initial = key[0], key[1][:1]
        if fault:
            self.of[fault] += 1
        if self.later is not None and initial + self.later not in _LEGAL:
            self.of["illegal"] += 1
        self.later = initial
        if turn is not None and turn != self.least:
            self.turns += 1
            self.least = turn
            self.most = turn if self.most is None else self.most
        self.pointers.append(self.costs.step(initial, fault))

    def stretch(self, last: bool) -> tuple:
        """The pointers gathered, in forward order, with the key of the first of their
        rows; with the counts if these are the first rows of the conversation."""
        self.seq -= 1
        out = bytes(reversed(self.pointers))
        self.pointers.clear()
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        counts = (gaps, *self.of.values(), self.costs.total()) if last else (None,) * 6
        return (self.conv, *self.key, self.seq, out, *counts)


def _backward_task(stretch: int):
    """Tasks that give out the backpointers, in stretches, of rows that come by
    conversation, last row first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, costs, schema = None, Costs(), {}
        for batch in batches:
            schema = {
                "conv": batch.schema.field(0).type, "turn": pa.int64(), "role": pa.string(),
                "digest": pa.binary(), "seq": pa.int64(), "pointers": pa.binary(),
                **dict.fromkeys(_SUMMARY, pa.int64()),
            }
            out = []
            for conv, *key, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if walk is None or walk.conv != conv:
                    if walk is not None:
                        out.append(walk.stretch(True))
                    walk = _Backward(costs, conv)
                elif len(walk.pointers) == stretch:
                    out.append(walk.stretch(False))
                walk.take(key, fault)
            yield _frame(out, schema)
        if walk is not None:
            yield _frame([walk.stretch(True)], schema)

    return run


class _Forward:
    """Edits of one conversation as its rows come by."""

    def __init__(self, conv) -> None:
        self.conv, self.edits, self.stretches = conv, Edits(), deque()
        self.at, self.counts = 0, (0,) * 6
        self.audit: list[str] = []
        self.repaired = hashlib.sha256()
        self.said = False

    def pointers(self, stretch: bytes, counts: tuple) -> None:
        self.stretches.append(stretch)
        if counts[0] is not None:
            self.counts = counts

    def row(self, role: str, text: str) -> list[tuple[str, str, str]]:
        """Edit, role and text of what is said up to this row, deleted rows too."""
        if self.at == len(self.stretches[0]):
            self.stretches.popleft()
            self.at = 0
        choice = self.stretches[0][self.at]
        self.at += 1
        return [
            (_EDITS[edit],
             speaker if edit in (_INSERT, _REROLE) else role, "" if edit == _INSERT else text)
            for edit, speaker in self.edits.of_row(choice, role[:1])
        ]

    def end(self) -> list[tuple[str, str, str]]:
        return [(_EDITS[edit], speaker, "") for edit, speaker in self.edits.to_end()]

    def note(self, said: list[tuple[str, str, str]]) -> None:
        for edit, role, text in said:
            self.audit.append(edit)
            if edit != "D":
                self.repaired.update(("\n" * self.said + f"{role}:{text}").encode())
                self.said = True


def _walks(batches: Iterator[pa.RecordBatch]):
    """For each batch the pairs of a conversation's walk and what it says next; None
    where it ends."""
    walk = None
    for batch in batches:
        said = []
        for conv, role, text, pointers, *counts in zip(
            *(c.to_pylist() for c in batch.columns), strict=True
        ):
            if walk is None or walk.conv != conv:
                if walk is not None:
                    said += [(walk, walk.end()), (walk, None)]
                walk = _Forward(conv)
            if pointers is None:
                said.append((walk, walk.row(role, text)))
            else:
                walk.pointers(pointers, tuple(counts))
        yield batch.schema.field(0).type, said
    if walk is not None:
        yield batch.schema.field(0).type, [(walk, walk.end()), (walk, None)]


def _summary_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for kind, said in _walks(batches):
        out = []
        for walk, rows in said:
            if rows is not None:
                walk.note(rows)
            else:
                out.append((walk.conv, *walk.counts, "".join(walk.audit),
                            walk.repaired.hexdigest()))
        yield _frame(out, {"conv": kind, **dict.fromkeys(_SUMMARY, pa.int64()),
                           "audit": pa.string(), "repaired_sha256": pa.string()})


def _rows_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for kind, said in _walks(batches):
        out = []
        for walk, rows in said:
            for row in rows or ():
                walk.said += 1
                out.append((walk.conv, walk.said, *row))
        yield _frame(out, {"conv": kind, "place": pa.int64(), "edit": pa.string(),
                           "role": pa.string(), "text": pa.string()})


def _streamed(
    scratch: Scratch, turns: DataFrame, conv: str, turn: str, role: str, text: str, stretch: int
) -> DataFrame:
    """Rows and stretches of backpointers, by conversation and in order, the stretch
    before its rows."""
    rows = _digested(turns, conv, turn, role, text)
    seen = Window.partitionBy("conv", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    faults = (
        rows.select("conv", *_ORDER, _fault(F.col("text")).alias("fault")).repartition("conv")
        .withColumn("again", F.row_number().over(seen) > 1)
        .withColumn("fault", F.when(F.col("again") & (F.col("fault") != "blank"), "duplicate")
                    .otherwise(F.col("fault")))
        .sortWithinPartitions(
            "conv", F.desc_nulls_last("turn"), *map(F.desc, _ORDER[1:]), F.desc("again")
        )
        .drop("again")
    )
    schema = wider(rows.select("conv", *_ORDER), "seq long, pointers binary, "
                   + ", ".join(f"{c} long" for c in _SUMMARY))
    pointers = scratch.store(faults.mapInArrow(_backward_task(stretch), schema))
    return (
        rows.withColumn("seq", F.lit(1).cast("long"))
        .unionByName(pointers, allowMissingColumns=True).repartition("conv")
        .sortWithinPartitions("conv", F.asc_nulls_first("turn"), *_ORDER[1:], "seq")
        .select("conv", "role", "text", "pointers", *_SUMMARY)
    )


def summaries(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    stretch: int = STRETCH,
) -> DataFrame:
    """One row per conversation: ``conv``, faults, ``cost``, ``audit`` and a digest.

    ``blank``, ``duplicate`` (role and text seen earlier) and ``truncated`` (no full stop
    at the end) count the rows by their first fault, ``gaps`` the turns missing between
    the first and the last, ``illegal`` the neighbours whose roles don't follow each
    other.  ``audit`` has the initials of the cheapest edits that lead to an optional
    system row and then pairs of user and assistant; of equally cheap ones the least by
    ASCII.  ``repaired_sha256`` digests the repaired ``role:text`` lines.

    Null roles and texts are one blank; rows of null conversation are one conversation;
    null turns come first and take no part in ``gaps``.  Rows of equal turn are ordered
    by role and a digest of the text; repeated rows are duplicates.  Texts of any length
    are compared by 128 bits of their digest.  No rows give no rows; other columns are
    not read.
    """
    scratch = Scratch(turns.sparkSession, "conversations")
    streamed = _streamed(scratch, turns, conv_col, turn_col, role_col, text_col, stretch)
    counts = ", ".join(f"{c} long" for c in _SUMMARY)
    return streamed.mapInArrow(
        _summary_task,
        wider(streamed.select("conv"), f"{counts}, audit string, repaired_sha256 string"),
    )


def repair(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    stretch: int = STRETCH,
) -> DataFrame:
    """The rows of all conversations with the edits of ``summaries``: ``conv``, ``place``,
    ``edit`` (D, I, K, R), ``role`` and ``text``; what is left without those of edit D is
    the repaired conversation.  Odd rows are treated as ``summaries`` says."""
    scratch = Scratch(turns.sparkSession, "conversations")
    streamed = _streamed(scratch, turns, conv_col, turn_col, role_col, text_col, stretch)
    return streamed.mapInArrow(
        _rows_task,
        wider(streamed.select("conv"), "place long, edit string, role string, text string"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by the checksum of ``conv_id:turn``.

    Of twenty remainders one drops a row, one empties its text, one takes its sentence
    ends out, one repeats it and one gives it to the user.  Nulls are one blank, in the
    checksum, the role and the text.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank)
                             for c in ("conv_id", "turn")))
    hit = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", blank)
    return (
        turns.withColumn("_hit", hit).where("_hit <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("_hit") == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
            F.when(F.col("_hit") == 1, "").when(F.col("_hit") == 2, F.translate(text, ".!?", ""))
            .otherwise(text).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("_hit") == 3, 2).otherwise(1)))
            .alias("_copy"),
        )
        .drop("_copy")
    )
