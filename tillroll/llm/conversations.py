"""Repair of the structure of conversations by cheapest edits.

Rows are dealt by conversation and sorted by turn (nulls first, then role and
text), and each task streams through its conversations: the state of a dynamic
program over the shapes a conversation may have is carried from one Arrow batch
to the next.  A repaired conversation is empty or an optional system row and
then one or more pairs of user and assistant, told by the initial of the role.

Per row one of

====== ========= =========================================================
Keep   0         the row stays
Rerole 3         its role becomes user or assistant
Delete 4         it goes (the only choice for blank and duplicate rows)
Insert 3         an empty user or assistant row is put in before it
====== ========= =========================================================

and 3 more for a truncated row that is not deleted.  Of several cheapest edit
lists the one whose initials, read in order, come first in ASCII is taken.

Memory: a conversation holds four costs, four running digests and one byte per
row and state of backpointers.  Backpointers beyond ``SPILL_BYTES`` go to an
unnamed file of the task, which is gone when the task ends; a lost task starts
over.  Repeated rows are marked beforehand by a window over the same
partitioning, so no set of rows is held.  A conversation is streamed by one
task, whatever its length.

Ties: a prefix's edits never begin another prefix's of equal rows, since both
end with the letter of the last row.  So prefixes are ordered once and for all,
and a rank per state suffices to compare them.

Defined results: a null role or text is one space; null ids form one
conversation; repeated rows count as duplicates.  Other columns are left out.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3

#: ASCII white space, and the marks that end a finished text.
SPACE, STOPS = " \t\n\x0b\x0c\r", ".!?"

#: Bytes of backpointers held in memory for one conversation.
SPILL_BYTES = 1 << 24

#: States: nothing yet, after system, after user, after assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_KEPT = {("s", _START): _SYSTEM, ("a", _USER): _ASSISTANT,
         **{("u", s): _USER for s in (_START, _SYSTEM, _ASSISTANT)}}
_NEVER = 1 << 60

#: What may stand for one row: inserts, then the row's letter; in ASCII order.
_WORDS = sorted("I" * k + letter for k in range(3) for letter in "DKR")

#: Transitions worked out before, by (costs, ranks, kind of row).
_known: dict = {}


def _inserts(state: int) -> Iterator[tuple[int, int]]:
    """(inserts, state after them).  More would return to an earlier state."""
    yield 0, state
    for k in range(1, 3 if state in (_START, _SYSTEM) else 2):
        state = _NEXT[state]
        yield k, state


def _transitions(initial: str, must_go: bool, truncated: bool) -> list[tuple[int, int, int, int]]:
    """(from, index of the word, to, cost) for one kind of row."""
    out = []
    for state in range(4):
        for k, at in _inserts(state):
            cost, word = k * INSERT, "I" * k
            out.append((state, _WORDS.index(word + "D"), at, cost + DELETE))
            if must_go:
                continue
            extra = TRUNCATED * truncated
            if (initial, at) in _KEPT:
                out.append((state, _WORDS.index(word + "K"), _KEPT[initial, at], cost + KEEP + extra))
            out.append((state, _WORDS.index(word + "R"), _NEXT[at], cost + REROLE + extra))
    return out


_KINDS = {(i, g, t): _transitions(i, g, t) for i in ("s", "u", "a", "") for g in (True, False)
          for t in (True, False)}


def _step(costs: tuple, ranks: tuple, kind: tuple) -> tuple[int, tuple, tuple, tuple]:
    """(least cost, costs above it, ranks, (from, word) per state) after one row."""
    key = costs, ranks, kind
    if key in _known:
        return _known[key]
    best: list = [None] * 4
    for state, word, to, cost in _KINDS[kind]:
        if costs[state] < _NEVER:
            found = (costs[state] + cost, ranks[state], word, state)
            if best[to] is None or found < best[to]:
                best[to] = found
    low = min(b[0] for b in best if b)
    order = sorted(b[1:3] for b in best if b)
    out = (low, tuple(b[0] - low if b else _NEVER for b in best),
           tuple(order.index(b[1:3]) if b else 4 for b in best),
           tuple((b[3], b[2]) if b else (0, 0) for b in best))
    if len(_known) > 100_000:
        _known.clear()
    _known[key] = out
    return out


class _Back:
    """Backpointers of one conversation: one byte per row and state."""

    def __init__(self):
        self.held, self.file, self.rows = bytearray(), None, 0

    def add(self, moves: tuple) -> None:
        self.held += bytes([state << 4 | word for state, word in moves])
        self.rows += 1
        if len(self.held) >= SPILL_BYTES:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.held)
            self.held = bytearray()

    def trace(self, state: int) -> str:
        """The words that lead to ``state``, in order."""
        out = []
        if self.file:
            self.file.write(self.held)
            self.held = bytearray()
        stop = 4 * self.rows
        while stop:
            if self.file:
                begin = max(0, stop - SPILL_BYTES)
                self.file.seek(begin)
                part = self.file.read(stop - begin)
            else:
                begin, part = 0, self.held
            for at in range(len(part) - 4, -1, -4):
                move = part[at + state]
                out.append(_WORDS[move & 15])
                state = move >> 4
            stop = begin
        if self.file:
            self.file.close()
        return "".join(reversed(out))


class _Conversation:
    """What is known of a conversation after some of its rows."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.turn = None
        self.turns = self.cost = 0
        self.initial = None
        self.costs, self.ranks = (0, _NEVER, _NEVER, _NEVER), (0, 4, 4, 4)
        self.digests = [hashlib.sha256(), None, None, None]
        self.back = _Back()

    def add(self, turn, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if turn is not None:
            if turn != self.turn:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        kind = (initial if initial in ("s", "u", "a") else "",
                fault in ("blank", "duplicate"), fault == "truncated")
        low, self.costs, self.ranks, moves = _step(self.costs, self.ranks, kind)
        self.cost += low
        raw = text.encode()
        digests = []
        for to in range(4):
            if self.costs[to] >= _NEVER:
                digests.append(None)
                continue
            state, word = moves[to]
            digest, word = self.digests[state], _WORDS[word]
            if word != "D":
                digest = digest.copy()
                state = _put(digest, state, len(word) - 1)
                if word[-1] != "D":
                    name = role if word[-1] == "K" else _ROLE[to]
                    digest.update(b"\n" * (state != _START) + name.encode() + b":")
                    digest.update(raw)
            digests.append(digest)
        self.digests = digests
        self.back.add(moves)

    def close(self) -> tuple:
        ends = [(self.costs[s] + k * INSERT, self.ranks[s], s, k)
                for s, k in ((_START, 0), (_SYSTEM, 2), (_USER, 1), (_ASSISTANT, 0))
                if self.costs[s] < _NEVER]
        cost, _, state, k = min(ends)
        digest = self.digests[state].copy()
        _put(digest, state, k)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal,
                self.cost + cost, self.back.trace(state) + "I" * k, digest.hexdigest())


def _put(digest, state: int, inserts: int) -> int:
    """Add so many inserted rows to a digest; the state after them."""
    for _ in range(inserts):
        first, state = state == _START, _NEXT[state]
        digest.update(b"\n" * (not first) + _ROLE[state].encode() + b":")
    return state


AUDIT_FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _audits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = None

    def frame(done):
        return pd.DataFrame(done, columns=["conv_id", *AUDIT_FIELDS], dtype=object)

    for batch in batches:
        done = []
        for conv_id, turn, role, text, fault in zip(*(batch[c] for c in ORDERED)):
            if held is None or conv_id != held.conv_id:
                if held is not None:
                    done.append(held.close())
                held = _Conversation(conv_id)
            if fault != "absent":
                held.add(None if turn is None else int(turn), role, text, fault)
        if done:
            yield frame(done)
    if held is not None:
        yield frame([held.close()])


def _present(rows: DataFrame) -> Column:
    return F.col("present") if "present" in rows.columns else F.lit(True)


def _fault() -> Column:
    """The first fault of a row, or the empty string."""
    body = F.rtrim(F.col("text"), F.lit(SPACE))
    last = F.substring(body, -1, 1)
    return (
        F.when(~F.col("present"), "absent")
        .when(body == "", "blank")
        .when(F.col("seen") > 1, "duplicate")
        .when(~last.isin(*STOPS), "truncated")
        .otherwise("")
    )


#: Ids and turns travel as text: pandas would make floats of whole numbers beside nulls.
ORDERED = ["conv_id", "turn", "role", "text", "fault"]


def ordered_rows(rows: DataFrame) -> DataFrame:
    """ORDERED, all strings, dealt by conversation and sorted.

    ``rows`` has conv_id, turn, role, text and perhaps ``present``: a row where
    that is false only says that its conversation exists.
    """
    space = F.lit(" ")
    dealt = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        _present(rows).alias("present")).repartition("conv_id")
    again = Window.partitionBy("conv_id", "present", "role", "text").orderBy("turn")
    marked = dealt.withColumn("seen", F.row_number().over(again)).withColumn("fault", _fault())
    return marked.sortWithinPartitions("conv_id", "turn", "role", "text", "seen").select(
        F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", "text", "fault")


def audit_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and AUDIT_FIELDS.

    gaps: turns missing between the first and the last; blank, duplicate,
    truncated: rows by their first fault; illegal: neighbours whose initials are
    not su, ua or au; cost and audit: the cheapest edits; repaired_sha256: of the
    repaired ``role:text`` rows, joined by newlines.
    """
    longs = ", ".join(f"{c} long" for c in AUDIT_FIELDS[:6])
    found = ordered_rows(rows).mapInPandas(
        _audits, f"conv_id string, {longs}, audit string, repaired_sha256 string")
    return found.withColumn("conv_id", F.col("conv_id").cast(rows.schema["conv_id"].dataType))


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    audit, at, position, state = "", 0, 0, _START
    conv_id = None
    for batch in batches:
        out = []

        def put(edit, turn, role, text):
            nonlocal position
            out.append((conv_id, position, edit, turn, role, text))
            position += 1

        def inserts():
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                state = _NEXT[state]
                put("I", None, _ROLE[state], "")
                at += 1

        for conv, kind, turn, role, text in zip(
                *(batch[c] for c in ("conv_id", "kind", "turn", "role", "text"))):
            if kind == 0:
                conv_id, audit, at, position, state = conv, text, 0, 0, _START
            elif kind == 1:
                inserts()
                letter = audit[at]
                at += 1
                if letter == "K":
                    state = _KEPT[role[:1], state]
                    put("K", turn, role, text)
                elif letter == "R":
                    state = _NEXT[state]
                    put("R", turn, _ROLE[state], text)
            else:
                inserts()
        if out:
            yield pd.DataFrame(out, columns=["conv_id", "position", "edit", "turn", "role", "text"], dtype=object)


def repaired_turns(rows: DataFrame, audits: DataFrame | None = None) -> DataFrame:
    """The rows of the repaired conversations: conv_id, position, edit (K, R or I),
    turn (null for an inserted row), role, text.

    The edit list of a conversation (``audits``, or those of its rows) travels as
    a row before and one after its rows, so conversations are streamed here too.
    """
    audits = audit_conversations(rows) if audits is None else audits
    space, none = F.lit(" "), F.lit(None).cast("long")
    body = rows.filter(_present(rows)).select(
        "conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    before = audits.select("conv_id", F.lit(0), none, space, "audit")
    after = audits.select("conv_id", F.lit(2), none, space, F.lit(""))
    found = (
        body.union(before).union(after).repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", "turn", "role", "text")
        .select(F.col("conv_id").cast("string"), "kind", F.col("turn").cast("string"), "role", "text")
        .mapInPandas(_edited, "conv_id string, position long, edit string, turn string, role string, text string")
    )
    return found.withColumns({
        "conv_id": F.col("conv_id").cast(rows.schema["conv_id"].dataType), "turn": F.col("turn").cast("long")})
