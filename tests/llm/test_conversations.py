"""Conversation repair against every list of edits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from llm_helpers import llm  # noqa: F401
from tillroll.llm import conversations
from tillroll.llm.queries import damaged_conversations

BLANK = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        marks = BLANK.findall(text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen
                   else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_repair(rows):
    """The least (cost, audit, rows) over all edit lists."""
    put = [p for k in range(3) for p in itertools.product(("user", "assistant"), repeat=k)]
    choices = []
    for (_, role, text), fault in zip(rows, faults(rows)):
        own = [("D", 4, [])]
        if fault not in ("blank", "duplicate"):
            more = 3 * (fault == "truncated")
            own += [("K", more, [(role, text)]), ("R", 3 + more, [("user", text)]), ("R", 3 + more, [("assistant", text)])]
        choices.append([("I" * len(p) + a, 3 * len(p) + c, [(x, "") for x in p] + t) for p in put for a, c, t in own])
    choices.append([("I" * len(p), 3 * len(p), [(x, "") for x in p]) for p in put])
    best = None
    for pick in itertools.product(*choices):
        made = [t for _, _, part in pick for t in part]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in made)):
            found = (sum(c for _, c, _ in pick), "".join(a for a, _, _ in pick), made)
            best = min(best or found, found)
    return best


def summary(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    kinds, turns = faults(rows), [r[0] for r in rows if r[0] is not None]
    cost, audit, made = every_repair(rows)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(kinds.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()), made


def make(seed, conversations_, rows):
    r = random.Random(seed)
    out = []
    for c in range(conversations_):
        for _ in range(r.randint(1, rows)):
            out.append((None if c == 0 else c * 10**16 + 1, r.choice([None, 0, 1, 2, 5, 10**16 + 1]),
                        r.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]),
                        r.choice(["Yes.", "no", "a. ", "Well! ", " \t", "", None, "é?"])))
    return out


def frame(spark, rows):
    return spark.createDataFrame(
        [(*x, "k", 3) for x in rows],
        "conv_id long, turn long, role string, text string, fault string, seen int").repartition(3)


def grouped(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return groups


@pytest.mark.parametrize("batch", [10_000, 2])
def test_against_every_edit_list(llm, batch):  # noqa: F811
    rows = make(batch, 40, 3)
    llm.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        audits = conversations.audit_conversations(frame(llm, rows))
        got = {r.conv_id: tuple(r)[1:] for r in audits.collect()}
        turns = defaultdict(list)
        for r in conversations.repaired_turns(frame(llm, rows)).orderBy("position").collect():
            turns[r.conv_id].append((r.role, r.text))
    finally:
        llm.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for conv, own in grouped(rows).items():
        want, made = summary(own)
        assert got[conv] == want
        assert turns[conv] == made
    assert len(got) == len(grouped(rows))


def test_damage(llm):  # noqa: F811
    rows = make(7, 60, 3)
    want = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        want[conv] += []
        if kind:
            one = (turn, "user" if kind == 4 else role,
                   "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            want[conv] += [one] * (1 + (kind == 3))
    got = {r.conv_id: tuple(r)[1:] for r in conversations.audit_conversations(
        damaged_conversations(frame(llm, rows))).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert set(got) == set(want)
    for conv, own in want.items():
        if len(own) <= 4:
            assert got[conv] == (summary(own)[0] if own else nothing)
    assert nothing in got.values()


def test_long_conversation_spills(monkeypatch):
    r = random.Random(2)
    rows = [(i, r.choice(["user", "assistant", "system"]), r.choice(["a.", "b", "c?"]) + str(i) + ".") for i in range(3000)]
    found = []
    for limit in (1 << 24, 64):
        monkeypatch.setattr(conversations, "SPILL_BYTES", limit)
        held = conversations._Conversation("1")
        for turn, role, text in rows:
            held.add(turn, role, text, "")
        assert (held.back.file is None) == (limit > 64)
        found.append(held.close())
    assert found[0] == found[1] and len(found[0][7].replace("I", "")) == 3000


def test_empty_table(llm):  # noqa: F811
    df = frame(llm, make(1, 2, 2)).limit(0)
    assert conversations.audit_conversations(df).collect() == []
    assert conversations.repaired_turns(df).collect() == []
