"""Conversation repair against all sequences of edits."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from tidemark.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, dropped boolean, fault string, audit int"


def faults(rows):
    """Of rows (role, text) in order."""
    out = []
    for k, (role, text) in enumerate(rows):
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append(1 if not bare else 2 if (role, text) in rows[:k] else 3 if bare[-1] not in ".!?" else 0)
    return out


def brute(rows):
    """(cost, audit, repaired lines) of the best of all edits with at most two insertions in a row."""
    found, judged = [], faults(rows)
    for edits in product("DKR", repeat=len(rows)):
        if any(f in (1, 2) and e != "D" for e, f in zip(edits, judged)):
            continue
        for made in product(("", "I", "II"), repeat=len(rows) + 1):
            audit = "".join(m + e for m, e in zip(made, [*edits, ""]))
            cost = sum({"K": 0, "R": 2, "D": 3, "I": 2}[e] for e in audit) + sum(f == 3 and e != "D" for e, f in zip(edits, judged))
            lines, at = [], 0
            for e in audit:
                role, text = ("", "") if e == "I" else rows[at]
                at += e != "I"
                if e != "D":
                    lines.append((e, role, text))
            options = [("user", "assistant") if e in "IR" else (role,) for e, role, _ in lines]
            if sum(len(o) for o in options) > 14:
                continue
            for roles in product(*options):
                if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r in roles)):
                    found.append((cost, audit, "\n".join(f"{r}:{t}" for r, (_, _, t) in zip(roles, lines))))
    best = min(found)
    assert len({x for x in found if x[:2] == best[:2]}) == 1
    return best


def expected(rows):
    """The result for rows (turn, role, text) of a conversation, in order."""
    judged, ini = faults([r[1:] for r in rows]), [r[1][:1] for r in rows]
    turns = {r[0] for r in rows if r[0] is not None}
    cost, audit, lines = brute([r[1:] for r in rows])
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, judged.count(1), judged.count(2), judged.count(3),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:])), cost, audit, hashlib.sha256(lines.encode()).hexdigest(),
    )


@pytest.fixture(scope="module")
def conversations():
    rng, out = random.Random(2), {}
    for conv in range(60):
        rows = []
        for _ in range(rng.randrange(0, 5)):
            rows.append((rng.choice([None, 0, 1, 2, 3, 7]), rng.choice(["user", "user", "assistant", "system", "tool", ""]), rng.choice(["Yes.", "no", " \t", "", "Why?\n", "é 东"])))
        out[conv] = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


@pytest.fixture(scope="module")
def wanted(conversations):
    return {c: expected(rows) for c, rows in conversations.items()}


def frame(spark, conversations):
    rows = [(c, *r, False, "x", 1) for c, rs in conversations.items() for r in rs]
    rows += [(c, 9, "user", "gone", True, "x", 1) for c, rs in conversations.items() if not rs or c == 5]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("segment", [256, 1, 2])
def test_cheapest_edits(spark, conversations, wanted, segment):
    got = {r.conv_id: tuple(r)[1:] for r in cr.repair(frame(spark, conversations), segment).collect()}
    assert got == wanted


def test_repaired_turns_give_the_digest(spark, conversations):
    rows = frame(spark, {None if c == 3 else c: rs for c, rs in conversations.items()})
    repaired = cr.repair(rows)
    lines = {r.conv_id: [] for r in repaired.collect()}
    for r in sorted(cr.repaired_turns(rows, repaired).collect(), key=lambda r: r.place):
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in lines.items()} == {r.conv_id: r.repaired_sha256 for r in repaired.collect()}


def test_long_conversations_do_not_depend_on_segments(spark):
    rng = random.Random(6)
    rows = {1: [(k, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", f"{k}", f"{k}.", ""])) for k in range(3000)]}
    whole, cut = (cr.repair(frame(spark, rows), n).collect() for n in (5000, 64))
    assert whole == cut and whole[0].cost > 1000


def test_damage(spark):
    given = [(c, t, r, x) for c in (*range(40), None) for t, r, x in [(0, "system", "A. b!"), (1, "user", None), (None, None, "c?"), (3, "assistant", "Same.")]]
    df = spark.createDataFrame([(*g, 5) for g in given], "conv_id long, turn long, role string, text string, dropped int")
    want = []
    for conv, turn, role, text in given:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        if kind in (0, 1):
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        want += [(conv, turn, role, text, kind == 0)] * (2 if kind == 3 else 1)
    key = lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else x for x in r)
    assert sorted(map(tuple, cr.damage(df).collect()), key=key) == sorted(want, key=key)


def test_every_conversation_has_a_row(spark):
    df = spark.createDataFrame([(None, None, None, None)], "conv_id long, turn long, role string, text string")
    (row,) = cr.repair(cr.damage(df)).collect()
    assert row.conv_id is None and (row.gaps, row.blank, row.cost, row.audit) == (0, 1, 3, "D")
    assert row.repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert cr.repair(cr.damage(df.limit(0))).collect() == []
