"""Conversation repair against all possible edits of short conversations, and against a plain dynamic programme."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tradewatch.llm import conversation_repair as cr
from tradewatch.llm import queries

SHAPE = re.compile(r"(s?(ua)+)?\Z")
SPACE = " \t\n\v\f\r"


def faults(rows):
    """(initial, has to go, truncated) of each turn, and the counts."""
    seen, out, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in rows:
        body = text.strip(SPACE)
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if kind:
            counts[kind] += 1
        out.append((role[:1], kind in ("blank", "duplicate"), kind == "truncated"))
    return out, counts


def roles_of(turns, audit):
    """Roles of the repaired turns, or None where the audit does not fit."""
    out, at = "", 0
    for letter in audit:
        if letter == "I":
            out += "a" if out.endswith("u") else "u"
            continue
        initial, faulty, _ = turns[at]
        at += 1
        if letter == "D":
            continue
        if faulty:
            return None
        out += (initial or "?") if letter == "K" else "a" if out.endswith("u") else "u"
    return out


def every_edit(turns):
    best = None
    for letters in itertools.product("DKR", repeat=len(turns)):
        for gaps in itertools.product(("", "I", "II"), repeat=len(turns) + 1):
            audit = gaps[0] + "".join(a + g for a, g in zip(letters, gaps[1:], strict=True))
            roles = roles_of(turns, audit)
            if roles is None or not SHAPE.match(roles):
                continue
            cost = 3 * audit.count("D") + 2 * audit.count("R") + 2 * audit.count("I") + sum(t[2] for t, a in zip(turns, letters, strict=True) if a != "D")
            if best is None or (cost, audit) < best:
                best = (cost, audit)
    return best


def programme(turns):
    """Cheapest (cost, audit) for every possible roles' state, whole strings compared."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserted(states):
        for _ in range(2):
            for state, (cost, audit) in list(states.items()):
                new = (cost + 2, audit + "I")
                if new < states.get(step[state], (1 << 60, "")):
                    states[step[state]] = new
        return states

    states = inserted({"": (0, "")})
    for initial, faulty, truncated in turns:
        new = {}

        def offer(state, value, into=new):
            if value < into.get(state, (1 << 60, "")):
                into[state] = value

        for state, (cost, audit) in states.items():
            offer(state, (cost + 3, audit + "D"))
            if not faulty:
                if initial and SHAPE.match(state.replace("a", "ua") + initial + {"s": "ua", "u": "a", "a": ""}.get(initial, "x")) or (state == "u" and initial == "a"):
                    offer(initial, (cost + truncated, audit + "K"))
                offer(step[state], (cost + 2 + truncated, audit + "R"))
        states = inserted(new)
    return min(states[s] for s in ("", "a") if s in states)


def searched(turns):
    s = cr.Survivors()
    for turn in turns:
        s.turn(*turn)
    return s.finish()


def test_survivors_find_the_cheapest_of_all_edits():
    kinds = [("u", False, False), ("a", False, False), ("s", False, False), ("x", False, False), ("u", True, False), ("a", False, True), ("", False, False)]
    for n in range(4):
        for turns in itertools.product(kinds, repeat=n):
            if n < 3 or hash(turns) % 5 == 0:
                assert searched(turns) == every_edit(turns), turns


@pytest.mark.parametrize("seed", range(40))
def test_survivors_equal_a_plain_programme_on_long_conversations(seed):
    r = random.Random(seed)
    turns = [(r.choice("uuuaaas x"), r.random() < 0.2, r.random() < 0.3) for _ in range(r.randint(5, 120))]
    assert searched(turns) == programme(turns)


def test_what_is_held_stays_small():
    alternating = [("u" if i % 2 == 0 else "a", i % 7 == 0, i % 5 == 0) for i in range(4000)]
    s = cr.Survivors()
    most = 0
    for turn in alternating:
        s.turn(*turn)
        most = max(most, s.held())
    assert most < 64
    users = cr.Survivors()  # two paths that never meet: their letters are all that is held
    nodes = set()
    for _ in range(4000):
        users.turn("u", False, False)
        for _, node in users.live.values():
            while node is not None:
                nodes.add(id(node))
                node = node.parent
    assert len(nodes) < 20
    assert users.finish() == programme([("u", False, False)] * 4000)


def damaged(rows):
    """Turns after damage by conversation, in order."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " ")):
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub(r"[.!?]", "", text)
        if kind == 4:
            role = "user"
        out.setdefault(conv, []).extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    return out


def expected(rows):
    out = {}
    for conv, turns in damaged(rows).items():
        kinds, counts = faults([t[1:] for t in turns])
        cost, audit = programme(kinds)
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(kinds))
        lines, at, state = [], 0, ""
        for letter in audit:
            role, text = ("", "") if letter == "I" else turns[at][1:]
            at += letter != "I"
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if state == "u" else "user"
            state = role[:1]
            lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return out


def result(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def test_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.op13_conversation_repair(spark, sf_dir)
    assert found.columns[:9] == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert result(found) == expected(rows)


def test_odd_rows(spark):
    r = random.Random(5)
    rows = [(None, i, "user", f"no id {i}.") for i in range(5)] + [(1, None, None, None), (1, None, "user", ""), (1, 5, "robot", "ok"), (1, 9, "", "x.")]
    rows += [(2, 0, "user", "same.")] * 3 + [(2, 1, "assistant", "same.")] * 2
    rows += [(3, t, r.choice(["system", "user", "assistant", "User"]), r.choice(["Yes.", "no", "", "\t", "Yes. ", "ä?", "x" * 200_000])) for t in range(-3, 40)]
    rows += [(c, 0, "assistant", "alone!") for c in range(10, 40)]  # some lose their only turn
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "'x' as audit", "1 as real", "2 as _kind", "3 as step")
    assert sum(not t for t in damaged(rows).values()) > 0
    assert result(cr.repair(cr.damage(df), df)) == expected(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair(cr.damage(df), df).collect() == []


def test_repaired_turns_have_the_right_shape(spark, sf_dir):
    turns = cr.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    by = {}
    for row in cr.apply(turns, cr.plan(turns)).collect():
        by.setdefault(row["conv_id"], []).append(row)
    assert by
    for rows in by.values():
        rows.sort(key=lambda x: x["step"])
        assert [x["step"] for x in rows] == list(range(1, len(rows) + 1))
        assert SHAPE.match("".join(x["role"][0] for x in rows))
        assert all((x["text"] == "") == (x["edit"] == "I") for x in rows)
