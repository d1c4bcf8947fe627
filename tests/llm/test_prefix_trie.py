"""The trie against a plain dictionary of all prefixes."""

import hashlib
import random
import re
import zlib

import pytest

from tradewatch.llm import prefix_trie, queries

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            out.setdefault(conv, []).append((turn is not None, turn or 0, role, digest, text))
    return {c: [(t[2], t[4]) for t in sorted(v)] for c, v in out.items()}


def rebuilt(by):
    out = {}
    for c, turns in by.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = by.get(c - c % 20, [])[:h] + turns[h:]
    return out


def nodes(by):
    """Every prefix with its members, then all figures by definition."""
    members = {}
    for c, turns in by.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def subtree(p):
        todo, out = [p], []
        while todo:
            out.append(todo.pop())
            todo.extend(children.get(out[-1], []))
        return out

    rows = []
    for p, m in members.items():
        below = subtree(p)
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in sorted(c for c in m if len(by[c]) == len(p)))
        leaves = sum(q not in children for q in below)
        rows.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=str)


def test_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = queries.op11_prefix_trie(spark, sf_dir)
    assert df.columns[:8] == NAMES
    assert found(df) == nodes(rebuilt(ordered(rows)))


def random_rows(seed, convs, deep, texts):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.choice([1, 2, 3, deep])):
            rows.append((c, t, r.choice(["user", "assistant"]) if texts > 2 else "user", f"word {r.randrange(texts)} \n x" if t < 3 or r.random() < 0.9 else None))
    return rows


@pytest.mark.parametrize("group_turns", [0, 30, prefix_trie.GROUP_TURNS])
def test_levels_and_blocks_give_the_same_nodes(spark, group_turns):
    rows = random_rows(3, 80, 9, 2) + [(900 + c, t, "user", "deep") for c in range(2) for t in range(20 + c)]
    assert found(prefix_trie.build(spark.createDataFrame(rows, SCHEMA), group_turns)) == nodes(ordered(rows))


def test_copies_of_one_conversation_are_a_few_rows(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(40_000, 40_400) for t in range(5)] + [(5, 0, "user", "turn 0")]
    df = prefix_trie.build(spark.createDataFrame(rows, SCHEMA))
    assert found(df) == nodes(ordered(rows))


def test_members_beyond_one_piece(spark):
    ids = [-5, -1, 3, 7, 1 << 14, (1 << 14) + 1, 5 << 14, 1 << 60]
    rows = [(c, 0, "user", "same") for c in ids]
    assert found(prefix_trie.build(spark.createDataFrame(rows, SCHEMA))) == nodes(ordered(rows))


def test_odd_rows(spark):
    rows = [(None, 0, "user", "no id"), (1, None, None, None), (1, 0, "", ""), (1, 0, "user", ""), (2, 3, "user", "x " * 300_000), (2, 3, "user", "x " * 300_000)]
    rows += [(3, 0, "us", "er"), (4, 0, "user", ""), (5, 0, "u", "ser"), (6, 1, "b", "t"), (6, 1, "a", "t"), (6, 1, "a", "s")]
    rows += [(c, t, "user", "only turn") for c in range(20, 60) for t in range(c % 3)]
    df = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], SCHEMA + ", depth int, key string, own int")
    assert found(prefix_trie.build(df)) == nodes(ordered(rows))
    whole = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turn_digests(df)))
    assert found(whole) == nodes(rebuilt(ordered(rows)))


def test_empty_table(spark):
    assert prefix_trie.build(spark.createDataFrame([], SCHEMA)).collect() == []
