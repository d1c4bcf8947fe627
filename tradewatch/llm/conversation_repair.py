"""Conversation structure repair by a Viterbi search whose survivors coalesce.

A conversation is repaired by edits of its turns: Keep (cost 0), Rerole to user or assistant (2), Delete (3; the only
edit of a blank turn or a repeated one) and Insert an empty user or assistant turn anywhere (2); a truncated turn that
stays costs 1 more.  The repaired roles read ``(system? (user assistant)+)?``.  The cheapest edits win, and of several
the ones whose initials in order (the audit) sort first.

``Survivors`` runs through the turns with one surviving path for each state of that grammar.  The paths are a tree of
back pointers with reference counts: a path that no state needs any more is freed, letters that all survivors share
are emitted at once, and a path that goes on alone grows in place, so what is held is the unresolved part only.  Equal
costs are settled by the complete unresolved suffixes: children of a node differ in their first letter, so two paths
are compared at the place where they part, however long they are.

On Spark: ``plan`` deals small rows (turn number, role, a 128-bit digest of role and text, two flags; no texts) by
conversation, sorts them and streams them through the search, so that a conversation of any length is read turn by
turn; ``apply`` streams the texts once, beside the audits, and gives the repaired turns.  What is held per
conversation is its audit, one byte an edit, which is part of the result.

Edge cases: turns are ordered by (turn, nulls first; role; digest), which settles ties; of equal turns all but the
first are repeated ones; a null role or text is one space; rows with a null conv_id are one conversation; very long
texts are streamed whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize_counted
from .common import prepare

START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
#: Where a turn with this role, or an inserted or reroled one, leads from each state.
ON_SYSTEM = {START: SYSTEM}
ON_USER = {START: USER, SYSTEM: USER, ASSISTANT: USER}
ON_ASSISTANT = {USER: ASSISTANT}
AHEAD = {**ON_USER, **ON_ASSISTANT}
BY_INITIAL = {"s": ON_SYSTEM, "u": ON_USER, "a": ON_ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}

NOT_SPACE = r"[^\x20\x09-\x0D]"
PLAN_SCHEMA = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
TURN_SCHEMA = "conv_id long, step long, edit string, role string, text string"


class _Node:
    """Letters that follow the parent's; ``refs`` counts children and states that end here."""

    __slots__ = ("parent", "letters", "depth", "refs")

    def __init__(self, parent: _Node | None, letters: bytes):
        self.parent, self.letters, self.refs = parent, bytearray(letters), 0
        self.depth = 0 if parent is None else parent.depth + 1
        if parent is not None:
            parent.refs += 1


def _parts(a: _Node, more_a: int, b: _Node, more_b: int) -> tuple[int, int]:
    """The first letters in which two paths differ: those of nodes a and b, each followed by one more letter."""
    while a is not b:
        if a.depth >= b.depth:
            a, more_a = a.parent, a.letters[0]
        else:
            b, more_b = b.parent, b.letters[0]
    return more_a, more_b


class Survivors:
    """The cheapest edits so far for every state, as a tree of back pointers."""

    def __init__(self):
        root = _Node(None, b"")
        root.refs = 1
        self.root = root
        self.done = bytearray()
        self.live: dict[int, tuple[int, _Node]] = {START: (0, root)}
        self._insert()

    def turn(self, initial: str, faulty: bool, truncated: bool) -> None:
        """One more turn: its role's initial, whether it has to go, whether it is truncated."""
        best: dict[int, tuple[int, _Node, int]] = {}

        def offer(state: int, cost: int, node: _Node, letter: int) -> None:
            known = best.get(state)
            if known is None or cost < known[0]:
                best[state] = (cost, node, letter)
            elif cost == known[0]:
                new, old = _parts(node, letter, known[1], known[2])
                if new < old:
                    best[state] = (cost, node, letter)

        for state, (cost, node) in self.live.items():
            offer(state, cost + DELETE, node, 68)  # D
            if not faulty:
                kept = BY_INITIAL.get(initial, {}).get(state)
                if kept is not None:
                    offer(kept, cost + KEEP + truncated, node, 75)  # K
                reroled = AHEAD.get(state)
                if reroled is not None:
                    offer(reroled, cost + REROLE + truncated, node, 82)  # R
        heirs: dict[int, int] = {}
        for _, node, _ in best.values():
            heirs[id(node)] = heirs.get(id(node), 0) + 1
        old = [node for _, node in self.live.values()]
        self.live = {}
        grown = set()
        for state, (cost, node, letter) in best.items():
            if heirs[id(node)] == 1 and node.refs == 1:  # this path goes on alone
                node.letters.append(letter)
                grown.add(id(node))
                self.live[state] = (cost, node)
            else:
                self.live[state] = (cost, self._child(node, letter))
        for node in old:
            if id(node) not in grown:
                self._free(node)
        self._insert()
        self._drop_beaten()
        self._emit()

    def _child(self, node: _Node, letter: int) -> _Node:
        child = _Node(node, bytes((letter,)))
        child.refs = 1
        return child

    def _free(self, node: _Node | None) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            node = node.parent

    def _insert(self) -> None:
        """Inserted turns after this one: two at most (a third would only repeat a state at a higher cost)."""
        for _ in range(2):
            for state, (cost, node) in list(self.live.items()):
                there = AHEAD[state]
                known = self.live.get(there)
                if known is not None:
                    if cost + INSERT > known[0]:
                        continue
                    if cost + INSERT == known[0]:
                        new, old = _parts(node, 73, known[1], 0)
                        if new >= old:
                            continue
                self.live[there] = (cost + INSERT, self._child(node, 73))  # I
                if known is not None:
                    self._free(known[1])

    def _drop_beaten(self) -> None:
        """Whatever may follow ``SYSTEM`` may follow ``ASSISTANT`` too, and what may follow ``START`` with one turn deleted."""
        if ASSISTANT in self.live:
            limit = self.live[ASSISTANT][0]
            for state, more in ((SYSTEM, 0), (START, DELETE)):
                if state in self.live and self.live[state][0] > limit + more:
                    self._free(self.live.pop(state)[1])

    def _emit(self) -> None:
        """Letters above the place where the survivors part are final."""
        ends = [node for _, node in self.live.values()]
        while True:
            self.done += self.root.letters
            self.root.letters.clear()
            if self.root.refs != 1 or any(n is self.root for n in ends):
                return
            node = ends[0]
            while node.parent is not self.root:
                node = node.parent
            node.parent = None
            self.root = node

    def held(self) -> int:
        """Letters that are not resolved yet."""
        seen, total = set(), 0
        for _, node in self.live.values():
            while node is not None and id(node) not in seen:
                seen.add(id(node))
                total += len(node.letters)
                node = node.parent
        return total

    def finish(self) -> tuple[int, str]:
        """Cost and audit of the whole conversation."""
        ends = [self.live[s] for s in (START, ASSISTANT) if s in self.live]
        best = ends[0]
        for other in ends[1:]:
            if other[0] < best[0]:
                best = other
            elif other[0] == best[0]:
                new, old = _parts(other[1], 0, best[1], 0)
                if new < old:
                    best = other
        tail, node = [], best[1]
        while node is not None:
            tail.append(bytes(node.letters))
            node = node.parent
        return best[0], (bytes(self.done) + b"".join(reversed(tail))).decode()


def _rows(turns: DataFrame) -> DataFrame:
    """Turns without nulls in role and text, with the digest that orders and identifies them."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumn("digest", F.substring(F.unhex(F.sha2(whole, 256)), 1, 16))


def _by_conversation(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def fault(text: Column) -> tuple[Column, Column]:
    """Whether a text is blank, and whether it breaks off (its last character that is no white space ends no sentence)."""
    return ~text.rlike(NOT_SPACE), ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def plan(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation: gaps in its turn numbers, faults, adjacent roles out of order, cost and audit of the cheapest edits.

    ``ids`` (conv_id) names conversations that may have no turns; they get zeros and an empty audit.
    """
    prepare(turns.sparkSession)
    blank, broken = fault(F.col("text"))
    rows = _rows(turns)
    same = Window.partitionBy("conv_id", "digest").orderBy("turn")
    initial = F.substring("role", 1, 1)
    small = rows.select("conv_id", "turn", "role", "digest", initial.alias("initial"), blank.alias("blank"), broken.alias("broken"))
    small = small.withColumn("again", F.row_number().over(same) > 1).withColumn("real", F.lit(True))
    if ids is not None:
        marks = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        small = small.unionByName(marks.withColumn("real", F.lit(False)), allowMissingColumns=True)
    ordered = _by_conversation(small, "real", "turn", "role", "digest", "again").select("conv_id", "real", "turn", "initial", "blank", "again", "broken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PLAN_SCHEMA.split(", ")]
        types = [pa.int64()] * (len(names) - 1) + [pa.string()]
        now: _Conversation | None = None
        for batch in batches:
            out = []
            for conv_id, real, *turn in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        out.append(now.row())
                    now = _Conversation(conv_id)
                if real:
                    now.turn(*turn)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(now.row(), types, strict=True)], names=names)

    return ordered.mapInArrow(run, PLAN_SCHEMA)


class _Conversation:
    """Counts and survivors of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.search = conv_id, Survivors()
        self.first: int | None = None
        self.last: int | None = None
        self.numbers = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None

    def turn(self, number: int | None, initial: str, blank: bool, again: bool, broken: bool) -> None:
        if number is not None and number != self.last:
            self.first = number if self.first is None else self.first
            self.last = number
            self.numbers += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.blank += blank
        self.duplicate += again and not blank
        truncated = broken and not blank and not again
        self.truncated += truncated
        self.search.turn(initial, blank or again, truncated)

    def row(self) -> tuple:
        cost, audit = self.search.finish()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.numbers
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def apply(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, step (1..), edit (K, R or I), role, text.

    Turns of a conversation stand one after the other in order inside a partition.
    """
    prepare(turns.sparkSession)
    rows = _rows(turns).withColumn("real", F.lit(True))
    audits = plans.select("conv_id", F.col("audit"), F.lit(False).alias("real"))
    both = _by_conversation(rows.unionByName(audits, allowMissingColumns=True), "real", "turn", "role", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        names = [x.split()[0] for x in TURN_SCHEMA.split(", ")]
        conv_id, audit, at, step, state = None, "", 0, 0, START
        for batch in batches:
            out: list[tuple] = []

            def put(letter: str, role: str | None, text: str) -> None:
                nonlocal step, state
                state = AHEAD[state] if letter != "K" else BY_INITIAL[role[0]][state]
                step += 1
                out.append((conv_id, step, letter, NAMES[state] if letter != "K" else role, text))

            def inserted() -> None:
                nonlocal at
                while at < len(audit) and audit[at] == "I":
                    put("I", None, "")
                    at += 1

            for c, real, a, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not real:  # the audit comes before the conversation's turns
                    conv_id, audit, at, step, state = c, a, 0, 0, START
                    inserted()
                    continue
                letter = audit[at]
                at += 1
                if letter != "D":
                    put(letter, role, text)
                inserted()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return both.select("conv_id", "real", "audit", "role", "text").mapInArrow(run, TURN_SCHEMA)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its repaired turns as ``role:text`` lines, read from ``apply``'s rows as they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h, fresh = None, None, True

        def rows(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["conv_id", "repaired_sha256"])

        for batch in batches:
            done = []
            for conv_id, step, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "step", "role", "text")], strict=True):
                if step == 1:
                    if not fresh:
                        done.append((now, h.hexdigest()))
                    now, h, fresh = conv_id, hashlib.sha256(), False
                else:
                    h.update(b"\n")
                h.update(role.encode() + b":" + text.encode())
            if done:
                yield rows(done)
        if not fresh:
            yield rows([(now, h.hexdigest())])

    return repaired.mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``plan`` with the digest of the repaired turns."""
    plans, _ = materialize_counted(plan(turns, ids), "audits")
    found = digests(apply(turns, plans)).withColumnRenamed("conv_id", "_conv")
    joined = plans.join(found, plans["conv_id"].eqNullSafe(found["_conv"]), "left")
    return joined.select(*plans.columns, F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damage(conversations: DataFrame) -> DataFrame:
    """Turns damaged by crc32(``conv_id:turn``) % 20: 0 drops one, 1 empties its text, 2 takes its ``[.!?]`` out, 3 repeats it, 4 calls it a user's."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(name) % 20).alias("_kind"))
    kind = F.col("_kind")
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    damaged = rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("_times"))
    return damaged.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_times")))).drop("_times", "_copy")
