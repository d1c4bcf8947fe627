"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns (role, text); its members are the conversations that start with it.  The
trie is built from the bottom: at the maximum depth, conversations that end there are regrouped with what survived from
below; each group is a node, whose figures are complete at that moment; its last turn is stripped and it goes on to the
next depth as one survivor that counts as one child.  So nodes are found and subtrees summed in the same descent.

A conversation travels as its path: 24 bytes a turn, a 128-bit chained digest of all turns so far and the turn's word
count.  Stripping a turn is cutting the path.  Equal conversations are one row from the start, and every regrouping is a
hash aggregation combined before the shuffle, so a prefix that a third of all conversations share is a few rows a task.

Deep tries would need one shuffle a level.  So runs of levels are peeled at once where that is safe: survivors are dealt
by their prefix of ``cut`` turns and peeled inside a task down to that depth.  ``cut`` is the smallest power of two under
which no prefix holds more than ``GROUP_TURNS`` turns below it, by an exact count of all prefixes; where there is none,
and for the top levels, Spark regroups level by level.  Both ways give the same nodes.

Edge cases: turns are ordered by (turn, nulls first; role; digest), which settles ties; repeated rows are turns; a null
role or text is empty; rows with a null conv_id belong to no conversation; very long texts are digested whole and never
shuffled; other columns are ignored; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize_counted
from .common import prepare

#: Bytes of a turn in a path: 16 of the chained digest, 8 of the word count (big-endian).
STEP, KEY = 24, 16
ROOT = b"\0" * KEY
#: Most turns below a prefix that one task peels at once.
GROUP_TURNS = 200_000
#: Levels that are always peeled one by one.
TOP = 2
#: Ids of one piece of a node's list of members (2 ** bits).
PIECE_BITS = 14

MESSAGE_SCHEMA = "depth int, path binary, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
NODE_SCHEMA = "depth int, key binary, parent_key binary, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
PEELED_SCHEMA = NODE_SCHEMA + ", path binary"
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def turn_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest of role and text, words of the text; texts go no further."""
    empty = F.lit("")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    ).filter("conv_id is not null")
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return rows.select("conv_id", "turn", "role", F.substring(F.unhex(F.sha2(whole, 256)), 1, KEY).alias("digest"), words.alias("words"))


def rebuilt(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Every conversation with its first h turns replaced by those of the first conversation of its group; h = crc32(id) % most.

    ``head`` turns come from there; of the conversation's own turns the first ``skip`` are to be left out.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % most
    own = turns.select("conv_id", F.lit(False).alias("head"), "turn", "role", "digest", "words", h.cast("int").alias("skip"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "digest")
    firsts = turns.filter(F.col("conv_id") % group == 0).withColumn("at", F.row_number().over(order)).filter(F.col("at") < most)
    firsts = firsts.select(F.col("conv_id").alias("first"), F.col("at").cast("long").alias("at"), "digest", "words")
    ids = turns.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("first"), h.cast("int").alias("skip"))
    heads = ids.filter("skip > 0").join(firsts, "first").filter("at <= skip")
    return own.unionByName(heads.select("conv_id", F.lit(True).alias("head"), F.col("at").alias("turn"), F.lit("").alias("role"), "digest", "words", "skip"))


def as_they_are(turns: DataFrame) -> DataFrame:
    return turns.withColumns({"head": F.lit(False), "skip": F.lit(0)})


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, depth, path: one row per conversation, streamed from its sorted turn digests."""
    ordered = turns.withColumn("own", ~F.col("head")).repartition("conv_id").sortWithinPartitions("conv_id", "own", "turn", "role", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, left, key, path = None, 0, ROOT, bytearray()

        def table(rows: list[tuple]) -> pa.RecordBatch:
            ids, whole = [r[0] for r in rows], [r[1] for r in rows]
            depths = [len(p) // STEP for p in whole]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(depths, pa.int32()), pa.array(whole, pa.binary())], names=["conv_id", "depth", "path"])

        for batch in batches:
            rows = []
            for conv_id, own, skip, digest, words in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if conv_id != now:
                    if now is not None:
                        rows.append((now, bytes(path)))
                    now, left, key, path = conv_id, skip, ROOT, bytearray()
                if own and left:
                    left -= 1
                    continue
                key = hashlib.sha256(key + digest).digest()[:KEY]
                path += key + words.to_bytes(8, "big")
            if rows:
                yield table(rows)
        if now is not None:
            yield table([(now, bytes(path))])

    return ordered.select("conv_id", "own", "skip", "digest", "words").mapInArrow(run, "conv_id long, depth int, path binary")


def _key(path: Column, depth: Column) -> Column:
    """The chained digest of the first ``depth`` turns."""
    return F.when(depth == 0, F.lit(ROOT)).otherwise(F.substring(path, (depth - 1) * STEP + 1, F.lit(KEY)))


def _level(messages: DataFrame, depth: int) -> DataFrame:
    """The nodes of one depth from all that ends there or survived from below (PEELED_SCHEMA)."""
    d = F.lit(depth)
    merged = messages.groupBy("path").agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in SUMS])
    words = F.conv(F.hex(F.substring("path", F.lit((depth - 1) * STEP + KEY + 1), F.lit(8))), 16, 10).cast("long") if depth else F.lit(0)
    parent = _key(F.col("path"), F.lit(depth - 1)) if depth else F.lit(None).cast("binary")
    return merged.select(
        d.cast("int").alias("depth"),
        _key(F.col("path"), d).alias("key"),
        parent.alias("parent_key"),
        "conv_id",
        "n_convs",
        "n_children",
        F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * words).alias("saved_tokens"),
        F.substring("path", F.lit(1), F.lit(max(depth - 1, 0) * STEP)).alias("path"),
    )


def peel(rows: list[tuple], cut: int) -> Iterator[tuple]:
    """Nodes deeper than ``cut`` of messages that share their first ``cut`` turns (rows of PEELED_SCHEMA).

    Nodes at depth cut + 1 carry the path that survives; the others carry none.
    """
    levels: dict[int, dict[bytes, list]] = {}

    def merge(depth: int, path: bytes, conv_id: int, n_convs: int, n_children: int, n_leaves: int, saved: int) -> None:
        key = path[(depth - 1) * STEP : (depth - 1) * STEP + KEY]
        known = levels.setdefault(depth, {}).get(key)
        if known is None:
            levels[depth][key] = [path, conv_id, n_convs, n_children, n_leaves, saved]
        else:
            known[1] = min(known[1], conv_id)
            known[2] += n_convs
            known[3] += n_children
            known[4] += n_leaves
            known[5] += saved

    for row in rows:
        merge(*row)
    for depth in range(max(levels, default=0), cut, -1):
        at = (depth - 1) * STEP
        for key, (path, conv_id, n_convs, n_children, n_leaves, saved) in levels.pop(depth, {}).items():
            leaves = n_leaves if n_children else 1
            saved += (n_convs - 1) * int.from_bytes(path[at + KEY : at + STEP], "big")
            yield depth, key, path[at - STEP : at - STEP + KEY], conv_id, n_convs, n_children, leaves, saved, path[:at] if depth == cut + 1 else None
            if depth > cut + 1:
                merge(depth - 1, path, conv_id, n_convs, 1, leaves, saved)


def _block(messages: DataFrame, cut: int) -> DataFrame:
    """All nodes deeper than ``cut``, peeled inside the tasks that hold all messages of a prefix (PEELED_SCHEMA)."""
    names = [x.split()[0] for x in PEELED_SCHEMA.split(", ")]
    types = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 5, pa.binary()]
    dealt = messages.withColumn("prefix", F.substring("path", F.lit((cut - 1) * STEP + 1), F.lit(KEY))).repartition("prefix").sortWithinPartitions("prefix")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            rows = []
            for prefix, *message in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if prefix != now:
                    rows.extend(peel(held, cut))
                    now, held = prefix, []
                held.append(message)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        rows = list(peel(held, cut))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return dealt.select("prefix", *[x.split()[0] for x in MESSAGE_SCHEMA.split(", ")]).mapInArrow(run, PEELED_SCHEMA)


def _cut(messages: DataFrame, top: int, group_turns: int) -> int:
    """The smallest power of two (TOP at least) under which no prefix holds more than ``group_turns`` turns, or top - 1."""
    cuts = [c for c in (TOP << k for k in range(31)) if c < top - 1]
    if not cuts:
        return top - 1
    each = messages.select("depth", "path", F.explode(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("depth"))).alias("cut"))
    held = each.groupBy("cut", _key(F.col("path"), F.col("cut")).alias("prefix")).agg(F.sum(F.col("depth") - F.col("cut")).alias("turns"))
    most = {r["cut"]: r["turns"] for r in held.groupBy("cut").agg(F.max("turns").alias("turns")).collect()}
    return min((c for c in cuts if most.get(c, 0) <= group_turns), default=top - 1)


def _member_digests(whole: DataFrame) -> DataFrame:
    """key, SHA-256 of the comma-joined ids of the conversations that end at a node, in order.

    Ids are listed in pieces of bounded length, and the pieces of a node stream through one hash in order.
    """
    ended = whole.select(_key(F.col("path"), F.col("depth")).alias("key"), "conv_id", F.shiftright("conv_id", PIECE_BITS).alias("piece"))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = ended.groupBy("key", "piece").agg(listed.alias("ids")).repartition("key").sortWithinPartitions("key", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, hashlib.sha256()

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["end_key", "ends_sha256"])

        for batch in batches:
            rows = []
            for key, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != now:
                    if now is not None:
                        rows.append((now, h.hexdigest()))
                    now, h = key, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(ids.encode())
            if rows:
                yield table(rows)
        if now is not None:
            yield table([(now, h.hexdigest())])

    return pieces.select("key", "ids").mapInArrow(run, "end_key binary, ends_sha256 string")


def trie(turns: DataFrame, group_turns: int = GROUP_TURNS) -> DataFrame:
    """The nodes of the trie of all conversations given by their turn digests (see ``as_they_are``, ``rebuilt``).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, node (hex
    of its chained digest).
    """
    spark = turns.sparkSession
    prepare(spark)
    whole, _ = materialize_counted(paths(turns), "paths")
    zero = F.lit(0).cast("long")
    ended = whole.groupBy("depth", "path").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    ended = ended.select("depth", "path", "conv_id", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"))
    ended, rows = materialize_counted(ended, "ended")
    top = ended.agg(F.max("depth")).first()[0] if rows else -1
    found, survivors = [], None
    while top >= 0:
        messages = ended if survivors is None else ended.filter(F.col("depth") <= top).unionByName(survivors)
        cut = _cut(messages, top, group_turns)
        below = messages.filter(F.col("depth") > cut)
        nodes, _ = materialize_counted(_block(below, cut) if cut < top - 1 else _level(below, top), f"nodes-{top}")
        found.append(nodes.drop("path"))
        alive = nodes.filter((F.col("depth") == cut + 1) & (F.col("depth") > 0))
        survivors = alive.select((F.col("depth") - 1).alias("depth"), "path", "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens")
        top = cut
    nodes = reduce(DataFrame.unionByName, found, spark.createDataFrame([], NODE_SCHEMA))
    # a node with one member is its children's smallest member too, so only shared parents are looked up
    shared = nodes.filter("n_convs > 1").select(F.col("key").alias("_key"), F.col("conv_id").alias("_conv"))
    placed = nodes.join(shared, nodes["parent_key"] == shared["_key"], "left").join(_member_digests(whole), F.col("key") == F.col("end_key"), "left")
    return placed.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > 0, F.coalesce("_conv", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        F.lower(F.hex("key")).alias("node"),
    )


def build(conversations: DataFrame, group_turns: int = GROUP_TURNS) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) as they are."""
    return trie(as_they_are(turn_digests(conversations)), group_turns)
