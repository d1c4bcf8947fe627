"""Sharding by longest-processing-time scheduling, law ``bytes`` (sizes near equal).

Rows of equal text form a group that stays together.  Groups are taken by falling size and each goes to the least
loaded shard, kept in a heap (ties: the lowest shard).  Groups of one size are interchangeable, so the schedule is made
over size classes: the driver holds one number per size that occurs (k sizes take k * k / 2 bytes at least, so there are
at most the square root of twice the table's bytes of them) and gives a class of many groups to the shards at once, by
the level up to which the heap would fill them.  The loads are those of the plain schedule, group by group.

On Spark: group sums are a hash aggregation (a group holding a third of all rows arrives as one row per task).  Groups
are sorted over range partitions by (size, key), so a size that most groups have spans many partitions; counts per
(partition, size) give every group its rank in its class, and the ranks are dealt to the shards in runs.  The shard
reaches the rows by a join on the group; groups of at least 1 / ``HOT_PARTS`` of all rows (so at most ``HOT_PARTS``) are
broadcast instead.  Slots are numbered without one task per shard: every shard is cut into blocks by a hash of a row
number, blocks get offsets from their counts, and rows are numbered inside a block.

Edge cases: a null text counts as an empty text (size 1) and groups with it; very long texts are measured and hashed
whole; groups of equal size share their class in order of their key; repeated rows are separate rows of one group and
get separate slots; null ids are kept, however many; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from itertools import groupby

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize_counted
from .common import partitions, prepare

SHARDS = 16
HOT_PARTS = 1024
#: Rows of one numbering block, on average.
BLOCK_ROWS = 4000
#: Groups of a class that are scheduled one by one; larger classes are filled to a level.
ONE_BY_ONE = 64


def fill(loads: list[int], size: int, count: int) -> list[int]:
    """How many of ``count`` items of one size each shard gets if each goes to the least loaded shard (ties: lowest)."""
    if count <= ONE_BY_ONE:
        heap = [(load, s) for s, load in enumerate(loads)]
        heapq.heapify(heap)
        out = [0] * len(loads)
        for _ in range(count):
            load, s = heap[0]
            out[s] += 1
            heapq.heapreplace(heap, (load + size, s))
        return out

    def below(level: int) -> list[int]:
        """Items that shards get while their load is under the level."""
        return [max(0, -(-(level - load) // size)) for load in loads]

    low, high = min(loads), max(loads) + size * count
    while low < high:  # the highest level that does not take more items than there are
        middle = (low + high + 1) // 2
        if sum(below(middle)) <= count:
            low = middle
        else:
            high = middle - 1
    out = below(low)
    left = count - sum(out)
    for s, load in enumerate(loads):  # shards whose load is the level itself, in order
        if left and load + out[s] * size == low:
            out[s] += 1
            left -= 1
    return out


def longest_processing_time(classes: list[tuple[int, int]], shards: int) -> dict[int, list[int]]:
    """Size to the number of its groups for each shard; ``classes`` are (size, number of groups)."""
    loads, out = [0] * shards, {}
    for size, count in sorted(classes, reverse=True):
        out[size] = fill(loads, size, count)
        loads = [load + size * n for load, n in zip(loads, out[size], strict=True)]
    return out


def runs(counts: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(part, size, first, last, shard): the groups of a part and size by their rank there, from (part, size, count)."""
    out = []
    classes = {size: sum(c for _, _, c in rows) for size, rows in ((k, list(g)) for k, g in groupby(sorted(counts, key=lambda r: (r[1], r[0])), key=lambda r: r[1]))}
    left = {size: [[s, n] for s, n in enumerate(each) if n] for size, each in longest_processing_time(list(classes.items()), shards).items()}
    for part, size, count in sorted(counts):
        at = 0
        while at < count:
            shard, n = left[size][0]
            take = min(n, count - at)
            out.append((part, size, at, at + take - 1, shard))
            at += take
            left[size][0][1] -= take
            if not left[size][0][1]:
                left[size].pop(0)
    return out


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", hot_parts: int = HOT_PARTS) -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard (null under this law) for every row."""
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base, rows = materialize_counted(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("group_key"),
            F.monotonically_increasing_id().alias("row_number"),
        ),
        "shard-rows",
    )
    sums = base.groupBy("group_key").agg(F.sum("size").alias("group_size"), F.count(F.lit(1)).alias("copies"))
    laid = sums.repartitionByRange(partitions(spark), "group_size", "group_key").withColumn("part", F.spark_partition_id())
    groups, _ = materialize_counted(laid, "shard-groups")
    counts = groups.groupBy("part", "group_size").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per size, and one more per part
    dealt = spark.createDataFrame(runs([(r["part"], r["group_size"], r["n"]) for r in counts], shards), "part int, group_size long, first long, last long, shard int")
    rank = F.row_number().over(Window.partitionBy("part", "group_size").orderBy("group_key")) - 1
    placed = groups.withColumn("rank", rank).join(dealt, ["part", "group_size"]).filter("rank between first and last").select("group_key", "copies", "shard")
    placed, _ = materialize_counted(placed, "shard-placed")
    is_hot = F.col("copies") * hot_parts >= max(rows, 1)
    hot = placed.filter(is_hot).select("group_key", F.col("shard").alias("hot_shard"))  # at most hot_parts groups
    named = base.join(F.broadcast(hot), "group_key", "left")
    rest = named.filter("hot_shard is null").join(placed.filter(~is_hot).select("group_key", "shard"), "group_key")
    columns = ["id", "size", "text_crc32", "row_number", "shard"]
    everything = rest.select(*columns).unionByName(named.filter("hot_shard is not null").withColumn("shard", F.col("hot_shard")).select(*columns))
    blocks = max(1, -(-rows // (shards * BLOCK_ROWS)))
    placed_rows, _ = materialize_counted(everything.withColumn("block", F.pmod(F.xxhash64("row_number"), F.lit(blocks))), "shard-numbered")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    each = placed_rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    offsets = each.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    number = F.row_number().over(Window.partitionBy("shard", "block").orderBy("id", "text_crc32", "row_number"))
    return placed_rows.join(offsets, ["shard", "block"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (number - 1 + F.col("offset")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
