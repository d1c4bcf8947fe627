import heapq
import random
import zlib
from collections import defaultdict

import pytest
from conftest_llm import frame

from tradewatch.llm.sharding import fill, longest_processing_time, runs, shard


def check(rows, out, shards):
    assert len(out) == len(rows)
    want = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in out) == want
    assert {(r.law, r.grown_shard) for r in out} <= {("bytes", None)}
    slots, load = defaultdict(list), [0] * shards
    for r in out:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load


def test_groups_stay_together_and_loads_are_even(docs, texts):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = shard(docs, 4).collect()
    load = check(rows, out, 4)
    where = {}
    for r in out:
        assert where.setdefault(texts[r.doc_id] or "", r.shard) == r.shard
    groups = defaultdict(int)
    for _, t in rows:
        groups[t or ""] += len((t or "").encode()) + 1
    assert max(load) - min(load) <= max(groups.values())
    # few groups: the plain schedule, so its bound holds
    assert max(load) <= sum(load) / 4 + max(groups.values())


def plain_loads(sizes, shards):
    """Group by group to the least loaded shard."""
    heap = [(0, i) for i in range(shards)]
    for size in sorted(sizes, reverse=True):
        load, i = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, i))
    return [load for load, _ in sorted(heap, key=lambda x: x[1])]


def test_loads_of_ten_thousand_groups_are_those_of_the_plain_schedule(spark):
    r = random.Random(7)
    texts = [f"{i} " + "y" * int(r.expovariate(1 / 40)) for i in range(10_000)]
    texts += [t for t in texts[:300] for _ in range(r.randint(1, 4))] + ["one hot text"] * 4000 + [None] * 50 + [""] * 7
    ids = [None if i % 50 == 0 else i for i in range(len(texts))]
    rows = list(zip(ids, texts, strict=True))
    out = shard(frame(spark, texts, ids), 16).collect()
    sizes = defaultdict(int)
    for _, t in rows:
        sizes[t or ""] += len((t or "").encode()) + 1
    assert sorted((r["size"], r.text_crc32) for r in out) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    load, where, slots = [0] * 16, {}, defaultdict(list)
    for r in out:
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        assert where.setdefault((r["size"], r.text_crc32), r.shard) == r.shard
    assert load == plain_loads(sizes.values(), 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("seed", range(30))
def test_a_class_is_filled_as_the_heap_would(seed):
    r = random.Random(seed)
    loads = [r.randint(0, 500) for _ in range(r.randint(1, 9))]
    size, count = r.randint(1, 60), r.choice([0, 1, 5, 64, 65, 200, 1000])
    heap = [(load, i) for i, load in enumerate(loads)]
    heapq.heapify(heap)
    want = [0] * len(loads)
    for _ in range(count):
        load, i = heapq.heappop(heap)
        want[i] += 1
        heapq.heappush(heap, (load + size, i))
    assert fill(loads, size, count) == want


def test_schedule():
    assert longest_processing_time([(7, 1), (5, 1), (4, 1), (3, 1)], 2) == {7: [1, 0], 5: [0, 1], 4: [0, 1], 3: [1, 0]}
    assert longest_processing_time([], 3) == {}
    # ranks of equal sizes are dealt in runs over the parts
    assert runs([(0, 5, 2), (1, 5, 3), (1, 9, 1)], 2) == [(0, 5, 0, 1, 0), (1, 5, 0, 2, 1), (1, 9, 0, 0, 0)]


def test_rows_without_ids_and_hot_groups_through_both_joins(spark):
    texts = ["same"] * 300 + [f"t{i % 40}" for i in range(400)]
    for hot_parts in (2, 1 << 40):
        out = shard(frame(spark, texts, [None] * len(texts)), 4, hot_parts=hot_parts).collect()
        assert len(out) == len(texts) and {r.doc_id for r in out} == {None}
        load = [sum(r["size"] for r in out if r.shard == s) for s in range(4)]
        sizes = defaultdict(int)
        for t in texts:
            sizes[t] += len(t) + 1
        assert load == plain_loads(sizes.values(), 4)


def test_empty_table(no_docs):
    assert shard(no_docs).count() == 0
