import random
import re

import numpy as np
import pytest
from conftest_llm import frame

from tradewatch.llm.decontamination import RADIUS, Benchmark, HammingIndex, find, near_masks, simhash
from tradewatch.llm.packs import Pack
from tradewatch.llm.words import shingles, word_hashes


def words(t):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items, share=0.8):
    """All item-sized windows of all texts by exact weighted similarity."""
    feats = lambda w, n: [tuple(w[i : i + min(5, n)]) for i in range(len(w) - min(5, n) + 1)]
    sets = {}
    for i, t in items:
        w = words(t)
        if w:
            sets[i] = (len(w), feats(w, len(w)))
    holders = {}
    for i, (_, f) in sets.items():
        for x in set(f):
            holders.setdefault(x, set()).add(i)
    weight = lambda x: np.log(1 + len(sets) / len(holders[x])) if x in holders else np.log(1 + len(sets))
    out = set()
    for d, t in rows:
        w = words(t)
        for i, (n, f) in sets.items():
            if len(w) < min(5, n):
                continue
            for s in range(max(1, len(w) - n + 1)):
                g = feats(w[s : s + n], n)
                every = set(f) | set(g)
                low = sum(weight(x) * min(f.count(x), g.count(x)) for x in every)
                if low and low >= share * sum(weight(x) * max(f.count(x), g.count(x)) for x in every) - 1e-9:
                    out.add((d, i))
                    break
    return out


def test_matches_brute_force(spark):
    r = random.Random(6)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(14, 45)))) for i in range(20)] + [(20, "w1 w2"), (21, None), (22, "..."), (23, "w7")]
    items.append((24, items[0][1]))
    rows = [(100, None), (101, ""), (102, items[3][1]), (103, "W1, w2!"), (104, " ".join(items[5][1].split()[:-1]))]
    for i in range(60):
        t = [r.choice(vocab[2:6] + vocab[8:]) for _ in range(r.randint(0, 60))]
        if i % 3:
            w = items[r.randrange(20)][1].split()
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                w[r.randrange(len(w))] = "zz"
            t[len(t) // 2 : len(t) // 2] = w
        rows.append((i, r.choice([" ", "\n", ", "]).join(t)))
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    got = find(docs, bench).collect()
    want = brute(rows, items)
    pairs = {(x.doc_id, x.item_id) for x in got}
    assert pairs <= want
    # borderline windows may lie beyond the radius; copies and single edits of long items may not
    assert len(pairs) >= 0.97 * len(want)
    exact = {(d, i) for d, t in rows for i, s in items if words(s) and f" {' '.join(words(s))} " in f" {' '.join(words(t))} "}
    assert exact <= pairs
    # blocks of the benchmark give the same rows
    assert {(x.doc_id, x.item_id) for x in find(docs, bench, block_bytes=700).collect()} == pairs


def test_hamming_index_finds_all_within_the_radius():
    r = random.Random(7)
    prints = [r.getrandbits(64) for _ in range(300)]
    index = HammingIndex(prints, 20, 5)
    for _ in range(60):
        q = r.choice(prints)
        for b in r.sample(range(64), r.randint(0, 26)):
            q ^= 1 << b
        assert index.near(q) == [i for i, p in enumerate(prints) if (p ^ q).bit_count() <= 20]
    assert len(near_masks(6, 2)) == 1 + 6 + 15


def test_empty_tables(spark, no_docs, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert find(docs, none).count() == 0
    assert find(no_docs, some).count() == 0
    assert Benchmark([]).by_size == {}


def test_blocks_of_the_benchmark_give_the_pairs_of_one_block(spark):
    """Items of a common template: the weights, and so the similarities, are those of the whole benchmark."""
    common = " ".join(f"common{i}" for i in range(20))
    items = [(k, f"{common} " + " ".join(f"own{k}x{i}" for i in range(25))) for k in range(12)]
    texts = [t.replace(f"own{k}x{i}", "other") for k, t in items for i in (24, 23, 22, 12)] + [t.replace("common0 ", "other ").replace("common10", "other") for _, t in items]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [{(r.doc_id, r.item_id): round(r.similarity, 9) for r in find(docs, bench, block_bytes=b).collect()} for b in (1 << 20, 700)]
    assert got[0] and got[0] == got[1]


@pytest.mark.parametrize("shared", [0, 50, 1000])
def test_radius_holds_the_windows_of_template_like_items(shared):
    """Items whose shingles are mostly held by ``shared`` others: windows just above the similarity are within the radius."""
    r = random.Random(shared)
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(6))
    templates = [[word() for _ in range(24)] for _ in range(max(1, 2000 // max(shared, 1)))]
    texts = [(templates[i % len(templates)] if shared else [word() for _ in range(24)]) + [word() for _ in range(16)] for i in range(2000)]
    bench = Benchmark([(i, " ".join(t)) for i, t in enumerate(texts)])
    pairs = found = 0
    for i in range(0, 2000, 2):
        for _ in range(3):
            w = list(texts[i])
            # the last words differ: rare shingles, where the shared ones are light
            w[r.randint(30, 39)] = word()
            if r.random() < 0.5:
                w[r.randrange(40)] = word()
            data = " ".join(w).encode()
            pack = Pack(0, np.array([0]), np.array([0, len(data)]), np.frombuffer(data, np.uint8))
            f, _ = shingles(*word_hashes(pack, letters_only=True), 5)
            features, counts = np.unique(f, return_counts=True)
            item = bench.items[i]
            if bench.compare(item, features, counts) >= bench.similarity:
                pairs += 1
                found += (simhash(features, np.sqrt(bench.weight(features) * counts)) ^ item.print).bit_count() <= RADIUS
    print(f"recall with shingles held by {shared}: {found} of {pairs}")
    assert pairs > 200 and found >= 0.995 * pairs
