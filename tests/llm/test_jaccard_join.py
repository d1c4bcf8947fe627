import random
import re

import numpy as np
import pytest
from conftest_llm import frame

from tradewatch.llm import jaccard_join as jj
from tradewatch.llm.jaccard_join import Sets, Sketched, bands, fold, join, signatures, sketch
from tradewatch.llm.packs import Pack

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingle_set(text, size):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(rows, size, percent):
    sets = {i: shingle_set(t, size) for i, t in rows}
    lead = {i: i for i in sets}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                lead[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_matches_brute_force(spark, docs, texts, size, percent):
    out = join(docs, size, percent, pack_bytes=3000).collect()
    assert len(out) == docs.count()
    want = brute(list(enumerate(texts)), size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want


def test_large_group_of_near_copies_in_many_packs(spark):
    """Copies at all distances from one text: chains of links, holders in several components."""
    r = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.randint(0, 8)):
            w[r.randrange(len(w))] = f"v{r.randrange(30)}"
        rows.append((i, " ".join(w)))
    r.shuffle(rows)
    out = join(frame(spark, [t for _, t in rows], [i for i, _ in rows]), pack_bytes=6000).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in out} == brute(rows, 3, 90)


def test_near_copies_with_long_texts_and_shared_passages(spark):
    """Many unlike texts around one passage (shared signatures without links), near copies across packs, one long text."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(80)]
    rows = []
    for i in range(120):
        kind = i % 4
        if kind == 0:
            w = passage + [word() for _ in range(r.randint(1, 60))]
        elif kind == 1 and rows:
            w = r.choice(rows)[1].split(" ")
            for _ in range(r.randint(0, max(1, len(w) // 12))):
                w[r.randrange(len(w))] = word()
        else:
            w = [word() for _ in range(r.randint(2, 200))]
        rows.append((i, " ".join(w)))
    long = [word() for _ in range(30_000)]
    rows += [(200, " ".join(long)), (201, " ".join(long[:29_500])), (202, " ".join(long[:20_000]))]
    for size, percent in ((3, 90), (5, 80)):
        out = join(frame(spark, [t for _, t in rows], [i for i, _ in rows]), size, percent, pack_bytes=8000).collect()
        assert {x.doc_id: (x.n_shingles, x.component_id) for x in out} == brute(rows, size, percent)


def test_rows_without_an_id(spark):
    """Each is a row of the result; it links like others, and never gives its component an id."""
    same = "one two three four five six"
    texts = [same, same, "seven eight nine ten", "seven eight nine ten", "alone here now", "", None]
    ids = [None, 7, None, None, None, None, 9]
    out = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in join(frame(spark, texts, ids)).collect()), key=str)
    assert out == sorted([(None, 4, 7), (7, 4, 7), (None, 2, None), (None, 2, None), (None, 1, None), (None, 0, None), (9, 0, 9)], key=str)
    with pytest.raises(ValueError):
        join(frame(spark, ["a b c", "a"], [None, 1 << 62])).count()


def test_linked_sets_share_a_signature():
    """Also at the limit, and where many partitions are empty."""
    r = np.random.default_rng(2)
    for percent in (80, 90):
        edges = bands(3000, percent)
        for n in (1, 2, 5, 9, 10, 11, 19, 30, 64, 150, 700):
            for _ in range(60):
                a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64) << np.uint64(1))
                if r.random() < 0.3:  # hashes in a part of the domain only
                    a >>= np.uint64(r.integers(1, 4))
                most = int(len(a) * (100 - percent) / percent)
                drop = int(r.integers(0, most + 1))
                b = np.unique(np.concatenate((r.permutation(a)[drop:], r.integers(0, 1 << 63, r.integers(0, most - drop + 1)).astype(np.uint64))))
                common = len(np.intersect1d(a, b))
                if common and 100 * common >= percent * (len(a) + len(b) - common):
                    assert len(np.intersect1d(signatures(a, edges, percent), signatures(b, edges, percent)))


def test_sketches_lose_no_link():
    r = np.random.default_rng(4)
    for percent in (80, 90):
        for n in (1, 5, 60, 64, 65, 127, 128, 129, 700):
            for _ in range(20):
                a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
                keep = r.random(len(a)) > r.random() * 0.2
                b = np.unique(np.concatenate((a[keep], r.integers(0, 1 << 63, r.integers(0, n // 6 + 2)).astype(np.uint64))))
                differ = len(np.setxor1d(a, b))
                x, y = sketch(a), sketch(b)
                while len(x) > len(y):
                    x = fold(x)
                while len(y) > len(x):
                    y = fold(y)
                assert np.bitwise_count(x ^ y).sum() <= differ
                sets = Sets(Pack(0, np.array([5]), np.array([0, 0]), np.zeros(0, np.uint8)), 3)
                sets.features, sets.counts = [b], np.array([len(b)])
                common = len(np.intersect1d(a, b))
                if common and 100 * common >= percent * (len(a) + len(b) - common):
                    assert Sketched(sets, percent).like(len(a), sketch(a)).tolist() == [0]


def test_empty_table(spark, no_docs):
    assert join(no_docs).count() == 0


def test_bands_hold_all_pairs_that_can_link():
    for percent in (80, 90):
        edges = bands(500, percent)
        band = lambda n: max(i for i, e in enumerate(edges) if e <= n)
        for a in range(1, 500):
            largest = a * 100 // percent
            assert band(min(largest, 500)) - band(a) <= 1


def test_a_family_below_the_threshold_is_hardly_announced(spark, monkeypatch):
    """Texts that share most signatures but no link are not sent to each other's packs; links among them are found."""
    r = random.Random(8)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        w = list(base)
        for k in r.sample(range(400), 20):
            w[k] = f"v{i}x{k}"
        rows.append((i, " ".join(w)))
    for i in range(0, 120, 30):
        w = rows[i][1].split(" ")
        w[r.randrange(400)] = "another"
        rows.append((200 + i, " ".join(w)))
    sent, per_pack = [], jj.Rounds.per_pack

    def counted(self, work, schema):
        out = per_pack(self, work, schema)
        if schema == jj.SHIP_SCHEMA:
            sent.append(out.filter(f"kind = {jj.SKETCH}").count())
        return out

    monkeypatch.setattr(jj.Rounds, "per_pack", counted)
    out = join(frame(spark, [t for _, t in rows], [i for i, _ in rows]), 5, 80, pack_bytes=8000).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in out} == brute(rows, 5, 80)
    assert len(sent) == 2 and sent[1] < len(rows)


def test_linked_sets_share_a_signature_with_chains_that_agree():
    """Also at the limit, with differences in one part of the domain, and where many partitions are empty."""
    r = np.random.default_rng(12)
    for percent in (80, 90):
        edges = bands(3000, percent)
        for n in (1, 2, 5, 9, 10, 11, 19, 30, 64, 150, 700):
            for _ in range(60):
                a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64) << np.uint64(1))
                most = int(len(a) * (100 - percent) / percent)
                drop = int(r.integers(0, most + 1))
                lost = r.permutation(a)[:drop] if r.random() < 0.5 else a[(at := r.integers(0, len(a) - drop + 1)) : at + drop]
                b = np.unique(np.concatenate((np.setdiff1d(a, lost), r.integers(0, 1 << 63, most - drop).astype(np.uint64))))
                common = len(np.intersect1d(a, b))
                if common and 100 * common >= percent * (len(a) + len(b) - common):
                    x, y = [], []
                    p, q = signatures(a, edges, percent, x), signatures(b, edges, percent, y)
                    x, y = np.concatenate(x), np.concatenate(y)
                    assert len(x) == len(p) and len(y) == len(q)
                    _, i, j = np.intersect1d(p, q, return_indices=True)
                    assert jj.chains_agree(x[i], y[j]).any()
