import hashlib
import random

from conftest_llm import frame

from tradewatch.llm.suffix_dedup import LENGTH, dedup


def brute(rows):
    """Every 50-byte string of a smaller id, position by position."""
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        for p in range(len(b) - LENGTH + 1):
            first.setdefault(b[p : p + LENGTH], i)
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - LENGTH + 1):
            if first[b[p : p + LENGTH]] < i:
                gone[p : p + LENGTH] = [True] * LENGTH
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def got(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_matches_brute_force(docs, texts):
    out = dedup(docs, pack_bytes=3000)
    assert out.count() == docs.count()
    assert got(out) == brute(list(enumerate(texts)))


def test_long_constant_and_periodic_texts(spark):
    r = random.Random(2)
    rows = [(7, "ab" * 400), (3, "a" * 900), (5, "b" + "ab" * 70), (1, "xy" * 30 + "a" * 60), (9, "".join(r.choice("ab") for _ in range(3000)))]
    rows += [(11, rows[4][1][1000:1100] + "q" + rows[4][1][1040:1200]), (13, rows[4][1][1050:1099]), (0, "é" * 49)]
    assert got(dedup(frame(spark, [t for _, t in rows], [i for i, _ in rows]), pack_bytes=500)) == brute(rows)


def test_spans_and_text_agree(docs, texts):
    for r in dedup(docs, with_text=True, pack_bytes=4000).collect():
        b = (texts[r.doc_id] or "").encode()
        e = r.span_edges
        assert sum(y - x for x, y in zip(e[::2], e[1::2], strict=True)) == r.n_removed
        ends = [0, *e, len(b)]
        pieces = [b[x:y] for x, y in zip(ends[::2], ends[1::2], strict=True)]
        assert hashlib.sha256(b"".join(pieces)).hexdigest() == r.kept_sha256
        assert r.kept_text == "".join(p.decode("utf-8", "ignore") for p in pieces)


def test_rows_without_an_id_come_last(spark):
    a, b, c = "first text " * 8, "second text " * 8, "third " * 12
    ids, texts = [None, 5, None, None, None, 3], [a, a + b, b, c, c, "x"]
    rows = dedup(frame(spark, texts, ids)).collect()
    # ids above all others, equal ones: what documents with ids have goes, what only they have stays
    want = brute([(5, a + b), (3, "x"), *((100, t) for t in (a, b, c, c))])
    out = sorted((r.n_bytes, r.n_removed, r.n_spans) for r in rows if r.doc_id is None)
    assert out == sorted([(len(a), len(a), 1), (len(b), len(b), 1), (len(c), 0, 0), (len(c), 0, 0)])
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows if r.doc_id is not None} == {i: want[i] for i in (5, 3)}


def test_empty_table(no_docs):
    assert dedup(no_docs).count() == 0
