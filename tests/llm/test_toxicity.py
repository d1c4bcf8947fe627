"""Toxicity: features against a plain version, the corrected risk by hand, and held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from conftest_llm import frame, make_texts
from tradewatch.llm import queries, toxicity
from tradewatch.llm.packs import mix
from tradewatch.llm.words import batch_pack, word_hashes

LABELS = "doc_id long, quality int, toxic int"


def pack_of(texts):
    columns = [pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())]
    return batch_pack(pa.RecordBatch.from_arrays(columns, names=["doc_id", "text"]), "doc_id", "text")


def plain_features(text):
    """Runs of 4 to 6 bytes inside words, as hashes."""
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    out = set()
    for word in re.findall(rb"[0-9A-Za-z\x80-\xff]+", data):
        for n in toxicity.GRAMS:
            out.update((n, word[i : i + n]) for i in range(len(word) - n + 1))
    codes = np.array([int.from_bytes(g, "little") + (n << 56) for n, g in out], np.uint64)
    return set(mix(codes).tolist())


@pytest.mark.parametrize("segment", [7, 64, 1 << 20])
def test_features_of_whole_texts(monkeypatch, segment):
    monkeypatch.setattr(toxicity, "SEGMENT", segment)
    texts = make_texts(n=20)
    pack = pack_of(texts)
    words, offsets = word_hashes(pack, letters_only=True)
    found = [set() for _ in texts]
    for doc, code in toxicity.features(pack):
        for d, c in zip(doc.tolist(), code.tolist(), strict=True):
            found[d].add(c)
    for i, text in enumerate(texts):
        assert found[i] == plain_features(text) | set(words[offsets[i] : offsets[i + 1]].tolist()), i


def test_known_features_are_found_once_per_document():
    pack = pack_of(["idiot idiot", None, "an IDIOT", "idio"])
    codes = np.unique(np.concatenate([c for _, c in toxicity.features(pack_of(["idiot"]))]))
    doc, at = toxicity.Known(codes).find(pack)
    assert doc.tolist() == [0] * len(codes) + [2] * len(codes) + [3]
    assert at[: len(codes)].tolist() == list(range(len(codes)))
    assert toxicity.Known(np.zeros(0, np.uint64)).find(pack)[0].tolist() == []


def risk(margin_p, margin_u, prior):
    def loss(z):
        return 1 / (1 + np.exp(z))

    return prior * loss(margin_p).mean(), loss(-margin_u).mean() - prior * loss(-margin_p).mean()


@pytest.mark.parametrize("shift", [0.0, -6.0])
def test_risk_step_is_the_derivative_of_the_corrected_risk(shift):
    r = np.random.default_rng(0)
    p, u, prior = r.normal(1, 1, 5), r.normal(shift, 1, 9), 0.3
    toxic, clean = risk(p, u, prior)
    assert (clean < 0) == (shift < 0)

    def target(p, u):
        toxic, clean = risk(p, u, prior)
        return -clean if shift < 0 else toxic + clean

    by_p, by_u = toxicity._risk_step(p, u, prior)
    for i in range(5):
        assert by_p[i] == pytest.approx((target(p + 1e-6 * np.eye(5)[i], u) - target(p, u)) / 1e-6, abs=1e-5)
    for i in range(9):
        assert by_u[i] == pytest.approx((target(p, u + 1e-6 * np.eye(9)[i]) - target(p, u)) / 1e-6, abs=1e-5)


def planted(spark, n=900, seed=3):
    """Documents of random words; a tenth is toxic by one to four insults, labels cover half of them."""
    r = random.Random(seed)
    insults = ["grumpole", "blargface", "snotwick", "dunderlump"]
    rows, labels, toxic = [], [], set()
    for i in range(n):
        words = ["".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(1, 8))) for _ in range(r.randint(5, 150))]
        if r.random() < 0.12:
            toxic.add(i)
            for _ in range(r.randint(1, 4)):
                words.insert(r.randrange(len(words)), r.choice(insults).upper() if r.random() < 0.2 else r.choice(insults) + r.choice(["", ",", "s"]))
        rows.append(" ".join(words))
        if i % 2 == 0:
            labels.append((i, 1, int(i in toxic)))
    return frame(spark, rows), spark.createDataFrame(labels, LABELS), toxic


def test_held_out_accuracy(spark):
    docs, labels, toxic = planted(spark)
    rows = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert len(rows) == 900
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert row["predicted"] == int(row["score"] >= 0.5) and 0 <= row["score"] <= 1
    unseen = [r for r in rows if r["held_out"]]
    caught = [r["predicted"] for r in unseen if r["doc_id"] in toxic]
    wrong = [r["predicted"] for r in unseen if r["doc_id"] not in toxic]
    assert len(caught) >= 15 and np.mean(caught) >= 0.9
    assert np.mean(wrong) <= 0.01


def test_held_out_labels_and_texts_teach_nothing(spark):
    docs, labels, _ = planted(spark, n=400)
    training = ~toxicity.held_out(labels["doc_id"])
    a, b = toxicity.learn(docs, labels), toxicity.learn(docs, labels.filter(training))
    c = toxicity.learn(docs.filter(~toxicity.held_out(docs["doc_id"])), labels)
    for other in (b, c):
        assert a.codes.tolist() == other.codes.tolist() and a.weights.tolist() == other.weights.tolist() and a.prior == other.prior


def test_bounds_of_the_fit(spark):
    docs, labels, _ = planted(spark, n=400)
    sample = toxicity._sample(docs.unionByName(docs), labels, 10, 50).collect()
    assert sum(r["positive"] for r in sample) == 10 and sum(not r["positive"] for r in sample) == 50
    assert toxicity.learn(docs, labels, positives=10, unlabelled=100, prior=0.1).prior == 0.1


def test_query_on_the_documents(spark, sf_dir):
    df = queries.op12_toxicity(spark, sf_dir)
    assert df.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = df.collect()
    assert len(rows) == 1000 == len({r["doc_id"] for r in rows})
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    judged = [r for r in rows if r["doc_id"] in label]
    clean = [r["predicted"] for r in judged if not label[r["doc_id"]]]
    # what marks a toxic document here is an English word; those in other languages have nothing to go by
    marks = re.compile(r"\b(idiot|moron|scum|clown|loser|worthless|pathetic|trash|stupid|disgusting)\b", re.I)
    insulting = [r["predicted"] for r in judged if label[r["doc_id"]] and marks.search(text[r["doc_id"]])]
    assert len(insulting) > 25 and np.mean(insulting) >= 0.9 and np.mean(clean) <= 0.02


def test_odd_rows(spark):
    docs, labels, toxic = planted(spark, n=400)
    odd = frame(spark, [None, "", "  ", "you grumpole", "blargface " * 60_000, "a b"], [None, None, 1000, 1001, 1002, 1001])
    more = spark.createDataFrame([(None, 1, 1), (1001, 0, None), (2, 1, 1), (2, 1, 0), (7777, 1, 1)], LABELS)
    both = docs.unionByName(odd)
    rows = toxicity.score(both, toxicity.learn(both, labels.unionByName(more))).collect()
    assert len(rows) == 406
    none = [r for r in rows if r["doc_id"] is None]
    assert len(none) == 2 and all(r["held_out"] and not r["predicted"] for r in none)
    assert sorted(r["predicted"] for r in rows if r["doc_id"] == 1001) == [0, 1]
    assert [r["predicted"] for r in rows if r["doc_id"] == 1002] == [1]


def test_without_examples_or_documents(spark, no_docs):
    docs, labels, _ = planted(spark, n=60)
    none = toxicity.score(docs, toxicity.learn(docs, labels.filter("toxic = 0"))).collect()
    assert len(none) == 60 and {r["score"] for r in none} == {0.0}
    assert toxicity.score(docs, toxicity.learn(docs, labels.limit(0))).count() == 60
    assert toxicity.score(no_docs, toxicity.learn(no_docs, labels)).collect() == []
    plain = toxicity.Model(np.zeros(0, np.uint64), np.array([0.0]), 0.5)
    assert {r["score"] for r in toxicity.score(docs, plain).collect()} == {0.5}
