import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import frame

from tradewatch.llm import lm_scoring
from tradewatch.llm.lm_scoring import MOVES, Model, draw_tables, score, seat
from tradewatch.llm.packs import Pack

WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + [None]


def test_base_figures_match_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    learn = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    c = Counter(x for i, t in rows if learn(i) for x in tokens(t))
    n, v = sum(c.values()), len(c)
    out = score(docs, pack_bytes=3000).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    for r in out:
        w = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not learn(r.doc_id), len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert r.score < 0
    # same result when asked again
    again = {r.doc_id: r.score for r in score(docs, pack_bytes=3000).collect()}
    assert all(math.isclose(again[r.doc_id], r.score, rel_tol=1e-9) for r in out)


def test_root_probabilities_sum_to_one():
    r = np.random.default_rng(1)
    customers = r.integers(1, 50, 200)
    tables = np.minimum(customers, r.integers(1, 9, 200))
    model = Model(0.7, 200, ((int(customers.sum()), int(tables.sum())),))
    seen = model.root_probability(customers.astype(float), tables.astype(float), 0).sum()
    unseen = model.root_probability(np.zeros(1), np.zeros(1), 0)[0]
    assert math.isclose(seen + unseen, 1.0, rel_tol=1e-12)


def test_small_corpus_by_hand(spark):
    """One training text whose pairs are all seen once: no seating is open, the score follows from the formula."""
    learn = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 7 != 2)
    out = score(frame(spark, ["a b c"], [learn])).collect()[0]
    # discount 0.75 (no pair is seen twice); four words with one customer and one table each in the root
    root = (1 - 0.6 + (1 + 0.6 * 4) / 5) / (1 + 4)
    each = (1 - 0.75 + (1 + 0.75) * root) / (1 + 1)
    assert math.isclose(out.score, 4 * math.log10(each), rel_tol=1e-9)


def test_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = [r for r in score(docs).collect() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_seating_follows_the_exact_distribution():
    """Tables of three customers of one dish: P(t) is proportional to the generalised Stirling numbers times the masses."""
    d, mass, slope = 0.6, 0.8, 0.3
    n = 40_000
    sizes = np.zeros((n, 3), np.int64)
    sizes[:, 0] = 3
    seat(sizes, np.full(n, 3.0), np.full(n, mass), np.full(n, slope), d, 40, np.random.default_rng(0))
    got = np.bincount((sizes > 0).sum(1), minlength=4)[1:] / n
    # a new table weighs mass + slope * (tables of others beyond the first state's)
    one = (1 - d) * (2 - d)
    two = 3 * (1 - d) * mass
    three = mass * (mass + slope)
    want = np.array([one, two, three]) / (one + two + three)
    assert sizes.sum(1).tolist() == [3] * n
    assert np.abs(got - want).max() < 0.02
    assert MOVES > 0


def test_rows_without_an_id_are_scored_and_teach_nothing(spark):
    texts = ["one two three", "one two", "one one one three", "two five five"]
    with_ids = {r.doc_id: r for r in score(frame(spark, texts)).collect()}
    out = score(frame(spark, [*texts, "one five nine", None, "one five nine"], [0, 1, 2, 3, None, None, None])).collect()
    assert {r.doc_id: r.score for r in out if r.doc_id is not None} == pytest.approx({i: r.score for i, r in with_ids.items()})
    none = sorted([r for r in out if r.doc_id is None], key=lambda r: r.n_tokens)
    assert [r.n_tokens for r in none] == [1, 4, 4] and all(r.held_out for r in none)
    assert none[1].score == none[2].score < 0 and none[1].n_known == (2 if with_ids[3].held_out else 3)
    assert {r.train_tokens for r in out} == {with_ids[0].train_tokens}


def test_empty_table_and_held_out_only(spark, no_docs):
    assert score(no_docs).count() == 0
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = score(frame(spark, ["a b"], [held])).collect()[0]
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0)


def test_every_sample_sums_to_one(spark, monkeypatch):
    """Pairs seen often: each averaged sample combines the tables, context sums and root of one round."""
    learn = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 != 2][:60]
    r = random.Random(3)
    texts = [" ".join(r.choice("abcde") for _ in range(30)) for _ in learn]
    kept, sides = {}, {}

    def keep(df, name):
        out = materialize(df, name)
        kept[name] = out[0].collect()
        return out

    def resolve(buckets, samples):
        sides["samples"], sides["buckets"] = samples, buckets
        return resolve_model(buckets, samples)

    def round_(self, ask, answer, side=None):
        if "samples" in sides:
            sides["side"] = side.collect()
        return run_round(self, ask, answer, side)

    def scorer(buckets, model, *more):
        sides["model"] = model
        return make_scorer(buckets, model, *more)

    materialize, resolve_model, run_round, make_scorer = lm_scoring.materialize_counted, lm_scoring._resolve_model, lm_scoring.Rounds.round, lm_scoring._score
    monkeypatch.setattr(lm_scoring, "materialize_counted", keep)
    monkeypatch.setattr(lm_scoring, "_resolve_model", resolve)
    monkeypatch.setattr(lm_scoring, "_score", scorer)
    monkeypatch.setattr(lm_scoring.Rounds, "round", round_)
    assert len(score(frame(spark, texts, learn)).collect()) == len(learn)
    n, samples, model = sides["buckets"], sides["samples"], sides["model"]
    seated = {}
    for row in kept["lm-seating"]:
        key, *columns = lm_scoring.unsqueeze(row["payload"])
        assert len(columns) == len(samples) == 2
        seated |= {(row["bucket"] - n, k): t for k, t in zip(key.tolist(), zip(*[c.tolist() for c in columns], strict=True), strict=True)}
    body = [t.encode() for t in texts]
    pack = Pack(0, np.array(learn), np.concatenate(([0], np.cumsum([len(b) for b in body]))), np.frombuffer(b"".join(body), np.uint8))
    t = lm_scoring.Tokens(pack, n)
    where = lambda p: (int(p) >> 48, int(p) & ((1 << 48) - 1))
    count = Counter(t.pair.tolist())
    assert sum(c > 1 for c in count.values()) > 20
    payloads = {(row["bucket"], row["kind"]): row["payload"] for row in sides["side"]}
    for k, s in enumerate(samples):
        figures = {}
        for b in {where(p)[0] for p in t.words}:
            key = lm_scoring.unsqueeze(payloads[b, lm_scoring.WORDS_KIND])[0]
            figures |= {(b, x): f for x, f in zip(key.tolist(), zip(*[c.tolist() for c in lm_scoring.unsqueeze(payloads[b, lm_scoring.TOTAL_KIND + s])], strict=True), strict=True)}
        of = [figures[where(p)] for p in t.words]
        root = model.root_probability(np.array([f[1] for f in of], float), np.array([f[2] for f in of], float), s)
        assert math.isclose(root.sum(), 1.0, rel_tol=1e-9)  # the begin mark, never a word, stands for the unseen
        for u in set(t.context.tolist()):
            mine = [p for p in count if t.context[t.pair_at[p]] == u]
            c_u = sum(count[p] for p in mine)
            own = sum(count[p] - model.discount * (seated[where(t.pairs[p])][k] if count[p] > 1 else 1) for p in mine)
            assert math.isclose((own + lm_scoring.STRENGTH + model.discount * of[u][0]) / (lm_scoring.STRENGTH + c_u), 1.0, rel_tol=1e-9)


def stirling_row(n, d):
    """log of the weights of all seatings of n customers, by number of tables."""
    row, tables = np.full(n, -np.inf), np.arange(1, n + 1)
    row[0] = 0.0
    for m in range(1, n):
        new = np.full(n, -np.inf)
        new[:m] = row[:m] + np.log(m - tables[:m] * d)
        new[1 : m + 1] = np.logaddexp(new[1 : m + 1], row[:m])
        row = new
    return row


def test_drawn_tables_follow_the_exact_distribution():
    """Few customers, and many with few and many tables: the whole distribution, not a bounded number of tables."""
    n = 20_000
    for count, mass, slope, d in ((2, 0.8, 0.3, 0.6), (3, 0.8, 0.3, 0.6), (20, 3.0, 0.1, 0.75), (400, 40.0, 0.1, 0.7), (600, 60.0, 0.3, 0.75), (3000, 1.0, 0.01, 0.6), (3000, 300.0, 0.1, 0.75)):
        weight = stirling_row(count, d) + np.cumsum(np.log(mass + slope * np.arange(count)))
        p = np.exp(weight - weight.max())
        p /= p.sum()
        got = draw_tables(np.full(n, count), np.full(n, mass), np.full(n, slope), d, np.random.default_rng(4))
        assert 1 <= got.min() and got.max() <= count
        assert np.abs(np.cumsum(np.bincount(got, minlength=count + 1)[1:] / n) - np.cumsum(p)).max() < 0.04
    # as customer after customer gives it; the mass of ``seat`` is that of a second table
    sizes = np.zeros((5000, 20), np.int64)
    sizes[:, 0] = 20
    seat(sizes, np.full(5000, 20.0), np.full(5000, 3.0), np.full(5000, 0.1), 0.75, 400, np.random.default_rng(0))
    drawn = draw_tables(np.full(5000, 20), np.full(5000, 2.9), np.full(5000, 0.1), 0.75, np.random.default_rng(1))
    assert abs((sizes > 0).sum(1).mean() - drawn.mean()) < 0.5


@pytest.mark.parametrize("count", [100_000, 10_000_000])
def test_tables_of_very_many_customers_have_the_exact_mean(count):
    """With mass = strength and slope = discount, the mean number of tables has a closed form."""
    for d, mass, within in ((0.6, 5.0, 0.02), (0.75, 5.0, 0.02), (0.9, 5.0, 0.02), (0.75, 500.0, 0.002), (0.75, 0.5, 0.08)):
        mean = math.exp(math.lgamma(mass + count + d) + math.lgamma(mass + 1) - math.lgamma(mass + count) - math.lgamma(mass + d)) / d - mass / d
        drawn = draw_tables(np.full(4000, count), np.full(4000, mass), np.full(4000, d), d, np.random.default_rng(1))
        assert abs(drawn.mean() / mean - 1) < within


def test_frequent_root_words_get_the_tables_of_the_real_mass():
    """A word with 3,000 customers, in a root where others have many tables: far more tables than the 25 of 24 draws."""
    model = Model(0.7, 2, ((6000, 1000),))
    key = np.array([5, 9], np.uint64)
    customers = np.array([3000, 3000], np.int64)
    side = {
        lm_scoring.WORDS_KIND: lm_scoring.squeeze(key, customers, customers, customers),
        lm_scoring.TOTAL_KIND: lm_scoring.squeeze(np.zeros(2, np.int64), customers, np.array([500, 500], np.int64)),
    }
    tables = lm_scoring.unsqueeze(lm_scoring._resolve_tables(1, model)([], [], side, 0)[-1])[2]
    weight = stirling_row(3000, 0.6) + np.cumsum(np.log((1 + 0.6 * (500 + np.arange(3000))) / 3))
    p = np.exp(weight - weight.max())
    p /= p.sum()
    mean = (p * np.arange(1, 3001)).sum()
    assert mean > 50 and np.abs(tables - mean).max() < 6 * math.sqrt((p * (np.arange(1, 3001) - mean) ** 2).sum())
