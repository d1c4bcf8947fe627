"""Toxicity by non-negative positive-unlabelled learning.

Learned from confirmed toxic documents (P) and documents without a label (U, among which toxic ones hide).  With the share
``prior`` of toxic documents, the risk of a classifier is prior E_P[loss(g)] + E_U[loss(-g)] - prior E_P[loss(-g)]; the
last two terms estimate the risk on clean documents, which cannot be negative, so whenever a step's estimate is, the
step goes the other way (the non-negative correction) and the classifier does not overfit to the few positives.
Several linear classifiers (numpy, sigmoid loss, Adam) are trained with different orders of the rows; a document's
score is the logistic function of their mean margin.

Features are whole words and all runs of 4 to 6 bytes inside words, of the whole text, ASCII letters lower-cased; a
feature counts once per document.  Those are kept that are more frequent in P than in U by more than chance, and their
weights are not negative: a feature may speak for toxicity, but much other text cannot outweigh an insult.

Bounds, all parameters: the fit uses at most ``POSITIVES`` toxic and ``UNLABELLED`` other documents, the first by a hash
of their id; ``CANDIDATES`` of the features of P by frequency, ``FEATURES`` of them by contrast.  The prior is counted over
all labelled rows of the training part, and every document is scored.  The labels' table is read for confirmed toxic
ids and the prior only; U is drawn from all documents of the training part, whatever their label.

On Spark: sampled ids (bounded) are broadcast to one scan of the texts; features of the sample are extracted and counted
in Arrow batches; the driver gets at most ``FEATURES`` numbers a sampled document; scoring is one narrow Arrow pass.

Edge cases: a null text is empty and scores as one without features; rows with a null id are scored and count as held
out; rows with equal ids are scored one by one (for the fit the least text stands for them); a label that is null counts
as no label, one of several labels of an id counts if it is toxic; without a toxic example all scores are 0; very long
texts are read whole, in segments; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize_counted
from .common import partitions, prepare
from .packs import Pack, U, mix
from .words import _LOWER, _PUNCT, SEGMENT, batch_pack, word_hashes

POSITIVES, UNLABELLED = 4000, 12000
CANDIDATES, FEATURES = 1 << 17, 4096
#: Least contrast of a feature: how unlikely (negative natural logarithm, Chernoff's bound) it would be as often in P by chance.
CONTRAST = 6.0
GRAMS = (4, 5, 6)
CLASSIFIERS, EPOCHS, BATCHES, RATE, DECAY, START = 3, 40, 8, 0.05, 1e-5, 0.5


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(True))


def features(pack: Pack) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, feature) arrays of a pack, segment by segment; a pair may come more than once."""
    hashes, offsets = word_hashes(pack, letters_only=True)
    yield np.repeat(np.arange(len(pack.ids)), np.diff(offsets)), hashes
    n, last = len(pack.data), max(GRAMS) - 1
    for a in range(0, n, SEGMENT):
        part = _LOWER[pack.data[a : a + SEGMENT + last]]
        size = len(part)
        stop = np.full(size + 1, size, np.int64)  # the next place where no word goes on
        ends = np.flatnonzero(_PUNCT[part])
        stop[ends] = ends
        begins = pack.offsets[np.searchsorted(pack.offsets, a, "right") : np.searchsorted(pack.offsets, a + size, "left")] - a
        # a document's begin stops the runs before it but not its own
        before = np.full(size + 1, size, np.int64)
        before[begins - 1] = begins
        stop = np.minimum.accumulate(np.minimum(stop, before)[::-1])[::-1]
        run = (stop[:size] - np.arange(size))[: min(SEGMENT, n - a)]
        code = np.zeros(len(run), np.uint64)
        wide = np.append(part.astype(np.uint64), np.zeros(last, np.uint64))
        for k in range(max(GRAMS)):
            code |= wide[k : k + len(run)] << U(8 * k)
            if k + 1 in GRAMS:
                at = np.flatnonzero(run > k)
                yield np.searchsorted(pack.offsets, at + a, "right") - 1, mix(code[at] + U((k + 1) << 56))


class Known:
    """Finds features of a fixed list."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes  # sorted
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(codes >> U(44)).astype(np.int64)] = True

    def find(self, pack: Pack) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, place in the list), in order."""
        pairs = [np.zeros(0, np.int64)]
        n = max(1, len(self.codes))
        for doc, code in features(pack) if len(self.codes) else ():
            hit = np.flatnonzero(self.maybe[(code >> U(44)).astype(np.int64)])
            code = code[hit]
            at = np.minimum(np.searchsorted(self.codes, code), n - 1)
            same = self.codes[at] == code
            pairs.append(np.unique(doc[hit][same] * n + at[same]))
        pairs = np.unique(np.concatenate(pairs))
        return pairs // n, pairs % n


def _risk_step(margin_p: np.ndarray, margin_u: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the (corrected) risk by the margins of a batch of P and of U."""
    p, u = 1 / (1 + np.exp(-margin_p)), 1 / (1 + np.exp(-margin_u))
    clean_risk = u.mean() - prior * p.mean()
    by_p, by_u = prior * p * (1 - p) / len(p), u * (1 - u) / len(u)
    if clean_risk < 0:
        return by_p, -by_u
    return -2 * by_p, by_u


def train(rows: list[np.ndarray], positive: np.ndarray, width: int, prior: float, seed: int) -> np.ndarray:
    """Weights (the last one is the constant) of one classifier; ``rows`` hold the features of a document each."""
    r = np.random.default_rng(seed)
    w = np.full(width + 1, START)
    w[width] = np.log(prior / (1 - prior))
    mean, square, step = np.zeros_like(w), np.zeros_like(w), 0
    p, u = np.flatnonzero(positive), np.flatnonzero(~positive)

    def margins(some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = [len(rows[i]) for i in some]
        columns = np.concatenate([rows[i] for i in some]) if sum(lengths) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(some)), lengths)
        return np.bincount(owner, w[columns], len(some)) + w[width], columns, owner

    for _ in range(EPOCHS):
        parts = zip(np.array_split(r.permutation(p), BATCHES), np.array_split(r.permutation(u), BATCHES), strict=True)
        for some_p, some_u in parts:
            if not len(some_p) or not len(some_u):
                some_p, some_u = p, u  # too few rows for batches
            (mp, cp, op), (mu, cu, ou) = margins(some_p), margins(some_u)
            gp, gu = _risk_step(mp, mu, prior)
            gradient = (np.bincount(cp, gp[op], width + 1) + np.bincount(cu, gu[ou], width + 1)).astype(float)  # without features: integers
            gradient[width] = gp.sum() + gu.sum()
            gradient[:width] += DECAY * w[:width]
            step += 1
            mean = 0.9 * mean + 0.1 * gradient
            square = 0.999 * square + 0.001 * gradient**2
            w -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            w[:width] = np.maximum(w[:width], 0)
    return w


class Model:
    """Features and their mean weights."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray, prior: float):
        self.codes, self.weights, self.prior = codes, weights, prior

    def scores(self, pack: Pack, known: Known) -> np.ndarray:
        doc, at = known.find(pack)
        margin = np.bincount(doc, self.weights[at], len(pack.ids)) + self.weights[-1]
        return 1 / (1 + np.exp(-margin))


def _sample(docs: DataFrame, labels: DataFrame, positives: int, unlabelled: int) -> DataFrame:
    """Texts of the fit: at most ``positives`` confirmed toxic ones and ``unlabelled`` others (columns doc_id, positive, text)."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter(~held_out(F.col("doc_id")))
    toxic = labels.filter("toxic = 1").select(F.col("doc_id").cast("long").alias("doc_id")).filter(~held_out(F.col("doc_id"))).distinct()

    def first(rows: DataFrame, seed: int, n: int) -> DataFrame:
        return rows.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(n)

    p = first(toxic, 1, positives).withColumn("positive", F.lit(True))
    u = first(ids.distinct(), 2, unlabelled).withColumn("positive", F.lit(False))
    wanted, _ = materialize_counted(p.unionByName(u), "sample-ids")  # bounded by the two parameters
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    chosen = texts.join(F.broadcast(wanted.select("doc_id").distinct()), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = chosen.join(F.broadcast(wanted), "doc_id").repartition(partitions(docs.sparkSession), "doc_id")
    return materialize_counted(rows, "sample")[0]


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, prior: float | None = None) -> Model:
    """The classifiers' mean for documents (doc_id, text) and labels (doc_id, toxic); only rows that are not held out are used.

    Without ``prior`` the share of toxic ones among the labelled training rows is taken.
    """
    spark = docs.sparkSession
    prepare(spark)
    if prior is None:
        known = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        prior = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).agg(F.avg("toxic")).first()[0] or 0.0
    none = Model(np.zeros(0, np.uint64), np.array([-np.inf]), 0.0)
    if prior <= 0:
        return none
    prior = min(prior, 0.99)
    sample = _sample(docs, labels, positives, unlabelled)
    count = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_p, n_u = count.get(True, 0), count.get(False, 0)
    if not n_p or not n_u:
        return none

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pack = batch_pack(batch, "doc_id", "text")
            codes = [np.zeros(0, np.uint64)]
            for i in range(len(pack.ids)):
                one = Pack(0, pack.ids[:1], np.array([0, pack.offsets[i + 1] - pack.offsets[i]]), pack.text(i))
                codes.append(np.unique(np.concatenate([c for _, c in features(one)])))
            code, n = np.unique(np.concatenate(codes), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(n.astype(np.int64))], names=["code", "n"])

    seen = sample.filter("positive").select("doc_id", "text").mapInArrow(frequent, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    seen = seen.filter(F.col("n") >= max(2, n_p // 200)).orderBy(F.desc("n"), "code").limit(CANDIDATES)
    candidates = np.sort(np.array([r["code"] for r in seen.select("code").collect()], np.int64).view(np.uint64))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        finder, n = Known(candidates), np.zeros((2, len(candidates)), np.int64)
        for batch in batches:
            doc, at = finder.find(batch_pack(batch, "doc_id", "text"))
            which = np.asarray(batch.column("positive").to_numpy(zero_copy_only=False), bool)[doc]
            n += [np.bincount(at[~which], minlength=len(candidates)), np.bincount(at[which], minlength=len(candidates))]
        yield pa.RecordBatch.from_arrays([pa.array([n.tobytes()], pa.binary())], names=["n"])

    total = sum((np.frombuffer(r["n"], np.int64) for r in sample.mapInArrow(counted, "n binary").collect()), np.zeros(2 * len(candidates), np.int64))
    in_u, in_p = total.reshape(2, -1)
    chance = n_p * (in_u + 0.5) / n_u  # documents of P that would have the feature if it told nothing
    contrast = np.where(in_p > chance, in_p * np.log(np.maximum(in_p, 1) / chance) - (in_p - chance), 0.0)
    best = np.argsort(-contrast, kind="stable")[:FEATURES]
    codes = candidates[np.sort(best[contrast[best] >= CONTRAST])]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Known(codes)
        for batch in batches:
            doc, at = finder.find(batch_pack(batch, "doc_id", "text"))
            edges = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(at.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("positive"), lists], names=["doc_id", "positive", "at"])

    rows = sample.mapInArrow(listed, "doc_id long, positive boolean, at array<int>").toPandas().sort_values(["positive", "doc_id"])
    lists, positive = [np.asarray(x, np.int64) for x in rows["at"]], rows["positive"].to_numpy(bool)
    weights = np.mean([train(lists, positive, len(codes), prior, seed) for seed in range(CLASSIFIERS)], axis=0)
    return Model(codes, weights, prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(model.codes)
        for batch in batches:
            s = model.scores(batch_pack(batch, "doc_id", "text"), known)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
