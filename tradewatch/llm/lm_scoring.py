"""LM scoring with a hierarchical Pitman-Yor bigram model.

The root restaurant seats words over a uniform base; every previous word has a context restaurant whose parent is
the root.  A word of count c after a context is c customers of one dish at t tables; its tables are customers of
the root.  Seating is sampled by Gibbs: a customer sits at a table in proportion to (table size - discount), or at a
new one in proportion to (strength + discount * tables of the restaurant) * parent probability.  ``SWEEPS`` sweeps are
made; in each, all customers of every (context, word) and of every root word are seated anew at once, by a draw of
their number of tables given the rest (``draw_tables``).  The predictive probabilities of the sweeps after the first
are averaged.

    P(w | u) = (c_uw - d t_uw + (a + d T_u) P_root(w)) / (a + c_u)

How it is spread: (context, word) pairs live in buckets by a hash of both, so neither a frequent word nor a frequent
context is one task's work.  A pair seen once has one table in every seating, so only pairs seen twice are
sampled.  Restaurants meet through sums: each bucket of pairs sends its tables per word and per context, once per
word, to the bucket of that word, which answers the root's customers and tables and the context's tables; pairs are
sampled given those sums of the sweep before (as in other distributed Gibbs samplers).  The seating of a bucket is a
function of its pairs, the answers and a seed, so a lost task repeats exactly.  Documents are compressed packs in
the shared folder (``packs.py``); counts cover all training documents, with no cutoff.

Tokens: A-Z lower-cased, words between ASCII white space, then one end token per document.  Words are 64-bit hashes;
their counts are kept under 48 bits of them inside a bucket.  The discount of the contexts is n1 / (n1 + 2 n2) from
the pairs seen once and twice.

Edge cases: a null or empty text is one end token; unseen words and contexts get the parent's probability; rows with
equal ids are scored each (and learnt from each); rows with a null id are held out; without training documents every
token has the base probability; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize_counted
from .packs import Pack, Rounds, U, group_edges, mix, place_by, release, squeeze, unsqueeze
from .words import word_hashes

PACK_BYTES = 8 << 20
SWEEPS = 3
#: Draws of single customers, for ``seat``.
MOVES = 8
STRENGTH = 1.0
ROOT_STRENGTH = 1.0
ROOT_DISCOUNT = 0.6
#: Up to so many customers, the Stirling numbers behind the number of tables are exact; beyond, they are carried on.
EXACT = 512
#: Above so many tables of more customers than that, the number of tables is drawn from the saddle point's density.
MANY = 128
#: Weights held at once.
CELLS = 1 << 20

END, BEGIN = U(0xE1D0E1D0E1D0E1D1), U(0xB0E5B0E5B0E5B0E3)
KEY_BITS = U(48)
KEY = (U(1) << KEY_BITS) - U(1)


def is_training(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 7 != 2


def placed(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """bucket << 48 | 48 bits of the hash."""
    return ((mix(hashes ^ U(0x1B873593)) >> U(32)) % U(buckets)) << KEY_BITS | (hashes & KEY)


def by_bucket(places: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    edges = np.searchsorted(places, np.arange(buckets + 1, dtype=np.uint64) << KEY_BITS)
    for b in np.flatnonzero(edges[1:] > edges[:-1]):
        yield int(b), int(edges[b]), int(edges[b + 1])


def lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index in sorted ``keys`` and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, the place of one of each, and where every value stands among them (by hashing: most repeat)."""
    codes, found = pd.factorize(values)
    order = np.argsort(found)
    rank = np.empty(len(found), np.int64)
    rank[order] = np.arange(len(found))
    inverse = rank[codes]
    place = np.empty(len(found), np.int64)
    place[inverse] = np.arange(len(values))
    return found[order], place, inverse


class Tokens:
    """Tokens of a pack, its distinct words (with the begin mark) and distinct pairs."""

    def __init__(self, pack: Pack, buckets: int):
        words, at = word_hashes(pack)
        docs = len(pack.ids)
        self.counts = np.diff(at) + 1
        self.edges = np.concatenate(([0], np.cumsum(self.counts)))
        self.token = np.empty(int(self.edges[-1]), np.uint64)
        is_end = np.zeros(len(self.token), bool)
        is_end[self.edges[1:] - 1] = True
        self.token[is_end], self.token[~is_end] = END, words
        before = np.concatenate((np.array([BEGIN], np.uint64), self.token[:-1]))
        before[self.edges[:-1]] = BEGIN
        self.doc = np.repeat(np.arange(docs), self.counts)
        self.held_out = np.array([not is_training(i) for i in pack.ids.tolist()], bool)
        self.train = ~self.held_out[self.doc]
        # words: all tokens, and the begin mark
        self.words, first, inverse = distinct(placed(np.append(self.token, BEGIN), buckets))
        self.word_hash = np.append(self.token, BEGIN)[first]
        self.word = inverse[:-1]
        begin = inverse[-1]
        self.context = np.concatenate(([begin], self.word[:-1]))
        self.context[self.edges[:-1]] = begin
        self.begin = int(begin)
        self.pairs, self.pair_at, self.pair = distinct(placed(mix(mix(before) + self.token), buckets))
        self.pair_train = np.bincount(self.pair, weights=self.train, minlength=len(self.pairs)).astype(np.uint32)


def _answer(places: np.ndarray, buckets: int, answers: dict[int, bytes], shift: int = 0) -> list[np.ndarray]:
    """Answers of all buckets put together in the order of ``places``."""
    parts = [unsqueeze(answers[b + shift]) for b, _, _ in by_bucket(places, buckets)]
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _ask_pairs(buckets: int):
    def ask(pack: Pack, _: dict) -> Iterator[tuple[int, bytes]]:
        t = Tokens(pack, buckets)
        for b, lo, hi in by_bucket(t.pairs, buckets):
            yield b, squeeze(t.pairs[lo:hi] & KEY, t.pair_train[lo:hi])

    return ask


def _resolve_pairs(packs: list[int], payloads: list[bytes]) -> list[bytes]:
    """Per pair its count in all training documents, and whether this pack is the first that has learnt it."""
    parts = [unsqueeze(p) for p in payloads]
    sizes = [len(k) for k, _ in parts]
    key, count = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.lexsort((count == 0, key))  # packs that learnt the pair first, in pack order
    first = group_edges(key[order])
    totals = np.add.reduceat(count[order].astype(np.int64), first)
    total, owner = np.empty(len(key), np.uint32), np.zeros(len(key), np.uint8)
    total[order] = np.repeat(totals, np.diff(np.append(first, len(key))))
    lead = order[first]
    owner[lead] = count[lead] > 0
    edges = np.concatenate(([0], np.cumsum(sizes)))
    return [squeeze(total[a:b], owner[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _send_counts(buckets: int):
    """Words with their counts, and their owned once-seen pairs as dish and as context; owned pairs seen more often."""

    def work(pack: Pack, answers: dict) -> Iterator[tuple[int, bytes]]:
        t = Tokens(pack, buckets)
        total, owner = _answer(t.pairs, buckets, answers[0])
        n = len(t.words)
        count = np.bincount(t.word, weights=t.train, minlength=n).astype(np.uint32)
        once = t.pair_at[(owner > 0) & (total == 1)]
        dish = np.bincount(t.word[once], minlength=n).astype(np.uint32)
        context = np.bincount(t.context[once], minlength=n).astype(np.uint32)
        learnt = (count > 0) | (dish > 0) | (context > 0)
        learnt[t.begin] |= bool(t.train.any())
        places = t.words[learnt]
        columns = [x[learnt] for x in (count, dish, context)]
        for b, lo, hi in by_bucket(places, buckets):
            yield b, squeeze(places[lo:hi] & KEY, *[x[lo:hi] for x in columns])
        often = (owner > 0) & (total > 1)
        at = t.pair_at[often]
        places = t.pairs[often]
        columns = [t.word_hash[t.context[at]], t.word_hash[t.word[at]], total[often]]
        for b, lo, hi in by_bucket(places, buckets):
            yield buckets + b, squeeze(places[lo:hi] & KEY, *[x[lo:hi] for x in columns])

    return work


STATE_SCHEMA = "pack_id long, payload binary, tokens long, types long, once long, twice long"


def _merge_counts(buckets: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        bucket = int(frame["bucket"].iloc[0])
        columns = [np.concatenate(x) for x in zip(*[unsqueeze(p) for p in frame["payload"]], strict=True)]
        order = np.argsort(columns[0], kind="stable")
        columns = [c[order] for c in columns]
        if bucket < buckets:
            first = group_edges(columns[0])
            key, (count, dish, context) = columns[0][first], [np.add.reduceat(c.astype(np.int64), first) for c in columns[1:]]
            sums = (int(count.sum()), int((count > 0).sum()), int(dish.sum()), 0)
            payload = squeeze(key, count, dish, context)
        else:
            sums = (0, 0, 0, int((columns[3] == 2).sum()))
            payload = squeeze(*columns)
        return pd.DataFrame([(bucket, payload, *sums)], columns=["pack_id", "payload", "tokens", "types", "once", "twice"])

    return run


@dataclass
class Pairs:
    """Pairs of a bucket that were seen at least twice."""

    pack_id: int
    key: np.ndarray
    context: np.ndarray
    word: np.ndarray
    count: np.ndarray


def open_pairs(pack_id: int, payload: bytes) -> Pairs:
    return Pairs(int(pack_id), *unsqueeze(payload))


@dataclass(frozen=True)
class Model:
    """Numbers that all buckets share."""

    discount: float
    types: int
    #: per finished round: (customers, tables) of the root
    root: tuple[tuple[int, int], ...] = ()

    def root_probability(self, customers: np.ndarray, tables: np.ndarray, r: int) -> np.ndarray:
        c, t = self.root[r]
        return (customers - ROOT_DISCOUNT * tables + (ROOT_STRENGTH + ROOT_DISCOUNT * t) / (self.types + 1)) / (ROOT_STRENGTH + c)


def seat(sizes: np.ndarray, count: np.ndarray, mass: np.ndarray, slope: np.ndarray, discount: float, moves: int, rng: np.random.Generator) -> None:
    """``moves`` Gibbs draws on the table sizes [pair, table]; a new table weighs mass + slope * (tables - first tables).

    Single customers, one after the other: what ``draw_tables`` draws at once is compared with this.
    """
    n, width = sizes.shape
    every = np.arange(n)
    tables = (sizes > 0).sum(1)
    base = tables.copy()
    for _ in range(moves):
        # a customer leaves
        at = (np.cumsum(sizes, 1) <= (rng.random(n) * count)[:, None]).sum(1)
        at = np.minimum(at, width - 1)
        sizes[every, at] -= 1
        tables -= sizes[every, at] == 0
        # and sits down again
        weight = np.maximum(sizes - discount, 0.0)
        new = np.maximum(mass + slope * (tables - base), 1e-300)
        room = tables < width
        new = np.where(room, new, 0.0)
        total = np.cumsum(weight, 1)
        draw = rng.random(n) * (total[:, -1] + new)
        joins = draw < total[:, -1]
        seat_at = np.minimum((total <= draw[:, None]).sum(1), width - 1)
        free = (sizes == 0).argmax(1)
        at = np.where(joins, seat_at, free)
        tables += sizes[every, at] == 0
        sizes[every, at] += 1


@lru_cache(maxsize=8)
def stirling(discount: float) -> np.ndarray:
    """[n, t - 1]: log of the weight of all seatings of n customers at t tables, each of size m weighing (1 - d) ... (m - 1 - d)."""
    out = np.full((EXACT + 1, EXACT), -np.inf)
    out[1, 0] = 0.0
    tables = np.arange(1, EXACT + 1)
    for n in range(1, EXACT):
        stay = out[n, :n] + np.log(n - tables[:n] * discount)
        out[n + 1, :n] = stay
        out[n + 1, 1 : n + 1] = np.logaddexp(out[n + 1, 1 : n + 1], out[n, :n])
    return out


#: Places of the grid on which many tables are drawn, and how many standard deviations it reaches from the mode.
GRID, GRID_WIDTH = 129, 12.0


def _pick(weight: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """1 + the column drawn by the log weights of each row."""
    total = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), 1)
    return 1 + np.minimum((total <= (draw * total[:, -1])[:, None]).sum(1), weight.shape[1] - 1)


def _saddle(count: np.ndarray, mass: np.ndarray, slope: np.ndarray, d: float):
    """For many customers, as functions of the saddle point x = 1 - exp(-g) of the generating function: the tables that
    belong to g, and the log of the weight of one table more against one less (between t - 1/2 and t + 1/2)."""

    def spread(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, f = -np.expm1(-g), -np.expm1(-d * g)
        mean = x * d * np.exp((1 - d) * g) / f
        bend = 1 / np.expm1(g) + (1 - d) - d / np.expm1(d * g)
        return count / mean, np.log(count * np.maximum(bend, 1e-300) * x) + g

    def at(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t, _ = spread(g)
        (t0, v0), (t1, v1) = spread(g * 1.001), spread(g / 1.001)
        ratio = np.log(-np.expm1(-d * g)) - 0.5 * (v1 - v0) / (t1 - t0)
        return t, ratio + np.log(mass + slope * np.maximum(t - 0.5, 0.0)) - np.log(d * (t + 0.5))

    return at


def _most(count: np.ndarray, mass: np.ndarray, slope: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Most likely number of tables of many customers, the variance there, and its saddle point."""
    at = _saddle(count, mass, slope, d)
    lo, hi = np.full(len(count), 1e-6), np.log(count / d) / (1 - d)
    hi = np.minimum(hi, 600.0)
    for _ in range(50):
        g = np.sqrt(lo * hi)
        less = at(g)[1] < 0
        lo, hi = np.where(less, g, lo), np.where(less, hi, g)
    (t0, r0), (t1, r1) = at(g * 1.001), at(g / 1.001)
    return at(g)[0], (t1 - t0) / np.maximum(r0 - r1, 1e-12), g


def _draw_many(count: np.ndarray, mass: np.ndarray, slope: np.ndarray, d: float, most: np.ndarray, variance: np.ndarray, g: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Tables drawn from the saddle point's density: its log is the running sum of the log ratios over a grid around the mode."""
    at = _saddle(count[:, None], mass[:, None], slope[:, None], d)
    per_step = np.abs(at((g * 1.001)[:, None])[0][:, 0] - most) / math.log(1.001)  # tables per unit of log g
    wide = np.minimum(GRID_WIDTH * np.sqrt(variance) / np.maximum(per_step, 1e-9), 5.0)
    steps = np.linspace(1.0, -1.0, GRID)  # falling g: rising t
    t, ratio = at(np.maximum(g[:, None] * np.exp(wide[:, None] * steps), 1e-9))
    gap = np.diff(t, axis=1)
    log = np.concatenate((np.zeros((len(g), 1)), np.cumsum(0.5 * (ratio[:, 1:] + ratio[:, :-1]) * gap, 1)), 1)
    density = np.exp(log - log.max(1, keepdims=True))
    total = np.concatenate((np.zeros((len(g), 1)), np.cumsum(0.5 * (density[:, 1:] + density[:, :-1]) * gap, 1)), 1)
    wanted = draw * total[:, -1]
    k = np.clip((total <= wanted[:, None]).sum(1) - 1, 0, GRID - 2)
    row = np.arange(len(g))
    inside = (wanted - total[row, k]) / np.maximum(total[row, k + 1] - total[row, k], 1e-300)
    return t[row, k] + inside * gap[row, k]


def draw_tables(count: np.ndarray, mass: np.ndarray, slope: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of ``count`` customers of one dish, all seated anew; with t tables of its own, a new one weighs mass + slope * t.

    P(t) is proportional to the Stirling number of (count, t) times the masses of the tables.  Above ``EXACT`` customers
    log S(n, t) = const - (t - 1) log d - log (t - 1)! + log h(n, t), where h depends on (t - 1) / n^d nearly alone
    and is read from the last exact row; where most likely more than ``MANY`` tables are, t is drawn from the saddle
    point's density on a grid around its mode.  So the work for a dish does not grow with its customers.
    """
    out = np.ones(len(count), np.int64)
    draw = rng.random(len(count))
    mass = np.maximum(mass, 1e-300)
    exact = stirling(discount)
    lo = 1
    while lo < EXACT:
        width = min(EXACT, 2 if lo == 1 else lo + max(1, lo // 2))
        mine = np.flatnonzero((count > lo) & (count <= width))
        for a in range(0, len(mine), CELLS // width):
            i = mine[a : a + CELLS // width]
            masses = np.log(mass[i, None] + slope[i, None] * np.arange(width))
            out[i] = _pick(exact[count[i], :width] + np.cumsum(masses, 1), draw[i])
        lo = width
    heavy = np.flatnonzero(count > EXACT)
    if not len(heavy):
        return out
    most, variance, saddle = _most(count[heavy].astype(float), mass[heavy], slope[heavy], discount)
    many = most > MANY
    i = heavy[many]
    for a in range(0, len(i), CELLS // EXACT):
        j, m = i[a : a + CELLS // EXACT], np.flatnonzero(many)[a : a + CELLS // EXACT]
        t = _draw_many(count[j].astype(float), mass[j], slope[j], discount, most[m], variance[m], saddle[m], draw[j])
        out[j] = np.clip(np.rint(t), 1, count[j])
    others = np.arange(EXACT)
    factorial = np.concatenate(([0.0], np.cumsum(np.log(others[1:]))))
    h = exact[EXACT] - exact[EXACT, 0] + others * math.log(discount) + factorial
    power = lambda n: math.lgamma(n - 2 * discount) - math.lgamma(n - discount)  # noqa: E731  (n^-d)
    rest = heavy[~many]
    for a in range(0, len(rest), CELLS // EXACT):
        i = rest[a : a + CELLS // EXACT]
        scale = np.exp(np.array([power(n) for n in count[i].tolist()]) - power(EXACT))
        masses = np.log(mass[i, None] + slope[i, None] * others)
        out[i] = _pick(np.interp(others * scale[:, None], others, h) - others * math.log(discount) - factorial + np.cumsum(masses, 1), draw[i])
    return out


class Seating:
    """Tables of a bucket's pairs, replayed from the answers so far (start: one table per pair)."""

    def __init__(self, pairs: Pairs, buckets: int, answers: dict, model: Model):
        n = len(pairs.key)
        self.places, inverse = np.unique(placed(np.concatenate((pairs.context, pairs.word)), buckets), return_inverse=True)
        self.context, self.word = inverse[:n], inverse[n:]
        self.history = [np.ones(n, np.int64)]
        count = pairs.count.astype(np.int64)
        for r in range(len(model.root)):
            of_context, customers, tables = _answer(self.places, buckets, answers[r])
            probability = model.root_probability(customers.astype(float), tables.astype(float), r)[self.word]
            others = of_context[self.context] - self.history[-1]
            mass = (STRENGTH + model.discount * others) * probability
            self.history.append(draw_tables(count, mass, model.discount * probability, model.discount, np.random.default_rng([pairs.pack_id, r])))


def _ask_tables(buckets: int, model: Model):
    def ask(pairs: Pairs, answers: dict) -> Iterator[tuple[int, bytes]]:
        s = Seating(pairs, buckets, answers, model)
        t = s.history[-1]
        dish = np.bincount(s.word, weights=t, minlength=len(s.places)).astype(np.int64)
        context = np.bincount(s.context, weights=t, minlength=len(s.places)).astype(np.int64)
        for b, lo, hi in by_bucket(s.places, buckets):
            yield b, squeeze(s.places[lo:hi] & KEY, dish[lo:hi], context[lo:hi])

    return ask


WORDS_KIND, TOTAL_KIND = 0, 1000


def _resolve_tables(number: int, model: Model):
    def resolve(packs: list[int], payloads: list[bytes], side: dict[int, bytes], bucket: int) -> list[bytes]:
        """Per asked word: tables of its context restaurant, its customers and tables in the root; then all words' and their sums."""
        if WORDS_KIND not in side:
            return []
        key, _, dish, context = unsqueeze(side[WORDS_KIND])
        customers, of_context = dish.astype(np.int64), context.astype(np.int64)
        parts = [unsqueeze(p) for p in payloads]
        for k, d, c in parts:
            at, _known = lookup(key, k)
            np.add.at(customers, at, d)
            np.add.at(of_context, at, c)
        # tables of the root without the word's own, in the round before (at first one per word)
        own = unsqueeze(side[TOTAL_KIND])[2] if TOTAL_KIND in side else np.minimum(customers, 1)
        others = (model.root[-1][1] if model.root else model.types) - own
        mass = (ROOT_STRENGTH + ROOT_DISCOUNT * others) / (model.types + 1)
        slope = np.full(len(key), ROOT_DISCOUNT / (model.types + 1))
        tables = np.minimum(customers, draw_tables(customers, mass, slope, ROOT_DISCOUNT, np.random.default_rng([bucket, number, 7])))
        out = []
        for k, _, _ in parts:
            at, _known = lookup(key, k)
            out.append(squeeze(of_context[at], customers[at], tables[at]))
        return [*out, squeeze(of_context, customers, tables)]

    return resolve


def _totals(frame: DataFrame) -> tuple[int, int]:
    """Customers and tables of the root, summed over the buckets of words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            sums = [unsqueeze(p)[1:] for p in f["payload"]]
            yield pd.DataFrame({"c": [int(c.sum()) for c, _ in sums], "t": [int(t.sum()) for _, t in sums]})

    row = frame.filter("pack_id = -1").select("payload").mapInPandas(run, "c long, t long").agg(F.sum("c"), F.sum("t")).first()
    return int(row[0] or 0), int(row[1] or 0)


def _send_seating(buckets: int, model: Model):
    def work(pairs: Pairs, answers: dict) -> Iterator[tuple[int, int, bytes]]:
        s = Seating(pairs, buckets, answers, model)
        yield pairs.pack_id, 0, squeeze(pairs.key, *[t.astype(np.uint32) for t in s.history[1:]])

    return work


def _ask_model(buckets: int):
    def ask(pack: Pack, answers: dict) -> Iterator[tuple[int, bytes]]:
        t = Tokens(pack, buckets)
        total, _ = _answer(t.pairs, buckets, answers[0])
        for b, lo, hi in by_bucket(t.words, buckets):
            yield b, squeeze(t.words[lo:hi] & KEY)
        often = t.pairs[total > 1]
        for b, lo, hi in by_bucket(often, buckets):
            yield buckets + b, squeeze(often[lo:hi] & KEY)

    return ask


def _resolve_model(buckets: int, samples: tuple[int, ...]):
    def resolve(packs: list[int], payloads: list[bytes], side: dict[int, bytes], bucket: int) -> list[bytes]:
        """Per word: count, then per sample tables as context, customers and tables in the root.  Per pair: tables per sample."""
        asked = [unsqueeze(p)[0] for p in payloads]
        if not side:
            return [squeeze(*[np.zeros(len(k), np.int64)] * (1 + 3 * len(samples))) for k in asked]
        if bucket < buckets:
            key, count, *_ = unsqueeze(side[WORDS_KIND])
            columns = [count, *[x for s in samples for x in unsqueeze(side[TOTAL_KIND + s])]]
        else:
            key, *columns = unsqueeze(side[WORDS_KIND])
        out = []
        for k in asked:
            at, known = lookup(key, k)
            out.append(squeeze(*[np.where(known, c[at], 0).astype(np.int64) for c in columns]))
        return out

    return resolve


SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(buckets: int, model: Model, train_tokens: int, train_docs: int, samples: tuple[int, ...]):
    def work(pack: Pack, answers: dict) -> Iterator[tuple]:
        t = Tokens(pack, buckets)
        pair_count, _ = _answer(t.pairs, buckets, answers[0])
        count, *columns = _answer(t.words, buckets, answers[1])
        often = pair_count > 1
        tables = np.zeros((len(samples), len(t.pairs)))
        tables[:, pair_count == 1] = 1
        if often.any():
            for k, column in zip(range(len(samples)), _answer(t.pairs[often], buckets, answers[1], buckets), strict=True):
                tables[k, often] = column
        base = np.log10((count + 1.0) / (train_tokens + 1.0 * (model.types + 1)))[t.word]
        as_context = count.astype(float)
        as_context[t.begin] = train_docs
        c_u, c_uw = as_context[t.context], pair_count[t.pair].astype(float)
        p = np.zeros(len(t.token))
        for k, r in enumerate(samples):
            of_context, customers, root_tables = columns[3 * k : 3 * k + 3]
            root = model.root_probability(customers.astype(float), root_tables.astype(float), r)[t.word]
            own = np.maximum(c_uw - model.discount * tables[k][t.pair], 0.0)
            mixed = (own + (STRENGTH + model.discount * of_context[t.context]) * root) / (STRENGTH + c_u)
            p += np.where(c_u > 0, mixed, root)
        logs = np.log10(p / len(samples))
        known = (count > 0)[t.word]
        first = t.edges[:-1]
        for i, (b, s, k) in enumerate(zip(np.add.reduceat(base, first).tolist(), np.add.reduceat(logs, first).tolist(), np.add.reduceat(known.astype(np.int64), first).tolist(), strict=True)):
            yield int(pack.ids[i]), bool(t.held_out[i]), int(t.counts[i]), k, train_tokens, b, s

    return work


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pack_bytes: int = PACK_BYTES, sweeps: int = SWEEPS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document."""
    # rows without an id travel under a number that is held out
    texts = Rounds.over(docs, id_col, text_col, pack_bytes, choose=lambda free: next(i for i in itertools.count(free) if not is_training(i)))
    n = texts.buckets
    texts.round(_ask_pairs(n), _resolve_pairs)
    # one checkpoint holds the words' counts and the buckets of pairs, dealt for the sweeps
    state = place_by(texts.per_pack(_send_counts(n), "bucket int, payload binary").groupBy("bucket").applyInPandas(_merge_counts(n), STATE_SCHEMA), "pack_id")
    sums = state.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types", "once", "twice")]).first()
    train_tokens, types, once, twice = (int(x) for x in sums)
    train_docs = docs.select(F.col(id_col).cast("long").alias("i")).filter("i is not null").filter(F.crc32(F.col("i").cast("string")) % 7 != 2).count()
    model = Model(once / (once + 2 * twice) if once and twice else 0.75, types)
    words = state.filter(F.col("pack_id") < n).select(F.col("pack_id").cast("int").alias("bucket"), F.lit(WORDS_KIND).alias("kind"), "payload")
    pairs = Rounds(state.filter(F.col("pack_id") >= n).select("pack_id", "payload"), n, open_pairs)
    side = before = words
    for r in range(sweeps):
        answers = pairs.round(_ask_tables(n, model), _resolve_tables(r, model), before)
        model = Model(model.discount, types, (*model.root, _totals(answers)))
        sums = answers.filter("pack_id = -1").select("bucket", "payload")
        side = side.unionByName(sums.withColumn("kind", F.lit(TOTAL_KIND + r)))
        before = words.unionByName(sums.withColumn("kind", F.lit(TOTAL_KIND)))
    # the first round's sums belong to the start, one table per pair; the others to sampled seatings
    samples = tuple(range(1, sweeps))
    replay = Model(model.discount, types, model.root[:-1])
    seated, _ = materialize_counted(pairs.per_pack(_send_seating(n, replay), "bucket int, kind int, payload binary"), "lm-seating")
    release(texts.spark)
    texts.round(_ask_model(n), _resolve_model(n, samples), side.unionByName(seated))
    return texts.per_pack(_score(n, model, train_tokens, train_docs, samples), SCORE_SCHEMA).withColumn("doc_id", texts.known("doc_id"))
