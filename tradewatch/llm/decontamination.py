"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

A benchmark item of n words is looked for in every window of n words of every text.  Windows and items are
compared on weighted ``SHINGLE``-word shingles (weight: how rare the shingle is among the items).  A window
takes a 64-bit SimHash in which a shingle votes with the square root of its weight (so the angle between two
fingerprinted vectors follows from their weighted Jaccard similarity alone: 0.8 is a cosine of 0.89 at least, about 10
of 64 bits, whichever shingles differ); the items' fingerprints are indexed by ``BLOCKS`` blocks of
bits, and a window looks up all block values within ``RADIUS`` // ``BLOCKS`` bits of its own, which finds every
item within ``RADIUS`` bits in all (pigeonhole).  Candidates are then checked by their exact weighted Jaccard
similarity.

Only windows that can reach the similarity are hashed: the weight of their shingles that occur in any item of
that size must be at least ``SIMILARITY`` times the weight of the lightest of them (a necessary condition, so
nothing is lost by it).

The benchmark is the query set.  It is broadcast in blocks of items of at most ``BLOCK_BYTES`` of text each,
measured first, and every block is run against all documents; documents are not shuffled at all.  Weights are those
of the whole benchmark: with several blocks, Spark counts the holders of the shingles that several items hold, and
these counts go to every block.

Words are lower-cased (A-Z) runs of letters and digits, so punctuation and line breaks do not hide a copy.

Edge cases: items shorter than a shingle are one feature; items without words match nothing; null or empty
texts match nothing; repeated items are reported each; repeated documents are reported each; rows with a null
doc_id are reported with it (``clean`` judges row by row); empty tables give an empty report.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare
from .packs import Pack, U, group_edges, mix
from .words import batch_pack, shingles, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCKS = 5
#: Text of one broadcast block of items at most (a single longer item is a block of its own).
BLOCK_BYTES = 32 << 20


class _Item:
    def __init__(self, item_id: int, features: np.ndarray, size: int):
        self.item_id, self.size = item_id, size
        self.features, self.counts = np.unique(features, return_counts=True)


def simhash(features: np.ndarray, weights: np.ndarray) -> int:
    """Per bit the sign of the weighted vote of the features."""
    bits = np.unpackbits(mix(features).view(np.uint8).reshape(-1, 8), axis=1)
    votes = weights @ (bits.astype(np.float64) * 2 - 1)
    return int.from_bytes(np.packbits(votes > 0).tobytes(), "big")


def near_masks(width: int, radius: int) -> np.ndarray:
    """All bit patterns of ``width`` bits with at most ``radius`` ones."""
    return np.array([sum(1 << i for i in c) for r in range(min(radius, width) + 1) for c in combinations(range(width), r)], np.int64)


class HammingIndex:
    """Fingerprints by blocks of bits; finds all within ``radius``."""

    def __init__(self, fingerprints: list[int], radius: int = RADIUS, blocks: int = BLOCKS):
        self.radius, self.prints = radius, fingerprints
        edges = [64 * i // blocks for i in range(blocks + 1)]
        self.blocks = []
        for lo, hi in zip(edges, edges[1:], strict=False):
            values = np.array([(f >> lo) & ((1 << (hi - lo)) - 1) for f in fingerprints], np.int64)
            order = np.argsort(values, kind="stable")
            starts = np.searchsorted(values[order], np.arange((1 << (hi - lo)) + 1))
            self.blocks.append((lo, hi - lo, order, starts, near_masks(hi - lo, radius // blocks)))

    def near(self, fingerprint: int) -> list[int]:
        found: set[int] = set()
        for lo, width, order, starts, masks in self.blocks:
            values = ((fingerprint >> lo) & ((1 << width) - 1)) ^ masks
            a, b = starts[values], starts[values + 1]
            for x, y in zip(a[b > a].tolist(), b[b > a].tolist(), strict=True):
                found.update(order[x:y].tolist())
        return sorted(i for i in found if (self.prints[i] ^ fingerprint).bit_count() <= self.radius)


class Benchmark:
    """The items of one block, ready to be searched for."""

    def __init__(self, items: list[tuple[int, str | None]], shingle: int = SHINGLE, similarity: float = SIMILARITY, whole: tuple[int, np.ndarray, np.ndarray] | None = None):
        """``whole``: of the whole benchmark the items with words, and the shingles (sorted) that several items hold, with their holders."""
        self.shingle, self.similarity = shingle, similarity
        texts = [(t or "").encode() for _, t in items]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        pack = Pack(0, np.arange(len(items)), offsets, np.frombuffer(b"".join(texts), np.uint8))
        words, at = word_hashes(pack, letters_only=True)
        self.items = []
        for i, (item_id, _) in enumerate(items):
            n = int(at[i + 1] - at[i])
            if n:
                f, _o = shingles(words[at[i] : at[i + 1]], np.array([0, n]), min(shingle, n))
                self.items.append(_Item(item_id, f, n))
        every = np.concatenate([x.features for x in self.items]) if self.items else np.zeros(0, np.uint64)
        self.known, holders = np.unique(every, return_counts=True)
        count, self.shared, self.holders = whole or (len(self.items), self.known[holders > 1], holders[holders > 1])
        self.count = max(1, count)
        self.rare = float(np.log(1 + self.count))
        self.known_weight = self.weight(self.known)
        for x in self.items:
            x.weights = self.weight(x.features) * x.counts
            x.total = float(x.weights.sum())
            x.print = simhash(x.features, np.sqrt(x.weights))
        self.by_size: dict[int, list[_Item]] = {}
        for x in self.items:
            self.by_size.setdefault(x.size, []).append(x)
        # sizes of the items that hold a known shingle
        held = sorted({(k, x.size) for x in self.items for k in np.searchsorted(self.known, x.features).tolist()})
        self.size_of = np.array([n for _, n in held], np.int64)
        self.size_from = np.searchsorted(np.array([k for k, _ in held], np.int64), np.arange(len(self.known) + 1))
        self.index = {n: HammingIndex([x.print for x in xs]) for n, xs in self.by_size.items()}
        # a first look that rules out nearly all shingles of the texts
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.known & U(0xFFFFF)).astype(np.int64)] = True

    def weight(self, features: np.ndarray) -> np.ndarray:
        """A shingle that one item or none holds weighs ``rare``."""
        if not len(self.shared):
            return np.full(len(features), self.rare)
        at = np.minimum(np.searchsorted(self.shared, features), len(self.shared) - 1)
        return np.where(self.shared[at] == features, np.log(1 + self.count / self.holders[at]), self.rare)

    def hits(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of shingles that occur in some item, and which known shingles they are."""
        at = np.flatnonzero(self.maybe[(features & U(0xFFFFF)).astype(np.int64)])
        if not len(at):
            return at, at
        k = np.minimum(np.searchsorted(self.known, features[at]), len(self.known) - 1)
        same = self.known[k] == features[at]
        return at[same], k[same]

    def compare(self, item: _Item, features: np.ndarray, counts: np.ndarray) -> float:
        """Weighted Jaccard similarity of an item and a window's distinct shingles."""
        _, i, j = np.intersect1d(item.features, features, assume_unique=True, return_indices=True)
        w = self.weight(item.features[i])
        shared = float((w * np.minimum(item.counts[i], counts[j])).sum())
        whole = item.total + float((self.weight(features) * counts).sum()) - shared
        return shared / whole if whole else 0.0

    def search(self, pack: Pack) -> Iterator[tuple[int, int, int, int, int, float]]:
        """(row, item_id, first word, words, bits apart, similarity): the best window of each row and item."""
        words, at = word_hashes(pack, letters_only=True)
        for k in sorted({min(self.shingle, n) for n in self.by_size}):
            features, offsets = shingles(words, at, k)
            hit, known = self.hits(features)
            rows = np.searchsorted(offsets, hit, "right") - 1
            # every hit counts for the sizes of the items that hold it
            many = self.size_from[known + 1] - self.size_from[known]
            inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            size = self.size_of[np.repeat(self.size_from[known], many) + inner]
            row, place, weight = np.repeat(rows, many), np.repeat(hit, many), np.repeat(self.known_weight[known], many)
            order = np.lexsort((place, size, row))
            row, place, weight, size = row[order], place[order], weight[order], size[order]
            first = group_edges(row, size)
            best: dict[tuple[int, int], tuple] = {}
            for f, e in zip(first.tolist(), [*first[1:].tolist(), len(row)][: len(first)], strict=True):
                r, n = int(row[f]), int(size[f])
                least = self.similarity * min(x.total for x in self.by_size[n]) - 1e-9
                if min(self.shingle, n) != k or at[r + 1] - at[r] < k or weight[f:e].sum() < least:
                    continue
                a, b = int(offsets[r]), int(offsets[r + 1])
                span = n - k + 1
                # windows that hold the first to the last hit (a text shorter than the item is one window)
                starts = np.arange(max(a, int(place[f]) - span + 1), min(int(place[e - 1]), max(b - span, a)) + 1)
                ends = np.minimum(starts + span, b)
                total = np.concatenate(([0.0], np.cumsum(weight[f:e])))
                inside = total[np.searchsorted(place[f:e], ends)] - total[np.searchsorted(place[f:e], starts)]
                for s in starts[inside >= least].tolist():
                    w, c = np.unique(features[s : min(s + span, b)], return_counts=True)
                    fingerprint = simhash(w, np.sqrt(self.weight(w) * c))
                    for q in self.index[n].near(fingerprint):
                        item = self.by_size[n][q]
                        value = self.compare(item, w, c)
                        key = (r, item.item_id)
                        if value >= self.similarity - 1e-12 and (key not in best or value > best[key][5]):
                            best[key] = (r, item.item_id, s - a, n, (item.print ^ fingerprint).bit_count(), value)
            yield from best.values()


def count_holders(items: DataFrame, shingle: int = SHINGLE) -> tuple[int, np.ndarray, np.ndarray]:
    """Items with words, the shingles that several items hold (sorted) and how many hold each, of the whole benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [x.features for x in Benchmark([(0, t) for t in batch.column("t").to_pylist()], shingle).items]
            f = np.concatenate([np.zeros(0, np.uint64), *held]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()), pa.array(np.ones(len(f), np.int64))], names=["f", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([len(held)], pa.int64())], names=["f", "n"])

    rows = items.select("t").mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).filter("f is null or n > 1").collect()
    count = sum(r["n"] for r in rows if r["f"] is None)
    shared = np.array([r["f"] for r in rows if r["f"] is not None], np.int64).view(np.uint64)
    holders = np.array([r["n"] for r in rows if r["f"] is not None], np.int64)
    order = np.argsort(shared)
    return count, shared[order], holders[order]


SCHEMA = "doc_id long, item_id long, first_word long, n_words long, bits_apart int, similarity double"


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str, block_bytes: int) -> Iterator[Callable[[], Benchmark]]:
    """Openers of the benchmark's blocks, for use inside tasks."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).cast("string").alias("t")).filter("i is not null")
    size = items.agg(F.sum(F.coalesce(F.octet_length("t"), F.lit(0)) + 64)).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    whole = spark.sparkContext.broadcast(count_holders(items) if blocks > 1 else None)
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).orderBy("i", "t").collect()
        shared = spark.sparkContext.broadcast([(r["i"], r["t"]) for r in part])
        yield lambda shared=shared: Benchmark(shared.value, whole=whole.value)


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and benchmark item it contains (best window)."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            bench = block()
            for batch in batches:
                rows = sorted(bench.search(batch_pack(batch, "id", "text")))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    ids = batch.column("id").take(pa.array(cols[0], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [ids, *[pa.array(c, t) for c, t in zip(cols[1:], (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64()), strict=True)]],
                        names=["doc_id", "item_id", "first_word", "n_words", "bits_apart", "similarity"],
                    )

        found = src.mapInArrow(run, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without a passage of the benchmark, row by row (whatever their ids), in one narrow pass per block."""
    prepare(docs.sparkSession)
    out, names = docs, docs.columns
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            bench = block()
            for batch in batches:
                texts = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch.column(names.index(text_col))], names=["id", "text"])
                dirty = np.zeros(batch.num_rows, bool)
                dirty[[row[0] for row in bench.search(batch_pack(texts, "id", "text"))]] = True
                yield batch.filter(pa.array(~dirty))

        out = out.mapInArrow(run, docs.schema)
    return out
