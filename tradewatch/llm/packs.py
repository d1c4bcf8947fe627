"""Packs: bounded runs of whole documents, and questions between packs through hash buckets.

Operators that compare every position or signature of a corpus would shuffle a row per position.  Here
a task gathers its documents into packs of a few MB, written once to the shared checkpoint folder
(compressed, hash-partitioned by pack id, lineage cut).  A round of questions is then

1. every pack sends one sorted, de-duplicated array of keys per bucket (so a key that a third of all
   documents share is sent once per pack: the map-side combine),
2. a bucket merges the arrays of all packs and answers each pack in the order it asked,
3. the answers, written as a small table, meet the packs again by pack id; the packs themselves are
   not shuffled again, because the checkpoint keeps their partitioning.

Packs hold about ``PACK_BYTES``; a longer document is a pack of its own.  The number of buckets follows the
number of packs, one for every ``BUCKET_BYTES`` of text.  Rows with a null id travel under numbers above all ids
(``Rounds.known`` gives the null back): one number for all of them, or one for each.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize_counted
from .common import partitions, prepare

PACK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 8
PACK_SCHEMA = "pack_id long, ids binary, lens binary, body binary"
ASK_SCHEMA = "bucket int, pack_id long, payload binary"
REPLY_SCHEMA = "pack_id long, round int, bucket int, payload binary"


@dataclass
class Pack:
    pack_id: int
    ids: np.ndarray  # int64 per document
    offsets: np.ndarray  # int64, one more than documents
    data: np.ndarray  # uint8, all texts one after the other

    def text(self, i: int) -> np.ndarray:
        return self.data[self.offsets[i] : self.offsets[i + 1]]


def open_pack(pack_id: int, ids: bytes, lens: bytes, body: bytes) -> Pack:
    import zstandard

    sizes = np.frombuffer(lens, np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    data = zstandard.ZstdDecompressor().decompress(body, max_output_size=max(1, int(offsets[-1])))
    return Pack(int(pack_id), np.frombuffer(ids, np.int64), offsets, np.frombuffer(data, np.uint8))


def first_free(docs: DataFrame, id_col: str) -> int | None:
    """The number above all ids if there are rows without one, else nothing."""
    ids = F.col(id_col).cast("long")
    last, without = docs.agg(F.max(ids), F.count(F.when(ids.isNull(), 1))).first()
    if not without:
        return None
    if last is not None and last >= 1 << 62:
        raise ValueError("ids of 2**62 and more leave no numbers for rows without an id")
    return max(last or 0, 0) + 1


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pack_bytes: int = PACK_BYTES, free: int | None = None, apart: bool = False
) -> DataFrame:
    """Checkpointed packs of all rows (a null text is an empty one), partitioned by pack_id.

    A row without an id gets the number ``free``, or with ``apart`` one of its own from there on.
    """
    spark = docs.sparkSession
    prepare(spark)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        part, squeeze, made = TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=1), 0
        ids: list[int] = []
        texts: list[bytes] = []
        held = without = 0

        def close() -> pa.RecordBatch:
            row = [[(part << 32) + made], [np.array(ids, np.int64).tobytes()], [np.array([len(t) for t in texts], np.int64).tobytes()], [squeeze.compress(b"".join(texts))]]
            return pa.RecordBatch.from_arrays([pa.array(row[0], pa.int64()), *[pa.array(x, pa.binary()) for x in row[1:]]], names=["pack_id", "ids", "lens", "body"])

        for batch in batches:
            texts_col = batch.column("text").cast(pa.binary())
            for i, t in zip(batch.column("id").to_pylist(), texts_col.to_pylist(), strict=True):
                if texts and held + len(t or b"") > pack_bytes:
                    yield close()
                    made, held = made + 1, 0
                    ids.clear()
                    texts.clear()
                if i is None:
                    i = free + ((part << 32) + without if apart else 0)
                    without += 1
                ids.append(i)
                texts.append(t or b"")
                held += len(t or b"")
        if texts:
            yield close()

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return place_by(src.mapInArrow(gather, PACK_SCHEMA), "pack_id")


def place_by(df: DataFrame, column: str) -> DataFrame:
    """Checkpoint of ``df`` dealt by ``column``: later rounds on that column do not shuffle it again."""
    spark = df.sparkSession
    placed = df.repartition(partitions(spark), column)
    # a checkpoint of an adaptive plan forgets how it is partitioned, and every round would shuffle the packs
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = placed.checkpoint()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    del placed
    release(spark)
    return out


def squeeze(*arrays: np.ndarray) -> bytes:
    """Equally long arrays as one compressed payload (bytes of a kind side by side: sorted keys and small counts shrink well)."""
    import zstandard

    head = f"{len(arrays[0])} {' '.join(a.dtype.str for a in arrays)}\n".encode()
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def unsqueeze(payload: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(payload)
    head, _, body = raw.partition(b"\n")
    n, *kinds = head.decode().split()
    out, at, n = [], 0, int(n)
    for kind in map(np.dtype, kinds):
        size = n * kind.itemsize
        planes = np.frombuffer(body, np.uint8, size, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += size
    return out


class Rounds:
    """Packs and the answers they have got so far."""

    def __init__(self, packs: DataFrame, buckets: int, opener: Callable = open_pack, free: int | None = None):
        self.packs, self.opener, self.buckets, self.free = packs, opener, buckets, free
        self.spark = packs.sparkSession
        self.replies = self.spark.createDataFrame([], REPLY_SCHEMA)
        self.done = 0

    @classmethod
    def over(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pack_bytes: int = PACK_BYTES, apart: bool = False, choose: Callable[[int], int] | None = None) -> Rounds:
        """Packs of all rows; ``choose`` may take a later number than the first free one for rows without an id."""
        free = first_free(docs, id_col)
        if free is not None and choose is not None:
            free = choose(free)
        packs = pack_documents(docs, id_col, text_col, pack_bytes, free, apart)
        return cls(packs, max(LEAST_BUCKETS, -(-packs.count() * pack_bytes // BUCKET_BYTES)), free=free)

    def known(self, name: str) -> Column:
        """A column of ids in which the numbers of rows without one are null again."""
        c = F.col(name)
        return c if self.free is None else F.when(c < self.free, c)

    def per_pack(self, work: Callable[[Pack, dict[int, dict[int, bytes]]], Iterable[tuple]], schema: str) -> DataFrame:
        """Rows that ``work`` gives for each pack and its answers ({round: {bucket: payload}})."""
        names, opener = [x.split()[0] for x in schema.split(", ")], self.opener

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            rows = []
            answers: dict[int, dict[int, bytes]] = {}
            for r, b, payload in zip(right["round"], right["bucket"], right["payload"], strict=True):
                answers.setdefault(int(r), {})[int(b)] = payload
            for row in left.itertuples(index=False):
                rows.extend(work(opener(*row), answers))
            return pd.DataFrame(rows, columns=names)

        if not self.done:

            def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
                for frame in batches:
                    for row in frame.itertuples(index=False):
                        yield pd.DataFrame(list(work(opener(*row), {})), columns=names)

            return self.packs.mapInPandas(first, schema)
        return self.packs.groupBy("pack_id").cogroup(self.replies.groupBy("pack_id")).applyInPandas(run, schema)

    def add(self, replies: DataFrame) -> None:
        """Counts a table made elsewhere (REPLY_SCHEMA, numbered with the next round) as that round's answers."""
        self.replies = self.replies.unionByName(replies)
        self.done += 1

    def round(self, ask: Callable[[Pack, dict], Iterable[tuple[int, bytes]]], resolve: Callable[..., list[bytes]], side: DataFrame | None = None) -> DataFrame:
        """One round: ``ask`` gives (bucket, payload) of a pack; ``resolve`` gets all packs' payloads of a bucket.

        With ``side`` (bucket int, kind int, payload binary), ``resolve`` also gets the bucket's side rows as
        {kind: payload} and its number, and may answer more than it was asked: those payloads go to pack -1.
        """
        number = self.done

        def asked(pack: Pack, answers: dict) -> Iterator[tuple[int, int, bytes]]:
            for bucket, payload in ask(pack, answers):
                yield bucket, pack.pack_id, payload

        def answer(frame: pd.DataFrame, bucket: int, *more) -> pd.DataFrame:
            frame = frame.sort_values("pack_id")
            packs = frame["pack_id"].tolist()
            out = resolve(packs, frame["payload"].tolist(), *more)
            packs += [-1] * (len(out) - len(packs))
            return pd.DataFrame({"pack_id": np.array(packs, np.int64), "round": np.int32(number), "bucket": np.int32(bucket), "payload": out})

        def resolved(frame: pd.DataFrame) -> pd.DataFrame:
            return answer(frame, int(frame["bucket"].iloc[0]))

        def resolved_with(key: tuple, frame: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            return answer(frame, int(key[0]), dict(zip(rows["kind"].tolist(), rows["payload"], strict=True)), int(key[0]))

        asks = self.per_pack(asked, ASK_SCHEMA).groupBy("bucket")
        made = asks.applyInPandas(resolved, REPLY_SCHEMA) if side is None else asks.cogroup(side.groupBy("bucket")).applyInPandas(resolved_with, REPLY_SCHEMA)
        new, _ = materialize_counted(made, f"replies-{number}")
        del asks, made  # nothing may hold the round's shuffles any more
        self.replies = self.replies.unionByName(new) if number else new
        self.done += 1
        release(self.spark)
        return new


def release(spark) -> None:
    """Lets the executors drop shuffle files of finished rounds now, not when the driver happens to collect garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every input bit moves every output bit)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def to_slots(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """bucket << 32 | 32 more bits of the hash: sorts by bucket first."""
    return ((hashes >> U(32)) % U(buckets)) << U(32) | (hashes & U(0xFFFFFFFF))


def bucket_bounds(slots: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the non-empty buckets of a sorted slot array."""
    edges = np.searchsorted(slots, np.arange(buckets + 1, dtype=np.uint64) << U(32))
    for b in np.flatnonzero(edges[1:] > edges[:-1]):
        yield int(b), int(edges[b]), int(edges[b + 1])


def group_edges(*keys: np.ndarray) -> np.ndarray:
    """Start index of every run of equal keys in sorted arrays."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)
