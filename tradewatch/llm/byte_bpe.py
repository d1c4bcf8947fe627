"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string exactly one token can be the last one of its BPE encoding.  ``Codec``
stores that token per prefix: the last token of ``s[:i]`` is the vocabulary entry ``t`` ending at ``i``
for which (last token of ``s[:i-len(t)]``, ``t``) is a pair that BPE would leave unmerged.  The encoding
is read off backwards, a byte is appended in constant work per candidate, and after an edit only the
prefixes from the edit up to the point where the stored tokens agree again are computed anew.

A pair is unmerged when no token across the border is made earlier than the tokens that stand on both
sides of it; walking up the two chains of merges that touch the border decides it.

``encode`` runs over a DataFrame: texts are split by a pattern, and each match is encoded by itself.
A task remembers encodings of short matches, and last tokens of their prefixes, in memories of bounded
size (they only save work: what is not remembered is computed).

Edge cases: a null text is an empty text with no tokens; a match of any length is encoded in linear
work; repeated rows and null ids are encoded row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

#: Entries of each memory of a task (matches, prefixes, pairs); a memory is emptied when full.
MEMORY = 400_000
#: Longer matches are not remembered.
SHORT = 48


class Codec:
    """Encoder and decoder for ranks (token bytes to id; a lower id is merged earlier)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        # byte string that ends some token: its id, or -1 if it is no token itself
        self.ends: dict[bytes, int] = {}
        for t in ranks:
            for i in range(1, len(t)):
                self.ends.setdefault(t[i:], -1)
        self.ends.update(ranks)
        self.last_of: dict[bytes, int] = {}  # remembered prefix: its last token

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of ``token`` joined (None: a single byte)."""
        if token not in self.parts:
            b = self.tokens[token]
            seq = [self.ranks[b[i : i + 1]] for i in range(len(b))]
            while len(seq) > 2:
                rank, at = min((self.ranks.get(self.tokens[x] + self.tokens[y], 1 << 60), i) for i, (x, y) in enumerate(zip(seq, seq[1:], strict=False)))
                seq[at : at + 2] = [rank]
            self.parts[token] = (seq[0], seq[1]) if len(seq) == 2 else None
        return self.parts[token]

    def border(self, token: int, side: int) -> list[int]:
        """Tokens at one end of ``token`` (side 0: left end, 1: right end), from the byte up to itself."""
        out = [token]
        while (p := self.split(out[-1])) is not None:
            out.append(p[side])
        return out[::-1]

    def unmerged(self, a: int, b: int) -> bool:
        """Whether BPE of the joined bytes of a and b gives exactly a, b."""
        key = (a, b)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MEMORY:
                self.pairs.clear()
            known = self.pairs[key] = self._unmerged(a, b)
        return known

    def _unmerged(self, a: int, b: int) -> bool:
        left, right = self.border(a, 1), self.border(b, 0)
        i = j = 0
        never = 1 << 60
        while True:
            next_left = left[i + 1] if i + 1 < len(left) else never
            next_right = right[j + 1] if j + 1 < len(right) else never
            across = self.ranks.get(self.tokens[left[i]] + self.tokens[right[j]], never)
            # equal ranks are equal tokens: the leftmost is made first
            if across < next_left and across <= next_right and across != never:
                return False
            if next_left == never and next_right == never:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def candidates(self, data: bytes, i: int) -> list[tuple[int, int]]:
        """(size, token) of the tokens that end at ``i``, shortest first."""
        ends, out = self.ends, []
        for size in range(1, i + 1):
            t = ends.get(data[i - size : i])
            if t is None:
                break
            if t >= 0:
                out.append((size, t))
        return out

    def extend(self, data: bytes, last: list[int], start: int, stop: int) -> None:
        """Sets ``last[i]`` for the prefixes of length start+1..stop (``last[0]`` stands for no token)."""
        for i in range(start + 1, stop + 1):
            for size, t in reversed(self.candidates(data, i)):
                if size == i or self.unmerged(last[i - size], t):
                    last[i] = t
                    break

    def prefixes(self, data: bytes) -> list[int]:
        last = [-1] * (len(data) + 1)
        self.extend(data, last, 0, len(data))
        return last

    def read(self, last: list[int]) -> list[int]:
        out, i = [], len(last) - 1
        while i:
            out.append(last[i])
            i -= len(self.tokens[last[i]])
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        return self.read(self.prefixes(data))

    def encode_short(self, data: bytes) -> list[int]:
        """Like ``encode``; prefixes met before, in whichever string, are looked up."""
        known, unmerged = self.last_of, self.pairs
        if len(known) >= MEMORY:
            known.clear()
        n = len(data)
        i = n
        while i and data[:i] not in known:
            i -= 1
        for i in range(i + 1, n + 1):
            for size, t in reversed(self.candidates(data, i)):
                if size == i:
                    break
                key = (known[data[: i - size]], t)
                ok = unmerged.get(key)
                if self.unmerged(*key) if ok is None else ok:
                    break
            known[data[:i]] = t
        out = []
        while n:
            out.append(known[data[:n]])
            n -= len(self.tokens[out[-1]])
        return out[::-1]

    def append(self, data: bytes, last: list[int], more: bytes) -> tuple[bytes, list[int]]:
        """State of data + more; only the new prefixes are computed."""
        joined = data + more
        out = last + [-1] * len(more)
        self.extend(joined, out, len(data), len(joined))
        return joined, out

    def edit(self, data: bytes, last: list[int], start: int, stop: int, new: bytes) -> tuple[bytes, list[int], int]:
        """State after data[start:stop] = new, and how many prefixes were computed.

        Prefixes up to ``start`` stay.  Behind the edit, once as many neighbouring prefixes as the longest
        token agree with the old state, all later ones agree too and are taken over.
        """
        joined = data[:start] + new + data[stop:]
        out = last[: start + 1] + [-1] * (len(joined) - start)
        shift, i, agree = len(new) - (stop - start), start, 0
        while i < len(joined):
            self.extend(joined, out, i, i + 1)
            i += 1
            if i - shift > stop and out[i] == last[i - shift]:
                agree += 1
                if agree >= self.longest:
                    out[i + 1 :] = last[i + 1 - shift :]
                    break
            else:
                agree = 0
        return joined, out, i - start

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class _Remembered(dict):
    """Match to its ids; a missing one is encoded, and kept if short."""

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, match: str) -> tuple[int, ...]:
        if len(match) > SHORT:
            return tuple(self.codec.encode(match.encode()))
        ids = tuple(self.codec.encode_short(match.encode()))
        if len(self) >= MEMORY:
            self.clear()
        self[match] = ids
        return ids


class TextEncoder:
    """Splits texts by the pattern and encodes the matches."""

    #: One per worker process and vocabulary: loading and remembered work are shared by its tasks.
    _made: dict[tuple[int, str], TextEncoder] = {}

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.codec = Codec(ranks)
        self.find = regex.compile(pattern).findall
        self.memory = _Remembered(self.codec)
        self.names = {i: str(i) for i in ranks.values()}

    @classmethod
    def shared(cls, ranks_data: bytes, pattern: str) -> TextEncoder:
        key = (hash(ranks_data), pattern)
        if key not in cls._made:
            cls._made.clear()
            cls._made[key] = cls({base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks_data.splitlines() if x)}, pattern)
        return cls._made[key]

    def encode(self, text: str) -> list[int]:
        memory = self.memory
        return list(chain.from_iterable([memory[m] for m in self.find(text)]))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``ids`` array<int>, ``decoded`` binary (from the ids) for every row; no shuffle."""
    return _over(docs, ranks_path, pattern, text_col, keep, "ids array<int>, decoded binary", _full)


def digest(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256, decoded_sha256: the digests of ``encode``, taken in the same task."""
    return _over(docs, ranks_path, pattern, text_col, keep, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digest)


def _full(encoder: TextEncoder, texts: list[str]) -> list[pa.Array]:
    ids = [encoder.encode(t) for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1]))
    return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array([encoder.codec.decode(x) for x in ids], pa.binary())]


def _digest(encoder: TextEncoder, texts: list[str]) -> list[pa.Array]:
    counts, id_hashes, byte_hashes = [], [], []
    for t in texts:
        ids = encoder.encode(t)
        counts.append(len(ids))
        id_hashes.append(hashlib.sha256(" ".join(map(encoder.names.__getitem__, ids)).encode()).hexdigest())
        byte_hashes.append(hashlib.sha256(encoder.codec.decode(ids)).hexdigest())
    return [pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(byte_hashes, pa.string())]


def _over(docs, ranks_path, pattern, text_col, keep, made, work) -> DataFrame:
    spark = docs.sparkSession
    prepare(spark)
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())  # a vocabulary file: fixed size, whatever the table
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder.shared(ranks.value, pattern)
        for batch in batches:
            # a slice at a time: ids of many long texts are not held together
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [t or "" for t in part.column("_t").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + work(encoder, texts), names=names + made_names)

    made_names = [x.split()[0] for x in made.split(", ")]
    src = docs.select(*[F.col(k).alias(n) for k, n in zip(keep, names, strict=True)], F.col(text_col).alias("_t"))
    kinds = ", ".join(f"{n} {src.schema[n].dataType.simpleString()}" for n in names)
    out = src.mapInArrow(run, (kinds + ", " if kinds else "") + made)
    return out.select(*[F.col(n).alias(k) for k, n in zip(keep, names, strict=True)], *made_names)
