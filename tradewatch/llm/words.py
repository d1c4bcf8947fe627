"""Words of whole texts as 64-bit hashes, array-wise (words are runs of bytes other than ASCII white space)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .packs import Pack, U, mix

#: Bytes handled at a time.
SEGMENT = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Everything in ASCII that is neither letter nor digit (bytes of other letters are part of a word).
_PUNCT = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Base of the words' polynomial hash, and its inverse modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first powers of a number modulo 2 ** 64 (``n`` at least)."""
    if len(_powers.get(base, ())) < n:
        p = np.full(max(2 * SEGMENT, n + n // 4), base, np.uint64)
        p[0] = 1
        _powers[base] = np.cumprod(p)
    return _powers[base]


def batch_pack(batch: pa.RecordBatch, id_col: str, text_col: str) -> Pack:
    """An Arrow batch as a pack (a null text is an empty one; a null id is 0)."""
    texts = pc.fill_null(batch.column(text_col), "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    ids = pc.fill_null(batch.column(id_col), 0).to_numpy(zero_copy_only=False)
    return Pack(0, ids, offsets - offsets[0], data[offsets[0] : offsets[-1]])


def word_hashes(pack: Pack, lower: bool = True, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the word offsets of the documents.

    Words are cut at white space, with ``letters_only`` at all ASCII punctuation too.
    """
    cut = _PUNCT if letters_only else _SPACE
    data, n = pack.data, len(pack.data)
    begins = np.zeros(n + 1, bool)
    begins[pack.offsets] = True  # a document's first byte begins a word even after a letter
    hashes, places = [], []
    a = 0
    while a < n:
        b = min(a + SEGMENT, n)
        while b < n and not cut[data[b]]:  # up to the end of a word
            step = cut[data[b : b + 4096]]
            b += int(step.argmax()) if step.any() else len(step)
        part = data[a:b]
        word = ~cut[part]
        first = word.copy()
        first[1:] &= ~word[:-1] | begins[a + 1 : b]
        last = word.copy()
        last[:-1] &= ~word[1:] | first[1:]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        if len(starts):
            # running sums of byte * base ** place; a word is a difference of two, moved back to place 0
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(((_LOWER[part] if lower else part).astype(np.uint64) + U(1)) * powers(_BASE, len(part))[: len(part)], out=sums[1:])
            hashes.append(mix((sums[ends] - sums[starts]) * powers(_INVERSE, len(part))[starts]))
            places.append(starts + a)
        a = b
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(pack.offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), pack.offsets)


def shingles(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles in order with their document offsets; a document with fewer
    words has its whole sequence as one, a document without words has none."""
    n = np.diff(offsets)
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    out_offsets = np.concatenate(([0], np.cumsum(counts)))
    at = np.repeat(offsets[:-1] - out_offsets[:-1], counts) + np.arange(out_offsets[-1])
    limit = np.repeat(offsets[1:], counts)
    h = np.full(len(at), 0x1234567, np.uint64)
    padded = np.append(words, U(0))
    for k in range(size):
        there = at + k < limit
        h = np.where(there, mix(h + padded[np.where(there, at + k, len(words))]), h)
    return h, out_offsets
