"""Suffix-array dedup by prefix-free parsing: removes text that an earlier document already has.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a document with a smaller id.

Parsing: a rolling hash over ``GRAM`` bytes is taken at every position; the trigger of a start position
is the smallest hash inside its ``LENGTH``-byte string, so it depends on that string alone.  A phrase is
a run of neighbouring starts with the same trigger, plus the ``LENGTH`` - 1 bytes that complete the last
start.  Neighbouring phrases overlap by those bytes: every ``LENGTH``-byte string of the corpus lies
inside exactly one phrase of its document, under a trigger that is the same wherever it occurs.

Order: equal strings can only meet under one trigger, so only triggers that occur in two documents matter
(round 1), a phrase that an earlier document also has is removed whole (round 2: dictionary of distinct
phrases with the smallest document of each), and only where different phrases share a trigger the strings
themselves are compared (round 3): a suffix array over the starts of those dictionary phrases, cut at depth
``LENGTH``, gives the runs of equal strings with their smallest document, and the parse carries each
dictionary verdict back to all places where the phrase stands.  As no comparison goes deeper than
``LENGTH``, which one phrase covers, suffixes of the parse need no ranks of their own.

Rounds run between packs of documents (``packs.py``): a phrase is sent once per pack however many copies
it holds, and a bucket gets a share of all triggers or strings, never one text's whole group.  Phrase and
string identity is a 64-bit hash under a further 32 bits or more of trigger hash.

Edge cases: a null text is an empty text; texts shorter than ``LENGTH`` keep every byte; rows with equal
ids do not remove one another's text; rows with a null id
come after all others and do not remove one another's text; an empty table gives an empty
result.  Matches never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .packs import PACK_BYTES, Pack, Rounds, U, bucket_bounds, group_edges, mix, to_slots

LENGTH = 50
GRAM = 24
#: Starts hashed at a time (keeps the arrays of a step in cache).
SEGMENT = 1 << 18
#: Starts of one phrase at most (only constant text comes near it).
MAX_RUN = 64


def _rolling(data: np.ndarray) -> np.ndarray:
    """32-bit hash of every GRAM bytes, built by doubling; mixed so that the smallest is a fair draw."""
    c = np.uint32
    h, size, power = data.astype(np.uint32) + c(1), 1, 0x9E3779B1
    powers, levels = {1: power}, {1: h}
    while size * 2 <= GRAM:
        h = h[:-size] * c(power) + h[size:]
        size, power = size * 2, power * power & 0xFFFFFFFF
        levels[size], powers[size] = h, power
    out, done = levels[size], size
    for part in (s for s in sorted(levels, reverse=True) if s < size):
        if GRAM - done >= part:
            tail = levels[part][done:]
            out = out[: len(tail)] * c(powers[part]) + tail
            done += part
    out = (out ^ (out >> c(15))) * c(0x2C1B3C6D)
    out = (out ^ (out >> c(12))) * c(0x297A2D39)
    return out ^ (out >> c(15))


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    rest = width - span
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def parse(pack: Pack) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of a pack: first start, end of the starts, 64-bit trigger hash (of the GRAM bytes)."""
    data, n = pack.data, len(pack.data)
    width = LENGTH - GRAM + 1
    ends = pack.offsets[1:]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, n - LENGTH + 1, SEGMENT):
        b = min(a + SEGMENT, n - LENGTH + 1)
        h = _rolling(data[a : b + LENGTH - 1])
        low = _smallest(h, width)
        ok = np.ones(b - a, bool)
        # starts whose string would pass the end of their document
        first, last = np.searchsorted(ends, a, "right"), np.searchsorted(ends, b + LENGTH, "right")
        for i in range(first, last):
            lo = max(int(ends[i]) - LENGTH + 1, int(pack.offsets[i])) - a
            ok[max(lo, 0) : max(int(ends[i]) - a, 0)] = False
        joined = ok[1:] & ok[:-1] & (low[1:] == low[:-1])
        starts = np.flatnonzero(ok & np.concatenate(([True], ~joined)))
        stops = np.flatnonzero(ok & np.concatenate((~joined, [True]))) + 1
        if not len(starts):
            continue
        if (stops - starts).max() > MAX_RUN:
            pieces = -(-(stops - starts) // MAX_RUN)
            k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            limits = np.repeat(stops, pieces)
            starts = np.repeat(starts, pieces) + k * MAX_RUN
            stops = np.minimum(starts + MAX_RUN, limits)
        at = starts + (h[starts[:, None] + np.arange(width)] == low[starts, None]).argmax(1)
        words = data[(a + at)[:, None] + np.arange(GRAM)].view(np.uint64)
        key = np.full(len(at), 0x51ED270B, np.uint64)
        for j in range(words.shape[1]):
            key = mix(key ^ words[:, j]) + U(j)
        out.append((starts + a, stops + a, key))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class _Parsed:
    """What every round needs of a pack, computed the same way each time."""

    def __init__(self, pack: Pack, buckets: int):
        self.pack, self.buckets = pack, buckets
        self.starts, self.stops, keys = parse(pack)
        self.doc = pack.ids[np.searchsorted(pack.offsets, self.starts, "right") - 1] if len(self.starts) else np.zeros(0, np.int64)
        self.slots = to_slots(keys, buckets)
        self.order = np.argsort(self.slots, kind="stable")
        s, d = self.slots[self.order], self.doc[self.order]
        self.first = group_edges(s)
        self.triggers = s[self.first]
        self.local = np.minimum.reduceat(d, self.first) != np.maximum.reduceat(d, self.first) if len(d) else np.zeros(0, bool)

    def repeated(self, bits: dict[int, bytes]) -> np.ndarray:
        """Which phrases (in order of position) have a trigger that stands in two documents."""
        seen = self.local.copy()
        for b, lo, hi in bucket_bounds(self.triggers, self.buckets):
            seen[lo:hi] |= np.unpackbits(np.frombuffer(bits[b], np.uint8), count=hi - lo).astype(bool)
        out = np.zeros(len(self.starts), bool)
        counts = np.diff(np.append(self.first, len(self.order)))
        out[self.order] = np.repeat(seen, counts)
        return out


class _Dictionary:
    """The pack's distinct phrases under repeated triggers, with the smallest document of each."""

    def __init__(self, p: _Parsed, repeated: np.ndarray):
        import xxhash

        self.at = np.flatnonzero(repeated)  # phrases by position
        raw, digest = p.pack.data.tobytes(), xxhash.xxh3_64_intdigest
        names = np.fromiter((digest(raw[s : e + LENGTH - 1]) for s, e in zip(p.starts[self.at].tolist(), p.stops[self.at].tolist(), strict=True)), np.uint64, len(self.at))
        slots, docs = p.slots[self.at], p.doc[self.at]
        order = np.lexsort((docs, names, slots))
        self.first = group_edges(slots[order], names[order])
        lead = order[self.first]
        self.lead = self.at[lead]  # the phrase's place in its smallest document
        self.slots, self.names, self.docs = slots[lead], names[lead], docs[lead]
        counts = np.diff(np.append(self.first, len(order)))
        self.entry = np.zeros(len(self.at), np.int64)  # dictionary entry of each place in ``at``
        self.entry[order] = np.repeat(np.arange(len(lead)), counts)


_ENTRY = np.dtype([("key", "<u4"), ("name", "<u8"), ("doc", "<i8")])
_STRING = np.dtype([("key", "<u8"), ("doc", "<i8")])
NEW, EARLIER, SHARED = 0, 1, 2


def _ask_triggers(buckets: int):
    def ask(pack: Pack, _: dict) -> Iterator[tuple[int, bytes]]:
        t = _Parsed(pack, buckets).triggers
        for b, lo, hi in bucket_bounds(t, buckets):
            yield b, (t[lo:hi] & U(0xFFFFFFFF)).astype("<u4").tobytes()

    return ask


def _resolve_triggers(packs: list[int], payloads: list[bytes]) -> list[bytes]:
    """A bit per key: whether another pack has it too."""
    arrays = [np.frombuffer(x, "<u4") for x in payloads]
    every = np.sort(np.concatenate(arrays))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    return [np.packbits(_member(a, twice)).tobytes() for a in arrays]


def _member(a: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(a), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, a), len(sorted_values) - 1)] == a


def _ask_phrases(buckets: int):
    def ask(pack: Pack, answers: dict) -> Iterator[tuple[int, bytes]]:
        p = _Parsed(pack, buckets)
        d = _Dictionary(p, p.repeated(answers.get(0, {})))
        out = np.empty(len(d.slots), _ENTRY)
        out["key"], out["name"], out["doc"] = d.slots & U(0xFFFFFFFF), d.names, d.docs
        for b, lo, hi in bucket_bounds(d.slots, buckets):
            yield b, out[lo:hi].tobytes()

    return ask


def _resolve_phrases(packs: list[int], payloads: list[bytes]) -> list[bytes]:
    """A code per phrase: EARLIER (a smaller document has it), SHARED (first, but other phrases share its trigger), NEW."""
    arrays = [np.frombuffer(x, _ENTRY) for x in payloads]
    every = np.concatenate(arrays)
    order = np.lexsort((every["doc"], every["name"], every["key"]))
    key, name, doc = every["key"][order], every["name"][order], every["doc"][order]
    phrase = group_edges(key, name)
    sizes = np.diff(np.append(phrase, len(key)))
    smallest = np.repeat(doc[phrase], sizes)
    trigger = group_edges(key[phrase])  # runs of phrases under one key
    several = np.repeat(np.repeat(np.diff(np.append(trigger, len(phrase))) > 1, np.diff(np.append(trigger, len(phrase)))), sizes)
    code = np.empty(len(key), np.uint8)
    code[order] = np.where(doc > smallest, EARLIER, np.where(several, SHARED, NEW))
    return _cut(code, [len(a) for a in arrays])


def _cut(values: np.ndarray, sizes: list[int]) -> list[bytes]:
    edges = np.concatenate(([0], np.cumsum(sizes)))
    return [values[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]


class _Strings:
    """Suffix array over the starts of the pack's SHARED dictionary phrases, cut at depth LENGTH."""

    def __init__(self, p: _Parsed, d: _Dictionary, answers: dict):
        self.code = np.zeros(len(d.slots), np.uint8)
        for b, lo, hi in bucket_bounds(d.slots, p.buckets):
            self.code[lo:hi] = np.frombuffer(answers[b], np.uint8)
        entries = np.flatnonzero(self.code == SHARED)
        lead = d.lead[entries]
        sizes = p.stops[lead] - p.starts[lead]
        self.begin = np.concatenate(([0], np.cumsum(sizes)))
        self.slot_of = np.full(len(d.slots), -1, np.int64)
        self.slot_of[entries] = np.arange(len(entries))
        total = int(self.begin[-1])
        inner = np.arange(total) - np.repeat(self.begin[:-1], sizes)
        place = np.repeat(p.starts[lead], sizes) + inner
        doc = np.repeat(d.docs[entries], sizes)
        strings = np.empty((total, LENGTH), np.uint8)
        for a in range(0, total, SEGMENT):
            strings[a : a + SEGMENT] = p.pack.data[place[a : a + SEGMENT, None] + np.arange(LENGTH)]
        # equal strings become neighbours; documents are in order inside a run
        text = strings.reshape(-1).view(f"S{LENGTH}") if total else np.zeros(0, f"S{LENGTH}")
        order = np.lexsort((doc, text))
        first = group_edges(text[order])
        sizes = np.diff(np.append(first, total))
        self.run = np.zeros(total, np.int64)
        self.run[order] = np.repeat(np.arange(len(first)), sizes)
        self.doc, self.smallest = doc, doc[order][first]
        padded = np.zeros((len(first), -(-LENGTH // 8) * 8), np.uint8)
        padded[:, :LENGTH] = strings[order[first]]
        words = padded.view(np.uint64)
        name, check = np.zeros(len(first), np.uint64), np.full(len(first), 0x2545F491, np.uint64)
        for j in range(words.shape[1]):
            name = mix(name ^ words[:, j]) + U(j)
            check = mix(check + words[:, j] * U(0x9E3779B97F4A7C15))
        bucket = check % U(p.buckets)
        self.sorted = np.lexsort((name, bucket))  # runs in the order they are asked
        self.bucket, self.name = bucket[self.sorted], name[self.sorted]

    def bounds(self, buckets: int) -> Iterator[tuple[int, int, int]]:
        edges = np.searchsorted(self.bucket, np.arange(buckets + 1, dtype=np.uint64))
        for b in np.flatnonzero(edges[1:] > edges[:-1]):
            yield int(b), int(edges[b]), int(edges[b + 1])


def _ask_strings(buckets: int):
    def ask(pack: Pack, answers: dict) -> Iterator[tuple[int, bytes]]:
        p = _Parsed(pack, buckets)
        d = _Dictionary(p, p.repeated(answers.get(0, {})))
        s = _Strings(p, d, answers.get(1, {}))
        out = np.empty(len(s.name), _STRING)
        out["key"], out["doc"] = s.name, s.smallest[s.sorted]
        for b, lo, hi in s.bounds(buckets):
            yield b, out[lo:hi].tobytes()

    return ask


def _resolve_strings(packs: list[int], payloads: list[bytes]) -> list[bytes]:
    """A bit per string: whether another pack has it in a smaller document."""
    arrays = [np.frombuffer(x, _STRING) for x in payloads]
    every = np.concatenate(arrays)
    order = np.lexsort((every["doc"], every["key"]))
    key, doc = every["key"][order], every["doc"][order]
    first = group_edges(key)
    earlier = np.empty(len(key), bool)
    earlier[order] = doc > np.repeat(doc[first], np.diff(np.append(first, len(key))))
    edges = np.concatenate(([0], np.cumsum([len(a) for a in arrays])))
    return [np.packbits(earlier[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]


def covered(pack: Pack, answers: dict, buckets: int) -> np.ndarray:
    """Removed bytes of a pack, as a mask."""
    p = _Parsed(pack, buckets)
    d = _Dictionary(p, p.repeated(answers.get(0, {})))
    s = _Strings(p, d, answers.get(1, {}))
    earlier = np.zeros(len(s.smallest), bool)  # by run
    for b, lo, hi in s.bounds(buckets):
        earlier[s.sorted[lo:hi]] = np.unpackbits(np.frombuffer(answers[2][b], np.uint8), count=hi - lo).astype(bool)
    # a start goes if another pack has its string in a smaller document, or this pack has
    gone = earlier[s.run] | (s.doc > s.smallest[s.run])
    step = np.zeros(len(pack.data) + 1, np.int32)
    docs = p.doc[d.at]
    whole = (s.code[d.entry] == EARLIER) | (docs > d.docs[d.entry])
    at = d.at[whole]
    np.add.at(step, p.starts[at], 1)
    np.add.at(step, p.stops[at] + LENGTH - 1, -1)
    # places of SHARED phrases in their smallest document: start by start
    part = np.flatnonzero(~whole & (s.slot_of[d.entry] >= 0))
    if len(part):
        k, q = s.slot_of[d.entry[part]], d.at[part]
        sizes = p.stops[q] - p.starts[q]
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        hit = gone[np.repeat(s.begin[k], sizes) + inner]
        places = (np.repeat(p.starts[q], sizes) + inner)[hit]
        np.add.at(step, places, 1)
        np.add.at(step, places + LENGTH, -1)
    return np.cumsum(step[:-1]) > 0


def _results(buckets: int, with_text: bool):
    def work(pack: Pack, answers: dict) -> Iterator[tuple]:
        gone = covered(pack, answers, buckets)
        for i in range(len(pack.ids)):
            lo, hi = pack.offsets[i], pack.offsets[i + 1]
            text, out = pack.data[lo:hi], gone[lo:hi]
            kept = text[~out].tobytes()
            edges = np.flatnonzero(np.diff(np.concatenate(([False], out, [False]))))
            row = (int(pack.ids[i]), int(hi - lo), int(out.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest())
            if with_text:
                # decoded piece by piece: halves of two characters never make a new one
                pieces = np.split(text, edges)[::2]
                row += (hashlib.sha256(text.tobytes()).hexdigest(), edges.tolist(), "".join(p.tobytes().decode("utf-8", "ignore") for p in pieces))
            yield row

    return work


DIGEST_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
TEXT_SCHEMA = DIGEST_SCHEMA + ", text_sha256 string, span_edges array<long>, kept_text string"


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """Per document: sizes, spans and digest of what stays; with ``with_text`` also the digest of the input
    text, the byte edges [from, to, from, to, ...] of the removed spans, and the text that stays (a character that
    a cut divides goes whole)."""
    rounds = Rounds.over(docs, id_col, text_col, pack_bytes)
    n = rounds.buckets
    rounds.round(_ask_triggers(n), _resolve_triggers)
    rounds.round(_ask_phrases(n), _resolve_phrases)
    rounds.round(_ask_strings(n), _resolve_strings)
    return rounds.per_pack(_results(n, with_text), TEXT_SCHEMA if with_text else DIGEST_SCHEMA).withColumn("doc_id", rounds.known("doc_id"))
