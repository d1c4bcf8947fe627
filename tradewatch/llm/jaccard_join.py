"""N-gram Jaccard join by PartEnum signatures, and the components of its links.

A document's features are its distinct word shingles.  Two sets of sizes a <= b with Jaccard >= t differ in at
most (a + b)(1 - t)/(1 + t) features, and b <= a / t.  Sizes are cut into bands so that linked sets lie in the
same or in neighbouring bands; a set signs for its own band and the next one.  For a band with largest size u
and k = 2u(1 - t)/(1 + t) the feature domain is cut into k // (s + 1) + 1 groups of 2s + 1 partitions: k differences
leave some group with at most s, which touch at most s of its partitions, so the two sets agree on the other s + 1.
Each choice of s + 1 partitions of each group, with the set's features inside it, is one signature:
sufficiently similar sets share at least one (s = 1 here: three signatures a group).

Signatures without any feature say nothing, but unlike sets share them.  So there are some groups more than that, e =
max(2, an eighth): sufficiently similar sets then agree so in e + 1 groups, and a set in which at most e groups have a
signature without features leaves all such signatures out; one of its e + 1 groups still has a shared one.  The other
sets (few and small ones) keep all theirs.

Checking stays linear in the copies of a group, and no feature set travels before a candidate pair has passed a test
that loses nothing.  For every signature one holder is announced to the packs of the others (round 1): its size, a
128-bit name of its set, and a parity sketch, in which every feature flips one of about as many bits as the set has
features.  Two sketches never differ in more bits than the sets differ in features, so a pair with more differing bits
than a link allows, or with incompatible sizes, is none; equal names are a link at once.  Of what is left one pair of
each two names is verified exactly: the one set is sent to the pack of the other, once for all its pairs there.  After
components, only shared signatures whose holders still lie in different components matter.  Their holders are compared
where the signature lives (round 2), each sent there once for a signature, of equal sets of a component one: by size and
by the chain of the signature, 16 parities for its group and for each of the seven groups after it in a ring.  Only
holders that pass are announced to each other's packs, each pair in one direction (never from the commonest component).

No link is lost by the chains: let group j of G = k // 2 + 1 + e have d_j differences, k in all, so that the steps 2 - d_j
sum up to 2G - k > 2e.  Around the ring, a group is good if the sums of the steps from it on are all positive, that is, if
it and the l - 1 groups after it have at most 2l - 1 differences for every l.  The least sum still to come rises at good
groups only, by at most 2 at each and by 2G - k in a round, so e + 1 groups at least are good.  A good group has at most
one difference, so its signatures are shared as above, and parities differ no more than features.  Two linked sets
thus share a signature whose chains pass, so either they are in one component already or they meet in round 2; pairs
inside a component need no check.

Edge cases: a null or empty text, or one without words, has an empty set and links with nothing; fewer words than
a shingle: the whole sequence is one feature; rows with equal ids are one node; a row with a null id is a node of its
own with its result row, and a component has a null id if no row of it has one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize_counted
from .components import components
from .packs import REPLY_SCHEMA, Pack, Rounds, U, bucket_bounds, group_edges, mix, open_pack, release, squeeze, to_slots, unsqueeze
from .words import shingles, word_hashes

WORDS = 3
PERCENT = 90
#: Larger packs than elsewhere: a holder is announced once to each pack that shares a signature with it.
PACK_BYTES = 8 << 20
#: Partitions of a group that may differ.
SPARE = 1
#: Groups in the chain of a signature, 16 bits each.
CHAIN = 8
#: Pairs of holders compared at a time.
PAIRS = 1 << 20
#: kind SKETCH: a set announced to a pack (document, its pack and row, size, name, sketch); kind ROWS: the pack's own
#: rows that hold shared signatures; kind FIRST: those of its own rows that are to be checked against the others.
SHIP_SCHEMA = "pack_id long, kind int, doc long, source long, row long, size long, x long, s long, payload binary"
SKETCH, ROWS, FIRST = 0, 1, 2
#: kind LINK: (id, id); kind SIZE: (id, set size); kind HOLDER: (id, pack, row); kind PAIR: two sets that may be linked,
#: each with its document, pack, row and name.
FOUND_SCHEMA = "kind int, a long, b long, c long, pa long, ra long, xa long, sa long, pb long, rb long, xb long, sb long"
LINK, SIZE, HOLDER, PAIR = 0, 1, 2, 3
#: Rows of FOUND_SCHEMA end with these where nothing is to be said.
NOTHING = (0,) * 8
#: A whole set sent to a pack (features), or one of the pack's own rows that it is to be checked with (features null).
CHECK_SCHEMA = "pack_id long, source long, row long, doc long, own long, id long, features binary"


def bands(largest: int, percent: int) -> list[int]:
    """Smallest size of every band up to the one after ``largest``: sets that can link differ by one band at most."""
    edges = [1]
    while edges[-1] <= largest or len(edges) < 3:
        edges.append(edges[-1] * 100 // percent + 1)
    edges.append(edges[-1] * 100 // percent + 1)
    edges.append(edges[-1] * 100 // percent + 1)
    return edges


def some_rows(pack: Pack, rows: np.ndarray) -> Pack:
    """The pack with these documents only."""
    texts = [pack.text(i) for i in rows.tolist()]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return Pack(pack.pack_id, pack.ids[rows], offsets, np.concatenate(texts) if texts else np.zeros(0, np.uint8))


class Sets:
    """The distinct feature sets of a pack, or of some of its rows."""

    def __init__(self, pack: Pack, words: int, rows: np.ndarray | None = None):
        if rows is not None:
            pack = some_rows(pack, rows)
        hashes, offsets = shingles(*word_hashes(pack), words)
        self.sizes = np.zeros(len(pack.ids), np.int64)
        found: dict[tuple[int, int, int], int] = {}
        self.features: list[np.ndarray] = []
        lead_rows: list[int] = []  # row of the smallest id that has the set
        names: list[tuple[int, int]] = []
        self.copies: list[tuple[int, int]] = []  # (lead id, id) of documents with equal sets
        for i in np.argsort(pack.ids, kind="stable").tolist():
            v = np.sort(hashes[offsets[i] : offsets[i + 1]])
            if len(v) > 1:
                v = v[np.append(True, v[1:] != v[:-1])]
            self.sizes[i] = len(v)
            if len(v):
                name = (len(v), int(np.bitwise_xor.reduce(v)), int(v.sum()))
                at = found.setdefault(name, len(self.features))
                if at == len(self.features):
                    self.features.append(v)
                    lead_rows.append(i)
                    names.append(name[1:])
                elif pack.ids[lead_rows[at]] != pack.ids[i]:
                    self.copies.append((int(pack.ids[lead_rows[at]]), int(pack.ids[i])))
        self.lead = pack.ids[lead_rows] if lead_rows else np.zeros(0, np.int64)
        self.rows = np.array(lead_rows, np.int64) if rows is None else rows[lead_rows] if lead_rows else np.zeros(0, np.int64)
        self.counts = np.array([len(v) for v in self.features], np.int64)
        self.names = np.array(names, np.uint64).reshape(-1, 2).view(np.int64)

    def only(self, rows: np.ndarray) -> Sets:
        """The sets that stand at these rows."""
        out = Sets.__new__(Sets)
        at = np.flatnonzero(np.isin(self.rows, rows)).tolist()
        out.features, out.lead, out.rows, out.counts = [self.features[i] for i in at], self.lead[at], self.rows[at], self.counts[at]
        out.names = self.names[at]
        return out


def signatures(v: np.ndarray, edges: list[int], percent: int, chained: list[np.ndarray] | None = None) -> np.ndarray:
    """Signatures of a sorted feature set for its own band and the next one; with ``chained`` their chains go there."""
    band = int(np.searchsorted(edges, len(v), "right")) - 1
    out = []
    # the features are mixed hashes, so the sum of a partition's features stands for their set
    sums = np.empty(len(v) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(v, out=sums[1:])
    for instance in (band, band + 1):
        limits, tags, more = _instance(instance, 2 * (edges[instance + 1] - 1) * (100 - percent) // (100 + percent))
        at = np.searchsorted(v, limits)
        s = np.diff(sums[np.append(at, len(v))]).reshape(-1, 2 * SPARE + 1)
        if len(tags) == 1:
            out.append(s.sum(1) ^ tags)
            if chained is not None:
                chained.append(np.zeros((1, CHAIN // 4), np.uint64))
            continue
        signs = s[:, _subsets()].sum(2).reshape(-1) ^ tags
        empty = np.diff(np.append(at, len(v))).reshape(-1, 2 * SPARE + 1)[:, _subsets()].sum(2) == 0
        stay = ~empty.reshape(-1) if empty.any(1).sum() <= more else np.ones(len(signs), bool)
        out.append(signs[stay])
        if chained is not None:
            chained.append(np.repeat(_chains(v, np.append(at[:: 2 * SPARE + 1], len(v))), len(_subsets()), axis=0)[stay])
    return mix(np.concatenate(out))


def _chains(v: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """For each group of a sorted set (``limits``: where they begin, and the end) the parities of it and those after it."""
    groups = len(limits) - 1
    cells = np.repeat(np.arange(groups), np.diff(limits)) << 4 | (v & U(15)).astype(np.int64)
    odd = (np.bincount(cells, minlength=16 * groups) & 1).astype(np.uint8)
    ring = np.packbits(odd, bitorder="little").view("<u2")
    out = np.zeros((groups, CHAIN), "<u2")
    for k in range(min(CHAIN, groups)):
        out[:, k] = np.roll(ring, -k)
    return out.view("<u8")


def chains_agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether chains differ in at most 2l - 1 parities of their first l groups, for every l."""
    differ = a ^ b
    out = np.bitwise_count(differ).sum(1) < 2 * CHAIN
    each = np.bitwise_count(differ[out].view("<u2")).cumsum(1)
    out[out] = (each < 2 * np.arange(1, CHAIN + 1)).all(1)
    return out


@lru_cache(maxsize=1)
def _subsets() -> np.ndarray:
    """The choices of SPARE + 1 partitions out of 2 SPARE + 1."""
    return np.array(list(combinations(range(2 * SPARE + 1), SPARE + 1)))


@lru_cache(maxsize=512)
def _instance(instance: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Where the partitions of a band begin, a random tag for each of its signatures, and how many groups are to spare.

    A feature's partition is the range its hash falls in, so partitions are runs of a sorted set.
    """
    groups = k // (SPARE + 1) + 1
    more = max(2, groups // 8) if k else 0
    parts = (2 * SPARE + 1) * (groups + more)
    limits = np.arange(parts, dtype=np.uint64) * U((1 << 64) // parts)
    n = len(_subsets()) * (groups + more) if k else 1
    return limits, mix((U(instance) << U(34)) + np.arange(n, dtype=np.uint64) + U(0x5851F42D)), more


class Keys:
    """(slot, set) of all signatures of a pack, sorted."""

    def __init__(self, sets: Sets, percent: int, buckets: int, chained: bool = False):
        edges = bands(int(sets.counts.max()) if len(sets.counts) else 1, percent)
        chains: list[np.ndarray] | None = [] if chained else None
        each = [signatures(v, edges, percent, chains) for v in sets.features]
        slots = to_slots(np.concatenate(each), buckets) if each else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(each)), [len(x) for x in each]).astype(np.int64)
        order = np.argsort(slots, kind="stable")
        self.slots, self.owner = slots[order], owner[order]
        self.chains = np.concatenate(chains)[order] if chains else np.zeros((0, CHAIN // 4), np.uint64)
        self.first = group_edges(self.slots)
        self.end = np.append(self.first[1:], len(self.slots))
        self.keys = self.slots[self.first]


def sketch(v: np.ndarray) -> np.ndarray:
    """Parity sketch of a feature set: as many bits as features, rounded up to a power of two (64 at least)."""
    bits = max(64, 1 << (len(v) - 1).bit_length())
    odd = np.bincount((v & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def fold(sketches: np.ndarray) -> np.ndarray:
    """The sketches of half as many bits (a bit's place modulo half the length)."""
    half = sketches.shape[-1] // 2
    return sketches[..., :half] ^ sketches[..., half:]


class Sketched:
    """Sketches of a pack's sets by length, and the sets that may be linked with a given one."""

    def __init__(self, sets: Sets, percent: int):
        self.sets, self.percent = sets, percent
        by: dict[int, list[int]] = {}
        each = [sketch(v) for v in sets.features]
        for i in np.argsort(sets.counts, kind="stable").tolist():
            by.setdefault(len(each[i]), []).append(i)
        #: words of a sketch: (sets by size, their sizes, sketches, sketches folded once)
        self.by = {}
        for words, at in by.items():
            m = np.stack([each[i] for i in at])
            self.by[words] = (np.array(at), sets.counts[at], m, fold(m) if words > 1 else m)

    def like(self, size: int, words: np.ndarray) -> np.ndarray:
        """Sets whose size and sketch allow a link with a set of this size and sketch (linked ones are all among them)."""
        out, n, p = [], len(words), self.percent
        for mine, theirs, at_fold in ((n, words, 2), (2 * n, words, 3), (n // 2, None, 2)):
            if mine not in self.by or (mine == 0):
                continue
            at, sizes, *tables = self.by[mine]
            lo, hi = np.searchsorted(sizes, -(-size * p // 100), "left"), np.searchsorted(sizes, size * 100 // p, "right")
            if lo < hi:
                other = fold(words) if theirs is None else theirs
                differ = np.bitwise_count(tables[at_fold - 2][lo:hi] ^ other).sum(1, dtype=np.int64)
                out.append(at[lo:hi][differ * (100 + p) <= (size + sizes[lo:hi]) * (100 - p)])
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def linked(v: np.ndarray, w: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough, exactly."""
    common = len(np.intersect1d(v, w, assume_unique=True))
    return 100 * common >= percent * (len(v) + len(w) - common) and common > 0


def _orders(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(position, number of targets, targets) of a reply, and how many bytes they take."""
    n, m = np.frombuffer(payload, "<i8", 2)
    at = 16
    position = np.frombuffer(payload, "<i4", n, at)
    many = np.frombuffer(payload, "<i4", n, at + 4 * n)
    targets = np.frombuffer(payload, "<i8", m, at + 8 * n)
    return position, many, targets, at + 8 * n + 8 * m


def _order_bytes(orders: list[tuple[int, np.ndarray]]) -> bytes:
    targets = np.concatenate([t for _, t in orders]) if orders else np.zeros(0, np.int64)
    head = np.array([len(orders), len(targets)], "<i8").tobytes()
    return head + np.array([p for p, _ in orders], "<i4").tobytes() + np.array([len(t) for _, t in orders], "<i4").tobytes() + targets.astype("<i8").tobytes()


def _ask_keys(words: int, percent: int, buckets: int):
    def ask(pack: Pack, _: dict) -> Iterator[tuple[int, bytes]]:
        k = Keys(Sets(pack, words), percent, buckets).keys
        for b, lo, hi in bucket_bounds(k, buckets):
            yield b, squeeze(np.diff((k[lo:hi] & U(0xFFFFFFFF)).astype("<u4"), prepend=np.uint32(0)))

    return ask


def _resolve_keys(packs: list[int], payloads: list[bytes]) -> list[bytes]:
    """Which keys other packs hold too (bits), and for their first pack: to which packs to send a holder."""
    arrays = [np.cumsum(unsqueeze(x)[0], dtype="<u4") for x in payloads]
    key = np.concatenate(arrays)
    pack = np.repeat(np.arange(len(arrays)), [len(a) for a in arrays])
    position = np.concatenate([np.arange(len(a)) for a in arrays])
    order = np.argsort(key, kind="stable")  # packs stay in order inside a key
    key, pack, position = key[order], pack[order], position[order]
    first = group_edges(key)
    size = np.diff(np.append(first, len(key)))
    shared = [np.zeros(len(a), bool) for a in arrays]
    orders: list[list[tuple[int, np.ndarray]]] = [[] for _ in arrays]
    ids = np.array(packs, np.int64)
    for f, n in zip(first[size > 1].tolist(), size[size > 1].tolist(), strict=True):
        members = pack[f : f + n]
        orders[members[0]].append((int(position[f]), ids[members[1:]]))
        for p, q in zip(members.tolist(), position[f : f + n].tolist(), strict=True):
            shared[p][q] = True
    return [_order_bytes(o) + np.packbits(s).tobytes() for o, s in zip(orders, shared, strict=True)]


def _shared(keys: Keys, answers: dict[int, bytes], buckets: int) -> np.ndarray:
    """Which keys have a holder in another pack, or two in this one."""
    out = (keys.end - keys.first) > 1
    for b, lo, hi in bucket_bounds(keys.keys, buckets):
        bits = answers[b][_orders(answers[b])[3] :]
        out[lo:hi] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
    return out


def _announce(pack: Pack, sets: Sets, wanted: set[tuple[int, int]]) -> Iterator[tuple]:
    made: dict[int, bytes] = {}
    for target, i in sorted(wanted):
        if i not in made:
            made[i] = sketch(sets.features[i]).tobytes()
        x, s = sets.names[i].tolist()
        yield target, SKETCH, int(sets.lead[i]), pack.pack_id, int(sets.rows[i]), int(sets.counts[i]), x, s, made[i]


def _own(pack: Pack, kind: int, rows: np.ndarray) -> tuple:
    return pack.pack_id, kind, 0, 0, 0, 0, 0, 0, np.sort(rows).tobytes()


def _ship_first(words: int, percent: int, buckets: int):
    def work(pack: Pack, answers: dict) -> Iterator[tuple]:
        sets = Sets(pack, words)
        keys = Keys(sets, percent, buckets)
        wanted: set[tuple[int, int]] = set()
        for b, lo, _ in bucket_bounds(keys.keys, buckets):
            position, many, targets, _n = _orders(answers[0][b])
            holder = keys.owner[keys.first[lo + position]]
            wanted.update(zip(targets.tolist(), np.repeat(holder, many).tolist(), strict=True))
        yield from _announce(pack, sets, wanted)
        # signatures with several holders in this pack: their first one is checked here
        inner = np.unique(keys.owner[keys.first[(keys.end - keys.first) > 1]])
        yield _own(pack, FIRST, sets.rows[inner])
        shared = np.repeat(_shared(keys, answers.get(0, {}), buckets), keys.end - keys.first)
        yield _own(pack, ROWS, sets.rows[np.unique(keys.owner[shared])])

    return work


def _mentioned(right: pd.DataFrame, kind: int) -> np.ndarray:
    """The pack's own rows of a kind."""
    rows = [np.frombuffer(x, np.int64) for x in right["payload"][right["kind"] == kind]]
    return rows[0] if rows else np.zeros(0, np.int64)


def _candidates(pack: Pack, sets: Sets, right: pd.DataFrame, inner: Sets | None, percent: int) -> Iterator[tuple]:
    """Links with sets that were announced here (where they are certain), pairs to be verified, and links inside the pack."""
    table = Sketched(sets, percent)
    told = right[right["kind"] == SKETCH].sort_values(["source", "row"])
    columns = [told[c].tolist() for c in ("doc", "source", "row", "size", "x", "s", "payload")]
    for doc, source, row, size, x, s, payload in zip(*columns, strict=True):
        for i in table.like(size, np.frombuffer(payload, np.uint64)).tolist():
            y, t = sets.names[i].tolist()
            if (x, s) == (y, t) and size == sets.counts[i]:
                if sets.lead[i] != doc:
                    yield LINK, doc, int(sets.lead[i]), 0, *NOTHING
            elif source != pack.pack_id:
                yield PAIR, doc, int(sets.lead[i]), 0, source, row, x, s, pack.pack_id, int(sets.rows[i]), y, t
            elif sets.lead[i] != doc and linked(sets.features[int(np.flatnonzero(sets.rows == row)[0])], sets.features[i], percent):
                yield LINK, doc, int(sets.lead[i]), 0, *NOTHING
    for k in range(len(inner.features) if inner is not None else 0):
        for i in table.like(int(inner.counts[k]), sketch(inner.features[k])).tolist():
            if sets.lead[i] != inner.lead[k] and linked(inner.features[k], sets.features[i], percent):
                yield LINK, int(inner.lead[k]), int(sets.lead[i]), 0, *NOTHING


def _found(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in FOUND_SCHEMA.split(", ")])


def _check_first(words: int, percent: int):
    """Sizes of all sets, links of equal ones, the holders of shared signatures, and candidates of the sets announced to a pack."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        for row in left.itertuples(index=False):
            pack = open_pack(*row[:4])
            sets = Sets(pack, words)
            own = _mentioned(right, ROWS)
            rows.extend((SIZE, i, n, 0, *NOTHING) for i, n in zip(pack.ids.tolist(), sets.sizes.tolist(), strict=True))
            rows.extend((LINK, a, b, 0, *NOTHING) for a, b in sets.copies)
            rows.extend((HOLDER, int(pack.ids[i]), pack.pack_id, i, *NOTHING) for i in own.tolist())
            rows.extend(_candidates(pack, sets.only(own), right, sets.only(_mentioned(right, FIRST)), percent))
        return _found(rows)

    return run


def _check_rest(words: int, percent: int):
    """Candidates of the sets announced to a pack."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if (right["kind"] == SKETCH).any():
            for row in left.itertuples(index=False):
                pack = open_pack(*row[:4])
                rows.extend(_candidates(pack, Sets(pack, words, _mentioned(right, ROWS)), right, None, percent))
        return _found(rows)

    return run


def _features(pack: Pack, rows: np.ndarray, words: int) -> dict[int, np.ndarray]:
    """The sorted feature sets of some rows."""
    hashes, offsets = shingles(*word_hashes(some_rows(pack, rows)), words)
    return {r: np.unique(hashes[offsets[i] : offsets[i + 1]]) for i, r in enumerate(rows.tolist())}


def _send_sets(words: int):
    """The sets that were asked for (rows of CHECK_SCHEMA)."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(right):
            for row in left.itertuples(index=False):
                pack = open_pack(*row[:4])
                sets = _features(pack, np.unique(right["row"].to_numpy(np.int64)), words)
                for target, r, doc in sorted(zip(right["target"].tolist(), right["row"].tolist(), right["doc"].tolist(), strict=True)):
                    rows.append((target, pack.pack_id, r, doc, -1, 0, sets[r].tobytes()))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in CHECK_SCHEMA.split(", ")])

    return run


def _verify_sets(words: int, percent: int):
    """Links (a, b) of the sets that were sent with the pack's own rows."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(right):
            sent = right["own"] < 0
            sets = {(p, r): np.frombuffer(f, np.uint64) for p, r, f in zip(right["source"][sent].tolist(), right["row"][sent].tolist(), right["features"][sent], strict=True)}
            asked = right[~sent]
            for row in left.itertuples(index=False):
                mine = _features(open_pack(*row[:4]), np.unique(asked["own"].to_numpy(np.int64)), words)
                for p, r, doc, own, i in zip(*[asked[c].tolist() for c in ("source", "row", "doc", "own", "id")], strict=True):
                    if linked(sets[p, r], mine[own], percent):
                        rows.append((doc, i))
        return pd.DataFrame(rows, columns=["a", "b"])

    return run


class Labelled:
    """Shared signatures of the pack's sets with their components: distinct (key, component) in order."""

    def __init__(self, pack: Pack, words: int, percent: int, buckets: int, answers: dict, chained: bool = False):
        known = [np.frombuffer(x, "<i8").reshape(-1, 2) for x in answers.get(1, {}).values()]
        pairs = np.concatenate(known) if known else np.zeros((0, 2), np.int64)
        self.sets = Sets(pack, words)
        keys = Keys(self.sets, percent, buckets, chained)
        shared = np.repeat(_shared(keys, answers.get(0, {}), buckets), keys.end - keys.first)
        slots, owner = keys.slots[shared], keys.owner[shared]
        # every set with a shared signature has a label
        component = pairs[np.searchsorted(pairs[:, 0], self.sets.rows[owner]), 1] if len(owner) else np.zeros(0, np.int64)
        order = np.lexsort((owner, component, slots))
        self.owner = owner[order]
        self.chains = keys.chains[shared][order] if chained else keys.chains
        slots, component = slots[order], component[order]
        self.first = group_edges(slots, component)
        self.end = np.append(self.first[1:], len(slots))
        self.slots, self.component = slots[self.first], component[self.first]


def _ask_components(words: int, percent: int, buckets: int):
    def ask(pack: Pack, answers: dict) -> Iterator[tuple[int, bytes]]:
        q = Labelled(pack, words, percent, buckets, answers)
        for b, lo, hi in bucket_bounds(q.slots, buckets):
            yield b, squeeze((q.slots[lo:hi] & U(0xFFFFFFFF)).astype("<u4"), q.component[lo:hi].astype("<i8"))

    return ask


def _resolve_components(packs: list[int], payloads: list[bytes]) -> list[bytes]:
    """Which keys are held in several components (bits)."""
    arrays = [unsqueeze(x) for x in payloads]
    key, component = np.concatenate([a[0] for a in arrays]), np.concatenate([a[1] for a in arrays])
    order = np.argsort(key, kind="stable")
    first = group_edges(key[order])
    several = np.zeros(len(key), bool)
    if len(key):
        mixed = np.minimum.reduceat(component[order], first) != np.maximum.reduceat(component[order], first)
        several[order] = np.repeat(mixed, np.diff(np.append(first, len(key))))
    return [np.packbits(x).tobytes() for x in np.split(several, np.cumsum([len(a[0]) for a in arrays])[:-1])]


def _ask_holders(words: int, percent: int, buckets: int):
    """The holders of signatures that are held in several components: key, component, size, name, row and chain."""

    def ask(pack: Pack, answers: dict) -> Iterator[tuple[int, bytes]]:
        q = Labelled(pack, words, percent, buckets, answers, chained=True)
        for b, lo, hi in bucket_bounds(q.slots, buckets):
            several = np.unpackbits(np.frombuffer(answers[2][b], np.uint8), count=hi - lo).astype(bool)
            many = (q.end - q.first)[lo:hi]
            at = int(q.first[lo]) + np.flatnonzero(np.repeat(several, many))
            if len(at):
                key, component = np.repeat(q.slots[lo:hi][several], many[several]), np.repeat(q.component[lo:hi][several], many[several])
                own = q.owner[at]
                yield b, squeeze(
                    (key & U(0xFFFFFFFF)).astype("<u4"), component.astype("<i8"), q.sets.counts[own].astype("<u4"),
                    q.sets.names[own, 0].astype("<i8"), q.sets.rows[own].astype("<i4"), *q.chains[at].astype("<u8").T,
                )

    return ask


def _outside_first(key: np.ndarray, component: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order in which the holders outside a key's commonest component come first, and which ones these are (in that order)."""
    by = np.lexsort((component, key))
    first = group_edges(key[by], component[by])
    size = np.diff(np.append(first, len(key)))
    runs = np.lexsort((-size, key[by][first]))
    commonest = np.zeros(len(first), bool)
    commonest[runs[group_edges(key[by][first][runs])]] = True
    outside = np.empty(len(key), bool)
    outside[by] = ~np.repeat(commonest, size)
    order = np.lexsort((~outside, key))  # stable
    return order, outside[order]


def _resolve_holders(percent: int):
    """Of two holders of a key in different components whose sizes and chains allow a link, one goes to the other's pack.

    That is the one outside the commonest component, of two such ones the one in the later pack.  A pack is told which of
    its rows go where, and which rows are of such a pair.
    """

    def resolve(packs: list[int], payloads: list[bytes]) -> list[bytes]:
        arrays = [unsqueeze(x) for x in payloads]
        pack = np.repeat(np.arange(len(arrays)), [len(a[0]) for a in arrays])
        key, component, size, name, row = (np.concatenate([a[k] for a in arrays]) for k in range(5))
        chain = np.stack([np.concatenate([a[k] for a in arrays]) for k in range(5, 5 + CHAIN // 4)], 1)
        # of equal sets in one component, one stands for all: the same one at all keys
        order = np.lexsort((row, pack, *chain.T, size, name, component, key))
        order = order[group_edges(*(x[order] for x in (key, component, name, size, *chain.T)))]
        order = order[np.lexsort((row[order], pack[order], key[order]))]
        by, outside = _outside_first(key[order], component[order])
        order = order[by]
        key, component, size, row, chain, pack = key[order], component[order], size[order].astype(np.int64), row[order], chain[order], pack[order]
        first = group_edges(key)
        end = np.repeat(np.append(first[1:], len(key)), np.diff(np.append(first, len(key))))
        # every holder outside the commonest component with all that come after it
        holders = np.flatnonzero(outside)
        upto = np.concatenate(([0], np.cumsum(end[holders] - holders - 1)))
        moves, pairs = [np.zeros((0, 3), np.int64)], [np.zeros((0, 2), np.int64)]
        lo = 0
        while lo < len(holders):
            hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + PAIRS, "right")) - 1)
            many = np.diff(upto[lo : hi + 1])
            i = np.repeat(holders[lo:hi], many)
            j = i + 1 + np.arange(len(i)) - np.repeat(upto[lo:hi] - upto[lo], many)
            near = (component[i] != component[j]) & (100 * size[i] >= percent * size[j]) & (100 * size[j] >= percent * size[i])
            i, j = i[near], j[near]
            agree = chains_agree(chain[i], chain[j])
            i, j = i[agree], j[agree]
            agree = np.bitwise_count(chain[i] ^ chain[j]).sum(1, dtype=np.int64) * (100 + percent) <= (size[i] + size[j]) * (100 - percent)
            i, j = i[agree], j[agree]
            goes, stays = np.where(outside[j], j, i), np.where(outside[j], i, j)
            moves.append(np.unique(np.stack((pack[goes], row[goes], pack[stays]), 1), axis=0))
            pairs.append(np.unique(np.stack((pack[np.append(i, j)], row[np.append(i, j)]), 1), axis=0))
            lo = hi
        move, pair = np.unique(np.concatenate(moves), axis=0), np.unique(np.concatenate(pairs), axis=0)
        ids, out = np.array(packs, np.int64), []
        for p in range(len(arrays)):
            _, at, to = move[slice(*np.searchsorted(move[:, 0], [p, p + 1]))].T
            edges = group_edges(at)
            targets = np.split(ids[to], edges[1:]) if len(at) else []
            rows = pair[slice(*np.searchsorted(pair[:, 0], [p, p + 1])), 1]
            out.append(_order_bytes(list(zip(at[edges].tolist(), targets, strict=True))) + rows.astype("<i4").tobytes())
        return out

    return resolve


def _ship_rest(words: int, percent: int, buckets: int):
    def work(pack: Pack, answers: dict) -> Iterator[tuple]:
        moves: set[tuple[int, int]] = set()
        rows = [np.zeros(0, np.int64)]
        for payload in answers.get(3, {}).values():
            row, many, targets, used = _orders(payload)
            moves.update(zip(targets.tolist(), np.repeat(row, many).tolist(), strict=True))
            rows.append(np.frombuffer(payload, "<i4", offset=used).astype(np.int64))
        own = np.unique(np.concatenate(rows))
        if len(own):
            sets = Sets(pack, words, own)
            at = {r: i for i, r in enumerate(sets.rows.tolist())}
            yield from _announce(pack, sets, {(target, at[r]) for target, r in moves})
            yield _own(pack, ROWS, own)

    return work


def _pack_labels(frame: pd.DataFrame) -> pd.DataFrame:
    pairs = frame.sort_values("at")[["at", "component"]].to_numpy(np.int64)
    return pd.DataFrame({"pack_id": [int(frame["pack_id"].iloc[0])], "round": [1], "bucket": [0], "payload": [pairs.astype("<i8").tobytes()]})


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", pack_bytes: int = PACK_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links) for every row."""
    if percent < 50:
        raise ValueError("sketches of linked sets are compared up to twice the size: a similarity of 50 percent at least")
    rounds = Rounds.over(docs, id_col, text_col, pack_bytes, apart=True)
    n = rounds.buckets

    def meet(sent: DataFrame, check, schema: str, name: str) -> DataFrame:
        both = rounds.packs.groupBy("pack_id").cogroup(sent.groupBy("pack_id")).applyInPandas(check, schema)
        found, _ = materialize_counted(both, name)
        del both
        release(rounds.spark)
        return found

    def checked(ship, check) -> DataFrame:
        return meet(rounds.per_pack(ship(words, percent, n), SHIP_SCHEMA), check(words, percent), FOUND_SCHEMA, "found")

    def verified(found: DataFrame) -> DataFrame:
        """The links of a round: certain ones, and of the candidates one pair of each two names, checked exactly."""
        turned = F.struct("xa", "sa") > F.struct("xb", "sb")
        names = [F.when(turned, F.col(f"{k}{j}")).otherwise(F.col(f"{k}{i}")).alias(f"{k}{m}") for i, j, m in (("a", "b", 1), ("b", "a", 2)) for k in "xs"]
        one = found.filter(F.col("kind") == PAIR).groupBy(*names).agg(F.min(F.struct("a", "pa", "ra", "b", "pb", "rb")).alias("one"))
        pairs, _ = materialize_counted(one.select("one.*"), "pairs")
        asked = pairs.select(F.col("pa").alias("pack_id"), F.col("ra").alias("row"), F.col("pb").alias("target"), F.col("a").alias("doc")).distinct()
        sets = rounds.packs.groupBy("pack_id").cogroup(asked.groupBy("pack_id")).applyInPandas(_send_sets(words), CHECK_SCHEMA)
        own = pairs.select(
            F.col("pb").alias("pack_id"), F.col("pa").alias("source"), F.col("ra").alias("row"), F.col("a").alias("doc"),
            F.col("rb").alias("own"), F.col("b").alias("id"), F.lit(None).cast("binary").alias("features"),
        )
        links = meet(sets.unionByName(own), _verify_sets(words, percent), "a long, b long", "links")
        return links.unionByName(found.filter(F.col("kind") == LINK).select("a", "b"))

    rounds.round(_ask_keys(words, percent, n), _resolve_keys)
    found = checked(_ship_first, _check_first)
    links = verified(found)
    sizes = found.filter(F.col("kind") == SIZE).select(F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"))
    holders = found.filter(F.col("kind") == HOLDER).select(F.col("a").alias("doc"), F.col("b").alias("pack_id"), F.col("c").alias("at"))
    stars = components(links)
    labels = holders.join(stars, holders["doc"] == stars["node"], "left").select("pack_id", "at", F.coalesce("component", "doc").alias("component"))
    known, _ = materialize_counted(labels.groupBy("pack_id").applyInPandas(_pack_labels, REPLY_SCHEMA), "labels")
    rounds.add(known)
    rounds.round(_ask_components(words, percent, n), _resolve_components)
    rounds.round(_ask_holders(words, percent, n), _resolve_holders(percent))
    more = verified(checked(_ship_rest, _check_rest))
    whole = components(links.unionByName(more))
    ids = sizes.join(whole, sizes["doc_id"] == whole["node"], "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    return ids.select(rounds.known("doc_id").alias("doc_id"), "n_shingles", rounds.known("component_id").alias("component_id"))
