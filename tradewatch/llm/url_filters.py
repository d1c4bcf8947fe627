"""URL filters: all glob rules run at once as one bit-parallel Shift-And automaton.

Every glob becomes a run of bits: a start bit, then one bit per literal byte.  A ``*`` gives the bit
before it a self-loop on the bytes the star may eat.  All globs lie side by side in one state of
several 64-bit words, so one step per byte of the URL,

    state = ((state << 1) & byte_mask[b]) | (state & loop_mask[b])

moves every rule at once; a batch of URLs is stepped together, one column of bytes at a time.

Canonical form: ``"." + host + path``, host lower-cased (A-Z), query and fragment cut off.  The leading
dot lets ``*.example.com/en/*`` fit the host itself and its subdomains; a star of the host part does
not eat ``/`` so a host glob can never be found inside a path.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits no rule and gets the
default verdict; an empty rule list allows everything; equal rules: the earlier one wins; repeated
rows and null ids are judged row by row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, prepare


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}*"


@dataclass(frozen=True)
class Glob:
    """A wildcard over the canonical form; it judges URLs that no ``Rule`` fits."""

    verdict: str
    glob: str


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
GLOBS = (Glob("block", "*.spam-*"), Glob("block", "*casino*"), Glob("block", "*-pills.*"))


class ShiftAnd:
    """The packed masks of a list of globs (``*`` any bytes, ``?`` one byte)."""

    def __init__(self, globs: Iterable[str]):
        bits: list[tuple[object, str]] = []  # literal byte (None: start, -1: any), class of its loop
        self.starts, self.finals = [], []
        for glob in globs:
            self.starts.append(len(bits))
            bits.append((None, ""))
            seen_slash = False
            for b in glob.encode():
                if b == ord("*"):
                    bits[-1] = (bits[-1][0], "any" if seen_slash else "host")
                else:
                    seen_slash |= b == ord("/")
                    bits.append((-1 if b == ord("?") else b, ""))
            # a trailing star takes the whole rest of the URL, path included
            if glob.endswith("*"):
                bits[-1] = (bits[-1][0], "any")
            self.finals.append(len(bits) - 1)
        self.words = max(1, -(-len(bits) // 64))
        self.byte_mask = np.zeros((256, self.words), np.uint64)
        self.loop_mask = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for i in self.starts:
            self.start[i // 64] |= np.uint64(1 << (i % 64))
        slash = ord("/")
        for i, (literal, loop) in enumerate(bits):
            bit = np.uint64(1 << (i % 64))
            if literal == -1:
                self.byte_mask[:, i // 64] |= bit
            elif literal is not None:
                self.byte_mask[literal, i // 64] |= bit
            if loop:
                self.loop_mask[:, i // 64] |= bit
                if loop == "host":
                    self.loop_mask[slash, i // 64] &= ~bit

    def match(self, texts: list[bytes]) -> np.ndarray:
        """Boolean matrix [text, glob]."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        data = np.frombuffer(b"".join(texts[i] for i in order) + b"\0", np.uint8)
        offsets = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        state = np.tile(self.start, (len(texts), 1))
        one, top = np.uint64(1), np.uint64(63)
        # texts are in order of falling length: those that still have a byte at k are the first ones
        alive = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(texts) else 0) + 1), side="right")
        for k, n in enumerate(alive):
            byte = data[offsets[:n] + k]
            old = state[:n]
            moved = old << one
            moved[:, 1:] |= old[:, :-1] >> top
            state[:n] = (moved & self.byte_mask[byte]) | (old & self.loop_mask[byte])
        out = np.zeros((len(texts), len(self.finals)), bool)
        for j, i in enumerate(self.finals):
            out[order, j] = (state[:, i // 64] >> np.uint64(i % 64)) & one != 0
        return out


def canonical(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` and ``path`` (empty without a url or a scheme)."""
    rest = F.when(F.instr(url_col, "://") > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return df.withColumns({"host": F.coalesce(lower_ascii(host), F.lit("")), "path": F.coalesce(path, F.lit(""))})


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    globs: tuple[Glob, ...] = GLOBS,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per page: id, host, path, rule (the longest that fits, else null), verdict.

    Without a rule the first fitting glob judges, else ``default``.  No shuffle; the rules are a
    parameter and travel with the task.
    """
    prepare(pages.sparkSession)
    machine = ShiftAnd([r.glob for r in rules] + [g.glob for g in globs])
    # longest rule first, ties in the order given; then globs in the order given
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), i))
    ranked = order + list(range(len(rules), len(rules) + len(globs)))
    names = [rules[i].name for i in order] + [None] * len(globs) + [None]
    verdicts = [rules[i].verdict for i in order] + [g.verdict for g in globs] + [default]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            host, path = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            hits = machine.match([f".{h}{p}".encode() for h, p in zip(host, path, strict=True)])[:, ranked]
            hits = np.concatenate([hits, np.ones((len(host), 1), bool)], axis=1)
            first = hits.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("host"), batch.column("path"), pa.array([names[i] for i in first], pa.string()), pa.array([verdicts[i] for i in first], pa.string())],
                names=[id_col, "host", "path", "rule", "verdict"],
            )

    src = canonical(pages.select(id_col, url_col), url_col).select(id_col, "host", "path")
    id_type = src.schema[id_col].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {id_type}, host string, path string, rule string, verdict string")
