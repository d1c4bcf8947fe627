"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text at block-level tags.  A logistic classifier gives every block the cost of
calling it content and of calling it boilerplate; the costs are the capacities of its edges to the two
terminals.  Neighbouring blocks, and more strongly blocks under the same parent, are tied by smoothness edges.
The minimum cut (found as a maximum flow) is the labelling of least total cost.  Blocks whose own cost outweighs
all their ties keep their side in every minimum cut, so they are settled first and the flow runs on the rest.

Markup that names its purpose (``BOILERPLATE_NAMES`` / ``CONTENT_NAMES``, as a tag or as a whole name in class, id or
role) is taken at its word: of a block's ancestors the innermost named one decides, but what stands in boilerplate
stays there (a comment may be an ``article``; only a form may hold the whole page).  The classifier judges all other
markup by tags, other names, link share, length and punctuation.  It is trained here, on blocks of a bounded sample of
pages (``SAMPLE_PAGES`` with the smallest hash of their id; at most ``SAMPLE_KINDS`` distinct feature combinations,
counted by Spark), labelled by their named ancestors and seen as if these had no names.  Extraction covers every page
whole, without a shuffle.

Text: character references are decoded, white space inside a block becomes one space, blocks are trimmed and
joined by one newline in page order; scripts, styles, comments and markup never are text, nor is the inside of
closed templates, noscripts, svgs, iframes and objects.  A head ends where something opens that cannot stand in it.

Edge cases: a null or empty page, or one without content, has an empty text; unclosed and stray tags are
tolerated; repeated rows and null ids are extracted row by row; an empty table gives an empty result and leaves
the classifier with two general rules.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

SAMPLE_PAGES = 1000
SAMPLE_KINDS = 20_000
#: Smoothness: between neighbours in page order, and more for blocks with the same parent.
NEAR, SIBLING = 0.3, 0.7

# Markup names that say what a part of a page is.
BOILERPLATE_NAMES = frozenset(
    "nav navbar navigation menu header footer aside sidebar form button select option label input ad ads advert advertisement banner promo sponsor sponsored "
    "cookie cookies notice notices alert gdpr consent popup modal newsletter subscribe signup login share sharing social related recommended breadcrumb breadcrumbs "
    "pagination pager comment comments respond reply replies discussion copyright legal widget toolbar complementary contentinfo".split()
)
CONTENT_NAMES = frozenset("article main content post entry story".split())
# Words that say nothing of their own in a compound name (comment-list, article-body, ad-slot).
PLAIN_WORDS = frozenset(
    "area articles bar block body box bottom button buttons card col column container content entry group holder icons inner item items left link links list main media outer page panel posts "
    "region right row section site slot space stories text thread top unit wrap wrapper zone".split()
)
#: Log-odds of a block whose markup says what it is.
NAMED = 6.0
# Tags that begin a new block of text, tags without an end, tags whose inside is no text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup "
    "hr html label legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("head title".split())
_CLOSES_P = BLOCK_TAGS - {"button", "label", "option", "select", "optgroup", "legend", "caption", "html", "body", "head", "title"}
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

# Tags whose inside is no text if they are closed; tags that may stand in a head.
SPAN_TAGS = frozenset("template noscript svg iframe object".split())
HEAD_TAGS = frozenset("html head title base basefont bgsound link meta noframes".split()) | SPAN_TAGS - {"svg", "iframe", "object"}

_RAW = r"<!--.*?(?:-->|\Z)|<(script|style|textarea)\b[^>]*>.*?(?:</\1\s*>|\Z)"
_SPAN = re.compile(_RAW + r"|<(/?)(template|noscript|svg|iframe|object)\b((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_TOKEN = re.compile(
    _RAW + r"|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|<[!?][^>]*>",
    re.S | re.I,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[tuple[int, str, tuple[str, ...]], ...]  # (element number, tag, names) from the root
    link_chars: int = 0
    parts: list[str] = field(default_factory=list)

    def features(self) -> tuple[str, ...]:
        """What the classifier sees: everything below the element that names the block's purpose."""
        path = self.path[named(self.path)[1] :]
        out = {f"tag:{t}" for _, t, _ in path} | {f"name:{w}" for _, _, names in path for w in names}
        share = self.link_chars / max(1, len(self.text))
        out.add(f"in:{path[-1][1] if path else ''}")
        out.add(f"links:{min(3, int(share * 4))}")
        out.add(f"length:{min(4, int(math.log10(max(1, len(self.text))) * 2))}")
        out.add(f"ends:{self.text[-1] in '.!?:;…。'}")
        return tuple(sorted(out))


@lru_cache(maxsize=20_000)
def _says(name: str) -> int | None:
    """1 for a whole name of content, 0 for one of boilerplate: a listed word, or a compound that such a word ends or
    that has none but such and plain words."""
    words = _WORD.findall(name)
    if words[-1:] == ["header"] and CONTENT_NAMES.intersection(words):
        return None  # as a header inside an article
    for known, other, answer in ((BOILERPLATE_NAMES, CONTENT_NAMES, 0), (CONTENT_NAMES, BOILERPLATE_NAMES, 1)):
        if words and (words[-1] in known or all(w in known or w in PLAIN_WORDS for w in words) and any(w in known and w not in other for w in words)):
            return answer
    return None


def named(path: tuple[tuple[int, str, tuple[str, ...]], ...]) -> tuple[int | None, int]:
    """What the markup says of a block (1 content, 0 boilerplate, None nothing), and how many elements lead to the one that says it."""
    says, at, page_form = None, 0, False
    for i, (_, tag, names) in enumerate(path):
        own = [_says(n) for n in names]
        if tag in BOILERPLATE_NAMES or 0 in own:
            if says == 1 and tag == "header" and 0 not in own:
                continue  # the heading of an article, not of the site
            if says != 0:
                page_form, says, at = says is None and tag == "form" and 0 not in own, 0, i + 1
            elif tag != "form" or 0 in own:
                page_form = False
        elif (tag in CONTENT_NAMES or 1 in own) and (says is None or page_form):
            says, at, page_form = 1, i + 1, False
    return says, at


def _describe(tag: str, seen: dict[str, tuple[str, bool, tuple[str, ...]]]) -> tuple[str, bool, tuple[str, ...]]:
    """(name, is an end tag, names in class, id and role)."""
    known = seen.get(tag)
    if known is None:
        name = _NAME.match(tag)[1].lower()
        words = tuple(dict.fromkeys(w for m in _ATTR.finditer(tag) for w in (m[1] or m[2] or m[3] or "").lower().split())) if name in BLOCK_TAGS and name not in ("html", "body") else ()
        known = (name, tag[1] == "/", words)
        if len(seen) > 50_000:
            seen.clear()
        seen[tag] = known
    return known


def _spans(page: str) -> dict[int, int]:
    """Start and end of the elements of ``SPAN_TAGS`` that are closed; <svg/> is whole, others without an end tag are left out."""
    out: dict[int, int] = {}
    open_at: dict[str, list[int]] = {}
    for m in _SPAN.finditer(page):
        if not m[3]:
            continue
        starts = open_at.setdefault(m[3].lower(), [])
        if not m[2]:
            if not (m[4].endswith("/") and m[3].lower() == "svg"):
                starts.append(m.start())
        elif starts:
            out[starts.pop()] = m.end()
    return out


def blocks(page: str, seen: dict | None = None) -> list[Block]:
    """Blocks of text in page order."""
    seen = {} if seen is None else seen
    out: list[Block] = []
    stack: list[tuple[int, str, tuple[str, ...]]] = []
    parts: list[str] = []
    link_chars = number = links = 0

    def close() -> None:
        nonlocal link_chars
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and not any(t in HIDDEN_TAGS for _, t, _ in stack):
                out.append(Block(text, tuple(stack), link_chars))
            parts.clear()
        link_chars = 0

    def pop(names: tuple[str, ...], stops: tuple[str, ...]) -> None:
        """Closes the innermost of ``names`` and all inside it, unless a stop comes first."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][1] in names:
                del stack[i:]
                return
            if stack[i][1] in stops:
                return

    def leave_head() -> None:
        """What cannot stand in a head ends it (its end tag may be left out)."""
        close()
        pop(("head",), ())

    at = 0
    spans: dict[int, int] | None = None
    tokens = _TOKEN.finditer(page)
    while (m := next(tokens, None)) is not None:
        start = m.start()
        if start > at:
            if stack and stack[-1][1] == "head" and page[at:start].strip():
                leave_head()
            parts.append(page[at:start])
            link_chars += (start - at) * (links > 0)
        at = m.end()
        tag = m[0]
        if m[1] or tag[1] in "!?":
            continue
        name, is_end, words = _describe(tag, seen)
        if name in SPAN_TAGS and not is_end:
            spans = _spans(page) if spans is None else spans
            if start in spans:
                at = spans[start]
                tokens = _TOKEN.finditer(page, at)
                continue
        if not is_end and stack and (name == "body" or stack[-1][1] == "head" and name not in HEAD_TAGS):
            leave_head()
        if name == "a":
            links = 0 if is_end else 1
        elif name == "br":
            parts.append(" ")
        if name not in BLOCK_TAGS:
            continue
        close()
        if is_end:
            pop((name,), ())
            continue
        if name in _CLOSES_P:
            pop(("p",), ("table", "td", "th", "button", "body"))
        if name in _SAME:
            pop(_SAME[name], ("ul", "ol", "dl", "table", "select"))
        if name not in VOID_TAGS and not tag.endswith("/>"):
            number += 1
            stack.append((number, name, words))
    if at < len(page):
        if stack and stack[-1][1] == "head" and page[at:].strip():
            leave_head()
        parts.append(page[at:])
    close()
    return out


@dataclass
class Classifier:
    weights: dict[str, float]
    bias: float

    def log_odds(self, features: tuple[str, ...]) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features)

    def judge(self, b: Block) -> float:
        says = named(b.path)[0]
        return self.log_odds(b.features()) if says is None else NAMED if says else -NAMED


def train(rows: list[tuple[tuple[str, ...], int, int]], steps: int = 300, ridge: float = 1e-4) -> Classifier:
    """Logistic regression by gradient steps over (features, label, count).

    A little of what is known without any page goes along: links alone speak for menus, long sentences for content.
    """
    known = [(("links:3", "ends:False"), 0, 1), (("links:0", "length:4", "ends:True"), 1, 1)]
    total = sum(n for _, _, n in rows) or 1
    rows = [(f, y, n / total) for f, y, n in rows] + [(f, y, 0.05) for f, y, _ in known]
    names = sorted({x for f, _, _ in rows for x in f})
    column = {x: i for i, x in enumerate(names)}
    row_of = np.concatenate([np.full(len(f), i) for i, (f, _, _) in enumerate(rows)])
    col_of = np.array([column[x] for f, _, _ in rows for x in f])
    y, n = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows])
    # both classes weigh the same
    for c in (0.0, 1.0):
        n[y == c] /= max(n[y == c].sum(), 1e-12) * 2
    w, bias = np.zeros(len(names)), 0.0
    scale = 1.0 / np.sqrt(np.bincount(col_of, weights=n[row_of], minlength=len(names)) + 1e-3)
    for _ in range(steps):
        z = np.bincount(row_of, weights=w[col_of], minlength=len(rows)) + bias
        g = n * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        w -= scale * np.bincount(col_of, weights=g[row_of], minlength=len(names)) + ridge * w
        bias -= g.sum()
    return Classifier({x: float(w[i]) for x, i in column.items()}, float(bias))


def min_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for nodes on the content side of a minimum cut.

    Capacities: source to node softplus(odds) (the cost of calling it boilerplate), node to sink softplus(-odds);
    both have passed as much flow as the smaller allows, so a node is left with its odds as excess or need.
    """
    n = len(odds)
    ties = [0.0] * n
    for a, b, c in edges:
        ties[a] += c
        ties[b] += c
    side: list[bool | None] = [x > 0 if abs(x) > t else None for x, t in zip(odds, ties, strict=True)]
    if None not in side:
        return side
    excess = [x if s is None else 0.0 for x, s in zip(odds, side, strict=True)]
    room: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in edges:
        if side[a] is None and side[b] is None:
            room[a][b] = room[a].get(b, 0.0) + c
            room[b][a] = room[b].get(a, 0.0) + c
        elif side[a] is None:
            excess[a] += c if side[b] else -c
        elif side[b] is None:
            excess[b] += c if side[a] else -c
    while True:  # shortest augmenting paths from nodes with excess to nodes in need
        back = {i: i for i in range(n) if side[i] is None and excess[i] > 1e-12}
        queue, end = deque(back), None
        while queue and end is None:
            i = queue.popleft()
            for j, c in room[i].items():
                if c > 1e-12 and j not in back:
                    back[j] = i
                    if excess[j] < -1e-12:
                        end = j
                        break
                    queue.append(j)
        if end is None:
            return [i in back if s is None else s for i, s in enumerate(side)]
        path, j = [], end
        while back[j] != j:
            path.append((back[j], j))
            j = back[j]
        flow = min(excess[j], -excess[end], *(room[a][b] for a, b in path))
        excess[j] -= flow
        excess[end] += flow
        for a, b in path:
            room[a][b] -= flow
            room[b][a] += flow


def main_text(page: str, model: Classifier, seen: dict | None = None) -> str:
    found = blocks(page or "", seen)
    odds = [model.judge(b) for b in found]
    edges = []
    last_child: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, NEAR))
        # the element that holds this block's element: siblings in turn are tied
        parent = b.path[-2][0] if len(b.path) > 1 else 0
        if parent in last_child:
            edges.append((last_child[parent], i, SIBLING))
        last_child[parent] = i
    return "\n".join(b.text for b, keep in zip(found, min_cut(odds, edges), strict=True) if keep)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES, sample_kinds: int = SAMPLE_KINDS) -> Classifier:
    """Classifier from the weakly labelled blocks of at most ``sample_pages`` pages."""
    prepare(pages.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, labels = [], []
            for page in batch.column("html").to_pylist():
                for b in blocks(page or ""):
                    y = named(b.path)[0]
                    if y is not None:
                        kinds.append("\n".join(b.features()))
                        labels.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(labels, pa.int32())], names=["kind", "label"])

    chosen = pages.select(F.col(id_col), F.xxhash64(id_col).alias("h")).orderBy("h", id_col).limit(sample_pages).select(F.col(id_col).alias("chosen")).distinct()
    sample = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).join(F.broadcast(chosen), F.col("id") == F.col("chosen")).select("html")
    counted = sample.mapInArrow(rows, "kind string, label int").groupBy("kind", "label").agg(F.count(F.lit(1)).alias("n"))
    best = counted.orderBy(F.desc("n"), "kind", "label").limit(sample_kinds).collect()
    return train([(tuple(r["kind"].split("\n")), r["label"], r["n"]) for r in best])


def extract(pages: DataFrame, model: Classifier | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars (code points) for every page."""
    prepare(pages.sparkSession)
    model = model or fit(pages, id_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in batches:
            texts = [main_text(page or "", model, seen) for page in batch.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column(url_col), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    src = pages.select(id_col, url_col, html_col)
    kind = src.schema[id_col].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars long")
