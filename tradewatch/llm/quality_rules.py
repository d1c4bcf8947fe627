"""Quality rules as a learned decision list (built-in functions only).

``measures`` takes per-document figures in one pass over the whole text, without a shuffle.
``learn`` fits an ordered list of threshold conjunctions by sequential covering: documents with known
quality are binned (Spark counts the good and bad ones of every bin combination and fold), then each
round grows the conjunction with the best information gain on the growing fold, prunes it on the
pruning fold, emits it, and removes what it covers.  ``verdict`` turns the list into one ordered
``CASE WHEN`` expression, so judging a corpus is a projection.

The fit uses at most ``max_labelled`` labelled rows (the rows with the smallest hash of their id; a
documented bound, so what reaches the driver is bounded); measures and verdicts cover every row.

Edge cases: a null or empty text has no words and fails the base rule; rows with a null id are judged
like others; without labels (or only one class) the list is empty and the base rule alone decides;
repeated label rows count as given; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize_counted
from .common import SPACE

WINDOW_WORDS = 5
MAX_LABELLED = 20_000
BINS = 16
MAX_RULES = 8
MAX_CONDITIONS = 3
#: A rule must be right on at least this share of what it covers in the pruning fold.
MIN_PRECISION = 0.97

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines")


def repeat_words(words: Column) -> Column:
    """Words that stand in a window of five that occurs at least twice in the text.

    Windows are hashed (64 bits, within one text).  Without a repeated hash the answer is 0; else
    windows sorted by (hash, position) show the repeated ones next to each other, and the union of
    their spans is summed in order of position.
    """
    w = WINDOW_WORDS
    starts = lambda ws: F.sequence(F.lit(0), F.size(ws) - w)
    hashes = lambda ws: F.transform(starts(ws), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(w)]))

    def repeated(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda p, a, b: F.coalesce(F.get(p, a)["h"] == F.get(p, b)["h"], F.lit(False))
        found = _let(pairs, lambda p: F.filter(F.transform(p, lambda x, k: F.when(same(p, k, k - 1) | same(p, k, k + 1), x["i"])), lambda i: i.isNotNull()))
        return F.aggregate(
            F.sort_array(found),
            F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
            lambda a, i: F.struct((i + w).alias("end"), (a["n"] + (i + w) - F.greatest(i, a["end"])).alias("n")),
            lambda a: a["n"],
        )

    return _let(
        words,
        lambda ws: F.when(F.size(ws) <= w, F.lit(0)).otherwise(
            _let(hashes(ws), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated(h)))
        ),
    )


def _let(value: Column, body) -> Column:
    """``body`` over a value that is computed once (bound as a lambda variable)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def measures(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the figures of ``COUNTS`` (long) for every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split("_t", SPACE), lambda x: x != "")
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    without = lambda pattern: F.length("_t") - F.length(F.regexp_replace("_t", pattern, ""))
    listed = docs.select(*keep, text.alias("_t")).select(*keep, "_t", words.alias("_w"), lines.alias("_l"))
    return listed.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        without(r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_w")).cast("long").alias("n_repeat_words"),
        without(r"[A-Z]+").cast("long").alias("n_upper"),
        (F.length("_t") - F.length(F.replace("_t", F.lit("!"), F.lit("")))).cast("long").alias("n_marks"),
        F.size("_l").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def features() -> dict[str, Column]:
    """What conditions may test: ratios per 1,000, so thresholds are whole numbers."""
    per = lambda a, b: F.coalesce((F.col(a) * 1000 / F.greatest(F.col(b), F.lit(1))).cast("int"), F.lit(0))
    return {
        "word_length": per("word_chars", "n_words"),
        "symbol_share": per("n_symbols", "word_chars"),
        "upper_share": per("n_upper", "word_chars"),
        "mark_share": per("n_marks", "n_words"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "words_per_line": per("n_words", "n_lines"),
        "n_words": F.col("n_words").cast("int"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    op: str  # ">" or "<="
    threshold: int

    def column(self) -> Column:
        c = features()[self.feature]
        return c > self.threshold if self.op == ">" else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {self.op} {self.threshold}"


@dataclass(frozen=True)
class DecisionRule:
    conditions: tuple[Condition, ...]
    keep: bool = False


def verdict(rules: list[DecisionRule]) -> Column:
    """The ordered conditional expression: base rule, learned rules, then keep."""
    out = F.when(base_failed(), F.lit(False))
    for r in rules:
        hit = F.lit(True)
        for c in r.conditions:
            hit = hit & c.column()
        out = out.when(hit, F.lit(r.keep))
    return out.otherwise(F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id", label_col: str = "quality", text_col: str = "text") -> list[DecisionRule]:
    """Decision list for ``label_col`` = 0, from at most ``max_labelled`` labelled rows."""
    sample = labels.select(id_col, F.col(label_col).alias("_good")).dropna().orderBy(F.xxhash64(id_col), id_col).limit(max_labelled)
    # bounded by max_labelled; written, so that only these rows are measured (filters on measures would move below the join)
    joined, _ = materialize_counted(docs.select(id_col, text_col).join(F.broadcast(sample), id_col), "labelled-sample")
    known = measures(joined, text_col, keep=(id_col, "_good")).filter(~base_failed())
    named = known.select(id_col, "_good", *[c.alias(n) for n, c in features().items()])
    # one Spark job gives the rows to be binned once; both aggregates below read its result
    named = named.persist()
    try:
        names = list(features())
        steps = [i / BINS for i in range(1, BINS)]
        cuts_row = named.agg(*[F.percentile_approx(n, steps, 1000).alias(n) for n in names]).first()
        cuts = {n: sorted(set(cuts_row[n] or [])) for n in names}
        binned = [_bin(F.col(n), cuts[n]).alias(n) for n in names]
        cells = (
            named.select("_good", (F.pmod(F.xxhash64(id_col), F.lit(3)) == 0).alias("prune"), *binned)
            .groupBy("prune", *names)
            .agg(F.sum(F.when(F.col("_good") == 0, 1).otherwise(0)).alias("bad"), F.sum(F.when(F.col("_good") == 0, 0).otherwise(1)).alias("good"))
            .collect()  # at most max_labelled rows
        )
    finally:
        named.unpersist()
    table = [(bool(r["prune"]), tuple(r[n] for n in names), r["bad"], r["good"]) for r in cells]
    return cover(table, [(n, cuts[n]) for n in names])


def _bin(c: Column, cuts: list[int]) -> Column:
    """How many cut points lie below the value (0..len(cuts))."""
    out = F.lit(0)
    for x in cuts:
        out = out + F.when(c > x, 1).otherwise(0)
    return out


def cover(cells: list[tuple[bool, tuple[int, ...], int, int]], bins: list[tuple[str, list[int]]]) -> list[DecisionRule]:
    """Sequential covering over counted bin combinations: (in the pruning fold, bins, bad, good)."""
    rules: list[DecisionRule] = []
    left = sorted(cells)
    while len(rules) < MAX_RULES:
        grown: list[tuple[int, str, int]] = []  # feature index, op, bin
        inside = [c for c in left if not c[0]]
        while len(grown) < MAX_CONDITIONS:
            bad, good = sum(c[2] for c in inside), sum(c[3] for c in inside)
            if not bad or not good:
                break
            best, gain = None, 1e-9
            for j, (_, cuts) in enumerate(bins):
                by = [[0, 0] for _ in range(len(cuts) + 1)]
                for c in inside:
                    by[c[1][j]][0] += c[2]
                    by[c[1][j]][1] += c[3]
                b = g = 0
                for k in range(len(cuts)):
                    b, g = b + by[k][0], g + by[k][1]
                    for op, p, n in (("<=", b, g), (">", bad - b, good - g)):
                        if p:
                            value = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                            if value > gain:
                                best, gain = (j, op, k), value
            if best is None:
                break
            grown.append(best)
            inside = [c for c in inside if _holds(best, c[1])]
        if not grown:
            return rules
        # prune: drop final conditions while that does not lower (bad - good) / covered on the other fold
        def worth(conds: list[tuple[int, str, int]]) -> tuple[float, int]:
            hit = [c for c in left if c[0] and all(_holds(x, c[1]) for x in conds)]
            p, n = sum(c[2] for c in hit), sum(c[3] for c in hit)
            return ((p - n) / (p + n) if p + n else -1.0, p)

        while len(grown) > 1 and worth(grown[:-1]) >= worth(grown):
            grown = grown[:-1]
        hit = [c for c in left if c[0] and all(_holds(x, c[1]) for x in grown)]
        p, n = sum(c[2] for c in hit), sum(c[3] for c in hit)
        if p < 3 or p < MIN_PRECISION * (p + n):
            return rules
        rules.append(DecisionRule(tuple(Condition(bins[j][0], op, bins[j][1][k]) for j, op, k in grown)))
        left = [c for c in left if not all(_holds(x, c[1]) for x in grown)]
    return rules


def _holds(cond: tuple[int, str, int], row: tuple[int, ...]) -> bool:
    j, op, k = cond
    return row[j] <= k if op == "<=" else row[j] > k


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for every document."""
    rules = learn(docs, labels, max_labelled, id_col, text_col=text_col)
    m = measures(docs, text_col, keep or (id_col,))
    return m.withColumns({"base_failed": base_failed(), "kept": verdict(rules)})
