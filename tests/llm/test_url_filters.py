import fnmatch
import random

from tradewatch.llm.url_filters import Rule, ShiftAnd, judge


def brute(url, rules):
    """Rule by rule on host and path."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name)).name if fits else None


URLS = [
    None, "", "no scheme", "http://", "http://x.com", "http://X.COM/", "https://www.example.com/en/1?q=/fr/", "http://example.com/en/", "http://notexample.com/en/",
    "http://a.b.example.com/en/x#y", "http://x.net/es/", "http://x.net/a.com/", "ftp://x.net?/fr/", "http://x.net/fr/" + "z" * 3000, "http://É.com/é", "http://com/", "http://.com/", "a://b://c.net/es/", "http://x.net/\n/es/", "http://x.net/es",
]


def test_matches_brute_force_with_clashing_columns_and_repeats(spark):
    from tradewatch.llm.url_filters import RULES

    rows = [(i, u, "k", "p", "v") for i, u in enumerate(URLS)] + [(0, None, "k", "p", "v"), (None, "http://x.com/", "k", "p", "v")]
    out = judge(spark.createDataFrame(rows, "page_id long, url string, host string, path string, verdict string")).collect()
    assert len(out) == len(rows)
    for r, (i, u, *_) in zip(sorted(out, key=lambda r: (r.page_id is None, r.page_id or 0)), sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), strict=True):
        assert (r.host, r.path, r.rule) == brute(u, RULES), u
        assert r.verdict in ("allow", "block")


def test_longest_wins_default_and_globs(spark):
    rows = [(1, "http://a.casino.org/"), (2, "http://a.org/"), (3, "http://casino.com/"), (4, "http://spam-x.org/")]
    got = {r.page_id: r.verdict for r in judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "block"}
    got = judge(spark.createDataFrame(rows[:1], "page_id long, url string"), rules=(), globs=(), default="block").collect()
    assert got[0].verdict == "block"


def test_empty_table(spark):
    assert judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_automaton_against_fnmatch_over_many_words():
    r = random.Random(1)
    globs = ["".join(r.choice("ab.*?") for _ in range(r.randint(1, 12))).replace("[", "") for _ in range(60)]
    texts = ["".join(r.choice("ab.") for _ in range(r.randint(0, 15))) for _ in range(300)]
    machine = ShiftAnd(globs)
    assert machine.words > 2
    hits = machine.match([t.encode() for t in texts])
    for i, t in enumerate(texts):
        for j, g in enumerate(globs):
            assert hits[i, j] == fnmatch.fnmatchcase(t, g), (t, g)


def test_host_star_stays_in_the_host():
    hits = ShiftAnd([Rule("block", "net", "/es/").glob]).match([b".x.net/es/1", b".x.org/a.net/es/1", b".net/es/", b".xnet/es/"])
    assert hits[:, 0].tolist() == [True, False, True, False]
