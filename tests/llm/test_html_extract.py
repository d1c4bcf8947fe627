import random
from itertools import product

import pytest

from tradewatch.llm.html_extract import blocks, extract, fit, main_text, min_cut, named

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p>";</script></head><body class="page">
<header><h2>Site name</h2></header><nav><ul><li><a href="/">Home</a><li><a href="/x">News</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><div id="sidebar"><p>Popular</p></div><!-- <p>hidden</p> -->
<article><h1>Caf&eacute; &#39;x&#39;</h1><p>First   <b>bold</b>
text &lt;ok&gt;.<br>More<p>Second <i>one</i> a&nbsp;b.</p><ul><li>item one<li>item two</ul><form><label>Mail</label><input name=q></form></article>
<div class="comments"><p>Nice article, thanks for it all.</p></div><aside>Ads here</aside><footer>&copy; me &middot; x</footer></body></html>"""
TEXT = "Café 'x'\nFirst bold text <ok>. More\nSecond one a b.\nitem one\nitem two"


def test_page_with_all_kinds_of_boilerplate(spark):
    rows = [(i, f"u{i}", PAGE, i) for i in range(5)] + [(7, None, None, 1), (8, "u", "", 1), (9, "u", "<p", 1), (None, "u", PAGE, 1), (0, "u0", PAGE, 0)]
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.n_chars == len(r.text)
        if r.page_id in (7, 8):
            assert r.text == ""
        elif r.page_id != 9:
            assert r.text == TEXT


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract(none).count() == 0
    assert main_text(PAGE, fit(none)) == TEXT


def test_blocks_tolerate_broken_markup():
    got = blocks("<div><p>a<p>b</div></div>c<b>d<li>e<script>x<y</script>f < g <a href='>'>h</a></li><p></p><td>i")
    assert [b.text for b in got] == ["a", "b", "cd", "ef < g h", "i"]
    assert got[3].link_chars == 1
    assert blocks("") == []
    assert [b.text for b in blocks("plain " * 50_000)] == [("plain " * 50_000).strip()]


@pytest.mark.parametrize("seed", range(40))
def test_min_cut_against_all_labellings(seed):
    r = random.Random(seed)
    n = r.randint(1, 9)
    odds = [r.uniform(-2, 2) for _ in range(n)]
    edges = [(a, b, r.uniform(0, 1.5)) for a in range(n) for b in range(a) if r.random() < 0.5]
    # content costs nothing where the odds are for it, else -odds; boilerplate the other way round
    cost = lambda s: sum(max(-x, 0) if k else max(x, 0) for x, k in zip(odds, s, strict=True)) + sum(c for a, b, c in edges if s[a] != s[b])
    assert cost(min_cut(odds, edges)) <= min(map(cost, product([False, True], repeat=n))) + 1e-9


def test_named_markup_says_what_it_is():
    says = lambda *path: named(tuple((i, t, tuple(n.split())) for i, (t, n) in enumerate(path)))[0]
    assert says(("div", "cookie-notice")) == says(("div", "comment-list")) == says(("div", "related-posts")) == says(("nav", "")) == says(("div", "ad_3")) == 0
    assert says(("div", "post-content")) == says(("div", "x article-body")) == says(("main", "")) == 1
    assert says(("div", "popup-art")) is says(("div", "columns")) is says(("div", "legal-analysis")) is says(("section", "")) is None
    assert says(("article", ""), ("div", "popup-art")) == says(("article", ""), ("header", "")) == says(("article", ""), ("header", "entry-header")) == 1
    assert says(("article", ""), ("section", "comments"), ("article", "comment")) == says(("aside", ""), ("article", "")) == says(("article", ""), ("form", ""), ("div", "content")) == 0
    assert says(("form", ""), ("article", "")) == 1 and says(("form", ""), ("nav", ""), ("article", "")) == 0


#: Unlike pages, each with its answer: the article's blocks.
TEMPLATES = {
    "comments inside": (
        "<article><h1>T</h1><p>First words here.</p><section class='comments'><h3>2 comments</h3><p>I disagree with this.</p><article class='comment'><p>Me too, at great length, and with many words.</p></article></section><p>After them.</p></article>",
        ["T", "First words here.", "After them."],
    ),
    "linked items": (
        "<nav><ul><li><a href=/>Home</a></li></ul></nav><article><p>See these:</p><ul><li><a href=x>linked item</a></li><li><a href=y>another one</a></li></ul></article>",
        ["See these:", "linked item", "another one"],
    ),
    "look-alike names": (
        "<article><p>About art.</p><div class='popup-art'>Popup art is folded.</div><div class='legal-analysis'><p>A court ruled.</p></div></article><div class='popup'>Join us!</div>",
        ["About art.", "Popup art is folded.", "A court ruled."],
    ),
    "divisions only": (
        "<div id=top-nav><a href=/>Home</a> <a href=/b>Blog</a></div><div id='main-content'><h2>Title</h2><div>One paragraph of the text.</div><div>Short.</div></div><div class='site-footer'>(c) me</div>",
        ["Title", "One paragraph of the text.", "Short."],
    ),
    "page in a form": (
        "<form id=aspnet><nav><a href=/>Home</a></nav><article><p>Text inside of a form.</p></article><div><input name=q><label>Search</label></div></form>",
        ["Text inside of a form."],
    ),
    "headers and footers": (
        "<header><h2>The Site</h2></header><article><header class='entry-header'><h1>The Title</h1></header><p>Words.</p><footer>Filed under things</footer></article><footer>Imprint</footer>",
        ["The Title", "Words."],
    ),
    "tables": (
        "<main><p>Prices:</p><table><tr><th>Fruit</th><th>Price</th></tr><tr><td>Apple</td><td>3</td></tr></table></main><table class=widget><tr><td>Weather</td></tr></table>",
        ["Prices:", "Fruit", "Price", "Apple", "3"],
    ),
    "boxes inside": (
        "<div class='post'><p>Begin.</p><aside class='related-posts'><article><h4>Read this too</h4></article></aside><div class=newsletter><p>Subscribe to our letter!</p><form><button>Go</button></form></div><div class='ad-slot'>Buy.</div><p>End.</p></div>",
        ["Begin.", "End."],
    ),
    "notices and quotes": (
        "<div role=alert class='cookie-banner'><p>We use cookies on this site.</p></div><div role=main><blockquote>To be.</blockquote><pre>x = 1</pre><figure><figcaption>A picture</figcaption></figure><dl><dt>term<dd>meaning</dl></div><div role=contentinfo>Imprint</div>",
        ["To be.", "x = 1", "A picture", "term", "meaning"],
    ),
    "no names at all": (
        "<div><a href=/>Home</a> <a href=/n>News</a> <a href=/c>Contact</a></div><div><h1>A day out</h1><p>We went to the sea, and it rained the whole day, but nobody minded that at all.</p>"
        "<p>In the evening we had soup, which was hot, and a long talk about the weather of the week.</p></div><div><ul><li><a href=/a>Older</a></li><li><a href=/b>Newer</a></li></ul></div>",
        ["A day out", "We went to the sea, and it rained the whole day, but nobody minded that at all.", "In the evening we had soup, which was hot, and a long talk about the weather of the week."],
    ),
    "old page": (
        "<table><tr><td class=menu><a href=a>One</a><br><a href=b>Two</a></td><td class=content><b>Hello</b><p>Text of an old page.<p>More of it.</td></tr></table>",
        ["Hello", "Text of an old page.", "More of it."],
    ),
}


@pytest.mark.parametrize("name", TEMPLATES)
def test_unlike_pages(spark, name):
    global _MODEL
    if _MODEL is None:
        _MODEL = fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    page, want = TEMPLATES[name]
    assert main_text(f"<!DOCTYPE html><html><head><title>t</title></head><body class='single-post'>{page}</body></html>", _MODEL).split("\n") == want


_MODEL = None


def test_against_the_template_of_the_test_pages(spark):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in extract(pages).collect():
        inner = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(x for x in parts if x)


def test_optional_head_end_and_unclosed_spans_lose_no_text():
    texts = lambda page: [b.text for b in blocks(page)]
    for page in (
        "<html><head><title>t</title><meta charset=a><body><article><p>one</p><p>two</p></article>",
        "<head><title>t</title><link rel=a><article><p>one<p>two</article>",
        "<head><title>t</title><script>x</script> one <p>two",
        "<head><title>t</title></head><body><p>one</p><p>two</p></body>",
    ):
        assert texts(page) == ["one", "two"], page
    assert texts("<article><p>one <svg class='a'/> two</p><p>three</p></article>") == ["one two", "three"]
    for tag in ("object", "iframe", "svg", "noscript", "template"):
        assert texts(f"<p>one <{tag} data=x> two</p><p>three</p>") == ["one two", "three"]
        assert texts(f"<p>one <{tag}>no</{tag}> two</p><p>three <{tag}> four</p>") == ["one two", "three four"]
        assert texts(f"<p>one <{tag}><{tag}>no</{tag}> no</{tag}> two</p><!-- </{tag}> <{tag}> --><p>three</p>") == ["one two", "three"]
    for raw in ("script", "style", "textarea"):
        assert texts(f"<p>one</p><{raw}>no <p>no") == ["one"]
    assert texts("<p>one</p><!-- no <p>no") == ["one"]
