"""Main text of pages: hand-made layouts, and every page of a table against its own markup."""

import html
import re

import pytest

from orderlens.llm import extract, queries

FOLDER = "/root/testdata/sf0.01"
WORDS = " ".join(f"word{i}" for i in range(40))


def by_markup(page):
    """The plain way for pages that mark their content: cut out the element and its tags."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    blocks = re.split(r"</?(?:p|h1|li|ul|div)>", body)
    blocks = [" ".join(html.unescape(re.sub("</?b>", "", b)).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.op10_html_extract(spark, FOLDER).collect()}
    assert got.keys() == pages.keys()
    for key, r in got.items():
        assert r.text == by_markup(pages[key].html) and r.n_chars == len(r.text) and r.url == pages[key].url


@pytest.fixture(scope="module")
def weights(spark):
    return extract.fit(spark.read.parquet(f"{FOLDER}/pages.parquet"))


FRAME = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>'
         '<nav><ul><li>Home</ul></nav><div class="cookie-notice">We use cookies</div><main>%s'
         '<section id="comments"><h2>Comments</h2><p>' + "nice post " * 300 + '</p></section></main>'
         '<div class="sidebar-left"><p>' + WORDS + '</p></div><footer>foot</footer></body></html>')


@pytest.mark.parametrize(("inner", "want"), [
    ("<h1>A &eacute; &amp;amp;</h1><p>one <b>t</b>wo<br>three</p>", ["A é &amp;", "one two three"]),
    (f"<p>{WORDS}</p><div class='ad-slot'><div>Buy</div>now</div><p>End.</p>", [WORDS, "End."]),
    ("<p>a</p><ul><li>x<li>y</ul><aside>s</aside><form><input>mail</form><p>b", ["a", "x", "y", "b"]),
    ("<p class='ad'>buy<p>kept<p>Last.</p>", ["kept", "Last."]),
    ("<ul><li class=ad>x<ul><li>q</ul></li><li>y</ul><p>z", ["y", "z"]),
    ("<p>a &lt;p&gt; \n\t b</p><script>var t='</p>';</script><!-- <p>no --><pre>c\n d</pre>", ["a <p> b", "c d"]),
    ("<p title='a > b'>q</p><div class='article-header'><h2>Head</h2></div>", ["q", "Head"]),
])
@pytest.mark.parametrize("element", ["article", "div class='post'"])
def test_layouts(weights, inner, want, element):
    page = FRAME % f"<{element}>{inner}</{element.split()[0]}>"
    assert extract.main_text(page, weights) == "\n\n".join(want)


@pytest.mark.parametrize("name", ["article-comments", "comment-body", "post-comments", "main-menu", "main-navigation",
                                  "entry-footer", "post-sidebar", "content-sidebar", "ad-content", "promo-content",
                                  "cookie-text", "main-header"])
@pytest.mark.parametrize("element", ["article", "div"])
def test_parts_of_the_page_named_after_the_article(weights, name, element):
    other = f"<div class='{name}'><p>" + "other words " * 100 + "</p></div>"
    page = f"<body><div><{element}><p>{WORDS}</p>{other}<p>End.</p></{element}>{other}</div></body>"
    assert extract.main_text(page, weights) == f"{WORDS}\n\nEnd."


@pytest.mark.parametrize("name", ["post-body", "entry-content", "main-content", "content-with-sidebar", "article-header",
                                  "post comments-open", "post comments-closed category-social tag-search", "no-sidebar"])
def test_wrappers_of_the_article(weights, name):
    assert extract.main_text(f"<body><div class='{name}'><p>{WORDS}</p></div></body>", weights) == WORDS


def test_only_the_region_can_tell():
    """No mark and no name tells the parts of this page apart, only what pages that mark their content have outside of it."""
    links = "<div>" + "<ul><li>one</li></ul>" * 30 + "</div>"
    marked = f"<body>{links}<article><p>{WORDS}</p></article>{links}</body>"
    page = f"<body>{links}<div><p>{WORDS}</p><p>{WORDS}</p></div>{links}</body>"
    assert extract.main_text(page, extract.Weights(extract.count([marked] * 20))) == f"{WORDS}\n\n{WORDS}"
    assert extract.main_text(page, extract.Weights({})).startswith("one\n\none")


def test_odd_pages(spark):
    rows = [(1, None), (None, ""), (2, "just  text"), (2, "just  text"), (3, "<p>a<p>b"), (4, "<article>x y"),
            (5, "<div><p>" + "long text " * 80000), (6, "<nav>only menu</nav>"), (7, "&amp &am; < <>")]
    df = spark.createDataFrame([(k, v, "clash", 1) for k, v in rows], "page_id long, html string, _html string, n int")
    got = {(r.page_id, r.html): r.text for r in extract.extract(df).collect()}
    assert got[1, None] == got[None, ""] == got[6, "<nav>only menu</nav>"] == ""
    assert got[2, "just  text"] == "just text" and got[3, "<p>a<p>b"] == "a\n\nb" and got[4, "<article>x y"] == "x y"
    assert len(got[5, rows[6][1]]) == 10 * 80000 - 1
    assert got[7, "&amp &am; < <>"] == "& &am; < <>"
    assert extract.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(("inner", "want"), [
    ('<div style="overflow:hidden"><p>a b c</p></div>', "a b c"),
    ("<div data-id='search' data-role=\"menu\" title=\"class='ad' hidden\"><p>a b c</p></div>", "a b c"),
    ('<div class="has-sidebar"><p>a b c</p></div>', "a b c"),
    ('<div class="page--with-sidebar no-ads menu-open"><p>a b c</p></div>', "a b c"),
    ("<div><nav><ul></ul></div><p>text", "text"),
    ("<ul><li><aside class=x><ul><li>q<li>r</ul></li><li>y</ul><p>z", "y\n\nz"),
    ("<section><div class='ad'><b>x</section><p>z</p>", "z"),
    ("<div><table><tr><td><nav>x</div>y</nav></td></tr></table><p>z</p></div>", "z"),
    ("<nav><div>x</div></nav><div class='sidebar-with-links'>q</div><div HIDDEN>r</div><p class='menu has-open'>s</p><p>z", "z"),
])
def test_kept_and_left_out(inner, want):
    assert extract.main_text(f"<body>{inner}", extract.Weights({})) == want


TAGS = {("tag", t, inside): n for t in ("div", "table", "tr", "td", "article", "section")
        for inside, n in ((True, 100), (False, 16000))} | {("word", "p", True): 90000, ("word", "div", False): 2000}
TABLE = "<table>" + f"<tr><td>{'cell ' * 3}</td><td>b</td></tr>" * 60 + "</table>"
ONE, TWO = "one " * 300, "two " * 200


@pytest.mark.parametrize("page", [
    f"<article><p>{ONE}</p><div><p>in</p></div><p>{TWO}</p></article>",
    f"<main><p>{ONE}</p>{TABLE}<p>{TWO}</p></main>",
    f"<div class=post><p>{ONE}</p><div><p>in</p></div><p>{TWO}</p></div>",
    f"<div><article><p>{ONE}</p></article></div><div class=ad>buy</div><div><div><article><p>{TWO}</p></article></div></div>",
])
def test_content_with_outside_tags(page):
    """Tags that other pages mostly have outside of the content do not split it."""
    text = extract.main_text(f"<body><div>x</div>{page}<footer>foot</footer>", extract.Weights(TAGS))
    assert text.count("one") == 300 and text.count("two") == 200 and "foot" not in text and "buy" not in text
    assert text.count("cell") == page.count("cell") and text.count("in") == page.count("<p>in")
