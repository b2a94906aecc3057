import html
import re
import time

import pytest

from orderlake.llm.html_text import extract, main_text, tokens
from orderlake.llm.queries import QUERIES

LONG = "Plain words make up this sentence of the page, and there are enough of them. " * 2


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("just a few words", "just a few words"), (f"<p>{LONG}</p><p>End.</p>", f"{LONG.strip()} End."),
    ("<article>One</article>", "One"),
    ("<article><h1>T &amp; x</h1><p>a<b>b</b>\n  c<br>d<p>e &eacute;&#233;&#xe9;&nbsp;f</article>", "T & x ab c d e ééé f"),
    ("<nav><ul><li><a href='/x'>Menu</a></ul></nav><article><p>Body</p></article><footer>&copy; me</footer>", "Body"),
    ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>x</p></article>", "Title x"),
    ("<article><p>in</p><div class='ad'>buy</div><aside>see also</aside><form>mail <input></form><p>out</p></article>", "in out"),
    ("<article><p>in</p><script>var a='</p><p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>out</p></article>", "in out"),
    ("<main><p>story</p></main><section id=comments><article class=comment><p>reader</p></article></section>", "story"),
    ("<div class='cookie-notice'>We use cookies</div><main><p>story</p><div hidden>x</div><div style='display:none'>y</div></main>", "story"),
    ("<article><p>a < b and c > d</p></article>", "a < b and c > d"),
    ("<ARTICLE><P>Upper</P></ARTICLE><FOOTER>f", "Upper"),
    ("<article><p>cut", "cut"), ("<article><p>cut <a href='", "cut"),
    ("<nav><p>never closed<article><p>text</p></article>", "text"),
    ("<article><p>one</p><ul><li><a href=1>menu</a></li></ul><p>two <a href=2>link</a></p></article>", "one menu two link"),
    ("<main><p>one</p><ul><li><a href=1>menu</a></li></ul><p>two <a href=2>link</a></p></main>", "one two link"),
    ("<article><p>Text</p><h2>References</h2><ol><li><a>First source</a></li></ol></article>", "Text References First source"),
    ("<article><h2 class='section-header'>A</h2><p class=social-science>b</p><h3 id=comment-on-law>C</h3><label>d</label></article>", "A b C d"),
    ("<article><p>in</p><div class='comment-list'>c</div><ul class='social share-buttons'><li>s</ul><p id=newsletter-signup-2>n</p><p>out</p></article>", "in out"),
    ("<form id=aspnetForm><article><p>story</p></article></form>", "story"),
    ("<div class=acme-comments><article><p>reader</p></article></div><article><p>story</p></article>", "story"),
    ("".join(f"<p>Short one {i}.</p>" for i in range(40)), " ".join(f"Short one {i}." for i in range(40))),
    (f"<nav>menu</nav><h1>Title</h1><p>By A.</p><p>Today.</p><p>Here.</p><p>{LONG}</p><footer>f</footer>", f"Title By A. Today. Here. {LONG.strip()}"),
    (f"<nav><a>Home</a><div><p>{LONG}</p></div>", LONG.strip()),
    (f"<div><ul><li><a>home and some more words</a></li></ul></div><div><p>{LONG}</p></div><div><p>tiny</p></div>", f"{LONG.strip()} tiny"),
])
def test_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("names", ["content no-sidebar", "layout has-sidebar", "with-comments", "related-layout"])
def test_wrappers_named_after_what_they_hold_keep_their_article(names):
    assert main_text(f"<div class='{names}'><div class=sidebar>side</div><article><p>story</p></article></div>") == "story"
    assert main_text(f"<div class='{names}'><div class=sidebar>side</div><p>{LONG}</p></div>") == LONG.strip()
    assert main_text("<div class=comments><article>x</article></div>") == ""


def test_broken_markup_ends():
    for page in ["<" * 3000, "<a " * 3000, "<!--" * 3000, '<p class="' * 3000, "</p>" * 3000, "<div>" * 3000 + "x"]:
        assert isinstance(main_text(page), str)
    assert [t.name for t in tokens("<p a='>'>x</p>")] == ["p", "p"]


def test_time_is_linear():
    for page in ["<div class=ad><article>" * 100_000, "<p class=ad>x" * 100_000, "<article>" + f"<p>{LONG}</p>" * 30_000]:
        began = time.monotonic()
        main_text(page)
        assert time.monotonic() - began < 30


def plain(page):
    inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.DOTALL)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner)]
    return " ".join(b for b in blocks if b)


def test_query(spark, sf):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op3_html_text"](spark, sf).collect()
    assert {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in got} == {
        i: (r["url"], plain(r["html"]), len(plain(r["html"]))) for i, r in pages.items()}


def test_rows_and_columns(spark):
    rows = [(1, None, "x"), (None, "<article>a</article>", "y"), (1, "<article>a</article>", None), (1, "<article>a</article>", None)]
    docs = spark.createDataFrame(rows, "page_id long, html string, text string")
    assert sorted((r["page_id"] is None, r["text"], r["n_chars"]) for r in extract(docs).collect()) == [(False, "", 0), (False, "a", 1), (False, "a", 1), (True, "a", 1)]
    assert extract(docs.limit(0)).count() == 0
