"""Main text of web pages by line-block distribution.

Markup is stripped so that each block element gives a line; menus, notices, adverts, forms, comments and the like, known by element, role or
class, leave blank lines, and so do lines outside articles that are mostly links. Text lengths are summed over sliding windows of lines. A
region starts with the run of lines in which the sum surges and ends where it dives to nothing, and all lines between are the text. A page
with an article or main element has text lengths only inside it, and there the least text is a surge; elsewhere a surge is half of the page's
densest window, or a paragraph's worth of text if that is less.

A class or id names what an element is if it consists of such names and of words for places and boxes (``comment-list``, ``site-footer``).
One that has such a name beside other words (``has-sidebar``, ``comment-on-law``) is a hint, which counts outside articles only. If
a page has no article then, an element that is only hinted at, a form or one that is never closed stays if it holds an article or most of the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm._runtime import tuned

WINDOW = 3
SURGE = 80

TOKEN = re.compile(
    r"<!--(?:.*?-->|>|->)|<!--.*\Z|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*>|</?[a-zA-Z][^>]*\Z", re.DOTALL)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = set("script style noscript template svg math iframe object canvas audio video textarea title select xmp noembed noframes".split())
GONE = set("head nav footer aside form button dialog menu datalist".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html "
    "legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
OPEN_ENDED = {"p", "dt", "dd", "td", "th", "tr", "option"}
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense adslot adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead topbar header footer comment comments disqus respond replies share sharing social "
    "related recommended login signin signup search pagination pager widget alert toolbar teaser".split())
OWN = set("article entry post content story main body page".split())
PLACES = OWN | set(
    "area bar block bottom box button buttons container count feed form global group head home icons inline inner item items js left link links list message name outer panel "
    "posts primary reader readers right row secondary section site slot thread title top unit user users view wrap wrapper zone".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
STAYS, HINT, SURE = 0, 1, 2


class Token(NamedTuple):
    start: int
    end: int
    close: bool
    name: str
    attributes: str


def tokens(page: str) -> list[Token]:
    """Tags and comments; the content of raw elements is inside its tag."""
    out, at = [], 0
    while (m := TOKEN.search(page, at)) is not None:
        at, name = m.end(), (m[2] or "").lower()
        if name in RAW and not m[1] and not (m[3] or "").rstrip().endswith("/"):
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else len(page)
            out.append(Token(m.start(), at, False, "", ""))
        else:
            out.append(Token(m.start(), at, bool(m[1]), name, m[3] or ""))
    return out


def judged(tag: Token, in_article: bool) -> int:
    """Whether an element is no part of an article: ``SURE`` by element, role or name, ``HINT`` if a class or id only contains a name."""
    if tag.name in GONE or tag.name in ("header", "label") and not in_article:
        return SURE
    if not tag.attributes or tag.name in ("html", "body", "main"):
        return STAYS
    values = {k.lower(): (a or b or c or "").lower() for k, a, b, c in ATTRIBUTE.findall(tag.attributes)}
    if "hidden" in values or values.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", values.get("style", "")):
        return SURE
    if values.get("role", "") in ROLES:
        return SURE
    verdict = STAYS
    for token in f"{values.get('class', '')} {values.get('id', '')}".split():
        parts = {p for p in re.split(r"[^a-z0-9]+", token) if p and not p.isdigit()}
        found = parts & NAMES
        if not found or found <= {"header", "banner", "body"} and parts & OWN or in_article and (found == {"header"} or tag.name in HEADINGS and parts != found):
            continue
        verdict = max(verdict, SURE if parts <= NAMES | PLACES else HINT)
    return verdict


class Page:
    """A page's tags, for each the last tag of its element, and what elements hold. Linear in the page."""

    def __init__(self, page: str) -> None:
        self.tags = tags = tokens(page)
        n = len(tags)
        self.last = list(range(n))
        self.closed = [True] * n
        # Where the next article starts, and the next block, seen from after each tag.
        article, block = [n] * (n + 1), [n] * (n + 1)
        for k in range(n - 1, -1, -1):
            name = tags[k].name
            article[k] = k if name in ("article", "main") and not tags[k].close else article[k + 1]
            block[k] = k if name in BLOCK and name != "br" else block[k + 1]
        self.article = article
        waiting: dict[str, list[int]] = {}
        for k, tag in enumerate(tags):
            if not tag.name or tag.name in VOID:
                continue
            if tag.name in OPEN_ENDED:
                if not tag.close:
                    end = block[k + 1]
                    self.last[k] = end if end < n and tags[end].close and tags[end].name == tag.name else end - 1
            elif not tag.close:
                waiting.setdefault(tag.name, []).append(k)
            elif waiting.get(tag.name):
                self.last[waiting[tag.name].pop()] = k
        # One that isn't closed ends at an article or with the page.
        for k in (k for rest in waiting.values() for k in rest):
            self.last[k], self.closed[k] = article[k + 1] - 1, False
        self.text = [0]
        for tag, following in zip(tags, [*(t.start for t in tags[1:]), len(page)]):
            self.text.append(self.text[-1] + len(page[tag.end : following].strip()))

    def gone(self, at: int, in_article: bool, lenient: bool) -> bool:
        """Whether the element is left out; ``lenient`` keeps a doubtful one that holds an article or most of the page's text."""
        tag = self.tags[at]
        verdict = judged(tag, in_article)
        if verdict == STAYS or verdict == HINT and in_article:
            return False
        if not lenient or verdict == SURE and tag.name != "form" and self.closed[at]:
            return True
        last = self.last[at]
        return self.article[at + 1] > last and 2 * (self.text[last] - self.text[at]) <= self.text[-1]


class Line(NamedTuple):
    text: str
    size: int


def lines(page: str, known: Page, lenient: bool = False) -> tuple[list[Line], bool]:
    """A line for each block with its text and the size that counts for it, blank lines for what is removed, and whether there is an article."""
    tags = known.tags
    out: list[Line] = []
    parts: list[str] = []
    linked = inside = articles = link = listed = 0

    def flush(blank: int = 0) -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            menu = 2 * linked > len(text) and not articles and (listed or not inside)
            out.append(Line("" if menu else text, 0 if menu or found and not inside else len(text)))
        parts.clear()
        linked = 0
        out.extend([Line("", 0)] * blank)

    # An article that is itself a comment or an advert is no article.
    found, k = False, 0
    while k < len(tags):
        if tags[k].name and not tags[k].close:
            if known.gone(k, False, lenient):
                k = known.last[k]
            elif tags[k].name in ("article", "main"):
                found = True
                break
        k += 1
    at, k = 0, 0
    while k <= len(tags):
        stop = tags[k].start if k < len(tags) else len(page)
        if stop > at:
            parts.append(page[at:stop])
            if link:
                linked += len(page[at:stop].strip())
        if k == len(tags):
            break
        tag = tags[k]
        at = tag.end
        if tag.name and not tag.close and known.gone(k, inside > 0, lenient):
            if tag.name in BLOCK:
                flush(WINDOW)
            k = known.last[k]
            at = tags[k].end
            k += 1
            continue
        if tag.name == "a":
            link = 0 if tag.close else 1
        elif tag.name in BLOCK:
            flush()
            link = 0
            step = -1 if tag.close else 1
            if tag.name in ("article", "main"):
                inside = max(0, inside + step)
                articles = max(0, articles + step) if tag.name == "article" else articles
                out.extend([Line("", 0)] * (WINDOW if not inside else 0))
            elif tag.name in ("ul", "ol"):
                listed = max(0, listed + step)
        k += 1
    flush()
    return out, found


def main_text(page: str | None) -> str:
    """The text of the article, its blocks joined by one space; empty if there is none."""
    if not page:
        return ""
    known = Page(page)
    rows, found = lines(page, known)
    return region(*(rows, found) if found else lines(page, known, lenient=True))


def region(rows: list[Line], found: bool) -> str:
    sums, total = [], 0
    sizes = [r.size for r in rows] + [0] * WINDOW
    total = sum(sizes[:WINDOW])
    for i in range(len(rows)):
        sums.append(total)
        total += sizes[i + WINDOW] - sizes[i] if i + WINDOW < len(sizes) else -sizes[i]
    surge = 1 if found else max(1, min(SURGE, max(sums, default=0) // 2))
    kept: list[str] = []
    i = done = 0
    while i < len(rows):
        if sums[i] < surge:
            i += 1
            continue
        # The rise to the surge may begin with short lines.
        while i > done and sizes[i - 1]:
            i -= 1
        while i < len(rows) and sums[i] > 0:
            if rows[i].text and (rows[i].size or not found):
                kept.append(rows[i].text)
            i += 1
        done = i
    return " ".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The input's rows with ``text`` and ``n_chars`` (its code points); columns of these names are replaced.

    Null and empty pages, and pages without text outside menus and the like, give the empty text. The work is linear in a page, however long or
    broken it is. Rows are independent: repeated rows, null ids and an empty table need no care.
    """
    tuned(pages.sparkSession)
    others = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py()) for v in batch.column(len(others))]
            yield pa.record_batch([*(batch.column(i) for i in range(len(others))), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                  names=[*others, "text", "n_chars"])
    slim = pages.select(*(F.col(f"`{c}`") for c in others), F.col(f"`{html_col}`").cast("string"))
    fields = ", ".join(f"`{c}` {t}" for c, t in slim.select(*(F.col(f"`{c}`") for c in others)).dtypes)
    return slim.mapInArrow(run, ", ".join(filter(None, [fields, "text string, n_chars long"])))
