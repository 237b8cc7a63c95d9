"""Main text of web pages as a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score above zero and tags below, by
how often labelled pages have them inside and outside the content; a linear scan
finds the contiguous region of the highest sum. Inside the region, text of
elements that are never content (menus, forms, adverts, comments and so on) is
left out, and the rest is joined block by block.

A page is labelled when it marks its content itself with ``article`` or ``main``.
The weights are fitted on at most ``fit_pages`` labelled pages, chosen by a hash of
the page; every page is then extracted whole.

Defined cases: null or empty html has an empty text; a page without tags is one
block; unclosed elements end where HTML lets them, at the latest with the element
around them or the page; a table without labelled pages is scored with words 1 and tags just below 0.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names and name parts.
CONTENT = {"article", "main"}
NEVER = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "svg", "object",
         "canvas", "audio", "video", "map", "datalist", "fieldset"}
NEVER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert",
               "alertdialog", "menu", "menubar"}
NEVER_PARTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
               "promotion", "banner", "nav", "navbar", "navigation", "menu", "menus", "breadcrumb", "breadcrumbs",
               "header", "masthead", "footer", "sidebar", "aside", "widget", "cookie", "cookies", "consent",
               "notice", "notices", "gdpr", "popup", "modal", "newsletter", "subscribe", "subscription", "signup",
               "login", "search", "share", "sharing", "social", "related", "recommended", "recommendations",
               "comment", "comments", "disqus", "respond", "reply", "replies", "pagination", "pager", "toolbar",
               "copyright", "disclaimer", "alert", "skip"}
# The head of an article is content where its class says whose head it is.
HEADS, HEADED = {"header", "masthead"}, {"article", "post", "content", "entry", "story"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl",
          "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "header", "hr", "html", "legend", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table",
          "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
# What ends where another one begins or its group ends, if it is not closed before.
OPEN_ENDED = {"p", "li", "dd", "dt", "td", "th", "tr"}
GROUPS = {"ul", "ol", "dl", "table"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

PIECES = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|noscript|template|textarea|iframe|svg|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.I | re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
# Words of a class that tell what a wrapper has, what it is about or what state it is in, not what it is.
STATES, STATE_ENDS = {"has", "with", "no", "category", "tag", "type", "status", "format"}, {"open", "closed"}
# What an end tag closes only inside one cell or table.
CELLS = {"table", "caption", "td", "th"}
TABLE = CELLS | {"tr", "tbody", "thead", "tfoot"}
# Least and most words that a tag counts against.
EPSILON, TAG_WORDS = 1e-3, 3.0


def never_content(name: str, attributes: str) -> bool:
    if name in NEVER:
        return True
    if not attributes or name in ("html", "body"):
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "role":
            if value in NEVER_ROLES:
                return True
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        elif key in ("class", "id"):
            for word in value.split():
                parts = re.split(r"[-_:]+", word)
                told = parts[:next((i for i, p in enumerate(parts) if p in STATES), len(parts))]
                named = [p for i, p in enumerate(told) if p in NEVER_PARTS
                         and not (p in HEADS and i and told[i - 1] in HEADED)]
                if named and parts[-1] not in STATE_ENDS:
                    return True
    return False


def _encloses(outer: list[str], name: str) -> bool:
    """Whether an end tag closes one of the open elements ``outer``, which then ends all that is open inside."""
    for open_name in reversed(outer):
        if open_name == name:
            return True
        if open_name in CELLS and name not in TABLE:
            return False
    return False


def _implied_end(skipped: str, name: str, closing: bool, groups: int) -> bool:
    """Whether a tag ends an element that was not closed: a block ends a paragraph, an item ends an item."""
    if skipped == "p":
        return name in BLOCKS and not (closing and name == "p")
    return skipped in OPEN_ENDED and groups == 0 and (name in GROUPS if closing else name == skipped)


def events(page: str) -> Iterator[tuple[str, str, bool]]:
    """(kind, value, content) in page order; kind: ``word`` text, ``open`` or ``close`` tag.

    ``content`` is false inside elements that are never content, their own tags included.
    """
    at, skipped, groups = 0, "", 0
    outer: list[str] = []  # Open blocks outside of what is skipped.
    inside: Counter = Counter()  # Open elements inside of it.
    for m in PIECES.finditer(page):
        if m.start() > at:
            yield "word", page[at:m.start()], not skipped
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        closing = bool(m[2])
        if skipped:
            if name in CONTENT and not closing or _implied_end(skipped, name, closing, groups):
                skipped = ""
            elif closing and not inside[name] and name != skipped and _encloses(outer, name):
                skipped = ""
            else:
                groups += (name in GROUPS) * (-1 if closing else 1)
                if not closing:
                    inside[name] += name not in VOID
                    continue
                if inside[name] or name != skipped:
                    inside[name] -= inside[name] > 0
                    if name in GROUPS and groups <= 0:
                        for item in OPEN_ENDED:
                            inside[item] = 0
                    continue
                skipped = ""
                yield "close", name, False
                continue
        if not closing and name not in VOID and never_content(name, m[4]):
            skipped, groups = name, 0
            inside.clear()
            yield "open", name, False
            continue
        if name in BLOCKS and name != "p" and name not in VOID:
            if closing:
                if _encloses(outer, name):
                    while outer.pop() != name:
                        pass
            else:
                if outer and outer[-1] == name and name in OPEN_ENDED:
                    outer.pop()
                outer.append(name)
        yield "close" if closing else "open", name, True
    if at < len(page):
        yield "word", page[at:], not skipped


def count(pages: list[str]) -> Counter:
    """How often tags and words (by block) are inside and outside the content of labelled pages."""
    found: Counter = Counter()
    for page in pages:
        depth, block = 0, "body"
        for kind, value, content in events(page):
            if kind == "word":
                found["word", block, depth > 0] += len(value.split()) if content else 0
            elif content:
                depth -= kind == "close" and value in CONTENT and depth > 0
                found["tag", value, depth > 0] += 1
                depth += kind == "open" and value in CONTENT
                block = value if kind == "open" and value in BLOCKS else block
    return found


class Weights:
    """Words: log-odds scaled into (0, 1]. Tags: log-odds below zero, no more than ``TAG_WORDS`` words each.

    Marks of content, and tags inside what they mark, count just below zero.
    """

    def __init__(self, counts: dict[tuple[str, str, bool], int]):
        odds = {(kind, name): math.log((counts.get((kind, name, True), 0) + 1)
                                       / (counts.get((kind, name, False), 0) + 1)) for kind, name, _ in counts}
        top = max([1e-9, *(v for (kind, _), v in odds.items() if kind == "word")])
        self.words = {name: min(1.0, max(0.05, v / top)) for (kind, name), v in odds.items() if kind == "word"}
        self.tags = {name: max(-TAG_WORDS, min(-EPSILON, v)) for (kind, name), v in odds.items()
                     if kind == "tag" and name not in CONTENT}

    def region(self, found: list[tuple[str, str, bool]]) -> tuple[int, int]:
        """First and last + 1 event of the highest sum, in one scan; the longer region of equal ones."""
        best, best_at, total, begin, block, depth = 0.0, (0, 0), 0.0, 0, "body", 0
        for i, (kind, value, content) in enumerate(found):
            if kind == "word":
                score = len(value.split()) * self.words.get(block, 1.0) if content else 0.0
            else:
                score = -EPSILON if depth else self.tags.get(value, -EPSILON)
                if content and value in CONTENT:
                    depth = max(0, depth + (1 if kind == "open" else -1))
                block = value if kind == "open" and value in BLOCKS else block
            if total < 0:
                total, begin = 0.0, i
            total += score
            if total > 0 and total >= best:
                best, best_at = total, (begin, i + 1)
        return best_at


def main_text(page: str | None, weights: Weights) -> str:
    found = list(events(page or ""))
    begin, end = weights.region(found)
    blocks, parts = [], []
    for kind, value, content in [*found[begin:end], ("open", "p", True)]:
        if kind == "word":
            if content:
                parts.append(html.unescape(value))
        elif value in BLOCKS or not content:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(text)
            parts = []
        elif value == "br":
            parts.append(" ")
    return "\n\n".join(blocks)


def fit(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", fit_pages: int = 2000) -> Weights:
    """Weights from at most ``fit_pages`` labelled pages; the driver gets one row per tag or block name."""
    labelled = pages.select(F.xxhash64(F.col(id_col), F.col(html_col)).alias("_place"), F.col(html_col).alias("_html"))
    labelled = labelled.filter(F.col("_html").rlike(r"(?i)<(article|main)\b"))
    chosen = labelled.select("_place").distinct().orderBy("_place").limit(fit_pages)

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = count(list(batch["_html"]))
            yield pd.DataFrame([(*k, v) for k, v in found.items()], columns=["kind", "name", "inside", "n"])

    rows = (labelled.join(F.broadcast(chosen), "_place").mapInPandas(counts, "kind string, name string, inside boolean, n long")
            .groupBy("kind", "name", "inside").agg(F.sum("n").alias("n")).collect())
    return Weights({(r["kind"], r["name"], r["inside"]): r["n"] for r in rows})


def extractor(pages: DataFrame, weights: Weights):
    """A column function from html to main text."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        for batch in batches:
            yield batch.map(lambda page: main_text(page, known))

    return extract


def extract(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", name: str = "text",
            fit_pages: int = 2000) -> DataFrame:
    """``pages`` plus the column ``name`` with the main text; an input column of that name is replaced."""
    text: Column = extractor(pages, fit(pages, html_col, id_col, fit_pages))(F.col(html_col))
    return pages.withColumn(name, text)
