"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's parser streams events; block elements end lines. A line's ratio is its
characters of text, those in links aside, to its tags. Ratios are smoothed by a Gaussian over the
neighbouring lines and a threshold, taken from the page's own spread, marks the lines that are
content. Marked lines vote for the containers they stand in, an article before a plain container.
All outermost containers of the best kind that have votes are elected, and a part takes the place
of its container only if it has all of the votes. They give all of their lines, short ones too, but
those within menus, forms and the like. If that is the page itself, it gives the lines from its
first to its last marked one, and all of the containers that these two stand in.

Menus, scripts and reader comments are left out as they are read. Other parts that a name or a form
sets apart are read with their lines, and stay if the ratios say so: a form, or a part that is named
like an article too, with over half of the page's marked text, a part named by layout words alone
with nearly all of it, and a part with other words in its name if its own text is mostly marked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed names of HTML elements, and of words in class, id and role that mark what isn't content.
HIDDEN = {"script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "head", "title"}
ASIDE = {"nav", "footer", "aside", "button", "select", "textarea", "menu", "dialog", "datalist"}
FORMS = {"form", "fieldset"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "masthead",
    "menu", "menubar", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pagination",
    "popup", "promo", "promoted", "promotion", "related", "replies", "respond", "search", "share", "sharing", "sidebar",
    "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
COMMENT_WORDS = {"comment", "comments", "disqus", "replies", "respond"}
ARTICLE_WORDS = {"article", "articlebody", "main", "post", "story", "entry", "content", "maincontent"}
# With the words above these make up the names of a layout, as in site-footer. An id with any other word is the slug of
# a title, and says nothing; a class with any other word says little.
LAYOUT_WORDS = {
    "all", "also", "area", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "center", "col",
    "column", "container", "count", "cta", "fixed", "form", "global", "group", "header", "heading", "icon", "icons",
    "inline", "inner", "item", "items", "label", "latest", "left", "link", "links", "list", "message", "middle", "mobile",
    "modal", "module", "more", "outer", "overlay", "page", "panel", "popular", "posts", "primary", "recent", "right",
    "row", "secondary", "section", "site", "slot", "sticky", "stories", "text", "thread", "title", "top", "unit", "us",
    "widgets", "wrap", "wrapper",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# An end tag of an inline element, paragraph or list item doesn't reach beyond these.
REGIONS = {"article", "main", "section", "div", "td", "body", "nav", "aside", "footer", "form"}
#: Lines to each side that smoothing reaches, and its spread.
REACH, SPREAD = 2, 1.0
#: Share of the page's marked text from which a form, or a part named like an article too, stays, and a part with
#: layout names alone; share of a part's own text that must be marked where its name has other words.
HALF, NEARLY_ALL, MOSTLY = 0.5, 0.9, 0.5


def says(name: str) -> str:
    """What a class, role or property says: ``aside`` or ``article`` if all its words are of a layout,
    ``comment`` if they are of reader comments, ``unsure`` if an aside's word is among others, or nothing."""
    words = {w for w in re.split("[^a-z]+", re.sub("[a-z]*[0-9][a-z0-9]*", " ", name)) if w}
    layout = words <= ASIDE_WORDS | ARTICLE_WORDS | LAYOUT_WORDS
    if words & ASIDE_WORDS:
        return "unsure" if not layout else "comment" if words & COMMENT_WORDS else "aside"
    return "article" if layout and words & ARTICLE_WORDS else ""


class Lines(HTMLParser):
    """Collects ``(text, tags, linked characters, container, part)`` for each block of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, int]] = []  # element, left out, container, part
        self.places: dict[str, list[int]] = {}  # of each element's open ones, in order
        self.kinds = [0]  # of containers: 0 plain, 1 named like an article, 2 article or main
        self.parents = [0]
        self.page = {0}  # containers that are the whole page
        self.apart = [(0, "")]  # parts set apart: the one around it, and what sets it apart; 0 is none
        self.lines: list[tuple[str, int, int, int, int]] = []
        self.begin()

    def begin(self) -> None:
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.part: int | None = None

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            container = self.open[-1][2] if self.open else 0
            self.lines.append((text, self.tags, self.linked, container, self.part or 0))
        self.begin()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if tag in VOID:
            self.parts.append(" " if tag in ("br", "hr") else "")
            return
        if tag == "p":  # a paragraph ends the one that is open
            self.end_element("p", {"article", "section", "div", "main", "td", "li", "blockquote", "body"})
        elif tag == "li":
            self.end_element("li", {"ul", "ol", "menu"})
        _, out, container, part = self.open[-1] if self.open else ("", False, 0, 0)
        given = dict(attrs)
        names = " ".join(given.get(k) or "" for k in ("class", "role", "itemprop")).lower().split()
        names = [n for n in names if not n.startswith(("with-", "has-", "no-"))]
        words = {w for n in names for w in re.split("[^a-z0-9]+", n)}
        own = {w for w in re.split("[^a-z0-9]+", (given.get("id") or "").lower()) if w and not w.isdigit()}
        if tag not in HEADINGS and own <= ASIDE_WORDS | ARTICLE_WORDS | LAYOUT_WORDS:
            words |= own
            names.append(" ".join(own))
        article = tag in ("article", "main") or "articlebody" in words
        why = ""
        if tag in HIDDEN or tag in ASIDE or "hidden" in given or given.get("aria-hidden") == "true":
            out = True
        elif tag == "header" and not (self.open and self.kinds[container] == 2):
            out = True
        elif tag not in ("html", "body", "article", "main"):
            said = {says(n) for n in names}
            if "comment" in said and "article" not in said:
                out = True
            elif said & {"aside", "comment"}:
                why = "both" if "article" in said else "aside"
            elif "unsure" in said and "article" not in said:
                why = "unsure"
            why = why or ("form" if tag in FORMS else "")
        if why and not out:
            if tag in BLOCKS:
                self.apart.append((part, why))
                part = len(self.apart) - 1
            else:  # its line goes on without it
                out = True
        if tag in ("article", "main", "section", "div", "td", "body"):
            # a body's classes name the kind of page, not a region
            self.kinds.append(2 if article else 1 if words & ARTICLE_WORDS and tag != "body" else 0)
            self.parents.append(container)
            container = len(self.kinds) - 1
            if tag == "body":
                self.page.add(container)
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, out, container, part))

    def end_element(self, tag: str, stop: set[str]) -> None:
        """End the innermost open ``tag``, unless one of ``stop`` is in between."""
        at = self.places.get(tag)
        if not at or any(self.places[s][-1] > at[-1] for s in stop if self.places.get(s)):
            return
        for name, *_ in self.open[(first := at[-1]) :]:
            self.places[name].pop()
        del self.open[first:]

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        small = tag not in BLOCKS or tag in ("p", "li")
        self.end_element(tag, REGIONS if small else set())

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        _, out, _, part = self.open[-1] if self.open else ("", False, 0, 0)
        if out:
            return
        if self.part not in (None, part):  # an end tag out of order has left the part within a line
            self.end_line()
        self.part = part
        self.parts.append(data)
        if self.places.get("a"):
            self.linked += len(data)


def plain(line: tuple[str, int, int, int, int]) -> int:
    """Characters of a line that aren't in links."""
    return max(len(line[0]) - line[2], 0)


def sums(own: dict[int, int], parents: list[int]) -> dict[int, int]:
    """Numbers of nodes with those of all within them; parents come before their parts, 0 is around all."""
    total = {0: 0, **own}
    for k in range(len(parents) - 1, 0, -1):
        if k in total:
            total[parents[k]] = total.get(parents[k], 0) + total[k]
    return total


def shown(parser: Lines) -> list[tuple[str, int, int, int, int]]:
    """The lines that stand in no part set apart, or in one that the ratios take for content."""
    if len(parser.apart) == 1 or not parser.lines:
        return parser.lines
    good, whole = {}, {}
    for line, mark in zip(parser.lines, marked(parser.lines)):
        whole[line[4]] = whole.get(line[4], 0) + plain(line)
        good[line[4]] = good.get(line[4], 0) + plain(line) * bool(mark)
    around = [a for a, _ in parser.apart]
    good, whole = sums(good, around), sums(whole, around)
    stays = [True]
    for k, (outer, why) in enumerate(parser.apart[1:], 1):
        own, share = good.get(k, 0), {"form": HALF, "both": HALF, "aside": NEARLY_ALL}.get(why)
        enough = own > share * good[0] if share else own > MOSTLY * whole.get(k, 0)
        stays.append(stays[outer] and enough)
    return [line for line in parser.lines if stays[line[4]]]


def marked(lines: list[tuple[str, int, int, int, int]]) -> np.ndarray:
    """Which lines the smoothed text-to-tag ratio takes for content."""
    ratio = np.array([(len(t) - min(linked, len(t))) / max(tags, 1) for t, tags, linked, *_ in lines])
    weights = np.exp(-(np.arange(-REACH, REACH + 1) ** 2) / (2 * SPREAD**2))
    padded = np.pad(ratio, REACH)
    shares = np.convolve(np.pad(np.ones(len(ratio)), REACH), weights, mode="valid")
    smooth = np.convolve(padded, weights, mode="valid") / shares
    return smooth >= min(smooth.std(), smooth.mean())


def main_text(html: str | None) -> str:
    """The main text: blocks in page order, one line each; empty if there is none."""
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    parser.end_line()
    lines = shown(parser)
    if not lines:
        return ""
    content = marked(lines)
    own: dict[int, int] = {}
    for line, good in zip(lines, content):
        if good:
            own[line[3]] = own.get(line[3], 0) + plain(line)
    votes = sums(own, parser.parents)  # a container answers for those within it
    best = max((parser.kinds[c] for c, v in votes.items() if v), default=0)
    parts: dict[int, list[int]] = {}
    for c in votes:
        if c and parser.kinds[c] >= best:
            parts.setdefault(parser.parents[c], []).append(c)
    elected: set[int] = set()
    seen: set[int] = set()  # outermost containers of the best kind and their parts
    within: set[int] = set()  # what is elected and its parts
    for c, parent in enumerate(parser.parents):  # parents come before their parts
        if parent in seen:
            seen.add(c)
            within |= {c} if parent in within else set()
        elif parser.kinds[c] == best and (votes.get(c) or not votes[0]):
            seen.add(c)
            chosen = c
            while inner := [x for x in parts.get(chosen, []) if votes[x] == votes[c] > 0]:
                chosen = inner[0]
            elected.add(chosen)
            within.add(chosen)
    rows = [k for k, line in enumerate(lines) if line[3] in within]
    if elected & parser.page:  # no region of its own: from the first to the last marked line
        good = [k for k in rows if content[k]]
        ends = {lines[k][3] for k in (good[0], good[-1])} - parser.page
        good += [k for k in rows if lines[k][3] in ends]
        first, last = min(good), max(good)
        rows = [k for k in rows if first <= k <= last]
    return "\n".join(lines[k][0] for k in rows)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages(page_id, url, html)``.

    A null or empty page has an empty text; repeated rows give equal rows; character references
    are decoded, white space within a block becomes one space; markup that never ends is read as
    far as it goes. Other columns are ignored.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column(2).to_pylist()]
            columns = [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(read, f"page_id {kind}, url string, text string, n_chars long")
