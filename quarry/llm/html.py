"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block of text; each line has a weight,
the length of its text if it can be content (no menu, advert, form, ... and not
made of links) and 0 otherwise.  Weights are summed over sliding windows of
lines; where the sums surge a region begins, where they dive it ends, and the
text between the two is kept, of all regions.
"""

from __future__ import annotations

import html as references
import re
from statistics import median

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common

WINDOW = 3
#: Share of a window of typical (median) lines at which a page without marked
#: content surges; no single line moves it.
SURGE = 0.2
LEAST_SURGE = 40
MOST_LINKED = 0.5

#: Elements by role (fixed lists of HTML element names).
UNSEEN = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "textarea",
          "title", "select", "audio", "video")
BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset", "search"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup",
          "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td",
          "tfoot", "th", "thead", "tr", "ul", "caption", "legend", "option"}
#: Elements whose blocks belong together.
BOXES = {"div", "section", "td", "center", "blockquote", "dd", "details", "figure"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CONTENT = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words that mark what is not content.  A class name, id, role or label marks its
#: element if it holds such a word and else only words that tell its place or form
#: ("site-footer", but not "has-sidebar" or "article-header").
MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
         "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header",
         "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination",
         "popup", "promo", "promoted", "promotion", "related", "reply", "replies", "search", "share", "sharing", "sidebar",
         "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "teaser", "toolbar", "topbar", "widget", "hidden"}

HEADS = {"header", "masthead", "banner"}
TALK = {"comment", "comments", "disqus", "reply", "replies"}
PLACES = {"site", "global", "top", "main", "primary", "secondary", "wrap", "wrapper", "container", "inner", "bar", "area", "mobile",
          "desktop", "sticky", "fixed"}
FORMS = PLACES | {"left", "right", "bottom", "box", "block", "list", "section", "slot", "unit", "buttons", "button", "links", "link",
                  "icons", "icon", "form", "posts", "stories", "articles", "items", "item", "thread", "overlay", "message", "media",
                  "email", "tools", "visually", "google", "x", "this", "our", "us", "on", "to", "the", "and", "for"}
#: Of an article's own parts these are no content.
PARTS, PART_MARKS = {"article", "entry", "page", "post"}, TALK | {"ad", "ads", "footer", "nav", "navigation", "pagination", "related",
                                                                 "share", "sharing", "social"}

_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_STOP = re.compile("[>\"']")
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in UNSEEN}
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_UNSHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Mark:
    """A marked element: why, the one around it, and whether an article or main opens
    inside it."""

    __slots__ = ("why", "outer", "article", "main", "held", "off")

    def __init__(self, why: str, outer: Mark | None):
        self.why, self.outer, self.article, self.main, self.held, self.off = why, outer, False, False, 0, False


class Line:
    """A block's text: its pieces, how many characters are links, where it lies;
    ``mark`` is the innermost marked element around it and ``box`` numbers the
    innermost open element that holds blocks."""

    __slots__ = ("pieces", "linked", "content", "off", "mark", "box")

    def __init__(self, content: bool, off: bool, mark: Mark | None, box: int):
        self.pieces, self.linked, self.content, self.off, self.mark, self.box = [], 0, content, off, mark, box


def _name_marks(name: str, inside: bool) -> str:
    """What a class name, id, role or label marks: "", "talk" or "other"."""
    words = {w.lower() for w in _WORD.findall(name)}
    marks = words & MARKS
    if not marks or inside and marks <= HEADS:  # an article's own header is content
        return ""
    beside = PLACES if marks <= HEADS else FORMS | PARTS if marks & PART_MARKS else FORMS
    return "" if words - marks - beside else "talk" if marks & TALK else "other"


def mark_of(name: str, attributes: str, inside: bool) -> str:
    """What marks an element as no content: "hidden", "talk", "other", or ""."""
    found = ""
    for attribute in _ATTRIBUTE.finditer(attributes):
        key, value = attribute[1].lower(), attribute[2] or attribute[3] or attribute[4] or ""
        if (key == "hidden" and value.lower() != "false" or key == "aria-hidden" and value.strip().lower() == "true"
                or key == "style" and _UNSHOWN.search(value)):
            return "hidden"
        if key == "id" and name in HEADINGS:  # made from the heading's text
            continue
        if key in ("class", "id", "role", "aria-label"):
            for part in value.split() if key in ("class", "role") else [value]:
                found = found or _name_marks(part, inside)
    return found


def tags_of(page: str):
    """The pieces of a page in order: (text, "", "", "") for text, and ("", "/" or "",
    name, attributes) for a tag; what nobody sees is a blank.

    Every character is looked at a bounded number of times, whatever the markup: a
    quote that never closes is a character like others, and once a tag has turned
    out to have no end because of its quotes, quotes no longer count on that page.
    """
    last = {q: page.rfind(q) for q in "\"'"}
    last_end = page.rfind(">")
    n, at, quotes = len(page), 0, True
    seek = 0
    while True:
        start = page.find("<", seek)
        unshown = start >= 0 and page.startswith(("<!--", "<![CDATA["), start)
        if start < 0 or start > last_end and not unshown:
            break
        if unshown:
            yield page[at: start], "", "", ""
            end = "-->" if page[start + 2] == "-" else "]]>"
            found = page.find(end, start + 4)
            at = seek = n if found < 0 else found + 3
            yield " ", "", "", ""
            continue
        name = _NAME.match(page, start)
        if name is None:
            seek = start + 1
            if page[seek: seek + 1] in ("!", "?", "/"):  # a declaration, or nothing
                found = page.find(">", seek)
                if found >= 0:
                    yield page[at: start], "", "", ""
                    at = seek = found + 1
            continue
        end, inside = -1, name.end()
        while quotes:
            stop = _STOP.search(page, inside)
            if stop is None:
                quotes = False
                break
            if stop[0] == ">":
                end = stop.start()
                break
            inside = stop.end() if stop.start() == last[stop[0]] else page.find(stop[0], stop.end()) + 1
        if end < 0:
            end = page.find(">", name.end())
        if end < 0:
            break
        if end > start:
            yield page[at: start], "", "", ""
        at = seek = end + 1
        low = name[2].lower()
        if low in _ENDS:
            if not name[1]:
                found = _ENDS[low].search(page, at)
                at = seek = n if found is None else found.end()
                yield " ", "", "", ""
                continue
        yield "", name[1], low, page[name.end(): end]
    tail = page[at:]
    cut = re.search(r"<[a-zA-Z/!?][^<>]*\Z", tail)  # a tag that the page's end cuts off
    yield tail[: cut.start()] if cut else tail, "", "", ""


class _Open:
    """The open elements: (name, adds to boilerplate, to content, to links, marked, a
    box), with the places of each name and of blocks, so that none is searched for."""

    def __init__(self):
        self.elements: list[tuple[str, int, int, int, int, int]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.off = self.inside = self.links = 0
        self.mark: Mark | None = None
        self.boxes = [0]

    def push(self, name: str, off: int, inside: int, why: str, box: int) -> None:
        self.places.setdefault(name, []).append(len(self.elements))
        if name in BLOCKS:
            self.blocks.append(len(self.elements))
        self.off += off
        self.inside += inside
        self.links += name == "a"
        if why:
            self.mark = Mark(why, self.mark)
        if box:
            self.boxes.append(box)
        self.elements.append((name, off, inside, name == "a", why != "", box > 0))

    def close(self, name: str) -> None:
        """Closes the innermost element of that name and all inside it, if there is one."""
        if not self.places.get(name):
            return
        first = self.places[name][-1]
        while len(self.elements) > first:
            closed, off, inside, link, marked, box = self.elements.pop()
            self.places[closed].pop()
            if closed in BLOCKS:
                self.blocks.pop()
            self.off -= off
            self.inside -= inside
            self.links -= link
            if marked:
                self.mark = self.mark.outer
            if box:
                self.boxes.pop()

    def in_paragraph(self) -> bool:
        """Whether the innermost open block is a paragraph."""
        return bool(self.blocks) and self.elements[self.blocks[-1]][0] == "p"


def lines_of(page: str) -> tuple[list[Line], list[Mark]]:
    """The lines of a page and its marked elements, in order.  A closing tag closes
    what is open inside its element, and one without an element is passed over."""
    now, lines, marks, n_boxes = _Open(), [], [], 0
    line = None
    for text, closing, name, attributes in tags_of(page):
        if not name:
            if line is None:
                if not text or not text.strip():
                    continue
                line = Line(now.inside > 0, now.off > 0, now.mark, now.boxes[-1])
                lines.append(line)
            line.pieces.append(text)
            if now.links:
                line.linked += len(text)
            continue
        if name in BLOCKS:
            line = None
        elif name == "br" and line is not None:
            line.pieces.append(" ")
        if closing:
            now.close(name)
            continue
        if name in VOID or attributes.endswith("/") and name not in BLOCKS:
            continue
        if name == "p" and now.in_paragraph():  # a paragraph ends the one before it
            now.close("p")
        off = int(name in BOILERPLATE or name == "header" and not now.inside)
        why = "" if off or name in CONTENT or name in ("body", "html") or not attributes else mark_of(name, attributes, now.inside > 0)
        if name in CONTENT and now.mark is not None:
            now.mark.main |= name == "main"
            now.mark.article |= name == "article"
        n_boxes += name in BOXES
        now.push(name, off, int(name in CONTENT), why, n_boxes if name in BOXES else 0)
        if why:
            marks.append(now.mark)
    return lines, marks


def settle(lines: list[Line], marks: list[Mark], texts: list[str]) -> None:
    """Switches off the lines in marked elements, unless the mark cannot be meant
    for them: the element holds main or most of the page's text, an article's
    included.  Comments, which can be longer than an article, and hidden elements
    stay off if there is content elsewhere; hidden ones also if they hold none.
    Articles in a lesser marked element are teasers."""
    total, elsewhere = 0, False
    for x, t in zip(lines, texts):
        if not x.off:
            total += len(t)
            elsewhere = elsewhere or bool(x.content and t and x.mark is None)
            if x.mark is not None:
                x.mark.held += len(t)
    for mark in reversed(marks):  # inner ones first
        if mark.outer is not None:
            mark.outer.held += mark.held
            mark.outer.main |= mark.main
            mark.outer.article |= mark.article
    for mark in marks:  # outer ones first
        most = 2 * mark.held > total
        meant = not (mark.held and (mark.why == "other" and (mark.main or most) or not elsewhere and (
            mark.main or most and (mark.article or mark.why != "hidden"))))
        mark.off = meant or mark.outer is not None and mark.outer.off
    for x in lines:
        x.off = x.off or x.mark is not None and x.mark.off


def weights(lines: list[Line], texts: list[str]) -> list[int]:
    """The weight of each line; if content is marked, other lines weigh nothing."""
    marked = any(x.content and not x.off and t for x, t in zip(lines, texts))
    out = []
    for x, t in zip(lines, texts):
        raw = sum(map(len, x.pieces))
        linked = not marked and raw and x.linked > MOST_LINKED * raw
        out.append(0 if x.off or linked or marked and not x.content else len(t))
    return out


def regions(w: list[int], surge: float) -> list[tuple[int, int]]:
    """(first, last) lines of the regions: a region begins at the surge point,
    the first line with weight of a window whose sum reaches ``surge``, or lines
    with weight just before it, and ends at the dive point, after which the window
    sums fall to 0 or stay under it."""
    n, found, i = len(w), [], 0
    sums = [sum(w[k: k + WINDOW]) for k in range(n)]
    while i < n:
        if sums[i] < surge or not w[i]:
            i += 1
            continue
        first = last = i
        while first and w[first - 1] and (not found or first - 1 > found[-1][1]):
            first -= 1
        while i < n and sums[i] > 0 and (sums[i] >= surge or w[i]):
            if w[i]:
                last = i
            i += 1
        found.append((first, last))
    return found


def kept_lines(w: list[int], boxes: list[int]) -> list[int]:
    """The lines of all regions of a page without marked content, and those between
    two regions that are parted by few lines or, in their own box, lie in one box."""
    typical = median(k for k in w if k)
    most = max(sum(w[k: k + WINDOW]) for k in range(len(w)))
    found = regions(w, min(most, max(LEAST_SURGE, SURGE * WINDOW * typical)))
    kept = set()
    for k, (first, last) in enumerate(found):
        kept.update(range(first, last + 1))
        if k:
            before = found[k - 1][1]
            near = first - before <= WINDOW + 1
            kept.update(i for i in range(before + 1, first) if near or boxes[i] == boxes[before] == boxes[first])
    return sorted(kept)


def main_text(page: str | None) -> str:
    """The main text of one page: blocks joined by an empty line; "" if none."""
    if not page:
        return ""
    lines, marks = lines_of(page)
    texts = [" ".join(references.unescape("".join(x.pieces)).split()) for x in lines]
    settle(lines, marks, texts)
    w = weights(lines, texts)
    if not any(w):
        return ""
    if any(x.content for x, k in zip(lines, w) if k):
        kept = [k for first, last in regions(w, 1) for k in range(first, last + 1)]
    else:
        kept = kept_lines(w, [x.box for x in lines])
    return "\n\n".join(texts[k] for k in kept if w[k] and texts[k])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html).

    A null, empty or text-free html gives an empty text.  Each row is treated by
    itself: no shuffle, and repeated rows, null ids and hot hosts cost nothing
    extra.  Other columns are not read.
    """
    common.ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))

    def texts(batches):
        for part in common.slices(batches, "html"):
            found = [main_text(page) for page in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(texts, "page_id long, url string, text string, n_chars long")
