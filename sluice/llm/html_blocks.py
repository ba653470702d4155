"""HTML extraction: two-pass block rules.

A page is cut into blocks at block-level tags. What stands in menus, forms, scripts and the
like, by tag, role or the words of an id or class, is no candidate. The first pass decides
the others by length, link density and the share of stop words: good, near good, short or
bad. In the second, short and near-good blocks inherit from their nearest decided
neighbours on both sides; a heading from the next one. Inside an article (or main) element
prose needs no stop words, and neighbours are looked for within the element; where such
elements hold most of the candidate text, all outside them is bad.

Character references are decoded, white space inside a block becomes one space, blocks are
joined in page order by one space. A null, empty or textless page gives an empty text. Pages
are read whole, in one pass; broken markup (tags never closed, quotes left open, '</p>' in a
script) is read as browsers do as far as this needs. Repeated rows get equal texts, a null
page_id or url stays null, extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, batch, table

#: Common words of the languages that the pages are written in; a parameter of ``extract``.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he in is it its not of on or she that the their they this to was we were which with you "
    "au aux avec ce dans de des du elle en est et il la le les ne ou par pas pour que qui se son sur un une "
    "auf das dem den der die ein eine er es für ich im ist mit nicht sich sie sind um und von war wie zu zum "
    "al como con del el ella es esta los las lo más no para pero por se sin su sus un una y".split()
)
#: Characters of a short and of a long block, stop-word shares of prose, link shares too high for text.
SHORT, LONG, SOME_STOP, MUCH_STOP, LINKS = 70, 200, 0.1, 0.2, 0.33

#: Elements whose content is never shown as text; read as characters up to their end tag.
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"}
#: Elements that hold no article text.
BOILER = {"nav", "footer", "aside", "form", "button", "select", "datalist", "template", "dialog", "menu", "noscript", "svg", "math", "canvas", "object", "audio", "video", "map"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that a sibling of the same kind closes.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "a": {"a"}}
ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search", "tooltip"}
#: Words of ids and classes that name something else than the article; the latter kind holds at any depth.
LAYOUT_WORDS = {"bottombar", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "menu", "menubar", "nav", "navbar", "navigation", "sidebar", "sidenav", "toolbar", "topbar", "topnav"}
OTHER_WORDS = {
    "ad", "ads", "adsbygoogle", "advert", "advertisement", "advertising", "adverts", "banner", "comment", "commentlist", "comments", "consent", "cookie", "cookies", "copyright", "disclaimer", "disqus", "gdpr", "login", "modal", "newsletter", "notice", "notices", "overlay", "pager",
    "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "respond", "share", "sharing", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "widget", "widgets",
}
_OWN_HEADER = {"article", "entry", "post", "story", "title", "headline"}
_NEGATED = {"has", "no", "with", "without"}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_ENDS = {name: re.compile(rf"</{name}[\s/>]", re.IGNORECASE) for name in RAW}


class Block:
    """A run of text between block-level tags."""

    __slots__ = ("text", "linked", "heading", "candidate", "region", "label")

    def __init__(self, text: str, linked: int, heading: bool, candidate: bool, region: int):
        self.text, self.linked, self.heading, self.candidate, self.region, self.label = text, linked, heading, candidate, region, ""


class _Open:
    __slots__ = ("name", "boiler", "region", "heading")

    def __init__(self, name: str, boiler: str, region: int, heading: bool):
        self.name, self.boiler, self.region, self.heading = name, boiler, region, heading


def _boiler(name: str, attributes: str, in_article: bool) -> str:
    """'' for an element that may hold article text; 'layout' where an article inside would undo it; else 'other'."""
    kind = ""
    if name in BOILER or (name == "header" and not in_article):
        kind = "layout" if name in ("form", "header", "noscript") else "other"
    if not attributes.strip() or kind == "other" or name in ("html", "body"):
        return kind
    for a in _ATTRIBUTE.finditer(attributes):
        key, value = a[1].lower(), (a[2] or "").strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return "other"
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return "other"
        if name == "main":
            continue
        if key == "role" and value.lower() in ROLES:
            kind = "layout" if value.lower() in ("form", "banner") else "other"
        elif key in ("class", "id"):
            for one in value.split():
                words = [w.lower() for w in _PARTS.findall(one)]
                if not words or words[0] in _NEGATED:
                    continue
                if not OTHER_WORDS.isdisjoint(words):
                    return "other"
                if not LAYOUT_WORDS.isdisjoint(words) and not ("header" in words and (in_article or not _OWN_HEADER.isdisjoint(words))):
                    kind = "layout"
    return kind


def blocks(page: str) -> list[Block]:
    """The blocks of a page in their order."""
    out: list[Block] = []
    stack: list[_Open] = []
    count: Counter[str] = Counter()  # open elements by name
    boiler = 0
    pieces: list[str] = []
    linked = regions = pos = 0
    tag = _TAG

    def close_block():
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                top = stack[-1] if stack else None
                out.append(Block(text, linked, bool(top and top.heading), not boiler, top.region if top else 0))
            pieces.clear()
        linked = 0

    def pop():
        nonlocal boiler
        if stack[-1].boiler:
            close_block()
        gone = stack.pop()
        count[gone.name] -= 1
        boiler -= bool(gone.boiler)

    def add(text: str):
        nonlocal linked
        if "&" in text:
            text = html.unescape(text)
        pieces.append(text)
        if count["a"]:
            linked += len("".join(text.split()))

    n = len(page)
    while pos < n:
        at = page.find("<", pos)
        if at < 0:
            add(page[pos:])
            break
        if at > pos:
            add(page[pos:at])
        nxt = page[at + 1 : at + 2]
        if page.startswith("<!--", at):
            end = page.find("-->", at + 2)
            pos = end + 3 if end >= 0 else n
            continue
        if nxt in ("!", "?") or (nxt == "/" and not page[at + 2 : at + 3].isalpha()):
            end = page.find(">", at)
            pos = end + 1 if end >= 0 else n
            continue
        if not (nxt == "/" or ("a" <= nxt.lower() <= "z" and nxt.isascii())):
            add("<")
            pos = at + 1
            continue
        m = tag.match(page, at)
        if m is None and tag is _TAG:  # a quote is open to the end: from here on quotes are characters
            tag = _PLAIN_TAG
            m = tag.match(page, at)
        if m is None:
            break  # a tag is open to the end
        pos = m.end()
        name, attributes = m[2].lower(), m[3]
        if m[1]:
            if name in BLOCK:
                close_block()
            if count[name]:
                while stack[-1].name != name:
                    pop()
                pop()
            continue
        if name in RAW:
            end = _ENDS[name].search(page, pos)
            if end is None:
                break
            close = page.find(">", end.start())
            pos = close + 1 if close >= 0 else n
            continue
        if name == "br":
            add(" ")
            continue
        block = name in BLOCK
        if block:
            close_block()
            while stack and (stack[-1].name == "p" or (stack[-1].name == "a" and len(stack) > 1 and stack[-2].name == "p")):
                pop()
        if name in SIBLINGS:
            while stack and stack[-1].name in SIBLINGS[name]:
                pop()
        if name in VOID:
            continue
        above = stack[-1] if stack else None
        region, heading = (above.region, above.heading) if above else (0, False)
        kind = _boiler(name, attributes, region > 0)
        if name in ("article", "main"):
            if not kind:
                for e in stack:
                    if e.boiler == "layout":
                        e.boiler = ""
                        boiler -= 1
            regions += 1
            region = regions
        if block or kind or name == "a":
            if kind:
                close_block()
            stack.append(_Open(name, kind, region, name in HEADINGS or (heading and not block)))
            count[name] += 1
            boiler += bool(kind)
    close_block()
    return out


def _first_pass(b: Block, stop: frozenset[str]) -> str:
    size = len(b.text)
    if b.text.startswith("©") or b.linked > LINKS * size:
        return "bad"
    if b.heading:
        return "heading"
    if size < SHORT:
        return "bad" if b.linked and not b.region else "short"
    if b.region:
        return "good"
    words = [w for w in (_EDGES.sub("", x).lower() for x in b.text.split()) if w]
    share = sum(w in stop for w in words) / len(words) if words else 0.0
    if share < SOME_STOP:
        return "bad"
    return "good" if share >= MUCH_STOP and size > LONG else "near"


def classify(found: list[Block], stop: frozenset[str] = STOP_WORDS) -> list[Block]:
    """The good blocks, in page order."""
    shown = [b for b in found if b.candidate]
    inside = sum(len(b.text) for b in shown if b.region)
    if 4 * inside >= sum(len(b.text) for b in shown if not b.region):
        shown = [b for b in shown if b.region or not inside]
    first = [_first_pass(b, stop) for b in shown]

    def nearest(order, into, steps):
        """The label of the nearest decided block before each in this order; an edge of an article is good, one of the page bad."""
        last, region = "bad", None
        for i in order:
            b = shown[i]
            if b.region != region:
                last, region = ("good" if b.region else "bad"), b.region
            into[i] = last
            if first[i] in steps:
                last = first[i]

    decided = ("good", "bad")
    before, after = [""] * len(shown), [""] * len(shown)
    nearest(range(len(shown)), before, decided)
    nearest(range(len(shown) - 1, -1, -1), after, decided)
    near_before, near_after = [""] * len(shown), [""] * len(shown)
    nearest(range(len(shown)), near_before, (*decided, "near"))
    nearest(range(len(shown) - 1, -1, -1), near_after, (*decided, "near"))
    kept = []
    for i, b in enumerate(shown):
        b.label = first[i]
        if b.label == "near":
            b.label = "bad" if before[i] == after[i] == "bad" and len(b.text) <= LONG else "good"
        elif b.label == "heading":
            b.label = "good" if near_after[i] != "bad" else "bad"
        elif b.label == "short":
            sides = {near_before[i], near_after[i]}
            b.label = "good" if "bad" not in sides else "bad"
        if b.label == "good":
            kept.append(b)
    return kept


def main_text(page: str | None, stop: frozenset[str] = STOP_WORDS) -> str:
    return " ".join(b.text for b in classify(blocks(page or ""), stop))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", stop_words: frozenset[str] = STOP_WORDS) -> DataFrame:
    """key, url, text, n_chars."""
    arrow_rows(pages.sparkSession, 200)
    source = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.col(page).alias("page"))
    schema = pa.schema([("key", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py(), stop_words) for x in b.column(2)]
            yield batch(schema, [b.column(0), b.column(1), texts, [len(t) for t in texts]])

    out = source.mapInArrow(run, "key long, url string, text string, n_chars long")
    return out.withColumnsRenamed({"key": key, "url": url})


def op12_html_text(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
