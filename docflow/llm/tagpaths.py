"""Main text of web pages by tag-path ratios.

A page is read once from left to right. Its text falls into blocks, each with the path of block elements
from the root to it; a path is a node of a tree that all blocks share, so that deep pages cost no more
than flat ones. For each path the lengths, punctuation marks and linked characters of its blocks are
aggregated: a path's ratio is its characters a block, times one more than its marks a block, less the
share in links. Ratios are smoothed along the path (an ancestor's ratio, weighted by text, counts half as
much for each step up; html and body, which all paths share, do not count) and lose the share in links
again, then they are fused with what the elements say of themselves: text outside the article's own element has no weight while there is one, and
within it a path has at least half of the element's ratio, less its share in links. Paths that reach a
tenth of the best are content. Their blocks are joined in page order.

Elements that are no part of an article (menus, footers, sidebars, scripts and the like) and those
whose class, id or role names them so never enter the ratios; of a header within an article its headings
do. An article within an article is a reader's comment. A form is left out unless it holds most of the
text. Class names are not believed where nothing would be left.

Defined cases: null and empty pages, and those without text of their own, have the empty text; text
without any tags is all content; unclosed elements end where HTML ends them, stray end tags are
skipped, an unclosed comment or script runs to the end; a long page is one task's work, in linear time.
Rows that repeat are each extracted; null ids and urls stay null; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of HTML: elements without content, with raw content, and those that flow within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CELLS = frozenset("table caption td th".split())
#: An element of these kinds ends an open one of these kinds, if only plain containers lie between.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "thead": ("thead", "tbody", "tfoot", "tr", "td", "th"), "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tfoot", "tr", "td", "th")}
BETWEEN = frozenset("div p address td th tr".split())

#: Elements that are never part of an article, and the words of names that say so.
OUTSIDE = frozenset("head nav footer aside button select label legend datalist menu dialog template noscript object canvas svg audio video map search".split())
NAMED_OUTSIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial adsense adsbygoogle banner sponsor sponsored sponsors promo promos promotion promoted"
    " nav navbar navi navigation menu menus submenu breadcrumb breadcrumbs crumbs pagination pager toolbar topbar masthead skip sitemap"
    " sidebar aside rail footer foot copyright legal disclaimer cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay paywall"
    " newsletter subscribe subscription signup login signin register search share sharing social follow"
    " comment comments commentlist disqus reply replies respond responses discussion related recommended recommendations trending widget widgets complementary contentinfo dialog alertdialog".split()
)
#: Words of names that mark a site's header, believed only where no word of an article stands beside them.
NAMED_HEADER = frozenset("header head meta byline author".split())
NAMED_ARTICLE = frozenset("article post entry story content body main".split())
MARKS = ".,;:!?…。，、；：！？"

STEP, OUTSIDE_SHARE, REACH = 0.5, 0.5, 0.1
#: Text outside marked elements that outweighs them: characters at least, and times theirs.
MISMARKED_CHARS, MISMARKED_TIMES = 500, 10

_BARE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)>")
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_SPACE = re.compile(r"[\s/]*")
_KEY = re.compile(r"[^\s/>=]+|=[^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNSHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}


class Reader:
    """The tags and texts of a page, in order."""

    def __init__(self, page: str):
        self.page = page
        self.missing: set[str] = set()

    def _find(self, what: str, at: int) -> int:
        """Where `what` comes next, or -1; what is missing once is not looked for again."""
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def _attributes(self, at: int) -> tuple[dict[str, str], int]:
        """Attributes from a position within a tag, and where the tag ends."""
        page, out = self.page, {}
        while True:
            at = _SPACE.match(page, at).end()
            if at >= len(page) or page[at] == ">":
                return out, at + 1
            key = _KEY.match(page, at)
            name, at = key[0].lower(), key.end()
            value = ""
            if equals := _EQUALS.match(page, at):
                at = equals.end()
                quote = page[at : at + 1]
                if quote in ("'", '"') and (end := self._find(quote, at + 1)) >= 0:
                    value, at = page[at + 1 : end], end + 1
                else:
                    bare = _BARE.match(page, at)
                    value, at = bare[0], bare.end()
            out.setdefault(name, value)

    def __iter__(self) -> Iterator[tuple[str, str, dict[str, str]]]:
        """("text", characters, {}), ("open", tag, attributes) and ("close", tag, {})."""
        page, at = self.page, 0
        while at < len(page):
            mark = page.find("<", at)
            if mark < 0:
                mark = len(page)
            if mark > at:
                yield "text", page[at:mark], {}
            if (bare := _BARE_TAG.match(page, mark)) and (bare[1] or bare[2].lower() not in RAW):
                at = bare.end()
                yield ("close" if bare[1] else "open"), bare[2].lower(), {}
                continue
            at = mark + 1
            if page.startswith("!--", at):
                if page.startswith((">", "->"), at + 3):
                    at = page.find(">", at) + 1
                else:
                    end = self._find("-->", at + 3)
                    at = len(page) if end < 0 else end + 3
            elif page.startswith(("!", "?"), at):
                end = self._find(">", at)
                at = len(page) if end < 0 else end + 1
            elif name := _NAME.match(page, at):
                tag = name[0].lower()
                attributes, at = self._attributes(name.end())
                yield "open", tag, attributes
                if tag in RAW:
                    end = _RAW_END[tag].search(page, at)
                    at = len(page) if end is None else end.start()
            elif page.startswith("/", at) and (name := _NAME.match(page, at + 1)):
                _, at = self._attributes(name.end())
                yield "close", name[0].lower(), {}
            elif page.startswith("/", at):
                end = self._find(">", at)
                at = len(page) if end < 0 else end + 1
            elif mark < len(page):
                yield "text", "<", {}


class Element:
    """An open block element: its path, what it leaves out, and whether it is part of the article."""

    __slots__ = ("article", "form", "headings", "mark", "out", "path", "tag")

    def __init__(self, tag: str, path: int, out: int, mark: int, headings: bool, article: bool, form: int):
        self.tag, self.path, self.out, self.mark, self.headings, self.article, self.form = tag, path, out, mark, headings, article, form


class Block:
    __slots__ = ("chars", "form", "heading", "linked", "marked", "marks", "out", "path", "tag", "text")

    def __init__(self, text: str, linked: int, holder: Element):
        self.text, self.chars, self.linked = text, len(text), min(linked, len(text))
        self.marks = sum(map(text.count, MARKS))
        self.path, self.tag, self.marked, self.form = holder.path, holder.tag, holder.mark, holder.form
        self.heading = holder.tag in HEADINGS
        # Of a header within an article only headings count.
        self.out = max(holder.out, 2) if holder.headings and not self.heading else holder.out


class Page:
    """The blocks of a page, and the tree of their paths: parent and label of each node, the root first."""

    def __init__(self, page: str):
        self.parent, self.blocks = [-1], []
        self._children: dict[tuple[int, str], int] = {}
        self.stack = [Element("", 0, 0, 0, False, False, 0)]
        self.open: list[Counter] = [Counter()]  # names of open elements, for each table cell anew
        self.link = 0  # depth of the stack at which a link was opened
        self.hushed = ""  # an inline element that is left out, and how often it is open
        self.hushed_depth = 0
        self.pieces: list[str] = []
        self.linked = 0
        self.seen_mark = 0
        for kind, what, attributes in Reader(page):
            if kind == "text":
                self._text(what)
            elif kind == "open":
                self._opened(what, attributes)
            else:
                self._closed(what)
        self._flush()

    def _text(self, raw: str) -> None:
        if self.stack[-1].out < 2 and not self.hushed:
            text = html.unescape(raw) if "&" in raw else raw
            self.pieces.append(text)
            if self.link:
                self.linked += len(text.strip())

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append(Block(text, self.linked, self.stack[-1]))
            self.pieces = []
        self.linked = 0

    def _push(self, element: Element) -> None:
        self.stack.append(element)
        if element.tag in CELLS:
            self.open.append(Counter())
        else:
            self.open[-1][element.tag] += 1

    def _pop_through(self, at: int) -> None:
        """Closes the element at this height of the stack and all above it."""
        self._flush()
        while len(self.stack) > at:
            tag = self.stack.pop().tag
            if tag in CELLS:
                self.open.pop()
            else:
                self.open[-1][tag] -= 1
        if self.link > len(self.stack):
            self.link = 0
        self.hushed = ""

    def _height(self, tags: tuple[str, ...]) -> int:
        return next((i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i].tag in tags), 0)

    def _opened(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "br":
            self.pieces.append(" ")
            return
        if tag in ("html", "body"):
            if (at := self._height(("head",))) and tag == "body":
                self._pop_through(at)
            return
        if tag in RAW or tag in VOID:
            if tag == "hr":
                self._flush()
            return
        outside = _outside(tag, attributes)
        if tag in INLINE or ("-" not in tag and tag not in BLOCKS and tag not in OUTSIDE):
            if tag == "a" and not self.link:
                self.link = len(self.stack)
            if self.hushed:
                self.hushed_depth += tag == self.hushed
            elif outside:
                self.hushed, self.hushed_depth = tag, 1
            return
        if self.stack[-1].tag == "head":
            self._pop_through(len(self.stack) - 1)
        if tag in ENDS_P and self.open[-1]["p"]:
            self._pop_through(self._height(("p",)))
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self._pop_through(len(self.stack) - 1)
        if tag in SIBLINGS:
            lowest = 0
            for at in range(len(self.stack) - 1, max(0, len(self.stack) - 32), -1):
                if self.stack[at].tag in SIBLINGS[tag]:
                    lowest = at
                elif self.stack[at].tag not in BETWEEN:
                    break
            if lowest:
                self._pop_through(lowest)
        self._flush()
        self.hushed = ""
        holder = self.stack[-1]
        article = tag == "article" or tag == "main" or attributes.get("role") in ("main", "article") or "articleBody" in attributes.get("itemprop", "")
        nested = tag == "article" and holder.article
        out, mark, headings = max(holder.out, outside, 1 if nested else 0), holder.mark, holder.headings
        if article and not outside and not nested:
            if not self.seen_mark and out < 2:
                out = 0  # the page's first article is not outside for a name around it
            if out == 0:
                mark = mark or len(self.parent)
                self.seen_mark = 1
        if tag == "header":
            out, headings = (out, True) if mark else (max(out, 2), headings)
        label = tag if tag in PLAIN else f"{tag} {re.sub('[0-9]+', '', attributes.get('class', ''))}"
        path = self._children.get((holder.path, label))
        if path is None:
            path = self._children[(holder.path, label)] = len(self.parent)
            self.parent.append(holder.path)
        self._push(Element(tag, path, out, mark, headings, holder.article or (tag == "article" and bool(mark)), holder.form or (path if tag == "form" else 0)))

    def _closed(self, tag: str) -> None:
        if self.hushed and tag == self.hushed:
            self.hushed_depth -= 1
            self.hushed = self.hushed if self.hushed_depth else ""
        if tag == "a":
            self.link = 0
        elif tag == "p" and not self.open[-1]["p"]:
            self._flush()
        elif tag in HEADINGS:
            if any(self.open[-1][h] for h in HEADINGS):
                self._pop_through(self._height(tuple(HEADINGS)))
        elif tag in CELLS:
            if len(self.open) > 1 and (at := self._height((tag,))):
                self._pop_through(at)
        elif tag in ("tr", "tbody", "thead", "tfoot"):
            at = self._height((tag, "table"))
            if at and self.stack[at].tag == tag:
                self._pop_through(at)
        elif self.open[-1][tag]:
            self._pop_through(self._height((tag,)))


#: Block elements, and those of them whose class names do not tell paths apart.
BLOCKS = ENDS_P | frozenset(SIBLINGS) | CELLS | frozenset("head legend optgroup option col colgroup rt".split()) - INLINE
PLAIN = frozenset("p li dt dd tr td th thead tbody tfoot pre blockquote figure figcaption summary caption".split()) | HEADINGS


def _outside(tag: str, attributes: dict[str, str]) -> int:
    """2 for an element that is no part of an article by its kind or is not shown, 1 by its name, else 0."""
    if tag in OUTSIDE:
        return 2
    if not attributes:
        return 0
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _UNSHOWN.search(attributes.get("style", "")):
        return 2
    words = {w.lower() for key in ("class", "id", "role") if attributes.get(key) for w in _WORD.findall(html.unescape(attributes[key]))}
    if words & NAMED_OUTSIDE or (words & NAMED_HEADER and not words & NAMED_ARTICLE and tag in ("div", "section")):
        return 1
    return 0


def content_paths(page: Page, blocks: list[Block]) -> set[int]:
    """The paths that hold content, by their smoothed and fused ratios."""
    size = len(page.parent)
    count, chars, marks, linked, held = [0] * size, [0] * size, [0] * size, [0] * size, [0] * size
    for b in blocks:
        count[b.path] += 1
        chars[b.path] += b.chars
        marks[b.path] += b.marks
        linked[b.path] += b.linked
        held[b.path] = b.marked
    used = [p for p in range(size) if count[p]]
    plain = {p: 1 - linked[p] / chars[p] for p in used}
    ratio = {p: chars[p] / count[p] * (1 + marks[p] / count[p]) * plain[p] for p in used}
    # An ancestor's ratio is that of the text below it; a child's number is always the greater one.
    weight, mass = [0.0] * size, [0.0] * size
    for p in reversed(range(size)):
        if p in ratio:
            weight[p] += chars[p]
            mass[p] += chars[p] * ratio[p]
        if p and weight[p]:
            weight[page.parent[p]] += weight[p]
            mass[page.parent[p]] += mass[p]
    # What the ancestors add is carried down the tree: a sum in which each step up counts half, and its weights.
    above, share = [0.0] * size, [0.0] * size
    for p in range(1, size):
        own = mass[p] / weight[p] if weight[p] else 0.0
        above[p], share[p] = own + STEP * above[page.parent[p]], 1 + STEP * share[page.parent[p]]
    smooth = {p: ((above[p] - mass[p] / weight[p] + ratio[p]) / share[p] if p else ratio[p]) * plain[p] for p in used}
    fused = dict(smooth)
    inside = [p for p in used if held[p]]
    others = [p for p in used if not held[p]]
    marked = sum(chars[p] for p in inside)
    if inside and not max((chars[p] for p in others), default=0) >= max(MISMARKED_CHARS, MISMARKED_TIMES * marked):
        for p in others:
            fused[p] = 0.0
        for p in inside:
            top = held[p]
            fused[p] = max(smooth[p], OUTSIDE_SHARE * mass[top] / weight[top] * plain[p])
    best = max(fused.values(), default=0.0)
    found = {p for p in used if fused[p] >= REACH * best and (fused[p] > 0 or best == 0)}
    # A heading stands or falls with what follows it under the same parent.
    for b, after in zip(blocks, blocks[1:]):
        if b.heading and after.path in found and page.parent[b.path] == page.parent[after.path]:
            found.add(b.path)
    return found


def outside_forms(blocks: list[Block]) -> list[Block]:
    """Without the blocks of forms; a form that has most of the text, and the article if any is marked, is the page itself."""
    marked = any(b.marked for b in blocks)
    chars: Counter = Counter()
    for b in blocks:
        if not marked or b.marked:
            chars[b.form] += b.chars
    every = chars.total()
    return [b for b in blocks if not b.form or 2 * chars[b.form] > every]


def main_text(source: str | None) -> str:
    """The text of a page's article; blocks are parted by a line feed."""
    page = Page(source or "")
    for out in (0, 1):
        blocks = outside_forms([b for b in page.blocks if b.out <= out])
        paths = content_paths(page, blocks)
        text = "\n".join(b.text for b in blocks if b.path in paths)
        if text:
            return text
    return ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    fields = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch["html"]]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [f.name for f in fields])

    return pages.select("page_id", "url", "html").mapInArrow(scan, fields)
