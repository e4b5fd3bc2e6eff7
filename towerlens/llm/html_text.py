"""Main text of web pages by a least cut between content and boilerplate.

A page is cut into blocks of text. A linear classifier gives each block a cost for either label, which are its
capacities to source and sink; blocks that follow each other, and more so within one parent or section, are
joined by edges that cost if labels differ. Maximum flow finds the labels of least total cost, so a short line
amid paragraphs stays with them and one in a menu goes.

Words of class, id and role that mark boilerplate are costs as well. A mark of an element that holds nearly all of
the page's content, as of a form around the whole page, says nothing about it and costs nothing.

Defined results: null or empty html gives an empty text; elements that aren't closed end with the page, but scripts
and the like that aren't closed are taken for a lone tag, and a lone ``<`` for text; repeated rows each get their row;
an empty table gives no rows. Pages are read in time in proportion to their length. The caller's columns travel in
a struct.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.llm.flow import least_cut

# Elements of HTML by how they lay out text.
# Elements whose content is no markup, and others whose content isn't shown as text.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
UNSEEN = {"template", "noscript", "svg", "object", "canvas", "audio", "video"}
# What may stand in the head; anything else ends it.
IN_HEAD = {"base", "link", "meta", "script", "style", "title", "template", "noscript", "object", "html", "head"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "rb", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
    "wbr", "img", "br", "input", "embed",
    "math", "mrow", "mi", "mn", "mo", "ms", "mtext", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup", "munder", "mover", "munderover",
    "mstyle", "mspace", "mpadded", "mphantom", "merror", "mtable", "mtr", "mtd", "semantics",
}
# A start tag that closes an open element of these kinds.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"},
}
SCOPES = {"ul", "ol", "dl", "table", "select", "div", "section", "article", "body"}
# Elements and words of class, id or role that mark what isn't content.
ASIDE = {"nav", "footer", "aside", "form", "menu", "button", "select", "dialog", "fieldset", "head"}
MARKED = {
    "ad", "ads", "adv", "advert", "advertisement", "advertising", "adbox", "adsbygoogle", "alert", "banner", "breadcrumb", "breadcrumbs",
    "comment", "commentlist", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "disclaimer",
    "disqus", "foot", "footer", "gdpr", "hidden", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "notification", "pager", "pagination", "popup", "privacy", "promo", "promoted", "promotion", "recommended",
    "related", "replies", "reply", "responses", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "topbar", "widget", "dialog", "form",
}
MAIN = {"article", "main"}
MAIN_WORDS = {"article", "articlebody", "content", "entry", "main", "post", "story", "body", "text"}
# Costs in hundredths. A mark weighs more than what a block's own text and neighbours usually say for it.
MARK = 1000
# An element with this share of the page's content, per cent, is no boilerplate for what its names say.
WHOLE = 90
ADJACENT, SIBLING, SECTION = 60, 60, 30

_NAME = re.compile(r"(/?)([A-Za-z][^\s/>]*)")
# An ordinary tag, with neither < nor > in its values; others are read piece by piece.
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/<>"']*)(?=[\s/>])((?:[^<>"']++|"[^"<>]*+"|'[^'<>]*+')*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class _Element:
    name: str
    number: int
    parent: int
    marked: bool
    main: bool


@dataclass
class Block:
    """Text between two block boundaries, and where it stands; ``marked`` is settled when the page has been read."""

    name: str
    parent: int
    section: int
    main: bool
    marked: bool = False
    text: list[str] = field(default_factory=list)
    linked: int = 0


class _Tokens:
    """The page's tags and texts in one pass: ``(text, closing, name, attributes)``, of which text or name is empty.

    What has been looked for in vain to the page's end isn't looked for again.
    """

    def __init__(self, html: str) -> None:
        self.html, self.at = html, 0
        # From where on there is none of it.
        self.missing: dict[str, int] = {}

    def find(self, what: str, at: int) -> int:
        """Place of the next ``what``, or -1."""
        found = -1 if at >= self.missing.get(what, len(self.html)) else self.html.find(what, at)
        if found < 0:
            self.missing[what] = min(at, self.missing.get(what, at))
        return found

    def end_of_tag(self, at: int) -> int:
        """Place of the ``>`` that ends a tag, past quoted values; of the first one if a quote isn't closed."""
        first = end = self.find(">", at)
        while end >= 0:
            quote = min((place for place in (self.html.find(mark, at, end) for mark in "\"'") if place >= 0), default=-1)
            if quote < 0:
                return end
            close = self.find(self.html[quote], quote + 1)
            if close < 0:
                return first
            at = close + 1
            end = end if end > close else self.find(">", at)
        return first

    def skip(self, name: str) -> bool:
        """Goes behind the end tag of an element whose content is no text, if it has one."""
        if name in self.missing:
            return False
        end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(self.html, self.at)
        if end is None:
            self.missing[name] = self.at
            return False
        close = self.find(">", end.end())
        self.at = close + 1 if close >= 0 else len(self.html)
        return True

    def __iter__(self) -> Iterator[tuple[str, bool, str, str]]:
        html = self.html
        while self.at < len(html):
            at = self.at
            if html[at] != "<":
                end = self.find("<", at)
                self.at = end if end >= 0 else len(html)
                yield html[at : self.at], False, "", ""
                continue
            tag = _TAG.match(html, at)
            if tag is not None:
                self.at = tag.end()
                yield "", bool(tag[1]), tag[2].lower(), tag[3]
                continue
            name = _NAME.match(html, at + 1)
            if name is None:
                if html.startswith("<!--", at):
                    end = self.find("-->", at + 4)
                    self.at = end + 3 if end >= 0 else len(html)
                elif html[at + 1 : at + 2] in ("!", "?", "/"):
                    end = self.find(">", at)
                    self.at = end + 1 if end >= 0 else len(html)
                else:
                    self.at = at + 1
                    yield "<", False, "", ""
                continue
            end = self.end_of_tag(name.end())
            if end < 0:
                self.at = at + 1
                yield "<", False, "", ""
                continue
            self.at = end + 1
            yield "", bool(name[1]), name[2].lower(), html[name.end() : end]


def _flags(name: str, attributes: str, main: bool) -> tuple[bool, bool]:
    """Whether an element marks boilerplate, and whether it marks content."""
    marked, content = name in ASIDE or (name == "header" and not main), name in MAIN
    if attributes and not attributes.isspace():
        whole_page = name in ("html", "body")
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values)
            if key in ("class", "id", "role"):
                words = set(_WORD.findall(_CAMEL.sub(r"\1 \2", value).lower()))
                marked |= not whole_page and (not words.isdisjoint(MARKED) or ("header" in words and not main))
                content |= not whole_page and not words.isdisjoint(MAIN_WORDS)
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or _HIDDEN.search(value):
                marked = True
    return marked, content


def blocks(html: str) -> list[Block]:
    """The page's blocks of text, in order; text of scripts, styles and the like isn't in any."""
    found: list[Block] = []
    elements = [_Element("", 0, 0, False, False)]
    stack, open_names, current, link = [elements[0]], Counter(), None, 0
    tokens = _Tokens(html)

    def close(depth: int) -> None:
        open_names.subtract(element.name for element in stack[depth:])
        del stack[depth:]

    for piece, closing, name, attributes in tokens:
        if not name:
            if current is None:
                if piece.isspace():
                    continue
                if stack[-1].name == "head":
                    close(len(stack) - 1)
                top = stack[-1]
                current = Block(top.name, top.number, stack[-2].number if len(stack) > 1 else 0, top.main)
                found.append(current)
            current.text.append(piece)
            current.linked += len(piece) * (link > 0)
            continue
        if name in RAW or name in UNSEEN:
            if not closing and not attributes.endswith("/"):
                tokens.skip(name)
            continue
        if name == "a":
            link = 0 if closing else 1
        if name in INLINE:
            if name == "br" and current is not None:
                current.text.append(" ")
            continue
        current, link = None, 0
        if closing:
            if open_names[name] > 0:
                close(max(depth for depth in range(len(stack)) if stack[depth].name == name))
            continue
        if stack[-1].name == "p" or (stack[-1].name == "head" and name not in IN_HEAD):
            close(len(stack) - 1)
        closes = CLOSES.get(name, ())
        if any(open_names[one] > 0 for one in closes):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name in closes:
                    close(depth)
                    break
                if stack[depth].name in SCOPES:
                    break
        if name not in VOID and not attributes.endswith("/"):
            top = stack[-1]
            marked, main = _flags(name, attributes, top.main)
            elements.append(_Element(name, len(elements), top.number, marked, top.main or main))
            stack.append(elements[-1])
            open_names[name] += 1
    _settle(found, elements)
    return found


def _settle(found: list[Block], elements: list[_Element]) -> None:
    """Marks the blocks below a marked element, unless that element holds nearly all of the page's content.

    Content is counted in words of blocks that aren't mostly links: of the blocks in elements named as main, or of all blocks where
    there are none. An element comes after its parent, so sums go up and marks go down in one pass each.
    """
    words = [sum(map(len, map(str.split, block.text))) if 2 * block.linked <= sum(map(len, block.text)) else 0 for block in found]
    only_main = any(count for block, count in zip(found, words) if block.main)
    held = [0] * len(elements)
    for block, count in zip(found, words):
        if block.main or not only_main:
            held[block.parent] += count
    for element in reversed(elements[1:]):
        held[element.parent] += held[element.number]
    below = [False] * len(elements)
    for element in elements[1:]:
        wrapper = held[0] and 100 * held[element.number] >= WHOLE * held[0]
        below[element.number] = below[element.parent] or (element.marked and not wrapper)
    for block in found:
        block.marked = below[block.parent]


def clean(block: Block) -> str:
    text = "".join(block.text)
    return " ".join((unescape(text) if "&" in text else text).split())


def excess(block: Block, text: str) -> int:
    """Cost of calling the block boilerplate less that of calling it content."""
    words = text.count(" ") + 1
    score = -60 + 12 * min(words, 30) + 200 * block.main
    score += 60 * (block.name == "p") + 80 * (block.name in ("h1", "h2", "h3", "h4", "h5", "h6"))
    score += 40 * (text[-1:] in ".!?:;\"')")
    score -= MARK * block.marked
    # A link says little inside the main element, where lists of them may be what the page is about.
    return int(score - (100 if block.main else 500) * block.linked / max(1, sum(map(len, block.text))) * (words < 30 or not block.main))


def main_text(html: str) -> str:
    """The page's content blocks, one a line."""
    found = [(block, text) for block in blocks(html) if (text := clean(block))]
    edges, by_parent, by_section = [], {}, {}
    for number, (block, _) in enumerate(found):
        if number:
            edges.append((number - 1, number, ADJACENT))
        for seen, key, cost in ((by_parent, (block.name, block.section), SIBLING), (by_section, block.section, SECTION)):
            if key in seen:
                edges.append((seen[key], number, cost))
            seen[key] = number
    kept = least_cut([excess(block, text) for block, text in found], edges)
    return "\n".join(text for (_, text), content in zip(found, kept) if content)


def extracted(pages: DataFrame, carried: list[str], html_col: str = "html") -> DataFrame:
    """The columns ``carried`` with ``text``, the main text of each page, and ``n_chars``, its code points."""
    rows = pages.select(
        F.struct(F.lit(0), *[F.col(f"`{name}`") for name in carried]).alias("row"), F.coalesce(html_col, F.lit("")).alias("html")
    )
    kind = dict(rows.dtypes)["row"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(html.as_py()) for html in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["row", "text"])

    rows = rows.mapInArrow(read, f"row {kind}, text string")
    length = F.char_length("text").cast("long").alias("n_chars")
    return rows.select(*[F.col("row")[name].alias(name) for name in carried], "text", length)
