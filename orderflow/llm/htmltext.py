"""Main text of web pages by scoring the element tree.

A page is parsed leniently into a tree. Elements that are never part of an article go first: scripts,
styles, menus, page headers and footers, sidebars, notices, adverts, forms, reader comments and hidden
elements, by tag, role, and the words of class and id. A word is outweighed if no article or main element is in view and
the element holds one, or has a name of content too, and holds more text than all in view. Every paragraph left earns points, one and one for
each comma and up to three for its length. It passes them to its ancestors: all to its parent, half to the
next, a third of that and less further up. An ancestor's points are discounted by the share of its text that is
links. The best container is kept, widened to the article or main element around it, with those
siblings that score a fifth of it or have few links (beside other parts of a page itself: that are running text, headings,
lists or tables with few links). Lists of links within it go.

The text is that of the kept blocks in page order: character references decoded, white space in a block one
space, blocks trimmed and joined by one space.

Each page is worked on alone, in batches, without recursion; memory is bounded by a page and time by its
length times the number of scored ancestors (``LEVELS``).

Defined results: null and empty pages, and pages without a text, have the empty text; a page of plain text is
its text; a page that breaks off is read as far as it goes; repeated rows have equal results; an
empty table gives an empty table; other columns are carried by the caller.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = 6
SIBLING_SHARE = 0.2
LINK_LIMIT = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "p pre section summary table tbody td tfoot th thead tr ul br".split()
)
#: Elements that close an open paragraph.
ENDS_P = BLOCK - frozenset("br body html caption tbody td tfoot th thead tr legend figcaption summary".split())
#: A start tag closes the open element of these tags, looked for up to the given ones.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
DROPPED = frozenset(
    "aside audio button canvas dialog embed footer form head iframe input map math menu nav noscript "
    "object script select style svg template textarea title video".split()
)
DROPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
#: Words of class or id that say an element is no article.
OUTSIDE = frozenset(
    "ad ads advert advertisement advertising adverts breadcrumb breadcrumbs comment commentlist comments "
    "consent cookie cookies disqus footer login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification overlay pager pagination paywall popup respond sidebar signup skip sponsor "
    "sponsored subscribe subscription toolbar".split()
)
#: The same, unless another word says it is one.
PERHAPS_OUTSIDE = frozenset("banner header promo promotion related share sharing social teaser widget widgets".split())
INSIDE = frozenset("article body content entry main page post story text".split())
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table".split())
PARAGRAPHS = frozenset("p pre blockquote li td dd".split())
_WORDS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_CUT_TAG = re.compile(r"<[a-zA-Z/!?][^<>]*$")


class Node:
    __slots__ = ("tag", "parent", "children", "outside", "named", "points", "chars", "links", "anchors")

    def __init__(self, tag: str, parent: Node | None, outside: bool = False):
        self.tag, self.parent, self.outside = tag, parent, outside
        #: Outside by a word only: None, or whether another name of the element says it is inside.
        self.named: bool | None = None
        self.children: list[Node | str] = []
        self.points, self.chars, self.links, self.anchors = 0.0, 0, 0, 0

    @property
    def link_density(self) -> float:
        return self.links / self.chars if self.chars else 0.0


def is_outside(tag: str, attributes: dict[str, str | None]) -> bool:
    """Whether an element is never part of an article."""
    if tag in DROPPED:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    if (attributes.get("role") or "").lower() in DROPPED_ROLES:
        return True
    if "hidden" in attributes or (attributes.get("aria-hidden") or "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", (attributes.get("style") or "").lower()):
        return True
    return False


def named_outside(tag: str, attributes: dict[str, str | None]) -> bool | None:
    """None, or of an element whose class or id says it is no article, whether another one says it is."""
    if tag in ("html", "body", "article", "main"):
        return None
    named = f"{attributes.get('class') or ''} {attributes.get('id') or ''}"
    tokens = [set(_WORDS.findall(_CAMEL.sub(" ", t).lower())) for t in named.split()]
    words = set().union(*tokens)
    if words & OUTSIDE or words & PERHAPS_OUTSIDE and not words & INSIDE:
        return any(t and t <= INSIDE for t in tokens)
    return None


class Tree(HTMLParser):
    """A lenient tree: unclosed elements end where their parents do, stray end tags are ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("#root", None)
        self.counts: dict[str, int] = {}

    def _close(self, tags: set[str], bounds: set[str] | frozenset[str]) -> None:
        if not any(self.counts.get(t) for t in tags):
            return
        node = self.open
        while node.parent is not None and node.tag not in bounds:
            if node.tag in tags:
                self._leave(node)
                return
            node = node.parent

    def _leave(self, node: Node) -> None:
        """Close ``node`` and all that is open in it."""
        while self.open is not node:
            self.counts[self.open.tag] -= 1
            self.open = self.open.parent
        self.counts[node.tag] -= 1
        self.open = node.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_P:
            self._close({"p"}, {"table", "td", "th", "button"})
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        node = Node(tag, self.open, is_outside(tag, dict(attrs)))
        if not node.outside:
            node.named = named_outside(tag, dict(attrs))
            node.outside = node.named is not None
        if tag == "header" and not self.counts.get("article") and not self.counts.get("main"):
            node.outside, node.named = True, None
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node
            self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash does not close an element

    def handle_endtag(self, tag: str) -> None:
        if self.counts.get(tag):
            node = self.open
            while node.tag != tag:
                # An inline end tag does not close blocks.
                if node.tag in BLOCK and tag not in BLOCK and tag not in DROPPED:
                    return
                node = node.parent
            self._leave(node)

    def handle_data(self, data: str) -> None:
        self.open.children.append(data)


def parse(html: str) -> Node:
    tree = Tree()
    tree.feed(_CUT_TAG.sub("", html))
    tree.close()
    return tree.root


def in_order(top: Node) -> list[Node]:
    """All elements below and with ``top`` that are not outside, parents first, in page order."""
    found, stack = [], [top]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.outside)
    return found


def unlinked(top: Node) -> int:
    """Characters below ``top`` that are neither in links nor in elements that are outside for good or by a word."""
    found, stack = 0, [top]
    while stack:
        for child in stack.pop().children:
            if isinstance(child, str):
                found += len("".join(child.split()))
            elif not child.outside and child.tag != "a":
                stack.append(child)
    return found


def release(root: Node) -> None:
    """Lets in elements that only a word puts outside and that hold most of the page's text.

    They must hold an article or main element, or be called content by another name as well; and only a page
    without an article or main element in view is looked at. The names of elements within them are weighed anew.
    """
    while True:
        nodes = in_order(root)
        if any(n.tag in ("article", "main") and unlinked(n) for n in nodes):
            return
        shut = [c for n in nodes for c in n.children if isinstance(c, Node) and c.outside and c.named is not None]
        best, most = None, unlinked(root)
        for node in shut:
            whole, inner, holds = 0, [node], bool(node.named)
            while inner:
                at = inner.pop()
                holds = holds or at.tag in ("article", "main")
                for c in at.children:
                    if isinstance(c, str):
                        whole += len("".join(c.split()))
                    elif c.tag != "a" and (not c.outside or c.named is not None):
                        inner.append(c)
            if holds and whole > most:
                best, most = node, whole
        if best is None:
            return
        best.outside, best.named = False, None


def trim_headers(nodes: list[Node]) -> None:
    """Of a header within an article only the headings stay."""
    for node in nodes:
        if node.tag == "header":
            node.children = [c for c in node.children if isinstance(c, Node) and re.fullmatch("h[1-6]|hgroup", c.tag)]


def score(nodes: list[Node]) -> None:
    """Text and link lengths of all elements, and the points of paragraphs passed to ancestors."""
    for node in reversed(nodes):
        for child in node.children:
            if isinstance(child, str):
                node.chars += len("".join(child.split()))
            elif not child.outside:
                node.chars += child.chars
                node.links += child.links
                node.anchors += child.anchors
        if node.tag == "a":
            node.links, node.anchors = node.chars, 1
    for node in nodes:
        own = [c for c in node.children if isinstance(c, str) and not c.isspace()]
        if not node.chars or not (node.tag in PARAGRAPHS or (node.tag in BLOCK and own and node.tag[0] != "h")):
            continue
        commas = sum(text.count(",") for text in (_texts(node) if node.tag in PARAGRAPHS else own))
        points = (1 + commas + min(node.chars / 100, 3)) * (1 - node.link_density)
        share, parent = 1.0, node if node.tag not in PARAGRAPHS else node.parent
        for level in range(LEVELS):
            if parent is None:
                break
            parent.points += points * share
            share = 0.5 if level == 0 else share / 3
            parent = parent.parent


def _texts(top: Node) -> list[str]:
    found, stack = [], [top]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            found.append(item)
        elif not item.outside and (item is top or item.tag not in PARAGRAPHS):
            stack.extend(reversed(item.children))
    return found


def container(nodes: list[Node]) -> list[Node]:
    """The best container, widened to an article or main element, with its siblings to keep."""
    worth = {id(n): n.points * (1 - n.link_density) for n in nodes}
    scored = [n for n in nodes if n.points > 0]
    if not scored:
        named = [n for n in nodes if n.tag in ("article", "main") and n.chars]
        return named[:1] or nodes[:1]
    best = max(scored, key=lambda n: worth[id(n)])
    top: Node | None = best
    while top is not None and top.tag not in ("article", "main"):
        top = top.parent
    best = top or best
    if best.parent is None:
        return [best]
    kept = []
    for child in best.parent.children:
        if isinstance(child, Node) and id(child) in worth:
            rich = child.points and worth[id(child)] >= SIBLING_SHARE * worth[id(best)]
            # In a content container all that has few links is content; beside other parts of a page, running text is.
            within = best.parent.tag not in ("#root", "html", "body") or child.tag in RUNNING
            plain = within and child.chars and child.link_density < 0.25
            if child is best or rich or (plain and best.tag not in ("article", "main")):
                kept.append(child)
    return kept


def text_of_blocks(tops: list[Node]) -> str:
    parts: list[str] = []
    stack: list[Node | str] = list(reversed(tops))
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            parts.append(item)
        elif not item.outside:
            listing = item.tag in ("ul", "ol", "dl", "div", "section", "table") and item not in tops
            if listing and item.anchors > 1 and item.link_density > LINK_LIMIT:
                continue
            if item.tag in BLOCK:
                parts.append(" ")
                stack.append(" ")
            stack.extend(reversed(item.children))
    return " ".join("".join(parts).split())


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    release(root)
    trim_headers(in_order(root))
    nodes = in_order(root)
    score(nodes)
    return text_of_blocks(container(nodes))


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text in place of the html, and ``n_chars``, its code points."""

    @F.pandas_udf("string")
    def extracted(column: pd.Series) -> pd.Series:
        return column.map(main_text, na_action=None)

    others = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in (html.lower(), text.lower(), "n_chars")]
    found = pages.select(*others, extracted(html).alias(text))
    return found.withColumn("n_chars", F.char_length(text).cast("long"))
