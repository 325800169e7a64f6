"""Main text of a web page by composite text density (Sun, Song and Liao, 2011).

A page becomes a tree of its elements. With C characters, T tags, and the same inside
links (LC, LT) in a node's subtree, a node's density is

    C / T * log(C / LC * T / LT) to the base ln(C / nLC * LC + LCb / Cb * C + e)

where nLC are the characters outside links, b is the body, and a zero divisor counts as 1.
A node's density sum is the sum of its children's densities. Only block elements have a
part in sums: bold or italic words count as tags of their paragraph, else a paragraph in
one pair of bold tags would outweigh the article around it. The threshold is the smallest
density on the path from the node of the largest sum up to the body. Nodes at or above the
threshold are searched from the body down; in each the subtree of the largest sum is main
text and is taken whole.

Elements that never hold main text are left out before counting: scripts, styles, forms,
navigation, asides, page headers and footers, hidden parts, and elements of which a whole
class, id or role is the name of an advert, menu, notice, share bar or reader comments. No
name, and no form, takes the main text along: an element that holds an article, main or h1
element stays, or in a page without article and main text one that holds over half of the
body's characters outside links, and density decides.

Null or empty html gives empty text. Unclosed and misplaced tags are closed as browsers
do in the cases that matter: a block ends an open paragraph, list items and table cells
end each other, a closing tag without an opening one is ignored. Pages of any length go
through whole; repeated rows get a row each; an empty table gives no rows. Only the named
columns are read.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprofile.llm.shared import by_size, unused

# Element names of HTML by what the parser does with them.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_DROPPED = frozenset(
    "script style noscript template iframe object svg canvas button select option input "
    "textarea nav aside footer head title menu dialog audio video map".split()
)
_RAW = frozenset("script style textarea title noscript iframe template xmp".split())
_ENDS_PARAGRAPH = _BLOCK - frozenset("html body caption tbody td tfoot th thead tr".split())
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th"),
}
_SCOPES = frozenset("ul ol dl table select body html div section article".split())

# Whole classes, ids and roles that name what is not main text.
_NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner promo promoted "
    "promotion sponsor sponsored sponsorship nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs sidebar aside widget widgets related recommended recommendations "
    "footer header masthead topbar toolbar comment comments commentlist disqus respond reply "
    "replies cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social pagination pager search skip "
    "copyright contentinfo complementary hidden "
    "site-header site-footer page-header page-footer main-nav main-menu nav-menu navigation-menu "
    "ad-banner ad-container ad-slot ad-wrapper cookie-banner cookie-consent cookie-notice "
    "comment-list comment-form comments-area comments-section share-bar share-buttons "
    "social-links social-share related-posts related-articles related-links newsletter-signup "
    "skip-link".split()
)
# Elements that hold the main text where a page has them.
_OWNERS = frozenset("article main h1".split())
# Beside one of these, "header" names the head of the main text.
_OWN_HEADER = frozenset("post entry article content story".split())
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_MARKS = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(
    r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S
)
_SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "depth", "parts", "chars", "tags", "link_chars", "link_tags",
                 "density", "total", "dropped", "named")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, named: bool = False):
        self.tag, self.parent, self.dropped, self.named = tag, parent, dropped, named
        self.depth = 0 if parent is None else parent.depth + 1
        self.parts: list = []  # strings and nodes in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0

    def children(self) -> Iterator[Node]:
        return (p for p in self.parts if isinstance(p, Node))


def _is_noise(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool]:
    """Whether an element is left out whatever it holds, and whether only by its name."""
    if tag in _DROPPED or (tag == "header" and not inside_article):
        return True, False
    named = tag == "form"
    if not attributes.strip() or tag in ("body", "html", "article", "main"):
        return False, named
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, False
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True, False
        if name in ("class", "id", "role"):
            words = set(value.lower().split())
            if words & _OWN_HEADER:
                words.discard("header")
            named = named or bool(words & _NOISE)
    return False, named


def _tag_ends(page: str) -> tuple[list[int], list[int]]:
    """Places of > and quotes, and for each the > that ends a tag read on from there.

    A quote is skipped to its partner; -1 stands for a tag that never ends. Read backwards,
    every place is looked at once.
    """
    places = [found.start() for found in _MARKS.finditer(page)]
    ends = [-1] * (len(places) + 1)
    partner: dict[str, int] = {}
    for k in range(len(places) - 1, -1, -1):
        mark = page[places[k]]
        if mark == ">":
            ends[k] = places[k]
        else:
            if mark in partner:
                ends[k] = ends[partner[mark] + 1]
            partner[mark] = k
    return places, ends


def _tokens(page: str) -> Iterator[tuple[str, str, str, int]]:
    """(text before, name with / for an end tag, attributes, place behind) of each tag.

    Comments and declarations have no name. Raw elements are left to the caller, who sends
    the place to go on from.
    """
    places, ends = _tag_ends(page)
    at = start = 0
    while True:
        at = page.find("<", at)
        if at < 0:
            yield page[start:], "", "", len(page)
            return
        if page.startswith("<!--", at):
            name, stop = "", page.find("-->", at + 4)
            behind = len(page) if stop < 0 else stop + 3
        elif page.startswith(("<!", "<?"), at):
            name, stop = "", page.find(">", at)
            if stop < 0:
                yield page[start:], "", "", len(page)
                return
            behind = stop + 1
        else:
            found = _NAME.match(page, at + 1)
            stop = ends[bisect_left(places, found.end())] if found else -1
            if stop < 0:
                at += 1  # not a tag, so text
                continue
            name, behind = found.group(), stop + 1
        attributes = page[found.end() : stop] if name else ""
        moved = yield page[start:at], name, attributes, behind
        at = start = behind if moved is None else moved


class _Open:
    """The elements that are open, by depth and by name."""

    def __init__(self, body: Node):
        self.stack = [body]
        self.named: dict[str, list[Node]] = {}
        self.blocks, self.scopes = [body], [body]

    def push(self, node: Node) -> None:
        self.stack.append(node)
        self.named.setdefault(node.tag, []).append(node)
        if node.tag in _BLOCK:
            self.blocks.append(node)
        if node.tag in _SCOPES:
            self.scopes.append(node)

    def close(self, node: Node) -> None:
        """Close the element and all inside it."""
        while self.stack[-1].depth >= node.depth:
            gone = self.stack.pop()
            self.named[gone.tag].pop()
            for held in (self.blocks, self.scopes):
                if held[-1] is gone:
                    held.pop()

    def last(self, tag: str) -> Node | None:
        held = self.named.get(tag)
        return held[-1] if held else None

    def outermost(self, tags: tuple[str, ...]) -> Node | None:
        """The outermost open element of these names inside the last scope."""
        scope, found = self.scopes[-1], None
        for tag in tags:
            held = self.named.get(tag, [])
            k = bisect_left(held, scope.depth + 1, key=lambda node: node.depth)
            if k < len(held) and (found is None or held[k].depth < found.depth):
                found = held[k]
        return found


def parse(page: str) -> Node:
    """The element tree below the body, with the elements left out marked."""
    body = Node("body", None, False)
    held = _Open(body)
    any_named, moved = False, None
    tokens = _tokens(page)
    while True:
        try:
            text, tag, attributes, behind = tokens.send(moved)
        except StopIteration:
            break
        moved, current = None, held.stack[-1]
        if text and not current.dropped:
            current.parts.append(text)
        closing, tag = tag.startswith("/"), tag.lstrip("/").lower()
        if tag in ("", "html", "body"):
            continue
        if closing:
            node = held.last(tag)
            # An inline end tag does not reach outside its block.
            if node is not None and (tag in _BLOCK or node.depth > held.blocks[-1].depth):
                held.close(node)
            continue
        if tag in _ENDS_PARAGRAPH and held.blocks[-1].tag == "p":
            held.close(held.blocks[-1])
        if tag in _CLOSES:
            node = held.outermost(_CLOSES[tag])
            if node is not None:
                held.close(node)
        current = held.stack[-1]
        dropped, named = _is_noise(tag, attributes, held.last("article") is not None)
        dropped = dropped or current.dropped
        any_named = any_named or named
        if tag in _RAW:
            stop = re.compile(f"</{tag}", re.I | re.A).search(page, behind)
            moved = (page.find(">", stop.end()) + 1 or len(page)) if stop else len(page)
            continue
        node = Node(tag, current, dropped, named)
        current.parts.append(node)
        if tag not in _VOID and not attributes.endswith("/"):
            held.push(node)
    if any_named:
        _drop_named(body)
    return body


def _drop_named(body: Node) -> None:
    """Leave out what a name says is not main text, but nothing that holds the main text."""
    nodes = _in_order(body)
    plain: dict[int, int] = {}  # characters outside links
    owners: set[int] = set()
    for node in reversed(nodes):
        count = 0
        for part in node.parts:
            if isinstance(part, str):
                count += sum(map(len, part.split()))
            elif not part.dropped:
                count += plain[id(part)]
                if part.tag in _OWNERS or id(part) in owners:
                    owners.add(id(node))
        plain[id(node)] = 0 if node.tag == "a" else count
    # Where the page itself marks its main text, a long advert beside it is still an advert.
    least = plain[id(body)] / 2
    if any(node.tag in ("article", "main") and plain[id(node)] for node in nodes):
        least = plain[id(body)]
    for node in nodes:
        if node.named and id(node) not in owners and plain[id(node)] <= least:
            node.dropped = True


def _in_order(root: Node) -> list[Node]:
    """Nodes that count, parents before children."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(c for c in node.children() if not c.dropped)
    return found


def weigh(body: Node) -> list[Node]:
    """Fill in counts, densities and density sums; the nodes, parents first."""
    nodes = _in_order(body)
    for node in reversed(nodes):
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len(_SPACES.sub("", html.unescape(part) if "&" in part else part))
            elif not part.dropped:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        c, lc = node.chars, node.link_chars
        tags, lt = max(node.tags, 1), max(node.link_tags, 1)
        if not c:
            continue
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        inside = c / max(lc, 1) * tags / lt
        # base is 1 or more; for 1 the logarithm to it is taken to be the natural one
        node.density = max(c / tags * math.log(max(inside, 1)) / max(math.log(base), 1.0), 0.0)
    for node in nodes:
        node.total = sum(
            c.density for c in node.children() if c.tag in _BLOCK and not c.dropped
        )
    return nodes


def main_nodes(body: Node) -> list[Node]:
    """Subtrees of main text in page order."""
    nodes = weigh(body)
    # Largest density sum within each subtree, children before parents.
    largest = {id(n): n for n in nodes}
    for n in reversed(nodes):
        for child in n.children():
            if not child.dropped and largest[id(child)].total > largest[id(n)].total:
                largest[id(n)] = largest[id(child)]
    best = largest[id(body)]
    if not best.total:
        return [body]
    threshold, node = best.density, best
    while node is not None:
        threshold = min(threshold, node.density)
        node = node.parent
    # In every node at or above the threshold the subtree of the largest sum is marked, from
    # the body down. A node without such sums below it, as a paragraph, is its own subtree.
    chosen, stack = set(), [body]
    while stack:
        node = stack.pop()
        if id(node) in chosen or node.density < threshold:
            continue
        chosen.add(id(largest[id(node)]))
        if largest[id(node)] is not node:
            stack.extend(c for c in node.children() if not c.dropped)
    return [n for n in _page_order(body) if id(n) in chosen]


def _page_order(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(reversed([c for c in node.children() if not c.dropped]))


def blocks_of(root: Node) -> list[str]:
    """Text of each block, white space as one space, without empty ones."""
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = _SPACES.sub(" ", html.unescape("".join(line))).strip()
        line.clear()
        if text:
            blocks.append(text)

    stack: list = [root]
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            line.append(part)
        elif part is None:
            end()
        elif not part.dropped:
            if part.tag in _BLOCK:
                end()
                stack.append(None)
            elif part.tag in ("br", "wbr"):
                line.append(" ")
            stack.extend(reversed(part.parts))
    end()
    return blocks


def main_text(page: str | None) -> str:
    if not page:
        return ""
    body = parse(page)
    return "\n".join(b for node in main_nodes(body) for b in blocks_of(node))


def extract_main_text(
    pages: DataFrame, source: str = "html", keep: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """``keep`` columns, text and n_chars of every page."""
    read = pages.select(*keep, F.col(source).alias(unused("_html", keep)))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1]]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in by_size(batch):
                found = [main_text(t) for t in texts]
                columns = [piece.column(i) for i in range(len(keep))]
                columns += [pa.array(found, pa.string()),
                            pa.array([len(t) for t in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text", "n_chars"])

    return read.mapInArrow(rows, ", ".join([*fields, "text string", "n_chars long"]))
