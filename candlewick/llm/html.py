"""Main text of web pages by composite text density.

A page becomes a tree of its tags. Every node gets its density: characters per tag, lowered where the
characters are link text. The densities of a node's children add up to its sum. The node with the
largest sum marks the text; the smallest density on its path up to the body is the threshold. From
the body down, under each node that reaches the threshold the subtree of the largest sum is marked
(a node without elements is its own), and its children are judged in turn; marks inside others merge. Elements that never hold text of an article (scripts, forms, menus, asides, and elements whose
class or id says advert, comment, sidebar and the like) are cut before any density is computed.

Blocks are joined by a line end, white space inside a block is one space, character references are
decoded. Null, empty and text-free pages have an empty text. Unclosed and stray tags are tolerated
and no page is too deep or too long: nothing recurses, nothing is cut. Rows are judged one by one; other
columns are untouched, a column with the result's name is replaced; an empty table stays empty.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
RAW = frozenset("script style noscript textarea title iframe template xmp noembed noframes".split())
DROPPED = frozenset(
    "script style noscript textarea title iframe template head nav footer aside form button select option input svg "
    "canvas object embed audio video dialog menu noembed noframes".split()
)
#: A new one of these ends an open one of the same group, up to the nearest element that may hold both.
ENDS = {
    "p": ({"p"}, {"article", "section", "div", "body", "td", "th", "li", "blockquote", "main", "dd"}),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements before which an open paragraph ends.
END_PARAGRAPH = BLOCKS - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dd", "dt"}

#: Words in class, id or role that mark an element as no part of the article.
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|comments?|disqus|respond|replies|sidebar|side-bar|menu|navbar|"
    r"nav|navigation|breadcrumbs?|pagination|pager|footer|masthead|site-header|page-header|cookies?|consent|gdpr|notice|"
    r"popup|modal|newsletter|subscribe|share|sharing|social|related|recommended|widget|toolbar|login|signup|search|"
    r"contentinfo|complementary|alert|skip-link)(?:$|[\s_-])",
    re.IGNORECASE,
)

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
_MARK = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.IGNORECASE)
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False) -> None:
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.children: list[Node | str] = []


def _noisy(tag: str, attributes: str, parent: Node) -> bool:
    if tag in DROPPED:
        return True
    if tag == "header" and not any(x.tag in ("article", "main") for x in _upward(parent)):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    marked = any(NOISE.search(next(filter(None, m.groups()), "")) for m in _MARK.finditer(attributes))
    return marked or bool(_HIDDEN.search(attributes))


def _upward(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def parse(page: str) -> Node:
    """The page's tree. Text and elements are children in page order."""
    root = at = Node("html", None)
    place = 0
    for token in _TOKEN.finditer(page):
        if token.start() < place:
            continue
        if token.start() > place:
            at.children.append(page[place : token.start()])
        place = token.end()
        name = token.group(2)
        if name is None:
            if token.group(0).startswith("<![CDATA["):
                at.children.append(token.group(0)[9:-3].replace("&", "&amp;"))
            continue
        tag = name.lower()
        if token.group(1):
            found = next((x for x in _upward(at) if x.tag == tag), None)
            if found is not None and found.parent is not None:
                at = found.parent
            continue
        if tag == "html":
            continue
        if tag in END_PARAGRAPH or tag in ENDS:
            closes, stops = ENDS.get(tag, ({"p"}, ENDS["p"][1]))
            if tag in END_PARAGRAPH and tag != "p":
                closes, stops = closes | {"p"}, stops | ENDS["p"][1]
            last = None
            for x in _upward(at):
                if x.tag in closes:
                    last = x
                elif x.tag in stops:
                    break
            if last is not None and last.parent is not None:
                at = last.parent
        node = Node(tag, at, _noisy(tag, token.group(3), at))
        at.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, place)
            if tag in ("textarea", "title", "noscript"):
                node.children.append(page[place : end.start() if end else len(page)])
            place = end.end() if end else len(page)
        elif tag not in VOID and not token.group(3).rstrip().endswith("/"):
            at = node
    if place < len(page):
        at.children.append(page[place:])
    return root


def _in_order(root: Node) -> list[Node]:
    """All kept elements, each before those in it."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(x for x in reversed(node.children) if isinstance(x, Node) and not x.dropped)
    return out


def measure(root: Node) -> list[Node]:
    """Sets characters, tags, link characters and link tags, densities and their sums."""
    nodes = _in_order(root)
    for node in reversed(nodes):
        kept = [x for x in node.children if isinstance(x, Node) and not x.dropped]
        own = sum(len(_SPACE.sub("", html.unescape(x))) for x in node.children if isinstance(x, str))
        node.chars = own + sum(x.chars for x in kept)
        node.tags = len(kept) + sum(x.tags for x in kept)
        link = node.tag == "a"
        node.link_chars = node.chars if link else sum(x.link_chars for x in kept)
        node.link_tags = node.tags + 1 if link else sum(x.link_tags for x in kept)
    body = next((x for x in nodes if x.tag == "body"), root)
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in reversed(nodes):
        node.density = _density(node, share)
        node.total = sum(x.density for x in node.children if isinstance(x, Node) and not x.dropped)
    return nodes


def _density(node: Node, body_share: float) -> float:
    """Characters per tag times a logarithm that falls as links take over the node's characters."""
    if not node.chars:
        return 0.0
    tags, links, link_tags = max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
    plain = max(node.chars - node.link_chars, 1)
    base = math.log(node.chars / plain * node.link_chars + body_share * node.chars + math.e)  # 1 at least
    weight = math.log(node.chars / links * tags / link_tags + 1) / math.log(base + 1)
    return node.chars / tags * weight


def select(nodes: list[Node]) -> list[Node]:
    """The chosen subtrees in page order."""
    body = next((x for x in nodes if x.tag == "body"), nodes[0])
    inside = [x for x in nodes if x is body or any(y is body for y in _upward(x))] if body is not nodes[0] else nodes
    best = max(inside, key=lambda x: x.total)
    if best.total <= 0:
        return [body]
    path = []
    for x in _upward(best):
        path.append(x)
        if x is body:
            break
    threshold = min(x.density for x in path)
    strongest = {id(x): x for x in inside}
    for x in reversed(inside):  # the descendant or self with the largest sum
        for child in x.children:
            if isinstance(child, Node) and not child.dropped and strongest[id(child)].total > strongest[id(x)].total:
                strongest[id(x)] = strongest[id(child)]
    marked: set[int] = set()
    todo = [body]
    while todo:
        node = todo.pop()
        if node.density >= threshold and node.chars:
            marked.add(id(strongest[id(node)]))
            todo.extend(x for x in node.children if isinstance(x, Node) and not x.dropped)
    chosen, todo = [], [body]
    while todo:
        node = todo.pop()
        if id(node) in marked:
            chosen.append(node)
        else:
            todo.extend(x for x in reversed(node.children) if isinstance(x, Node) and not x.dropped)
    return chosen


def blocks(root: Node) -> list[str]:
    """The text of a subtree by blocks."""
    done: list[str] = []
    line: list[str] = []

    def close() -> None:
        if text := _SPACE.sub(" ", html.unescape("".join(line))).strip():
            done.append(text)
        line.clear()

    todo: list[tuple[Node | str, bool]] = [(root, False)]
    while todo:
        item, leaving = todo.pop()
        if isinstance(item, str):
            line.append(item)
            continue
        if item.tag in BLOCKS:
            close()
        if not leaving:
            todo.append((item, True))
            todo.extend((x, False) for x in reversed(item.children) if isinstance(x, str) or not x.dropped)
    close()
    return done


def _article(nodes: list[Node], chosen: list[Node]) -> list[Node]:
    """Where the chosen subtrees lie in one article or main element, all of it: its title and its
    short paragraphs belong to it though they are not dense."""
    holders = [next((y for y in _upward(x) if y.tag in ("article", "main")), None) for x in chosen]
    if None in holders:
        return chosen
    return list(dict.fromkeys(holders))


def main_text(page: str | None) -> str:
    if not page:
        return ""
    nodes = measure(parse(page))
    return "\n".join(line for root in _article(nodes, select(nodes)) for line in blocks(root))


def extract(page: Column) -> Column:
    """The main text of pages."""

    @F.arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([main_text(x.as_py()) for x in pages], pa.string())

    return extracted(page)
