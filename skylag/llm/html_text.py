"""Main text of web pages by composite text density.

Each page becomes a small tree. Every node gets its characters per tag, lowered
where its text stands in links; a node's density sum is the sum over its
children. The subtree with the largest sum is the article. The least density on
the path from there to the body is the threshold at which further subtrees
beside it count as content too. As a bonus, what stands in the same outermost
article or main element needs no such density unless it is mostly links. Menus, adverts, forms and the like are cut out
first, by element and role, and by class if they hold the lesser part of the text.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import sliced

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)(?:((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|[^>]*+>)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPACE = re.compile(r"[ \t\n\r\f\v]+")

# Element names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCK - frozenset("td th tr tbody thead tfoot body html".split())
_CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
}
_SCOPES = frozenset("ul ol dl table tr div article section main aside nav header footer body html blockquote form".split())
_CUT = frozenset(
    "head script style noscript template nav aside footer form button select input textarea iframe svg canvas object embed "
    "menu dialog audio video map label fieldset title".split()
)
_CUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# Words that name page furniture in class and id.
_FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar cookie cookies consent "
    "notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended comment comments commentlist reply replies respond disqus widget search pagination pager copyright".split()
)
_CONTENT = frozenset(["article", "main"])


class Node:
    __slots__ = ("tag", "parent", "children", "cut", "chars", "links", "tags", "link_tags", "density", "total", "place", "content", "marked", "own")

    def __init__(self, tag, parent, cut, place, content):
        self.tag, self.parent, self.cut, self.place, self.content = tag, parent, cut, place, content
        self.children: list = []
        self.chars = self.links = self.tags = self.link_tags = self.own = 0
        self.marked = False
        self.density = self.total = 0.0


def _furniture(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is no part of an article. ``inside``: it stands in an article or main element."""
    if tag in _CUT or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), entities.unescape(value.strip("\"'")).lower()
        if name == "role" and value in _CUT_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
    return False


def _named(tag: str, attributes: str) -> bool:
    """Whether a whole class name or the id speaks of page furniture, which is evidence only."""
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    return any(
        name.lower() in ("class", "id") and not _FURNITURE.isdisjoint(entities.unescape(value.strip("\"'")).lower().split())
        for name, value in _ATTRIBUTE.findall(attributes)
    )


def parse(page: str) -> Node:
    """The element tree; unclosed and misnested elements are closed where the next element demands it.

    Text nodes are strings among the children.
    """
    root = node = Node("#root", None, False, 0, False)
    at, place = 0, 0
    while True:
        match = _TOKEN.search(page, at)
        text = page[at : match.start() if match else len(page)]
        if text:
            node.children.append(entities.unescape(text))
        if match is None:
            return root
        at = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1]:
            up = node
            while up is not None and up.tag != tag:
                up = up.parent if tag not in ("p", "b", "i", "a", "em", "span", "strong") or up.tag not in _SCOPES else None
            if up is not None and up.parent is not None:
                node = up.parent
            elif tag in ("p", "br"):
                node.children.append(Node(tag, node, False, place, False))
            continue
        if tag in ("html", "body") and any(c.tag == tag for c in _line(node)):
            continue
        if tag in _CLOSES_P:
            node = _close(node, ("p",))
        if tag in _CLOSED_BY:
            node = _close(node, _CLOSED_BY[tag])
        if tag == "body" or (node.tag == "head" and tag not in ("meta", "link", "base", "title", "style", "script", "noscript", "template")):
            node = _close(node, ("head",))
        place += 1
        inside = node.content
        child = Node(tag, node, node.cut or _furniture(tag, match[3] or "", inside), place, inside or tag in _CONTENT)
        child.marked = not child.cut and _named(tag, match[3] or "")
        node.children.append(child)
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if not child.cut:
                child.children.append(entities.unescape(page[at : end.start() if end else len(page)]))
            at = end.end() if end else len(page)
        elif tag not in _VOID and (tag in _BLOCK or not (match[3] or "").endswith("/")):
            node = child


def _line(node):
    while node is not None:
        yield node
        node = node.parent


def _close(node: Node, tags) -> Node:
    """Leave the nearest open element of these names, unless a container stands in between."""
    for up in _line(node):
        if up.tag in tags and up.parent is not None:
            return up.parent
        if up.tag in _SCOPES:
            break
    return node


def _left(root: Node) -> list[Node]:
    """Nodes that are not cut, parents before children."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        if not node.cut:
            nodes.append(node)
            stack.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return nodes


def _cut_marked(root: Node) -> list[Node]:
    """Cut nodes named as furniture; the nodes left.

    A node with most of the page's text outside links stays, unless it has no
    article, main or h1 element and others do.
    """
    nodes = _left(root)
    for node in reversed(nodes):
        node.own = sum(len(_SPACE.sub("", c)) for c in node.children if isinstance(c, str))
    if not any(n.marked for n in nodes):
        return nodes
    plain, heads = {}, {}
    for node in reversed(nodes):
        below = [id(c) for c in node.children if not isinstance(c, str) and not c.cut]
        plain[id(node)] = 0 if node.tag == "a" else node.own + sum(plain[c] for c in below)
        heads[id(node)] = (node.tag in _CONTENT or node.tag == "h1") + sum(heads[c] for c in below)
    for node in nodes:
        if node.marked:
            most = 2 * plain[id(node)] > plain[id(root)]
            node.cut = not most or heads[id(node)] == 0 < heads[id(root)]
    return _left(root)


def _measure(nodes: list[Node], body: Node) -> None:
    """Characters, tags and densities, children before parents."""
    for node in reversed(nodes):
        link = node.tag == "a"
        node.chars += node.own
        node.links += node.own * link
        for child in node.children:
            if not isinstance(child, str) and not child.cut:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.links += child.chars if link else child.links
                node.link_tags += child.link_tags + (child.tag == "a")
    overall = body.links / body.chars if body.chars else 0.0
    for node in nodes:
        if node.chars:
            tags, links, plain = max(node.tags, 1), max(node.links, 1), max(node.chars - node.links, 1)
            ratio = node.chars / links * tags / max(node.link_tags, 1)
            base = math.log(node.chars / plain * node.links + overall * node.chars + math.e)
            node.density = node.chars / tags * (math.log(ratio) / base if ratio > 1 else 0.0)
    for node in nodes:
        node.total = sum(c.density for c in node.children if not isinstance(c, str) and not c.cut and c.tag in _BLOCK)
        node.total += node.own if node.tag in _BLOCK else 0.0


def _blocks(root: Node) -> list[str]:
    blocks, open_text = [], []

    def flush():
        text = _SPACE.sub(" ", "".join(open_text)).strip(" ")
        text = re.sub(r"\s+", " ", text).strip()
        if text:
            blocks.append(text)
        open_text.clear()

    stack: list = [root]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            open_text.append(item)
        elif item is None:
            flush()
        elif item.tag == "br":
            open_text.append(" ")
        elif not item.cut:
            if item.tag in _BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(item.children))
    flush()
    return blocks


def main_text(page: str | None) -> str:
    """The article of a page as blocks with an empty line between; empty where there is none."""
    if not page:
        return ""
    root = parse(page)
    nodes = _cut_marked(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    _measure(nodes, body)
    blocks = [n for n in nodes if n.tag in _BLOCK or n is root]
    best = max(blocks, key=lambda n: (n.total, -n.place))
    while best is not body and best.parent is not None and (best.tag in ("p", "li", "ul", "ol", "dl", "tr", "td", "tbody", "thead") or best.tag[0] == "h" and best.tag[1:].isdigit()):
        best = best.parent
    path = [n for n in _line(best) if n.chars]
    threshold = min((n.density for n in path), default=0.0)
    home = next((n for n in reversed(path) if n.tag in _CONTENT), best)
    chosen = [home]
    if best is not body:
        under = set(map(id, path))
        whole = set(map(id, _left(best)))
        for node in _left(home):
            if node.tag in _BLOCK and node.density < threshold and 2 * node.links > node.chars and id(node) not in under and id(node) not in whole:
                node.cut = True
        for node in blocks:
            if id(node) in under or node.cut or node.total <= 0 or node.density < threshold:
                continue
            if not any(c is up for up in _line(node) for c in chosen):
                chosen.append(node)
    chosen.sort(key=lambda n: n.place)
    return "\n\n".join(b for n in chosen for b in _blocks(n))


def extract(df: DataFrame, html_col: str = "html") -> DataFrame:
    """Add ``text`` and ``n_chars`` (code points); a null, empty or textless page has an empty text.

    All other columns stay, but an own column ``text`` or ``n_chars`` is replaced.
    """
    kept = [c for c in df.columns if c not in ("text", "n_chars")]
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    place = kept.index(html_col)

    def run(batches):
        for part in sliced(batches, html_col):
            texts = [main_text(page) for page in part.column(place).to_pylist()]
            columns = [*part.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "text", "n_chars"])

    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, kinds + ", text string, n_chars long")
