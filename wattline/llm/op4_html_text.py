"""Main text of web pages by composite text density.

A page is read into a tree of its block elements in one pass over its tags; elements that the format allows to stay
open are closed where the next one begins. Every node gets its characters per tag, adjusted for characters and tags in
links; a node's density sum adds up its children's densities. The least density on the path from the densest node up to
the body is the threshold; among nodes that reach it, the one with the largest density sum is the main subtree. It is
widened to its parent while the parent keeps at least half its density, so that sections stay together.

Tags are told apart as the markup standard does, in one pass that reads no character twice: a quote inside an unquoted value
or a name opens nothing, and a tag that the page ends in drops what follows.

Never part of the text, and cut out before densities are taken: navigation, footers, sidebars, scripts, styles and the
like by their element, and the labels of a form. Cut out where they don't hold the page's own text: forms and page headers outside an article;
adverts, notices, menus, comments and the like by class, id and role (names made of such words only: ``sidebar`` and
``cookie-notice``, not ``has-sidebar``); hidden elements. Articles and main elements and what holds one always stay,
and so does a node with most of the page's text outside links, unless an article beside it (or, for comments, around it)
has a tenth of that. If the cuts would take more than nine tenths of the page's text, densities decide alone.

Defined results: null and empty html, and pages without text, give the empty string; character references are decoded;
white space inside a block becomes one space; blocks are joined in page order by an empty line; unclosed and stray tags
are accepted; nesting may be of any depth.
"""

from __future__ import annotations

import html as references
import math
import re
from functools import lru_cache

from pyspark.sql import DataFrame

from wattline.llm.common import map_texts

# As the markup standard reads them. Repetitions are possessive: what was read is never read again.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*+)?)?+|=)*+)>""")
COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.S)
ATTRIBUTE = re.compile(r"""=?([^\s/>=]++)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>][^\s>]*+)?)?+""")

# fixed values: what the markup standard and common practice give
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
CUT = RAW | {"nav", "footer", "aside", "button", "select", "option", "svg", "canvas", "object", "audio", "video", "head", "menu", "dialog", "input", "map"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
INLINE = {
    "b", "i", "em", "strong", "span", "u", "s", "small", "big", "font", "tt", "code", "kbd", "samp", "var", "sub", "sup", "mark", "q",
    "cite", "abbr", "acronym", "time", "del", "ins", "bdi", "bdo", "dfn", "strike", "ruby", "rb", "rt", "rp", "data", "a", "wbr", "center", "label",
    "math", "mrow", "mi", "mo", "mn", "mtext", "ms", "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot", "mover", "munder", "munderover",
}
BLOCKS_CLOSE_P = {
    "p", "div", "ul", "ol", "dl", "h1", "h2", "h3", "h4", "h5", "h6", "table", "article", "section", "header", "footer", "nav", "aside",
    "blockquote", "pre", "form", "figure", "figcaption", "main", "hr", "address", "fieldset", "details", "menu",
}
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "p": {"td", "th", "li", "blockquote", "div", "article", "section", "main", "body"}}
BOILERPLATE = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "sponsor", "sponsored", "promo", "cookie", "cookies", "consent", "notice", "notices",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "side", "aside", "widget", "widgets", "footer", "comment",
    "comments", "reply", "replies", "disqus", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "subscription",
    "popup", "modal", "overlay", "login", "signup", "search", "pagination", "pager", "toolbar", "masthead", "complementary", "contentinfo", "alert",
}
READERS = {"comment", "comments", "reply", "replies", "disqus"}
NAMES = {"class", "id", "role"}
TOPS = {"article", "main"}


class Node:
    __slots__ = ("tag", "parent", "children", "blocks", "chars", "link_chars", "tags", "link_tags", "cut", "top", "density", "inner", "doubt", "post", "holds", "plain", "told")

    def __init__(self, tag: str, parent: Node | None, cut: bool, doubt: str = ""):
        self.tag, self.parent, self.cut = tag, parent, cut
        self.top = tag in TOPS or (parent is not None and parent.top)  # inside an article
        self.doubt = doubt  # why it may be unwanted
        self.post = tag == "article" or (parent is not None and parent.post)
        self.holds = tag == "main" or (tag == "article" and not parent.post)  # articles in articles are comments and the like
        self.plain = self.told = 0  # text outside links: of the subtree, of the articles and main elements in it
        self.children: list[Node] = []
        self.blocks: list = []  # text pieces and nodes, in page order
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.inner = 0.0


def doubtful(tag: str, attributes: str, article: bool) -> str:
    """Why an element may be unwanted; empty if nothing says so."""
    if tag == "form" or (tag == "header" and not article):
        return tag
    found = ""
    for m in ATTRIBUTE.finditer(attributes):
        name = (m.group(1) or "").lower()  # none for a quoted text without a name
        if name == "hidden":
            found = found or "named"
        elif name in NAMES:
            for token in (m.group(2) or "").strip("\"'").lower().split():
                words = [w for w in re.split(r"[^a-z]+", token) if w]
                if words and BOILERPLATE.issuperset(words):
                    found = "readers" if not READERS.isdisjoint(words) else found or "named"
    return found


@lru_cache(maxsize=len(RAW))
def raw_end(name: str) -> re.Pattern:
    return re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.I)


def parse(page: str) -> Node:
    """The tree of block elements; cut ones are read past but hold nothing."""
    root = Node("body", None, False)
    stack = [root]
    links = 0
    at, end = 0, len(page)

    def text(piece: str) -> None:
        node = stack[-1]
        if piece and not node.cut:
            node.blocks.append(piece)
            size = len(piece.strip())
            node.chars += size
            if links:
                node.link_chars += size

    def close(names: set[str], until: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in names:
                del stack[depth:]
                return
            if stack[depth].tag in until:
                return

    while at < end:
        start = page.find("<", at)
        if start < 0:
            text(page[at:])
            break
        if start > at:
            text(page[at:start])
        kind = page[start + 1 : start + 2]
        m = TAG.match(page, start)
        if m is None:
            if page.startswith("<![CDATA[", start):
                stop = page.find("]]>", start)
                text(page[start + 9 : stop if stop >= 0 else end])
                at = stop + 3 if stop >= 0 else end
            elif page.startswith("<!--", start):
                at = COMMENT.match(page, start).end()
            elif kind in ("!", "?", "/") and kind:
                at = page.find(">", start) + 1 or end
            elif kind.isascii() and kind.isalpha():
                break  # a tag that the page ends in
            else:
                text("<")
                at = start + 1
            continue
        at, name = m.end(), m.group(2)
        name, attributes = name.lower(), m.group(3)
        if m.group(1):
            if name == "a":
                links = max(0, links - 1)
            if name in INLINE:
                depth = len(stack) - 1
                while stack[depth].tag in INLINE:
                    if stack[depth].tag == name:
                        del stack[depth:]
                        break
                    depth -= 1
            elif name not in ("html", "body"):
                close({name}, {"article", "body"} if name not in ("article", "main", "div", "section") else set())
            continue
        if name in ("html", "body"):
            continue
        if name in RAW:
            done = raw_end(name).search(page, at)
            at = done.end() if done else end
            continue
        parent = stack[-1]
        if name in INLINE or name in VOID:
            if name == "label" and not parent.cut and any(x.tag == "form" for x in stack):
                node = Node(name, parent, True)
                stack.append(node)
            elif name == "a" and not attributes.rstrip().endswith("/"):
                links += 1
                parent.link_tags += not parent.cut
                parent.tags += not parent.cut
            elif name in ("br", "hr", "wbr"):
                text("" if name == "wbr" else " ")
                if name == "hr" and not parent.cut:
                    parent.blocks.append(None)
            elif name in INLINE and not parent.cut and not attributes.rstrip().endswith("/"):
                doubt = doubtful(name, attributes, True)
                if doubt or parent.tag in INLINE:
                    node = Node(name, parent, False, doubt)
                    parent.children.append(node)
                    parent.blocks.append(node)
                    stack.append(node)
            continue
        links = 0
        if name in BLOCKS_CLOSE_P:
            close({"p"}, HOLDS["p"])
        if name in SAME_CLOSES:
            close(SAME_CLOSES[name], HOLDS[name])
        parent = stack[-1]
        node = Node(name, parent, parent.cut or name in CUT, "" if parent.cut else doubtful(name, attributes, parent.top))
        if not node.cut:
            parent.children.append(node)
            parent.blocks.append(node)
            parent.tags += 1
        if not attributes.rstrip().endswith("/"):
            stack.append(node)
    settle(root)
    return root


def settle(root: Node) -> None:
    """Cut what is unwanted and doesn't hold the page's own text; inline elements become part of their blocks."""
    nodes = walk(root)
    if not any(n.doubt or n.tag in INLINE for n in nodes):
        return
    for node in reversed(nodes):
        node.plain = node.chars - node.link_chars + sum(x.plain for x in node.children)
        node.told = sum(x.told for x in node.children)
        if node.holds:
            node.told = max(node.told, node.plain if node.tag == "article" or not node.told else 0)
        node.holds = node.holds or any(x.holds for x in node.children)

    def stays(node: Node) -> bool:
        if node.tag in TOPS or node.holds:
            return True
        if node.doubt == "header" or 2 * node.plain <= root.plain:
            return False
        around = node.parent
        while around.parent is not None and around.tag not in TOPS:
            around = around.parent
        rest = root.told  # of an article elsewhere on the page, or around the readers' comments
        if around.tag in TOPS:
            rest = around.plain - node.plain if node.doubt == "readers" else 0
        return 10 * rest < node.plain

    gone = {n for n in nodes if n.doubt and not stays(n)}
    left, todo = 0, [root]
    while todo:
        node = todo.pop()
        left += node.chars - node.link_chars
        todo.extend(x for x in node.children if x not in gone)
    if 10 * left < root.plain:
        gone = {n for n in gone if n.doubt == "header"}
    for node in reversed(nodes):
        merged = [x for x in node.children if x.tag in INLINE and x not in gone]
        node.tags -= sum(x.tag not in INLINE for x in node.children if x in gone)
        if not merged and gone.isdisjoint(node.children):
            continue
        for child in merged:
            node.chars += child.chars
            node.link_chars += child.link_chars
            node.tags += child.tags
            node.link_tags += child.link_tags
            for x in child.children:
                x.parent = node
        node.children = [y for x in node.children if x not in gone for y in (x.children if x.tag in INLINE else [x])]
        node.blocks = [y for x in node.blocks if x not in gone for y in (x.blocks if isinstance(x, Node) and x.tag in INLINE else [x])]


def walk(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out = [root]
    for node in out:
        out.extend(node.children)
    return out


def densities(root: Node) -> list[Node]:
    nodes = walk(root)
    for node in reversed(nodes):
        for child in node.children:
            node.chars += child.chars
            node.link_chars += child.link_chars
            node.tags += child.tags
            node.link_tags += child.link_tags
    body = max(root.chars, 1)
    share = root.link_chars / body
    for node in reversed(nodes):
        c, lc, t, lt = node.chars, node.link_chars, max(node.tags, 1), max(node.link_tags, 1)
        if c:
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            node.density = c / t * max(0.0, math.log(max(c / max(lc, 1) * t / lt, 1.0))) / base
        node.inner = sum(x.density for x in node.children)
    return nodes


def main_node(root: Node) -> Node:
    nodes = densities(root)
    densest = max(nodes, key=lambda n: n.density)
    threshold, at = densest.density, densest
    while at.parent is not None:
        at = at.parent
        threshold = min(threshold, at.density)
    best = max((n for n in nodes if n.density >= threshold), key=lambda n: n.inner)
    while best.parent is not None and best.tag not in TOPS and best.parent.density >= 0.5 * best.density:
        best = best.parent
    return best


def blocks(node: Node) -> list[str]:
    """Texts of a subtree's blocks in page order."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if line:
            piece = " ".join(references.unescape("".join(line)).split())
            line.clear()
            if piece:
                out.append(piece)

    todo: list = [iter(node.blocks)]
    while todo:
        item = next(todo[-1], flush)
        if item is flush:
            flush()
            todo.pop()
        elif isinstance(item, str):
            line.append(item)
        else:
            flush()
            if item is not None:
                todo.append(iter(item.blocks))
    return out


def extract(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    if not root.children:
        return "\n\n".join(blocks(root))
    return "\n\n".join(blocks(main_node(root)))


def extract_text(df: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all other columns by default), ``text`` and ``n_chars`` (code points)."""

    def make(pages):
        texts = [extract(p) for p in pages]
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    keep = [c for c in df.columns if c not in (html, "text", "n_chars")] if keep is None else keep
    return map_texts(df, html, "text string, n_chars bigint", make, keep)
