"""A small tolerant HTML tree, enough to tell blocks of text and where they stand."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

# Tags with well-formed or sloppy attributes, comments, declarations. Nothing here backtracks
# over more than the tag itself: a tag ends before the next `<` outside quotes.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*+>"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*+)(?P<attrs>(?:[^<>"']|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/<>]*+)(?P<attrs2>[^<>]*+)>""",
    re.S,
)
_ATTR = re.compile(
    r"""([a-zA-Z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([a-zA-Z_:][-\w:.]*)""", re.S
)

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript template iframe svg math object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
# An open element of the first kind ends where one of the second kind begins.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"},
}
_SCOPES = frozenset("html body table td th ul ol dl select button article section".split())


class Node:
    """`kids` holds nodes and decoded strings, in page order."""

    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def attributes(self) -> dict[str, str]:
        found = {}
        for name, a, b, c, bare in _ATTR.findall(self.attrs):
            found.setdefault((name or bare).lower(), html.unescape(a or b or c))
        return found


def _close(stack: list[Node], tags: set[str]) -> None:
    """Ends the innermost open element of these tags, unless a scope lies in between."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in _SCOPES:
            return


def parse(page: str) -> Node:
    root = Node("#root")
    stack, at, size = [root], 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            stack[-1].kids.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            stack[-1].kids.append(html.unescape(page[at : m.start()]))
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag not in INLINE and tag not in RAW:
            _close(stack, {"p"})
        if tag in _CLOSES:
            _close(stack, _CLOSES[tag])
        attrs = m["attrs"] if m["tag"] else m["attrs2"]
        node = Node(tag, attrs)
        stack[-1].kids.append(node)
        if tag in VOID or attrs.endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^<>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        stack.append(node)
    return root


def blocks(node: Node, skip, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], str]]:
    """(path, text) of the blocks below a node. `skip(node, path)` leaves out subtrees.

    A block's text is all text between two borders of block elements, its white space joined.
    Iterative, so that deep nesting is no concern.
    """
    text: list[str] = []

    def flush(where: tuple[str, ...]) -> Iterator[tuple[tuple[str, ...], str]]:
        joined = " ".join("".join(text).split())
        text.clear()
        if joined:
            yield where, joined

    todo: list[tuple[str, object, tuple[str, ...]]] = [("in", node, path)]
    while todo:
        step, item, where = todo.pop()
        if step == "out":
            yield from flush(where)
        elif isinstance(item, str):
            text.append(item)
        elif item.tag == "br":
            text.append(" ")
        elif item is node or not (item.tag in RAW or skip(item, where)):
            inside = where
            if item.tag not in INLINE:
                yield from flush(where)
                inside = where if item is node else where + (item.tag,)
                todo.append(("out", None, inside))
            todo.extend(("in", kid, inside) for kid in reversed(item.kids))
