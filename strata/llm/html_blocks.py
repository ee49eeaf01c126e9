"""Leaf text blocks of an HTML page, with the tags and names of their ancestors.

A forgiving reader in the spirit of browsers: a regular expression finds tags,
comments and declarations; scripts, styles and other raw-text elements are
skipped; elements with optional end tags are closed by their siblings; an end
tag without a start is ignored; a page may stop anywhere. Text between two
block-level tags is one leaf block; inline tags (and ``br``) stay inside it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
NAMED = re.compile(r"""(?:^|\s)(class|id|role|rel|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
NAME_PARTS = re.compile(r"[A-Za-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Kinds of HTML elements.
RAW = frozenset("script style noscript template iframe textarea title svg math noembed noframes xmp select datalist object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output picture progress q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr source".split()
)
# A start tag of the first kind ends an open element of the second, up to the third.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
    "body": (("head",), ("html",)),
}
P_ENDERS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section summary table ul".split()
)
P_SCOPE = frozenset("button table td th caption html".split())


class Node:
    """An open element; ``path`` walks up to the outermost one."""

    __slots__ = ("names", "parent", "tag", "view")

    def __init__(self, tag: str, names_: tuple[str, ...], parent: Node | None):
        self.tag, self.names, self.parent = tag, names_, parent
        self.view = None  # what a reader of blocks keeps per element

    def path(self) -> list[Node]:
        out, node = [], self
        while node is not None:
            out.append(node)
            node = node.parent
        return out[::-1]


@dataclass
class Block:
    text: str
    node: Node | None  # the innermost block-level element, outside of any: None
    linked: int  # characters inside links

    @property
    def path(self) -> tuple[tuple[str, tuple[str, ...]], ...]:
        """(tag, name parts) of the block-level ancestors, outermost first."""
        return tuple((n.tag, n.names) for n in self.node.path()) if self.node else ()


def names(attributes: str) -> tuple[str, ...]:
    """The words of an element's class, id and the like, lower-cased."""
    if "=" not in attributes:
        return ()
    out = []
    for m in NAMED.finditer(attributes):
        value = m.group(2) or m.group(3) or m.group(4) or ""
        out += [x.lower() for x in NAME_PARTS.findall(CAMEL.sub(" ", value))]
    return tuple(out)


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[Node] = []  # all open elements
    outer: list[Node | None] = [None]  # the innermost block-level element at each depth of the stack
    open_tags: Counter[str] = Counter()
    parts: list[str] = []
    linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if open_tags["a"]:
                linked += len(text)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, outer[-1], linked))
            parts.clear()
        linked = 0

    def close(tags: tuple[str, ...], scope: tuple[str, ...] | frozenset[str]) -> None:
        """End the innermost open element of these tags, and all in it, unless one of ``scope`` is nearer."""
        if not any(open_tags[t] for t in tags):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].tag in tags:
                open_tags.subtract(x.tag for x in stack[k:])
                del stack[k:], outer[k + 1 :]
                return
            if stack[k].tag in scope:
                return

    at = 0
    while m := TAG.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        if end := m.group(1):
            tag = end.lower()
            if tag not in INLINE:
                flush()
            close((tag,), ())
            continue
        start = m.group(2) or m.group(4)
        if not start:
            continue
        tag, attributes = start.lower(), m.group(3) or m.group(5) or ""
        if tag not in INLINE:
            flush()
        if tag in RAW:
            if not attributes.rstrip().endswith("/"):
                over = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = over.end() if over else len(page)
            continue
        if tag in P_ENDERS:
            close(("p",), P_SCOPE)
        if tag in ENDS:
            close(*ENDS[tag])
        if tag == "br":
            parts.append(" ")
        if tag not in VOID and not (attributes.endswith("/") and tag in INLINE):
            node = Node(tag, names(attributes), outer[-1])
            stack.append(node)
            outer.append(outer[-1] if tag in INLINE else node)
            open_tags[tag] += 1
    add(page[at:])
    flush()
    return out
