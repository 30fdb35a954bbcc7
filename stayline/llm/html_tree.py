"""A small DOM: block elements as a tree, with the text that stands directly in them.

Inline elements are transparent: their text belongs to the block around them. Script, style and the like are dropped with
what they hold, comments and declarations too. Missing end tags are closed as a browser does for paragraphs, list items,
cells and options; a document cut off in a tag loses that tag.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Elements by what the standard says of them
DROPPED = frozenset("script style noscript template head title iframe object svg math canvas audio video textarea select "
                    "datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output "
                   "progress q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
    "option": ("option",),
}
KEEPS_OPEN = frozenset("ul ol dl table body html div section article main aside nav form".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^>]*(?:>|\Z)",
                    re.S)
_MARKS = re.compile(r"""(?:^|[\s"'])(class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    marks: tuple[str, ...] = ()
    attributes: str = ""
    runs: list[tuple[int, str]] = field(default_factory=list)  # (position in the page, text)
    linked: int = 0  # characters of link text
    holds: set[str] = field(default_factory=set)  # tags of its blocks


def _marks(attributes: str) -> tuple[str, ...]:
    found = {part for m in _MARKS.finditer(attributes)
             for part in _PARTS.findall(_CAMEL.sub(" ", m[2]).lower()) if len(part) > 1}
    if _HIDDEN.search(attributes):
        found.add("hidden")
    return tuple(sorted(found))


def parse(page: str) -> list[Node]:
    """Nodes in page order, a parent before its children; the first is the document."""
    nodes = [Node("#document", -1)]
    open_ = [0]  # indexes of open blocks
    links, at, place, ends = 0, 0, 0, len(page)

    def add_text(raw: str) -> None:
        nonlocal place
        text = html.unescape(raw) if "&" in raw else raw
        if text:
            node = nodes[open_[-1]]
            node.runs.append((place, text))
            place += 1
            if links:
                node.linked += len(text.strip())

    def close(tags: tuple[str, ...]) -> None:
        for i in range(len(open_) - 1, 0, -1):
            tag = nodes[open_[i]].tag
            if tag in tags:
                del open_[i:]
                return
            if tag in KEEPS_OPEN:
                return

    while at < ends:
        found = _TOKEN.search(page, at)
        if found is None:
            add_text(page[at:])
            break
        if found.start() > at:
            add_text(page[at:found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag, ending = tag.lower(), found[1] == "/"
        if tag in DROPPED:
            if not ending and not found[3].endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                if tag == "head":  # may be left open; it ends where the body begins
                    body = re.compile(r"<body\b", re.I).search(page, at)
                    at = min(stop.end() if stop else ends, body.start() if body else ends)
                else:
                    at = stop.end() if stop else ends
            continue
        if tag == "a":
            links = 0 if ending else 1
        if tag in VOID:
            if tag in ("br", "hr"):
                add_text(" ")
            if tag == "hr":
                close(("p",))
            continue
        if tag in INLINE:
            continue
        if ending:
            for i in range(len(open_) - 1, 0, -1):
                if nodes[open_[i]].tag == tag:
                    del open_[i:]
                    break
            continue
        links = 0
        close(("p",))
        if tag in CLOSES:
            close(CLOSES[tag])
        nodes[open_[-1]].holds.add(tag)
        nodes.append(Node(tag, open_[-1], _marks(found[3]) if "=" in found[3] or "hidden" in found[3] else (), found[3]))
        open_.append(len(nodes) - 1)
    return nodes


def block_runs(nodes: list[Node]) -> list[tuple[int, int, str]]:
    """(place, node, text) of the blocks in page order: runs of one node that no other block's run parts, white space
    made one space and trimmed."""
    flat = sorted((place, i, text) for i, node in enumerate(nodes) for place, text in node.runs)
    out: list[tuple[int, int, str]] = []
    start = 0
    for end in range(1, len(flat) + 1):
        if end == len(flat) or flat[end][1] != flat[start][1]:
            text = " ".join("".join(t for _, _, t in flat[start:end]).split())
            if text:
                out.append((flat[start][0], flat[start][1], text))
            start = end
    return out
