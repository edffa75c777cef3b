"""A forgiving HTML reader: block elements and runs of text, with what the extractor looks at.

Inline elements don't become nodes; their text belongs to the block around them. A run of
text between two block boundaries is a leaf of its own. Void elements, optional end tags
and unmatched end tags are treated the way browsers do where it changes the text; scripts,
styles, comments and other content that isn't shown have no text, nor have blocks with the attribute ``hidden`` or the style
``display: none``.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

_REST = (
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>?"
)
_TOKEN = re.compile(r"<!\[CDATA\[.*?\]\]>|" + _REST, re.S)
_LATE_TOKEN = re.compile(_REST, re.S)  # behind the last end of a CDATA section, where none can be
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_UNSHOWN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = frozenset("script style noscript template iframe object svg head title textarea select option canvas audio video datalist".split())
#: hidden elements that end with the block around them; the others only by their own end tag
_LOOSE = frozenset("option canvas audio video datalist svg".split())
#: what can stand in a head, which any other tag or text ends
_HEAD = frozenset("html head title base link meta style script noscript noframes template".split())
_RAW = frozenset("script style textarea title iframe noscript noframes xmp".split())
#: Tags that end an open svg, as the HTML standard lists them
_BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = (
    "html body article main section div nav header footer aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption details summary address fieldset dialog menu search center hgroup legend label button"
).split()
_BLOCK = frozenset(BLOCKS)
_CLOSES_P = _BLOCK - frozenset("label button legend html body".split())
#: what an opening tag ends, and what that search doesn't look beyond
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_P_SCOPE = frozenset("table td th caption html body button figure".split())


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    words: tuple[str, ...] = ()
    children: list[int] = field(default_factory=list)
    text: str = ""  # of a run
    link_chars: int = 0
    tags: int = 0  # inline elements in a run


_QUOTED = re.compile(r"([-\w:.]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")


def _kept_style(found: re.Match) -> str:
    """An attribute without its value, but for a style's declarations and a plain hidden."""
    name = found[1].lower()
    return found[2] if name == "style" else " hidden " if name == "hidden" and "until-found" not in found[2] else f"{name}_"


def _attribute_words(source: str) -> tuple[str, ...]:
    if not source.strip():
        return ()
    found: list[str] = []
    for name, value in _ATTRIBUTE.findall(source):
        if name.lower() in ("class", "id", "role", "itemprop", "aria-label", "hidden", "style"):
            value = value.strip("\"'")
            if name.lower() == "hidden" or name.lower() == "style" and re.search(r"display\s*:\s*none", value):
                found.append("hidden")
            elif name.lower() != "style":
                found += (x.lower() for x in _PIECE.findall(value))
    return tuple(found)


def parse(source: str) -> list[Node]:
    """Nodes in page order; node 0 is the root, runs of text have the tag ``#text``."""
    nodes = [Node("#root", -1, 0)]
    stack = [0]  # open blocks
    count: dict[str, int] = {}  # of them by tag
    dark: list[int] = []  # how deep those lie whose content isn't shown
    pieces: list[str] = []
    state = {"links": 0, "chars": 0, "tags": 0}
    hidden: list[str] = []  # open hidden elements, and the blocks inside
    foreign: list[str] = []  # svg elements around an open foreignObject, whose text is shown

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            if text and not dark:
                at = stack[-1]
                nodes[at].children.append(len(nodes))
                nodes.append(Node("#text", at, len(stack), (), [], text, state["chars"], state["tags"]))
            pieces.clear()
        state["chars"] = state["tags"] = 0

    def close(depth: int) -> None:
        """Closes open blocks down to a stack of ``depth``."""
        flush()
        for i in stack[depth:]:
            count[nodes[i].tag] -= 1
        del stack[depth:]
        while dark and dark[-1] >= depth:
            dark.pop()

    def opened(tags: set[str] | frozenset[str], bar: set[str] | frozenset[str]) -> int | None:
        if not any(count.get(tag) for tag in tags):  # the common case, without a walk up a deep page
            return None
        for i in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[i]].tag
            if tag in tags:
                return i
            if tag in bar:
                return None
        return None

    at = 0
    last_section = source.rfind("]]>")
    while True:
        m = (_TOKEN if at <= last_section else _LATE_TOKEN).search(source, at)
        end = m.start() if m else len(source)
        if hidden == ["head"] and source[at:end].strip():
            hidden.clear()
        if end > at and not hidden:
            text = entities.unescape(source[at:end])
            pieces.append(text)
            if state["links"]:
                state["chars"] += len(text)
        if not m:
            break
        at = m.end()
        closing = m[1]
        if closing:
            tag = closing.lower()
            if tag == "foreignobject" and foreign:
                hidden.append(foreign.pop())
                continue
            if tag in hidden:
                while hidden.pop() != tag:
                    pass
                continue
            if hidden:
                if tag not in _BLOCK or not _LOOSE.issuperset(h for h in hidden if h in _HIDDEN) or opened({tag}, ()) is None:
                    continue
                hidden.clear()
            if tag == "a":
                state["links"] = max(0, state["links"] - 1)
            elif tag in _BLOCK and (i := opened({tag}, _P_SCOPE if tag == "p" else ())) is not None:
                close(i)
            elif tag == "br":
                pieces.append(" ")
            continue
        tag = (m[2] or m[4] or "").lower()
        if not tag:
            continue
        if hidden == ["head"] and tag not in _HEAD:
            hidden.clear()
        if hidden and hidden[-1] == "svg":
            if tag in _BREAKOUT:
                hidden.pop()
            elif tag == "foreignobject" and not (m[3] or m[5] or "").endswith("/"):
                foreign.append(hidden.pop())
                continue
        if "select" in hidden and tag in ("select", "input", "textarea"):
            del hidden[hidden.index("select") :]
            if tag == "select":
                continue
        if tag in _RAW:
            ended = re.compile(rf"</{tag}\s*>?", re.I).search(source, at)
            at = ended.end() if ended else len(source)
            continue
        if hidden or tag in _HIDDEN:
            if (tag in _HIDDEN or tag in _BLOCK) and not (tag == "option" and hidden) and not (m[3] or m[5] or "").endswith("/"):
                hidden.append(tag)
            continue
        if tag not in _BLOCK:
            if tag in ("br", "hr", "img"):
                pieces.append(" ")
            if tag == "hr":
                flush()
            if tag == "a":
                state["links"] += 1
            if tag not in _VOID:
                state["tags"] += 1
            continue
        flush()
        if tag in _CLOSES_P and (i := opened({"p"}, _P_SCOPE)) is not None:
            close(i)
        if tag in _ENDS and (i := opened(*_ENDS[tag])) is not None:
            close(i)
        parent = stack[-1]
        nodes[parent].children.append(len(nodes))
        attributes = m[3] or m[5] or ""
        nodes.append(Node(tag, parent, len(stack), _attribute_words(attributes)))
        if not (m[3] or "").endswith("/"):
            if attributes and _UNSHOWN.search(_QUOTED.sub(_kept_style, attributes)):
                dark.append(len(stack))
            stack.append(len(nodes) - 1)
            count[tag] = count.get(tag, 0) + 1
    flush()
    return nodes
