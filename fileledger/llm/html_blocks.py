"""Leaf blocks of a web page, in page order, with their tag paths.

Time and memory are linear in the page's length, whatever its nesting, stray quotes and unclosed elements: an open
element points to its parent, and counts of open elements tell whether a tag ends any of them before they are looked for.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from functools import lru_cache

#: A comment, a tag with its attributes (a ``>`` in a quoted value doesn't end it), or a declaration.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-z][^\s/>]*)((?>=\s*+(?>\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[^\W\d_a-zA-Z]+")
#: Elements whose content is not markup, each with the form of its end tag.
_RAW = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE) for name in ("script", "style", "title", "iframe", "textarea")}
_RAW_NEXT = {name: re.compile(rf"<(/?){name}(?=[\s/>])", re.IGNORECASE) for name in _RAW}
#: Of these, without an end tag, the rest of the page is theirs; of the others only the start tag goes.
_TO_THE_END = frozenset(["script", "style"])
#: Void elements that neither end a block nor add anything to it.
_VOID = frozenset("area base col embed img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: Embedded content stands in a line of text: what is in it or after it belongs to the same block.
_INLINE |= frozenset("audio canvas math noscript object svg video".split())
_INLINE |= frozenset("annotation menclose mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
_INLINE |= frozenset("circle defs ellipse g line path polygon polyline rect symbol text tspan use".split())
#: Open elements that such a start tag ends; any other block ends a paragraph.
_ENDED = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option", "p")}
_ENDABLE = frozenset(name for names in _ENDED.values() for name in names)
#: Elements outside of which a start tag ends nothing.
_SCOPES = frozenset(["ul", "ol", "dl", "table", "div", "article", "section", "body", "td"])


class Element:
    """An open element: its own path tokens, its parent, its nearest block element and the scope that it stands in."""

    __slots__ = ("block", "inline", "inside", "mask", "name", "parent", "scope", "tokens")

    def __init__(self, name: str, tokens: tuple[str, ...], parent: Element | None):
        self.name, self.tokens, self.parent, self.mask = name, tokens, parent, None
        is_block = parent is None or name not in _INLINE
        self.block = self if is_block else parent.block
        self.inline: dict[str, int] | None = None  # of a block element: the inline elements open in it
        self.inside: dict[str, int] | None = None  # of a scope: the elements open in it that a start tag can end
        self.scope = self if parent is None or name in _SCOPES else parent.scope

    def path(self) -> tuple[str, ...]:
        parts, node = [], self
        while node is not None:
            parts.append(node.tokens)
            node = node.parent
        return tuple(t for tokens in reversed(parts) for t in tokens)


class Block:
    """Text between two block boundaries, white space made single spaces, references decoded; and its block element."""

    __slots__ = ("element", "leaf", "linked", "text")

    def __init__(self, text: str, element: Element, linked: int):
        self.text, self.element, self.leaf, self.linked = text, element, element.name, linked

    @property
    def path(self) -> tuple[str, ...]:
        """Tags and words of class, id and role, from the page's root to the block's element."""
        return self.element.path()


class _Open:
    """The stack of open elements, with counts that say what a tag can end."""

    def __init__(self) -> None:
        self.stack = [Element("", (), None)]
        self.names: dict[str, int] = defaultdict(int)
        self.links = 0

    def push(self, name: str, tokens: tuple[str, ...]) -> None:
        top = self.stack[-1]
        node = Element(name, tokens, top)
        self.stack.append(node)
        self.names[name] += 1
        self.links += name == "a"
        if node.block is not node:
            if node.block.inline is None:
                node.block.inline = defaultdict(int)
            node.block.inline[name] += 1
        elif name in _ENDABLE:
            if top.scope.inside is None:
                top.scope.inside = defaultdict(int)
            top.scope.inside[name] += 1

    def pop(self) -> Element:
        node = self.stack.pop()
        self.names[node.name] -= 1
        self.links -= node.name == "a"
        if node.block is not node:
            node.block.inline[node.name] -= 1
        elif node.name in _ENDABLE:
            node.parent.scope.inside[node.name] -= 1
        return node

    def end(self, name: str) -> None:
        """An end tag: of a block element up to the last one open, of an inline element only within its block."""
        if name in _INLINE:
            inline = self.stack[-1].block.inline
            if inline is None or not inline[name]:
                return
        elif not self.names[name]:
            return
        while self.pop().name != name:
            pass

    def make_room(self, name: str) -> None:
        """End the elements that a start tag of a block ends."""
        names = _ENDED.get(name, ("p",))
        while True:
            scope = self.stack[-1].scope
            inside = scope.inside
            if inside is not None and (inside["p"] if len(names) == 1 else any(inside[n] for n in names)):
                while self.pop().name not in names:
                    pass
                if len(names) == 1:
                    return
            elif scope.parent is not None and scope.name in names:
                while self.pop() is not scope:
                    pass
            else:
                return


@lru_cache(maxsize=4096)
def path_tokens(name: str, attributes: str) -> tuple[str, ...]:
    """A tag and the words of its class, id and role."""
    return ("t:" + name, *("c:" + w.lower() for got in _NAMES.findall(attributes) for w in _WORD.findall("".join(got))))


def _closed(attributes: str) -> bool:
    """Whether a slash ends a start tag: after white space, a quote or the bare name; else it is an unquoted value's last letter."""
    return attributes.endswith("/") and (len(attributes) == 1 or attributes[-2] in " \t\n\r\f\"'")


def blocks_of(page: str | None) -> list[Block]:
    """The page's blocks that have text; script, style, title, iframe and textarea have none. Null and empty pages have no blocks.

    HTML knows no closed script, XHTML does. A closed start tag of these five is taken as such unless an end tag of its name
    comes before the next start tag of that name; in that case what lies between is raw.
    """
    out: list[Block] = []
    tree = _Open()
    pieces: list[str] = []
    element = tree.stack[0]
    linked = 0
    page = page or ""
    endless: set[str] = set()

    def close() -> None:
        nonlocal linked
        if pieces:
            raw = "".join(pieces)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(text, element, linked))
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal element, linked
        if not pieces:
            if raw.isspace():
                return
            element = tree.stack[-1].block
        pieces.append(raw)
        if tree.links:
            linked += len(raw)

    at = 0
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, ends, attributes = m[2].lower(), m[1], m[3]
        if name == "br":
            if pieces:
                pieces.append(" ")
            continue
        if name in _VOID:
            continue
        if name not in _INLINE:
            close()
        if ends:
            tree.end(name)
            continue
        if _closed(attributes) and not (name in _RAW and name not in endless and (then := _RAW_NEXT[name].search(page, at)) and then[1]):
            continue
        if name in _RAW:
            got = None if name in endless else _RAW[name].search(page, at)
            if got:
                at = got.end()
            else:
                endless.add(name)
                if name in _TO_THE_END:
                    at = len(page)
            continue
        if name == "hr":
            continue
        if name not in _INLINE:
            tree.make_room(name)
        tree.push(name, (path_tokens if len(attributes) < 256 else path_tokens.__wrapped__)(name, attributes))
    if at < len(page):
        add(page[at:])
    close()
    return out
