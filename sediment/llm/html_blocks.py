"""The visible text blocks of an HTML page, each with the tags it stands in and how much of it is link.

A block is text between two block-level tags; inline tags do not end it and a line break is white
space. Tags are read as browsers read them: elements that need no end tag end where the next one
begins, an end tag closes what is open inside it, a page that breaks off inside a tag or a comment ends
there. Text that is never shown (scripts, styles, titles) gives no block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

# Fixed values of HTML: inline elements, elements whose content is no text, elements without content.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
HIDDEN = set("audio canvas datalist embed iframe noembed noframes noscript object script select style svg template textarea title video xmp".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Fixed values of HTML: which open elements a start tag ends, and where the search for them stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
REST = re.compile(r"""(?:[^>"']++|"[^"]*"|'[^']*')*+>""")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass(slots=True)
class Block:
    text: str
    tag: str
    path: tuple[str, ...]
    linked: float


def marks(name: str, attributes: str) -> tuple[str, ...]:
    """What an element tells of its part in the page: its tag, and the words of its class, id and role."""
    found = ["<" + name]
    if "=" in attributes:
        for _, *values in ATTRIBUTE.findall(attributes):
            found += WORD.findall(CAMEL.sub(" ", "".join(values)).lower())
    return tuple(found)


class _Page:
    def __init__(self) -> None:
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.counts: Counter[str] = Counter()
        self.pieces: list[str] = []
        self.links = self.linked = self.total = 0
        self.path: tuple[str, ...] | None = ()

    def push(self, name: str, told: tuple[str, ...]) -> None:
        self.open.append((name, told))
        self.counts.update(told)
        self.path = None

    def pop_to(self, size: int) -> None:
        while len(self.open) > size:
            self.counts.subtract(self.open.pop()[1])
            self.path = None

    def close(self, names: set[str], stops: set[str]) -> None:
        """Ends the outermost open element of ``names`` that no element of ``stops`` lies above."""
        place = None
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in stops:
                break
            if self.open[i][0] in names:
                place = i
        if place is not None:
            self.pop_to(place)

    def end(self, name: str) -> None:
        if self.counts["<" + name] > 0:
            place = len(self.open) - 1
            while self.open[place][0] != name:
                place -= 1
            self.pop_to(place)

    def text(self, piece: str) -> None:
        if piece:
            self.pieces.append(piece)
            self.total += len(piece)
            self.linked += len(piece) if self.links else 0

    def flush(self) -> Iterator[Block]:
        if self.pieces:
            text = " ".join(html.unescape("".join(self.pieces)).split())
            if text:
                if self.path is None:
                    self.path = tuple(sorted(k for k, n in self.counts.items() if n > 0))
                yield Block(text, self.open[-1][0] if self.open else "", self.path, self.linked / self.total)
        self.pieces, self.linked, self.total = [], 0, 0


def blocks(page: str | None) -> Iterator[Block]:
    """The blocks of ``page`` in order; none of a null or empty page."""
    page = page or ""
    state, at = _Page(), 0
    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            state.text(page[at:])
            break
        state.text(page[at:begin])
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            if end < 0:
                break
            at = end + 3
            continue
        name = NAME.match(page, begin + 1)
        if name is None:
            if page[begin + 1 : begin + 2] in ("!", "?", "/"):
                end = page.find(">", begin)
                if end < 0:
                    break
                at = end + 1
            else:
                state.text("<")
                at = begin + 1
            continue
        rest = REST.match(page, name.end())
        if rest is None:
            break
        at, closing, tag = rest.end(), name[1], name[2].lower()
        if tag in HIDDEN and not closing:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            if end is None:
                break
            at = max(page.find(">", end.end()) + 1, end.end())
        elif tag == "a":
            state.links = 0 if closing else 1
        elif tag == "br":
            state.text(" ")
        elif tag not in INLINE and tag not in HIDDEN:
            yield from state.flush()
            state.links = 0
            if closing:
                state.end(tag)
                continue
            if state.open and state.open[-1][0] == "p":
                state.pop_to(len(state.open) - 1)
            if tag in ENDS:
                state.close(*ENDS[tag])
            if tag not in VOID:
                state.push(tag, marks(tag, rest[0]))
    yield from state.flush()
