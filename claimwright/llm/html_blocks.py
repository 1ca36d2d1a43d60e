"""Web pages as sequences of text blocks with the elements around them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

# Elements that end a block, and those whose text is never shown as prose.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
RAW_TAGS = frozenset(
    "script style textarea title iframe noembed noframes xmp noscript template svg math object".split()
)
EMPTY_TAGS = frozenset("hr br img input meta link base col area wbr embed source track param".split())
# Starting one of these ends an open one of the same kind within the given elements.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "optgroup"}),
}

# Comments, declarations, and tags; quoted values may hold ">". A tag whose quote never
# ends stops at the first ">", and markup that is cut off runs to the end of the page.
_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*+)|<!\[CDATA\[(?:.*?\]\]>|.*+)|<[!?][^>]*+>?"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?",
    re.S,
)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none""", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# The elements around a block: (tag, words of class, id and role), outermost first.
Element = tuple[str, tuple[str, ...]]


@dataclass(frozen=True)
class Path:
    """An element and what it lies in."""

    element: Element
    parent: "Path | None"


@dataclass
class Block:
    """A run of text between two block tags."""

    text: str
    path: Path | None
    linked: int  # characters of the text within links


def blocks(html: str) -> Iterator[Block]:
    """The blocks of a page in page order, with references decoded and blanks joined.

    Scripts, styles, hidden elements, comments and markup are no text. A page without text
    has no blocks; markup that is broken or cut off ends at its best guess.
    """
    return _Reader().read(html)


class _Reader:
    def __init__(self) -> None:
        self.open: list[Path] = []
        self.open_tags: Counter[str] = Counter()
        self.pieces: list[str] = []
        self.linked = 0
        self.in_link = False
        self.paths: dict[tuple[Element, int], Path] = {}

    def read(self, html: str) -> Iterator[Block]:
        at, end = 0, len(html)
        while at < end:
            found = _MARKUP.search(html, at)
            stop = found.start() if found else end
            if stop > at:
                self._text(html[at:stop])
            if not found:
                break
            at = found.end()
            name = found.group(2) or found.group(5)
            if not name:
                continue
            name = name.lower()
            closing = bool(found.group(1) or found.group(4))
            attributes = found.group(3) or found.group(6) or ""
            if closing:
                if name in BLOCK_TAGS:
                    yield from self._flush()
                    self._end(name)
                elif name == "a":
                    self.in_link = False
                continue
            hidden = "idden" in attributes or "display" in attributes
            hidden = hidden and name not in EMPTY_TAGS and bool(_HIDDEN.search(attributes))
            if (name in RAW_TAGS or hidden) and not attributes.endswith("/"):
                if name in BLOCK_TAGS:
                    yield from self._flush()
                at = _end_of(html, at, name, nested=hidden and name not in RAW_TAGS)
            elif name == "br":
                self.pieces.append(" ")
            elif name == "a":
                self.in_link = True
            elif name in BLOCK_TAGS:
                yield from self._flush()
                self._start(name, attributes)
        yield from self._flush()

    def _text(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        self.pieces.append(text)
        if self.in_link:
            self.linked += len(text.strip())

    def _flush(self) -> Iterator[Block]:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                yield Block(text, self.open[-1] if self.open else None, self.linked)
        self.pieces, self.linked, self.in_link = [], 0, False

    def _start(self, name: str, attributes: str) -> None:
        if self.open and self.open[-1].element[0] == "p":
            self._close(len(self.open) - 1)
        ends, within = IMPLIED_END.get(name, ((), ()))
        if any(self.open_tags[tag] for tag in ends):
            for place in range(len(self.open) - 1, -1, -1):
                tag = self.open[place].element[0]
                if tag in ends:
                    self._close(place)
                    break
                if tag in within:
                    break
        if name in EMPTY_TAGS:
            return
        words: list[str] = []
        for found in _NAMED.finditer(attributes):
            value = found.group(2) or found.group(3) or found.group(4) or ""
            words += (word.lower() for word in _NAME_WORD.findall(value))
        element = (name, tuple(dict.fromkeys(words)))
        parent = self.open[-1] if self.open else None
        # One object for each different path of the page.
        key = (element, id(parent))
        path = self.paths.get(key)
        if path is None:
            path = self.paths[key] = Path(element, parent)
        self.open.append(path)
        self.open_tags[name] += 1

    def _end(self, name: str) -> None:
        if self.open_tags[name]:
            place = len(self.open) - 1
            while self.open[place].element[0] != name:
                place -= 1
            self._close(place)

    def _close(self, place: int) -> None:
        self.open_tags.subtract(path.element[0] for path in self.open[place:])
        del self.open[place:]


_ENDS: dict[str, re.Pattern] = {}


def _end_of(html: str, at: int, name: str, nested: bool) -> int:
    """Where the element ``name``, open at ``at``, ends; the end of the page without an end tag."""
    if name not in _ENDS:
        _ENDS[name] = re.compile(rf"<(/?){re.escape(name)}(?=[\s/>])[^>]*+>?", re.I)
    depth = 1
    for tag in _ENDS[name].finditer(html, at):
        if tag.group(1):
            depth -= 1
        elif nested:
            depth += 1
        if depth == 0:
            return tag.end()
    return len(html)
