"""HTML pages as trees of block elements with runs of text as leaves."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from dataclasses import dataclass, field

# A quote opens a value only behind =, and only if it is closed; each part is taken once.
_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>",
    re.DOTALL,
)
# Where quotes run to the end of the page: a tag ends at the next >.
_PLAIN_TAG = re.compile(r"<!--(?:.*?-->|.*)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))")

#: Elements of HTML by how they are read (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
UNSEEN = RAW | frozenset("head select button svg math object canvas audio video datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var br wbr img nobr".split()
)
#: An element on the left ends an open one on the right (within the nearest holder).
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "option": {"option"}, "body": {"head"},
}
#: Elements of other languages, which may close themselves.
FOREIGN = ("svg", "math")
HOLDERS = frozenset("html body div article section main aside nav table ul ol dl form blockquote td th".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul li".split()
)


@dataclass
class Tree:
    """Nodes in page order; the first is the page itself. Leaves have text."""

    parents: list[int] = field(default_factory=lambda: [-1])
    tags: list[str] = field(default_factory=lambda: ["#page"])
    attributes: list[str] = field(default_factory=lambda: [""])
    texts: list[str | None] = field(default_factory=lambda: [None])
    linked: list[int] = field(default_factory=lambda: [0])

    def add(self, parent: int, tag: str, attributes: str = "", text: str | None = None, linked: int = 0) -> int:
        self.parents.append(parent)
        self.tags.append(tag)
        self.attributes.append(attributes)
        self.texts.append(text)
        self.linked.append(linked)
        return len(self.parents) - 1


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


class _Open:
    """The stack of open elements, and where in it each tag is."""

    def __init__(self) -> None:
        self.tags, self.nodes = ["#page"], [0]
        self.places: dict[str, list[int]] = {}
        self.holders: list[int] = []
        self.blocks: list[int] = [0]
        self.unseen = self.links = 0

    def push(self, tag: str, node: int) -> None:
        self.places.setdefault(tag, []).append(len(self.tags))
        if tag in HOLDERS:
            self.holders.append(len(self.tags))
        if tag not in INLINE:
            self.blocks.append(len(self.tags))
        self.tags.append(tag)
        self.nodes.append(node)
        self.unseen += tag in UNSEEN
        self.links += tag == "a"

    def close(self, to: int) -> None:
        while len(self.tags) > to:
            tag = self.tags.pop()
            self.nodes.pop()
            self.places[tag].pop()
            if tag in HOLDERS:
                self.holders.pop()
            if tag not in INLINE:
                self.blocks.pop()
            self.unseen -= tag in UNSEEN
            self.links -= tag == "a"

    def last(self, tag: str) -> int:
        own = self.places.get(tag)
        return own[-1] if own else 0

    def close_within_holder(self, ended: set[str]) -> None:
        """Close the open elements of these tags above the nearest holder of another tag."""
        holder = next((i for i in reversed(self.holders) if self.tags[i] not in ended), 0)
        own = (self.places.get(tag, []) for tag in ended)
        lowest = min((places[k] for places in own if (k := bisect_right(places, holder)) < len(places)), default=0)
        if lowest:
            self.close(lowest)

    def close_inline(self, tag: str) -> None:
        """Close an inline element, if it is open above the nearest block."""
        if self.last(tag) > self.blocks[-1]:
            self.close(self.last(tag))


def parse(page: str) -> Tree:
    """The tree of a page; tags that nothing opened or closed do no harm.

    A tag ends at the first > outside quoted values; what starts like a tag and has no
    such end is text. The page is read once, in time that grows with its length.
    """
    tree, open_ = Tree(), _Open()
    run: list[str] = []
    linked = 0
    at, size, last_end = 0, len(page), page.rfind(">")
    form = _TAG

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                tree.add(open_.nodes[-1], "#text", "", text, linked)
            run.clear()
        linked = 0

    while at < size:
        start = page.find("<", at)
        found = None
        if start >= 0:
            comment = page.startswith("<!--", start)
            if start < last_end or comment:
                found = form.match(page, start)
                if found is None and form is _TAG and (found := _PLAIN_TAG.match(page, start)):
                    # Quotes led to the end of the page; from here on they are not trusted.
                    form = _PLAIN_TAG
        end = size if start < 0 else start if found else start + 1
        if end > at and not open_.unseen:
            run.append(page[at:end])
            if open_.links:
                linked += end - at
        at = found.end() if found else end
        tag = (found[2] or "").lower() if found else ""
        if not tag:
            continue
        block = tag not in INLINE
        if block:
            flush()
        elif tag in ("br", "img"):
            run.append(" ")
        if found[1]:
            if not block:
                open_.close_inline(tag)
            elif open_.last(tag):
                open_.close(open_.last(tag))
            continue
        if tag in RAW:
            raw_end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(page, at)
            at = page.find(">", raw_end.start()) + 1 if raw_end else size
            at = at or size
            continue
        if tag in VOID or found[3].endswith("/") and tag in ("br", "hr", *FOREIGN):
            continue
        if block and open_.unseen and open_.tags[-1] == "head" and tag not in UNSEEN:
            open_.close(len(open_.tags) - 1)
        if tag in ENDS_P or tag in ENDS:
            open_.close_within_holder(ENDS.get(tag, set()) | ({"p"} if tag in ENDS_P else set()))
        node = tree.add(open_.nodes[-1], tag, found[3]) if block and not open_.unseen else open_.nodes[-1]
        open_.push(tag, node)
    flush()
    return tree
