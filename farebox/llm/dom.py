"""HTML as a tree of blocks, many pages at a time, held as flat arrays."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from html import unescape

import numpy as np

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>])*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?]")

# Elements by how HTML treats them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "script style template noscript iframe object svg math canvas head title textarea select datalist "
    "audio video map noframes".split()
)
RAW = frozenset("script style title textarea noscript iframe noframes template".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
ENDS_ITSELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody"}, "td": {"tr"}, "th": {"tr"}}
ALIKE = {"dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}}


@dataclass
class Forest:
    """Block elements and the text runs beside them, parents before children."""

    page: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    place: list[int] = field(default_factory=list)  # among the parent's children
    tokens: list[tuple[str, ...]] = field(default_factory=list)
    text: list[str] = field(default_factory=list)  # of a leaf, markup and references resolved
    links: list[int] = field(default_factory=list)  # characters of it within links

    def add(self, page: int, parent: int, depth: int, place: int, tokens: tuple[str, ...]) -> int:
        self.page.append(page)
        self.parent.append(parent)
        self.depth.append(depth)
        self.place.append(place)
        self.tokens.append(tokens)
        self.text.append("")
        self.links.append(0)
        return len(self.page) - 1


def _tokens(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag, and the words of its class, id and role."""
    found = ["<" + tag]
    if "=" in attributes:
        for _, *value in _ATTRIBUTE.findall(attributes):
            found += [t.lower() for t in _TOKEN.findall("".join(value))]
    return tuple(dict.fromkeys(found))


class _Page:
    """Reads one page into the forest."""

    def __init__(self, forest: Forest, number: int):
        self.forest, self.number = forest, number
        root = forest.add(number, -1, 0, 0, ("<page",))
        self.open: list[tuple[str, int]] = [("page", root)]
        self.children = {root: 0}
        self.hidden = 0
        self.link = 0
        self.run: list[str] = []
        self.run_links = 0

    def _child(self, tokens: tuple[str, ...]) -> int:
        parent = self.open[-1][1]
        place = self.children[parent]
        self.children[parent] = place + 1
        node = self.forest.add(self.number, parent, len(self.open), place, tokens)
        self.children[node] = 0
        return node

    def end_run(self) -> None:
        """Each run of text between block tags becomes a leaf of its own."""
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                leaf = self._child(("<text",))
                self.forest.text[leaf] = text
                self.forest.links[leaf] = min(self.run_links, len(text))
            self.run, self.run_links = [], 0

    def _leave_head(self) -> None:
        """What cannot stand in a head ends one that is open: its end tag may be left out."""
        if self.open[-1][0] == "head":
            self._cut(len(self.open) - 1)

    def add_text(self, text: str) -> None:
        if self.hidden and text.strip(" \t\n\f\r"):
            self._leave_head()
        if not self.hidden:
            text = unescape(text) if "&" in text else text
            self.run.append(text)
            if self.link:
                self.run_links += len(text)

    def _close(self, tags: set[str], within: set[str]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.open[at][0]
            if tag in tags:
                self._cut(at)
                return
            if tag in within:
                return

    def _cut(self, at: int) -> None:
        self.hidden -= sum(tag in HIDDEN for tag, _ in self.open[at:])
        del self.open[at:]

    def start(self, tag: str, attributes: str) -> None:
        if tag not in IN_HEAD:
            self._leave_head()
        if tag in INLINE:
            self.link += tag == "a"
            return
        if tag in VOID:
            self.run.append(" ")
            return
        self.end_run()
        if tag in ENDS_ITSELF:
            self._close(ALIKE.get(tag, {tag}), ENDS_ITSELF[tag])
        elif self.open[-1][0] == "p":
            self._cut(len(self.open) - 1)
        self.link = 0
        self.open.append((tag, self._child(_tokens(tag, attributes))))
        self.hidden += tag in HIDDEN

    def end(self, tag: str) -> None:
        if tag in INLINE:
            self.link -= tag == "a" and self.link > 0
            return
        self.end_run()
        if tag not in VOID:
            self._close({tag}, set())


def parse(pages: Iterable[str]) -> Forest:
    forest = Forest()
    for number, html in enumerate(pages):
        page, at = _Page(forest, number), 0
        while found := _MARKUP.search(html, at):
            if found.start() > at:
                page.add_text(html[at : found.start()])
            at = found.end()
            closing, tag, attributes = found.groups()
            if tag is None:
                continue
            tag = tag.lower()
            if closing:
                page.end(tag)
            else:
                page.start(tag, attributes)
                if tag in RAW:
                    closed = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
                    at = closed.end() if closed else len(html)
                    page.end(tag)
        page.add_text(html[at:])
        page.end_run()
    return forest


NUMBERS = 17


def numbers(forest: Forest) -> np.ndarray:
    """For each node: depth, place and siblings, and how its subtree's text is spread."""
    n = len(forest.page)
    parent, depth = np.array(forest.parent), np.array(forest.depth)
    page, place = np.array(forest.page), np.array(forest.place, dtype=float)
    own = np.array([len(t) for t in forest.text], dtype=float)
    sums = {
        "text": own.copy(),
        "links": np.array(forest.links, dtype=float),
        "marks": np.array([len(_PUNCTUATION.findall(t)) for t in forest.text], dtype=float),
        "nodes": np.ones(n),
        "paragraphs": np.array([t[0] == "<p" for t in forest.tokens], dtype=float),
    }
    children = np.bincount(parent[parent >= 0], minlength=n).astype(float)
    levels = [np.flatnonzero(depth == d) for d in range(1, depth.max(initial=0) + 1)]
    for level in reversed(levels):
        for total in sums.values():
            np.add.at(total, parent[level], total[level])
    text, root = sums["text"], np.flatnonzero(parent < 0)
    whole = np.maximum(text[root], 1)[page]
    before = np.cumsum(own) - own
    start = (before - before[root][page]) / whole
    up = np.maximum(parent, 0)
    siblings = np.where(parent >= 0, children[up], 1.0)
    beside = np.where(parent >= 0, text[up] - text, 0.0)
    earlier, later = np.zeros(n), np.zeros(n)
    order = np.lexsort((place, up, page))
    next_to = (up[order][1:] == up[order][:-1]) & (parent[order][1:] >= 0) & (parent[order][:-1] >= 0)
    earlier[order[1:]] = np.where(next_to, text[order[:-1]], 0)
    later[order[:-1]] = np.where(next_to, text[order[1:]], 0)
    safe = np.maximum(text, 1)
    columns = [
        depth, place, siblings, place / siblings, children, np.log1p(sums["paragraphs"]), np.log1p(text),
        sums["links"] / safe, text / sums["nodes"], sums["marks"] / safe, text / whole, start,
        beside / np.maximum(siblings - 1, 1), np.log1p(earlier), np.log1p(later), text / np.maximum(text[up], 1),
        sums["paragraphs"] / sums["nodes"],
    ]
    return np.column_stack(columns).astype(np.float32)


def flags(forest: Forest, known: dict[str, int]) -> np.ndarray:
    """For each node, which known tokens it has, and which some node above it has."""
    n, width = len(forest.page), len(known)
    own = np.zeros((n, width), dtype=bool)
    rows = [(i, known[t]) for i, tokens in enumerate(forest.tokens) for t in tokens if t in known]
    if rows:
        own[tuple(np.array(rows).T)] = True
    above = np.zeros((n, width), dtype=bool)
    parent, depth = np.array(forest.parent), np.array(forest.depth)
    for d in range(1, depth.max(initial=0) + 1):
        level = np.flatnonzero(depth == d)
        above[level] = above[parent[level]] | own[parent[level]]
    return np.concatenate([own, above], axis=1)
