"""A small, forgiving reading of HTML as a tree of block nodes and text runs, with features for each of them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np

OPEN = re.compile(r"</?[a-zA-Z][^\s/>]*")
# An attribute, or nothing: quotes count only where a value begins, as in the standard.
ATTRIBUTE = re.compile(r"[\s/]*(?:([^\s/>=][^\s/>=]*|=[^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?)?")
NAMES = frozenset("class id role itemprop".split())
MARK = "data-mark"
TOKEN = re.compile(r"[a-z]+")

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template iframe svg object select textarea button title head canvas".split())
RAW = frozenset("script style noscript template iframe textarea title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark nobr q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_PARAGRAPH = HEADINGS | frozenset(
    "address article aside blockquote div dl fieldset figure footer form header hr main nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
BARRIER = frozenset("ul ol dl table div section article main body".split())
GOOD_TAGS, BAD_TAGS = frozenset(["article", "main"]), frozenset("nav aside header footer form fieldset".split())
GOOD_TOKENS = frozenset("article content post entry main story body text blog news".split())
BAD_TOKENS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead logo footer bottom copyright "
    "legal sidebar side aside widget related recommended rail cookie cookies consent notice alert gdpr popup modal "
    "overlay banner ad ads advert adverts advertisement sponsor sponsored promo promotion form subscribe newsletter "
    "login signup search comment comments reply replies respond response responses discussion thread feedback share "
    "social follow toolbar disclaimer".split()
)
PARAGRAPH = frozenset("p")
SENTENCE = re.compile(r"[.!?]")
TEXT = "#text"


@dataclass
class Page:
    """Nodes in page order: tag, parent, attribute tokens, text of runs, characters within links, and start marks."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    tokens: list[list[str]] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    marks: list[str] = field(default_factory=list)

    def add(self, tag: str, parent: int, tokens: list[str], text: str = "", linked: int = 0, mark: str = "") -> int:
        for values, value in (
            (self.tags, tag), (self.parents, parent), (self.tokens, tokens), (self.texts, text), (self.linked, linked), (self.marks, mark),
        ):
            values.append(value)
        return len(self.tags) - 1


def _tag_end(source: str, at: int) -> tuple[int, dict[str, str], bool]:
    """Where a tag ends whose name ends at `at` (-1 if it never does), its attributes, and whether it closes itself."""
    found: dict[str, str] = {}
    while True:
        part = ATTRIBUTE.match(source, at)
        at = part.end()
        if part[1]:
            found.setdefault(part[1].lower(), part[2] or part[3] or part[4] or "")
        if at >= len(source):
            return -1, found, False
        if source[at] == ">":
            return at + 1, found, source[at - 1] == "/" and not (part[1] and part[4])


@dataclass
class _Stack:
    """Open elements as (tag, node; -1 for inline ones), with the places of each tag, of blocks and of barriers."""

    entries: list[tuple[str, int]] = field(default_factory=list)
    places: dict[str, list[int]] = field(default_factory=dict)
    blocks: list[int] = field(default_factory=list)
    barriers: list[int] = field(default_factory=lambda: [0])

    def push(self, tag: str, node: int) -> None:
        at = len(self.entries)
        self.entries.append((tag, node))
        self.places.setdefault(tag, []).append(at)
        if node >= 0:
            self.blocks.append(at)
        if tag in BARRIER:
            self.barriers.append(at)

    def cut(self, depth: int) -> list[tuple[str, int]]:
        gone = self.entries[depth:]
        for tag, node in reversed(gone):
            self.places[tag].pop()
            if node >= 0:
                self.blocks.pop()
            if tag in BARRIER:
                self.barriers.pop()
        del self.entries[depth:]
        return gone

    def last(self, tag: str) -> int:
        """The depth of the innermost open element of this tag, 0 if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def node(self) -> int:
        return self.entries[self.blocks[-1]][1]


def read(source: str) -> Page:
    """The tree of a page, in one pass.

    Inline elements belong to the run of text they stand in; unclosed elements end with their parent.  A `<` that begins
    no tag is text; a tag, comment or raw element that never ends takes the rest of the page.
    """
    page = Page()
    page.add("#root", -1, [])
    stack = _Stack()
    stack.push("#root", 0)
    run: list[str] = []
    endless: set[str] = set()
    linked = links = 0

    def end_run() -> None:
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                page.add(TEXT, stack.node(), [], text, min(linked, len(text)))
            run.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal links
        if stack.blocks[-1] >= depth:
            end_run()
        links -= sum(t == "a" for t, _ in stack.cut(depth))

    at, size = 0, len(source)
    while at < size:
        start = source.find("<", at)
        follows = source[start + 1 : start + 2] if start >= 0 else ""
        is_text = start >= 0 and not (follows in ("!", "?") or OPEN.match(source, start) or (follows == "/" and start + 2 < size))
        text = source[at:] if start < 0 else source[at : start + is_text]
        if text:
            run.append(text)
            linked += len(text) * (links > 0)
        if start < 0:
            break
        if is_text:
            at = start + 1
            continue
        opened = OPEN.match(source, start)
        if not opened:
            ends = source.find("-->", start + 4) if source.startswith("<!--", start) else source.find(">", start)
            at = size if ends < 0 else ends + (3 if source.startswith("<!--", start) else 1)
            continue
        closing = follows == "/"
        tag = opened[0].lstrip("</").lower()
        at, attributes, closed = _tag_end(source, opened.end())
        if at < 0:
            break
        if closing:
            depth = stack.last(tag)
            if depth and not (tag in INLINE and stack.blocks[-1] > depth):
                close(depth)
            continue
        if tag in SKIPPED:
            ended = None
            if tag not in VOID and tag not in endless:
                ended = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                if ended is None:
                    endless.add(tag)
            if tag in RAW or ended:
                at = ended.end() if ended else size
            continue
        if tag in INLINE:
            if tag in ("br", "img", "input"):
                run.append(" ")
            elif tag not in VOID and not closed:
                links += tag == "a"
                stack.push(tag, -1)
            continue
        if tag in ENDS_PARAGRAPH or tag in SIBLINGS:
            depth = max(stack.last(t) for t in SIBLINGS.get(tag, PARAGRAPH))
            if depth > stack.barriers[-1]:
                close(depth)
        end_run()
        names = " ".join(v for k, v in attributes.items() if k in NAMES).lower()
        node = page.add(tag, stack.node(), TOKEN.findall(names), mark=attributes.get(MARK, "")[:1])
        if tag not in VOID and not closed:
            stack.push(tag, node)
    end_run()
    return page


FEATURES = 26


def describe(page: Page) -> np.ndarray:
    """Feature rows of the nodes: text and link sizes of node, subtree, parent and siblings, depth, place and names."""
    n = len(page.tags)
    parents = np.array(page.parents)
    own_text = np.array([len(t) for t in page.texts], dtype=float)
    is_text = np.array([t == TEXT for t in page.tags])
    text, link = own_text.copy(), np.array(page.linked, dtype=float)
    nodes, runs = np.ones(n), is_text.astype(float)
    stops = np.array([len(SENTENCE.findall(t)) if t else 0 for t in page.texts], dtype=float)
    paragraphs = np.array([t == "p" for t in page.tags], dtype=float)
    depth, good, bad = np.zeros(n), np.zeros(n), np.zeros(n)
    names_good = [any(x in GOOD_TOKENS for x in t) for t in page.tokens]
    names_bad = [any(x in BAD_TOKENS for x in t) for t in page.tokens]
    own_good = np.array([t in GOOD_TAGS for t in page.tags], dtype=float) + names_good
    own_bad = np.array([t in BAD_TAGS for t in page.tags], dtype=float) + names_bad
    order, count = np.zeros(n), np.zeros(n)
    for i in range(1, n):
        p = page.parents[i]
        depth[i] = depth[p] + 1
        good[i] = good[p] + own_good[p]
        bad[i] = bad[p] + own_bad[p]
        order[i] = count[p]
        count[p] += 1
    sums = np.stack([text, link, nodes, runs, stops, paragraphs], axis=1)
    before = np.cumsum(own_text) - own_text
    for i in range(n - 1, 0, -1):
        sums[page.parents[i]] += sums[i]
    text, link, nodes, runs, stops, paragraphs = sums.T
    up = np.maximum(parents, 0)
    grand = up[up]
    total = max(1.0, text[0])
    category = {TEXT: 0, "p": 1, "li": 2, "ul": 3, "ol": 3, "div": 4, "section": 5, "table": 6, "td": 6, "blockquote": 7, "pre": 7, "a": 8}
    kind = np.array([9 if t in HEADINGS else category.get(t, 10) for t in page.tags], dtype=float)
    rows = [
        np.log1p(text), link / np.maximum(1, text), text / nodes, np.log1p(runs), stops / np.maximum(1, text) * 100, paragraphs,
        depth, order, count[up], order / np.maximum(1, count[up]), before / total, text / total, kind, kind[up],
        own_good, own_bad, good, bad, np.log1p(text[up]), link[up] / np.maximum(1, text[up]), text[up] / np.maximum(1, runs[up]),
        paragraphs[up], own_good[up], own_bad[up], np.log1p(text[grand]), text / np.maximum(1, runs),
    ]
    return np.stack(rows, axis=1)


def decode(page: Page, odds: np.ndarray) -> list[str]:
    """Texts of the runs kept by the likeliest choice in which a node is kept only with its parent.

    `odds` are the log odds of each node.  From the leaves up, a node is worth its odds and the worth of the children
    that gain by being kept; from the root down, nodes with a gain are kept.
    """
    worth = odds.tolist()
    for i in range(len(worth) - 1, 0, -1):
        if worth[i] > 0:
            worth[page.parents[i]] += worth[i]
    kept = [worth[0] > 0]
    for i in range(1, len(worth)):
        kept.append(kept[page.parents[i]] and worth[i] > 0)
    return [t for t, k in zip(page.texts, kept, strict=True) if k and t]
