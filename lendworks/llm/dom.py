"""A page as a tree of elements: parsing, node features, and text of chosen nodes."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape
from zlib import crc32

import numpy as np

_TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)|<[!?][^>]*>?"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|</?[a-zA-Z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Slots that the words of class, id and role attributes are hashed into.
TOKEN_SLOTS = 4_096

# The element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
HIDDEN = frozenset("head script style title noscript template iframe svg object canvas xmp noembed noframes textarea".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary"
    " table tbody td tfoot th thead title tr ul".split()
)
ENDS_PARAGRAPH = BLOCK - {"br", "body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOISE_TAGS = frozenset("nav header footer aside form button menu select fieldset dialog input label".split())
MAIN_TAGS = frozenset("article main".split())
INLINE_FORMAT = frozenset("a abbr b big cite code em font i kbd mark q s small span strike strong sub sup tt u".split())
#: An item ends an open item of its kind, up to the list or row that holds it.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
@dataclass
class Page:
    """Elements in page order; element 0 stands for the page itself."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    depths: list[int] = field(default_factory=lambda: [0])
    #: Slots of the words in the element's attributes.
    names: list[frozenset[int]] = field(default_factory=lambda: [frozenset()])
    #: What is known of an element's part in a page made for training, see KnownPage.
    kept: list[int | None] = field(default_factory=lambda: [None])
    #: Text pieces in page order with their element; a None text is the border of a block.
    pieces: list[tuple[int, str | None]] = field(default_factory=list)


@lru_cache(maxsize=20_000)
def slot(word: str) -> int:
    return crc32(word.lower().encode("utf-8")) % TOKEN_SLOTS


def token_odds(counts: np.ndarray) -> np.ndarray:
    """Log-odds of a slot's elements to belong to the article, from counts ``(kept, slot)``; zero where little is known."""
    other, own = counts + 4.0 * counts.sum(axis=1, keepdims=True) / max(counts.sum(), 1.0)
    odds = np.log(own / max(counts[1].sum(), 1.0)) - np.log(other / max(counts[0].sum(), 1.0))
    return np.where(counts.sum(axis=0) > 0, np.clip(odds, -4, 4), 0.0)


class KnownPage(str):
    """A page made for training. ``marked`` is the same page with the attribute MARK on elements of known part.

    Parts are told by the elements' order, so nothing in the page itself can be mistaken for them.
    """

    MARK = re.compile(r' part-kept="([01])"')

    def __new__(cls, marked: str) -> KnownPage:
        page = super().__new__(cls, cls.MARK.sub("", marked))
        page.marked = marked
        return page


def parse(html: str) -> Page:
    page = _parsed(html, None)
    if isinstance(html, KnownPage):
        page.kept = _parsed(html.marked, KnownPage.MARK).kept
    return page


def _parsed(html: str, mark: re.Pattern | None) -> Page:
    page = Page()
    stack = [0]
    open_tags: dict[str, int] = {}
    at, n = 0, len(html)

    def pop_to(size: int) -> None:
        while len(stack) > size:
            tag = page.tags[stack.pop()]
            open_tags[tag] -= 1
            if tag in BLOCK:
                page.pieces.append((stack[-1], None))

    def place(tags: set[str], inside: set[str]) -> int | None:
        for i in range(len(stack) - 1, 0, -1):
            tag = page.tags[stack[i]]
            if tag in tags:
                return i
            if tag in inside:
                return None
        return None

    while at < n:
        token = _TOKEN.match(html, at)
        at = token.end()
        text = token["text"]
        if text is not None:
            page.pieces.append((stack[-1], text))
            continue
        if token["tag"] is None:
            continue
        tag = token["tag"].lower()
        if token["end"]:
            if open_tags.get(tag):
                size = place({tag}, BLOCK if tag in INLINE_FORMAT else set())
                if size is not None:
                    pop_to(size)
            continue
        if tag in ENDS_PARAGRAPH and open_tags.get("p"):
            size = place({"p"}, {"table", "td", "th", "button", "object"})
            if size is not None:
                pop_to(size)
        if tag in SIBLINGS:
            size = place(*SIBLINGS[tag])
            if size is not None:
                pop_to(size)
        node = len(page.tags)
        names, kept = set(), None
        if "=" in token["attrs"]:
            for values in _ATTRIBUTE.findall(token["attrs"]):
                names.update(slot(w) for value in values for w in _WORDS.findall(value))
            if mark is not None and (known := mark.search(token["attrs"])):
                kept = int(known[1])
        page.tags.append(tag)
        page.parents.append(stack[-1])
        page.depths.append(len(stack))
        page.names.append(frozenset(names))
        page.kept.append(kept)
        if tag in BLOCK:
            page.pieces.append((stack[-1], None))
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = end.start() if end else n
        stack.append(node)
        open_tags[tag] = open_tags.get(tag, 0) + 1
    return page


FEATURES = (
    "depth", "depth_share", "children", "siblings", "sibling_place", "same_tag_siblings", "own_text", "subtree_text",
    "subtree_share", "link_share", "tags_a_char", "paragraphs", "stops_a_word", "text_a_block", "place", "end_place",
    "heading", "paragraph", "list", "container", "inline", "noise_tag", "main_tag", "noise_tokens", "main_tokens",
    "named", "noise_above", "main_above", "noise_tag_above", "main_tag_above", "parent_link_share", "text_before", "text_after",
    "fields_inside", "noise_inside", "hidden",
)


def features(page: Page, odds: np.ndarray) -> np.ndarray:
    """A row of FEATURES per element: subtree density, attribute tokens by their learnt odds, depth, and siblings."""
    n = len(page.tags)
    tags, parents = page.tags, page.parents
    own = np.zeros(n)
    start_at = np.zeros(n)
    stops = np.zeros(n)
    words = np.zeros(n)
    own_blocks = np.zeros(n)
    hidden = np.zeros(n, bool)
    for i in range(1, n):
        hidden[i] = tags[i] in HIDDEN or hidden[parents[i]]
    for node, text in page.pieces:
        if text is None:
            own_blocks[node] += 1
        elif not hidden[node]:
            size = len(text.strip())
            if size:
                own[node] += size
                words[node] += text.count(" ") + 1
                stops[node] += text.count(".") + text.count(",")
    parent = np.array(parents)
    links = np.array([t == "a" for t in tags], float)
    in_link = np.zeros(n, bool)
    noise_tag = np.array([t in NOISE_TAGS for t in tags], float)
    main_tag = np.array([t in MAIN_TAGS for t in tags], float)
    known = [[odds[t] for t in w] for w in page.names]
    noise = np.array([-min(v, default=0.0) for v in known]).clip(0)
    main = np.array([max(v, default=0.0) for v in known]).clip(0)
    named = np.array([len(w) for w in page.names], float)
    above = np.zeros((n, 4))
    own_four = np.stack([noise > 1, main > 1, noise_tag > 0, main_tag > 0], axis=1)
    for i in range(1, n):
        p = parents[i]
        in_link[i] = links[i] or in_link[p]
        above[i] = above[p] + own_four[p]
    sums = np.stack(
        [
            own,
            own * in_link,
            np.ones(n),
            [t == "p" for t in tags],
            stops,
            words,
            [t in ("input", "button", "select", "textarea", "label") for t in tags],
            (noise > 1) | (noise_tag > 0),
            own_blocks,
        ],
        axis=1,
    ).astype(float)
    children = np.zeros(n)
    place = np.zeros(n)
    same: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        p = parents[i]
        place[i] = children[p]
        children[p] += 1
        same[p, tags[i]] = same.get((p, tags[i]), 0) + 1
    before_text = np.concatenate([[0], np.cumsum(own)[:-1]])
    for i in range(n - 1, 0, -1):
        sums[parents[i]] += sums[i]
    text, linked, inner, paragraphs, all_stops, all_words, fields, noisy, blocks = sums.T
    total = max(text[0], 1.0)
    before, after, last = np.zeros(n), np.zeros(n), {}
    for i in range(1, n):
        if (left := last.get(parents[i])) is not None:
            before[i], after[left] = text[left], text[i]
        last[parents[i]] = i
    depth = np.array(page.depths, float)
    siblings = np.where(parent >= 0, children[parent], 1)
    link_share = linked / np.maximum(text, 1)
    start_at = before_text / total
    one = lambda kinds: np.array([t in kinds for t in tags], float)
    columns = [
        depth,
        depth / max(depth.max(), 1),
        np.log1p(children),
        np.log1p(siblings),
        place / np.maximum(siblings, 1),
        np.log1p([same.get((p, t), 0) for p, t in zip(parents, tags)]),
        np.log1p(own),
        np.log1p(text),
        text / total,
        link_share,
        inner / np.maximum(text, 1),
        np.log1p(paragraphs),
        all_stops / np.maximum(all_words, 1),
        np.log1p(text / np.maximum(blocks, 1)),
        start_at,
        start_at + text / total,
        one(HEADINGS),
        one({"p"}),
        one({"ul", "ol", "li", "dl", "dt", "dd"}),
        one({"div", "section", "table", "td", "tr", "body", "html"}),
        one(INLINE_FORMAT),
        noise_tag,
        main_tag,
        noise,
        main,
        named,
        above[:, 0],
        above[:, 1],
        above[:, 2],
        above[:, 3],
        np.where(parent >= 0, link_share[parent], 0),
        np.log1p(before),
        np.log1p(after),
        np.log1p(fields),
        noisy / inner,
        hidden,
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def text_of(page: Page, chosen: np.ndarray) -> str:
    """Text of the chosen elements: references decoded, each run of white space one space, blocks in page order."""
    hidden = np.zeros(len(page.tags), bool)
    for i in range(1, len(page.tags)):
        hidden[i] = page.tags[i] in HIDDEN or hidden[page.parents[i]]
    chosen = chosen & ~hidden
    # References are decoded piece by piece: what two elements hold side by side is no reference.
    found = ["\n" if text is None else unescape(text) for node, text in page.pieces if text is None or chosen[node]]
    return " ".join("".join(found).split())
