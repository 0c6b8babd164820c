"""Main text of web pages from flat text blocks, classified by a small decision tree.

A page is read as a flat run of text blocks, cut at block-level tags. A block is described by its
words and link density, those of its neighbours before and after, and where it stands: inside an
article, inside something that is none by its tag, class or role. A decision tree, trained here on
the labelled table below, says which blocks are main text; these are joined in page order.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regista.llm.shipping import ship

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "place", "aside", "heading", "links_beside")
#: ``place`` of a block: inside an article, on a page without one, outside the article of its page
IN_ARTICLE, NO_ARTICLE, OUTSIDE = 1.0, 0.5, 0.0

#: blocks labelled by hand: :data:`FEATURES` but the last, then whether the block is main text
LABELLED = (
    # articles: titles, paragraphs long and short, lists and quotes, single words
    (9, 0.0, 6, 0.0, 60, 0.0, 1.0, 0, 1, 1), (7, 0.0, 0, 0.0, 45, 0.0, 1.0, 0, 1, 1), (1, 0.0, 12, 0.0, 30, 0.0, 1.0, 0, 1, 1),
    (60, 0.0, 9, 0.0, 80, 0.0, 1.0, 0, 0, 1), (120, 0.05, 60, 0.0, 40, 0.0, 1.0, 0, 0, 1), (15, 0.0, 90, 0.0, 110, 0.0, 1.0, 0, 0, 1),
    (5, 0.0, 70, 0.0, 6, 0.0, 1.0, 0, 0, 1), (8, 0.0, 110, 0.0, 14, 0.0, 1.0, 0, 0, 1), (1, 0.0, 30, 0.0, 2, 0.0, 1.0, 0, 0, 1),
    (35, 0.2, 40, 0.0, 30, 0.1, 1.0, 0, 0, 1), (12, 0.25, 20, 0.0, 50, 0.0, 1.0, 0, 0, 1), (3, 0.0, 4, 0.0, 3, 0.0, 1.0, 0, 0, 1),
    (200, 0.0, 10, 0.0, 0, 0.0, 1.0, 0, 0, 1), (2, 0.0, 2, 0.0, 2, 1.0, 1.0, 0, 0, 1), (18, 0.0, 1, 1.0, 25, 0.0, 1.0, 0, 0, 1),
    (10, 0.4, 30, 0.0, 30, 0.0, 1.0, 0, 0, 1), (6, 0.6, 40, 0.0, 30, 0.0, 1.0, 0, 0, 1), (25, 0.7, 40, 0.0, 30, 0.0, 1.0, 0, 0, 1),
    # articles: paragraphs beside links, as first block, after a title; a source line, a linked title, a lone link
    (40, 0.0, 0, 0.0, 1, 1.0, 1.0, 0, 0, 1), (60, 0.0, 1, 0.0, 2, 1.0, 1.0, 0, 0, 1), (30, 0.3, 12, 0.0, 2, 1.0, 1.0, 0, 0, 1),
    (18, 0.2, 9, 0.0, 4, 1.0, 1.0, 0, 0, 1), (6, 0.5, 0, 0.0, 1, 1.0, 1.0, 0, 0, 1), (8, 0.0, 2, 1.0, 3, 1.0, 1.0, 0, 0, 1),
    (2, 1.0, 40, 0.0, 0, 0.0, 1.0, 0, 0, 1), (3, 1.0, 60, 0.0, 50, 0.0, 1.0, 0, 0, 1), (6, 0.8, 40, 0.0, 30, 0.0, 1.0, 0, 0, 1),
    (25, 1.0, 30, 0.0, 40, 0.0, 1.0, 0, 0, 1), (10, 0.9, 0, 0.0, 50, 0.0, 1.0, 0, 0, 1), (4, 0.75, 50, 0.0, 0, 0.0, 1.0, 0, 0, 1),
    (1, 1.0, 80, 0.0, 70, 0.1, 1.0, 0, 0, 1), (15, 1.0, 60, 0.2, 0, 0.0, 1.0, 0, 0, 1), (7, 1.0, 0, 0.0, 45, 0.0, 1.0, 0, 1, 1),
    (3, 1.0, 0, 0.0, 20, 0.0, 1.0, 0, 1, 1), (2, 1.0, 0, 0.0, 25, 0.0, 1.0, 0, 0, 1), (5, 1.0, 0, 0.0, 60, 0.0, 1.0, 0, 1, 1),
    (3, 0.7, 0, 0.0, 22, 0.0, 1.0, 0, 0, 1), (50, 0.1, 3, 1.0, 2, 1.0, 1.0, 0, 0, 1), (12, 0.4, 4, 0.9, 3, 1.0, 1.0, 0, 0, 1), (5, 0.6, 3, 0.5, 4, 0.6, 1.0, 0, 0, 1),
    (3, 0.0, 2, 1.0, 40, 0.0, 1.0, 0, 0, 1), (4, 0.0, 20, 0.0, 3, 1.0, 1.0, 0, 0, 1), (5, 0.0, 3, 1.0, 3, 1.0, 1.0, 0, 0, 1),
    (1, 0.0, 4, 1.0, 3, 1.0, 1.0, 0, 1, 1), (4, 0.0, 0, 0.0, 2, 1.0, 1.0, 0, 1, 1), (3, 0.0, 2, 1.0, 0, 0.0, 1.0, 0, 0, 1),
    # inside an article but none of it: lists of links
    (2, 1.0, 80, 0.0, 3, 1.0, 1.0, 0, 0, 0), (4, 1.0, 80, 0.0, 5, 1.0, 1.0, 0, 0, 0), (3, 1.0, 2, 1.0, 3, 1.0, 1.0, 0, 0, 0),
    (6, 1.0, 5, 1.0, 40, 0.0, 1.0, 0, 0, 0), (6, 0.95, 5, 1.0, 0, 0.0, 1.0, 0, 0, 0), (9, 1.0, 7, 1.0, 8, 1.0, 1.0, 0, 0, 0),
    (9, 0.9, 60, 0.0, 6, 0.95, 1.0, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1.0, 0, 0, 0), (12, 0.9, 10, 0.9, 11, 0.9, 1.0, 0, 0, 0),
    # and forms, reader comments, adverts, notices
    (30, 0.0, 40, 0.0, 25, 0.0, 1.0, 1, 0, 0), (12, 0.0, 60, 0.0, 50, 0.0, 1.0, 1, 0, 0), (90, 0.1, 80, 0.0, 30, 0.0, 1.0, 1, 0, 0),
    (2, 0.0, 5, 0.0, 1, 0.0, 1.0, 1, 1, 0), (5, 0.5, 20, 0.0, 8, 0.0, 1.0, 1, 0, 0), (150, 0.0, 90, 0.0, 100, 0.0, 1.0, 1, 0, 0),
    (8, 0.0, 30, 0.0, 12, 0.0, 1.0, 1, 0, 0), (25, 1.0, 40, 0.0, 30, 0.0, 1.0, 1, 0, 0), (3, 1.0, 60, 0.0, 50, 0.0, 1.0, 1, 0, 0),
    (40, 0.0, 0, 0.0, 1, 1.0, 1.0, 1, 0, 0),
    # outside the article of a page: menus, footers, texts about the site, even long ones
    (1, 1.0, 1, 1.0, 1, 1.0, 0.0, 1, 0, 0), (2, 1.0, 0, 0.0, 1, 1.0, 0.0, 0, 0, 0), (14, 0.0, 1, 1.0, 9, 0.0, 0.0, 1, 0, 0),
    (8, 0.0, 2, 1.0, 10, 0.0, 0.0, 1, 0, 0), (15, 0.1, 40, 0.0, 0, 0.0, 0.0, 1, 0, 0), (60, 0.0, 30, 0.0, 20, 0.5, 0.0, 1, 0, 0),
    (25, 0.0, 6, 0.8, 60, 0.0, 0.0, 0, 0, 0), (110, 0.0, 20, 0.0, 90, 0.0, 0.0, 0, 0, 0), (10, 0.0, 100, 0.0, 3, 0.0, 0.0, 0, 1, 0),
    (20, 0.0, 70, 0.0, 0, 0.0, 0.0, 0, 0, 0), (5, 0.0, 3, 1.0, 9, 0.0, 0.0, 0, 1, 0), (40, 0.3, 10, 0.0, 10, 0.9, 0.0, 0, 0, 0),
    # pages without an article: what is long, has few links or stands beside such blocks
    (70, 0.0, 10, 0.0, 60, 0.0, 0.5, 0, 0, 1), (45, 0.1, 80, 0.0, 50, 0.0, 0.5, 0, 0, 1), (130, 0.0, 0, 0.0, 0, 0.0, 0.5, 0, 0, 1),
    (18, 0.0, 60, 0.0, 70, 0.0, 0.5, 0, 0, 1), (25, 0.2, 5, 0.0, 40, 0.0, 0.5, 0, 0, 1), (12, 0.0, 45, 0.0, 50, 0.0, 0.5, 0, 0, 1),
    (22, 0.0, 90, 0.0, 8, 0.5, 0.5, 0, 0, 1), (8, 0.0, 3, 0.5, 60, 0.0, 0.5, 0, 1, 1), (6, 0.0, 50, 0.0, 40, 0.0, 0.5, 0, 1, 1),
    (30, 0.0, 2, 1.0, 4, 0.0, 0.5, 0, 0, 1), (16, 0.1, 20, 0.0, 18, 0.0, 0.5, 0, 0, 1), (14, 0.0, 30, 0.0, 2, 1.0, 0.5, 0, 0, 1),
    (20, 0.0, 2, 1.0, 22, 0.0, 0.5, 0, 0, 1), (22, 0.0, 3, 0.7, 25, 0.0, 0.5, 0, 0, 1), (35, 0.1, 5, 0.9, 12, 0.0, 0.5, 0, 0, 1),
    (2, 0.0, 0, 0.0, 20, 0.0, 0.5, 0, 0, 1), (3, 0.0, 0, 0.0, 35, 0.0, 0.5, 0, 0, 1), (2, 0.0, 25, 0.0, 0, 0.0, 0.5, 0, 0, 1),
    (2, 0.0, 0, 0.0, 50, 0.1, 0.5, 0, 0, 1), (4, 0.0, 22, 0.0, 20, 0.0, 0.5, 0, 0, 1),
    (2, 1.0, 0, 0.0, 20, 0.0, 0.5, 0, 0, 0), (3, 0.7, 0, 0.0, 22, 0.0, 0.5, 0, 0, 0), (6, 0.9, 0, 0.0, 60, 0.0, 0.5, 0, 0, 0),
    (2, 1.0, 2, 1.0, 3, 1.0, 0.5, 0, 0, 0), (5, 0.8, 4, 1.0, 6, 0.7, 0.5, 0, 0, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0.5, 0, 0, 0),
    (9, 0.6, 60, 0.0, 10, 0.7, 0.5, 0, 0, 0), (20, 0.7, 50, 0.0, 15, 0.9, 0.5, 0, 0, 0), (3, 0.0, 4, 0.5, 2, 0.0, 0.5, 0, 0, 0),
    (40, 0.0, 70, 0.0, 50, 0.0, 0.5, 1, 0, 0), (10, 0.0, 40, 0.0, 6, 0.0, 0.5, 1, 0, 0), (85, 0.1, 20, 0.0, 0, 0.0, 0.5, 1, 0, 0),
    (1, 0.0, 1, 1.0, 2, 1.0, 0.5, 0, 1, 0), (30, 0.9, 10, 1.0, 20, 0.8, 0.5, 0, 0, 0), (3, 0.0, 0, 0.0, 2, 1.0, 0.5, 0, 0, 0),
)


class Node(NamedTuple):
    """A split (``feature`` at most ``limit`` goes left) or, without children, a leaf."""

    share: float
    feature: int = -1
    limit: float = 0.0
    left: Node | None = None
    right: Node | None = None


def train(table: tuple[tuple[float, ...], ...] = LABELLED, least: int = 2, depth: int = 8) -> Node:
    """A decision tree by Gini impurity; the first of equal splits is taken, in order of feature and limit."""
    data = np.asarray(table, float)
    return _grow(np.array([_with_beside(tuple(row)) for row in data[:, :-1]]), data[:, -1], least, depth)


def _with_beside(features: tuple[float, ...]) -> tuple[float, ...]:
    """All :data:`FEATURES`: the last is the higher link density of the two neighbours."""
    return (*features, max(features[3], features[5]))


def _impurity(y: np.ndarray) -> float:
    share = y.mean() if len(y) else 0.0
    return len(y) * 2 * share * (1 - share)


def _grow(x: np.ndarray, y: np.ndarray, least: int, depth: int) -> Node:
    best = None
    if depth and _impurity(y) > 0:
        for feature in range(x.shape[1]):
            values = np.unique(x[:, feature])
            for limit in (values[1:] + values[:-1]) / 2:
                low = x[:, feature] <= limit
                if min(low.sum(), (~low).sum()) >= least:
                    cost = _impurity(y[low]) + _impurity(y[~low])
                    if best is None or cost < best[0] - 1e-12:
                        best = cost, feature, limit, low
    if best is None or best[0] >= _impurity(y) - 1e-12:
        return Node(float(y.mean()))
    _, feature, limit, low = best
    return Node(float(y.mean()), feature, float(limit), _grow(x[low], y[low], least, depth - 1),
                _grow(x[~low], y[~low], least, depth - 1))


def is_main(tree: Node, features: tuple[float, ...]) -> bool:
    while tree.left is not None:
        tree = tree.left if features[tree.feature] <= tree.limit else tree.right
    return tree.share >= 0.5


_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?:svg|math)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*/>"
    r"|<(script|style|noscript|template|svg|math|textarea|select|button|iframe|object|title|canvas|audio|video)\b[^>]*>"
    r".*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>", re.S | re.I)
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead tr ul".split())
_BREAK = frozenset(("br", "img", "wbr", "input"))
_HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_KEPT_OPEN = _BLOCK - frozenset("p li dd dt tr td th option hr".split()) - _HEADING
_ASIDE_TAGS = frozenset(("nav", "footer", "aside", "form", "dialog", "menu", "head"))
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
#: --- Fixed values: words of class names and ids for what is no article ---
_ASIDE_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies footer masthead menu modal "
    "nav navbar navigation newsletter notice notices pager pagination popup promo promotion recommended related share sharing sidebar social sponsor "
    "sponsored subscribe subscription toolbar widget").split())
_READER_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
#: of a page or what it has, not of what stands there
_STATE_WORDS = frozenset("allow allowed closed count disabled enabled free has hide no off on open with without".split())
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: a block outside an article that begins like this is the site's
_LEGAL = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved\b)", re.I)


def _named_aside(names: str) -> int:
    """What the words of a class or id say: 0 nothing, 1 that readers or the site speak here, 2 that for certain.

    The first or the last word of a name counts, unless the name says that something is open, has or has no such thing.
    """
    found = 0
    for name in names.split():
        parts = [p.lower() for p in _NAME_PARTS.findall(name)]
        if not parts or not _STATE_WORDS.isdisjoint(parts):
            continue
        if parts[0] in _READER_WORDS or parts[-1] in _READER_WORDS or _ASIDE_WORDS.issuperset(parts):
            return 2
        if parts[0] in _ASIDE_WORDS or parts[-1] in _ASIDE_WORDS:
            found = 1
    return found


#: what holds a page's text is named for the page, not for itself
_NEVER_BY_NAME = frozenset(("html", "body", "main", "article"))
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())


def _aside(tag: str, attributes: str, in_article: bool) -> int:
    """Whether an element is none of the article: 0 no, 1 by a name that may mislead, 2 for certain."""
    if tag in _ASIDE_TAGS or tag == "header" and not in_article:
        return 2
    found = 0
    for name, a, b, c in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return 2
        if name == "role" and value.lower() in _ASIDE_ROLES:
            return 2
        if name in ("class", "id") and tag not in _NEVER_BY_NAME:
            found = max(found, _named_aside(value))
    return found


class Block(NamedTuple):
    text: str
    words: int
    link_words: int
    article: bool
    aside: int           # as of :func:`_aside`, the highest around
    named: int           # which element a misleading name is on, 0 for none
    heading: bool


class _Open(NamedTuple):
    """An element that is open."""

    tag: str
    article: bool
    aside: int
    number: int


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, without empty ones."""
    found: list[Block] = []
    parts: list[tuple[str, bool]] = []
    opened: list[_Open] = []
    links, inner, heading, articles, certain, numbers = 0, 0, False, 0, 0, 0
    named: list[int] = []

    def close() -> None:
        if parts:
            decoded = [(html.unescape(p), link) for p, link in parts]
            text = " ".join("".join(p for p, _ in decoded).split())
            if text:
                linked = len(" ".join(p for p, link in decoded if link).split())
                legal = articles == 0 and _LEGAL.match(text) is not None
                found.append(Block(
                    text, len(text.split(" ")), linked, articles > 0, 2 if certain or legal else 1 if named else 0,
                    named[0] if named else 0, heading))
            parts.clear()

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            parts.append((page[at:token.start()], links > 0))
        at = token.end()
        tag = token[3]
        if tag is None:
            if token[1] or token[0][1] in "SsMm":
                parts.append((" ", False))
            continue
        tag, closing = tag.lower(), bool(token[2])
        if tag in _BREAK:
            parts.append((" ", False))
        elif tag == "a":
            links, inner = 0 if closing else 1, 0
        elif tag in _BLOCK:
            close()
            # a link may hold blocks; it ends with the block around it at the latest
            if closing and not inner:
                links = 0
            inner = max(0, inner - 1) if closing else inner + 1
            if tag in _HEADING:
                heading = not closing
            elif not closing:
                heading = False
            if tag not in _KEPT_OPEN:
                continue
            if not closing:
                numbers += 1
                element = _Open(tag, tag in ("article", "main"), _aside(tag, token[4], articles > 0), numbers)
                opened.append(element)
                articles, certain = articles + element.article, certain + (element.aside == 2)
                if element.aside == 1:
                    named.append(numbers)
            elif any(e.tag == tag for e in opened):
                while True:
                    element = opened.pop()
                    articles, certain = articles - element.article, certain - (element.aside == 2)
                    if element.aside == 1:
                        named.pop()
                    if element.tag == tag:
                        break
    if at < len(page) and not re.match(r"<[/!a-zA-Z]", page[at:]):
        parts.append((page[at:], links > 0))
    close()
    return found


def _misnamed(found: list[Block], some: bool) -> set[int]:
    """Elements whose name says they are none of the article, but that hold most of its words without links."""
    own = [b for b in found if b.aside < 2 and (b.article or not some)]
    total = sum(b.words - b.link_words for b in own)
    held: Counter[int] = Counter()
    for b in own:
        if b.named:
            held[b.named] += b.words - b.link_words
    return {number for number, words in held.items() if 2 * words > total}


def main_text(tree: Node, page: str | None) -> str:
    found = blocks(page or "")
    some = any(b.article for b in found)
    misnamed = _misnamed(found, some)
    density = [b.link_words / b.words for b in found]
    kept = []
    for i, b in enumerate(found):
        before, after = (i - 1 if i else None), (i + 1 if i + 1 < len(found) else None)
        aside = b.aside == 2 or b.aside == 1 and b.named not in misnamed
        features = (
            b.words, density[i],
            found[before].words if before is not None else 0, density[before] if before is not None else 0.0,
            found[after].words if after is not None else 0, density[after] if after is not None else 0.0,
            IN_ARTICLE if b.article else OUTSIDE if some else NO_ARTICLE, aside, b.heading)
        if is_main(tree, _with_beside(features)):
            kept.append(b.text)
    return " ".join(kept)


def _text_batches(tree: Node):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(tree, page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, tree: Node | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html; more are ignored).

    Null or blank html, and pages without main text, give an empty text. Pages of any length are read whole. White space, also that
    written as a character reference, becomes one space. Repeated rows give repeated results, null
    ids and addresses stay null, an empty table gives no rows.
    """
    ship(pages.sparkSession)
    return pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        _text_batches(tree or train()), "page_id bigint, url string, text string, n_chars bigint")
