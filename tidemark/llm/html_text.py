"""Main text of web pages by flat text blocks and a decision tree.

A page is cut into flat blocks at block-level tags. A block is described by its word count and
link density, those of the blocks before and after it, whether it is a heading, and
the kind of container it lies in. A decision tree, trained when first used on the small table
below, says which blocks are main text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.llm.common import pick, text_slices

# HTML's own lists of elements.
HIDDEN = "script|style|template|noscript|svg|iframe|object|textarea|select|title|math|canvas"
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main "
    "menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset(
    "article aside body details dialog div dl fieldset figure footer form head header main menu "
    "nav ol section table tbody td tr ul li button label".split()
)
OUTSIDE = frozenset("aside button dialog fieldset footer form head header label menu nav".split())
INSIDE = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Words of a class, id or role that tell what a container holds.
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent "
    "contentinfo cookie cookies disqus footer form gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice overlay pager pagination popup promo promoted related "
    "replies reply search share sharing sidebar signup social sponsor sponsored subscribe "
    "tags toolbar widget".split()
)
#: Of these, what makes even an article element something else.
FOREIGN_WORDS = frozenset(
    "ad ads advert advertisement comment comments promo promoted related reply sponsored".split()
)
BESIDE_WORDS = frozenset("has no with without".split())
INSIDE_WORDS = frozenset("article body content entry main post story text".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({HIDDEN})\b[^>]*(?<!/)>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^\"'<>]|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|</?[a-zA-Z][^<>]*>",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_UNSEEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none", re.I)
_PARTS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")

FEATURES = (
    "words",
    "link_density",
    "words_before",
    "link_density_before",
    "words_after",
    "link_density_after",
    "heading",
    "container",  # -1 outside the main text, 1 inside, 0 not told
)

#: Labelled blocks: the features above, then 1 for main text.
LABELLED = (
    # menus, lists of links, breadcrumbs
    (1, 1.0, 0, 0.0, 1, 1.0, 0, -1, 0),
    (2, 1.0, 1, 1.0, 2, 1.0, 0, -1, 0),
    (1, 1.0, 1, 1.0, 9, 0.0, 0, -1, 0),
    (2, 1.0, 2, 1.0, 1, 1.0, 0, 0, 0),
    (3, 1.0, 3, 1.0, 30, 0.0, 0, 0, 0),
    (6, 1.0, 5, 1.0, 7, 1.0, 0, 0, 0),
    (7, 0.9, 60, 0.0, 8, 0.9, 0, 0, 0),
    (9, 0.8, 0, 0.0, 4, 1.0, 0, 0, 0),
    (12, 0.6, 3, 1.0, 5, 1.0, 0, 0, 0),
    # adverts, notices, forms, footers, comments, side columns
    (8, 0.0, 1, 1.0, 9, 0.0, 0, -1, 0),
    (20, 0.0, 40, 0.0, 0, 0.0, 0, -1, 0),
    (45, 0.0, 6, 0.0, 50, 0.0, 0, -1, 0),
    (120, 0.0, 10, 0.0, 80, 0.0, 0, -1, 0),
    (30, 0.2, 80, 0.0, 3, 1.0, 0, -1, 0),
    (4, 0.0, 30, 0.0, 40, 0.0, 1, -1, 0),
    (2, 0.0, 4, 1.0, 5, 1.0, 1, -1, 0),
    (6, 0.0, 50, 0.1, 0, 0.0, 0, -1, 0),
    (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0),
    (5, 0.0, 3, 1.0, 0, 0.0, 0, 0, 0),
    (3, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0),
    (6, 0.0, 2, 0.5, 4, 0.8, 0, 0, 0),
    (2, 0.0, 3, 1.0, 2, 1.0, 1, 0, 0),
    # article text, long and short, with and without links
    (60, 0.0, 9, 0.0, 70, 0.0, 0, 1, 1),
    (35, 0.1, 60, 0.0, 20, 0.0, 0, 1, 1),
    (12, 0.0, 60, 0.0, 4, 0.0, 0, 1, 1),
    (4, 0.0, 12, 0.0, 40, 0.0, 0, 1, 1),
    (1, 0.0, 3, 0.0, 2, 0.0, 0, 1, 1),
    (2, 0.0, 50, 0.0, 4, 0.0, 0, 1, 1),
    (3, 0.0, 1, 1.0, 30, 0.0, 0, 1, 1),
    (9, 0.4, 40, 0.0, 35, 0.0, 0, 1, 1),
    (3, 1.0, 40, 0.0, 35, 0.0, 0, 1, 1),
    (1, 0.0, 40, 0.0, 6, 0.0, 0, 1, 1),
    (7, 0.0, 8, 0.0, 60, 0.0, 1, 1, 1),
    (5, 0.0, 1, 1.0, 6, 0.0, 1, 1, 1),
    (2, 0.0, 90, 0.0, 50, 0.0, 1, 1, 1),
    (8, 1.0, 0, 0.0, 50, 0.0, 1, 1, 1),
    (60, 0.0, 3, 1.0, 80, 0.0, 0, 0, 1),
    (90, 0.1, 60, 0.0, 4, 1.0, 0, 0, 1),
    (25, 0.0, 40, 0.0, 30, 0.0, 0, 0, 1),
    (40, 0.2, 5, 0.0, 6, 0.0, 0, 0, 1),
    (14, 0.0, 45, 0.0, 60, 0.0, 0, 0, 1),
    (18, 0.0, 4, 0.0, 5, 0.0, 0, 0, 1),
    (6, 0.0, 2, 1.0, 60, 0.0, 1, 0, 1),
    (8, 0.0, 40, 0.0, 50, 0.0, 1, 0, 1),
    (5, 0.0, 50, 0.0, 45, 0.0, 0, 0, 1),
    (8, 0.0, 30, 0.0, 20, 0.0, 0, 0, 1),
    (2, 0.0, 6, 0.0, 1, 0.0, 0, 1, 1),
    (1, 0.0, 1, 0.0, 1, 0.0, 0, 1, 1),
    (40, 0.0, 1, 0.0, 1, 0.0, 0, 1, 1),
    (70, 0.0, 0, 0.0, 0, 0.0, 0, 1, 1),
    (5, 0.0, 1, 0.0, 0, 0.0, 0, 1, 1),
    (300, 0.0, 200, 0.0, 3, 1.0, 0, 1, 1),
    (2, 0.0, 30, 0.0, 2, 1.0, 0, 1, 1),
    (15, 0.0, 3, 1.0, 2, 0.5, 0, 1, 1),
    (4, 0.0, 4, 1.0, 3, 1.0, 0, 1, 1),
    (20, 0.5, 3, 0.0, 1, 0.0, 0, 1, 1),
    (8, 0.0, 60, 0.0, 4, 1.0, 1, 1, 1),
    # menus and notices with much text around
    (10, 0.0, 70, 0.0, 70, 0.0, 0, -1, 0),
    (60, 0.0, 0, 0.0, 60, 0.0, 0, -1, 0),
    (200, 0.1, 60, 0.0, 1, 0.0, 0, -1, 0),
    (1, 0.0, 1, 0.0, 1, 0.0, 0, -1, 0),
    (3, 1.0, 60, 0.0, 60, 0.0, 0, -1, 0),
    # lists of links put into an article
    (4, 1.0, 5, 1.0, 4, 1.0, 0, 1, 0),
    (6, 1.0, 6, 1.0, 5, 1.0, 0, 1, 0),
    (3, 1.0, 4, 1.0, 3, 1.0, 0, 1, 0),
    # article text beside links, at either end of a page
    (40, 0.0, 1, 0.0, 3, 1.0, 0, 1, 1),
    (70, 0.0, 0, 0.0, 5, 1.0, 0, 1, 1),
    (6, 0.0, 2, 0.0, 4, 1.0, 0, 1, 1),
    (8, 0.0, 3, 1.0, 0, 0.0, 0, 1, 1),
    (15, 0.0, 5, 1.0, 1, 0.0, 0, 1, 1),
    (3, 0.0, 9, 1.0, 9, 1.0, 1, 1, 1),
    (30, 0.0, 1, 0.5, 5, 0.0, 0, 1, 1),
    (5, 0.0, 2, 0.6, 9, 0.0, 0, 1, 1),
    (60, 0.0, 2, 0.5, 34, 0.1, 0, 0, 1),
    (95, 0.0, 2, 0.4, 0, 0.0, 0, 0, 1),
    # headings that are links
    (6, 1.0, 4, 0.0, 20, 0.0, 1, -1, 0),
    (3, 1.0, 0, 0.0, 4, 1.0, 1, -1, 0),
    (7, 1.0, 30, 0.0, 60, 0.0, 1, -1, 0),
)

#: Labelled pages without a telling container: words, link density, heading, main text of each block.
PAGES = (
    # article between a menu and a list of links, its last paragraph short
    ((1, 1.0, 0, 0), (2, 1.0, 0, 0), (6, 0.0, 1, 1), (60, 0.0, 0, 1), (45, 0.1, 0, 1), (12, 0.0, 0, 1), (70, 0.0, 0, 1),
     (30, 0.0, 0, 1), (3, 1.0, 0, 0), (4, 1.0, 0, 0), (9, 0.6, 0, 0)),
    ((9, 1.0, 0, 0), (5, 0.0, 1, 1), (80, 0.0, 0, 1), (18, 0.0, 0, 1), (8, 1.0, 0, 0), (14, 1.0, 0, 0)),
    ((4, 1.0, 0, 0), (3, 0.0, 1, 1), (25, 0.0, 0, 1), (50, 0.2, 0, 1), (22, 0.0, 0, 1), (2, 1.0, 0, 0)),
    ((3, 1.0, 0, 0), (8, 0.0, 1, 1), (140, 0.0, 0, 1), (13, 0.0, 0, 1), (6, 1.0, 0, 0), (5, 1.0, 0, 0)),
    # references and short headings within the text
    ((2, 1.0, 0, 0), (7, 0.0, 1, 1), (55, 0.1, 0, 1), (2, 0.0, 1, 1), (33, 0.0, 0, 1), (1, 0.0, 1, 1), (15, 0.0, 0, 1),
     (40, 0.0, 0, 1), (10, 1.0, 0, 0), (12, 0.9, 0, 0), (11, 1.0, 0, 0)),
    ((6, 0.0, 1, 1), (20, 0.0, 0, 1), (4, 0.0, 1, 1), (28, 0.0, 0, 1), (3, 0.0, 1, 1), (17, 0.1, 0, 1), (5, 0.0, 1, 1),
     (90, 0.0, 0, 1), (7, 0.3, 0, 1), (65, 0.0, 0, 1), (26, 0.0, 0, 1), (1, 1.0, 0, 0), (1, 1.0, 0, 0)),
    # rows of many link words before and amid text
    ((12, 1.0, 0, 0), (40, 0.0, 0, 1), (16, 1.0, 0, 0), (52, 0.0, 0, 1), (9, 0.9, 0, 0), (24, 0.0, 0, 1)),
    ((30, 1.0, 0, 0), (7, 0.0, 1, 1), (34, 0.0, 0, 1), (60, 0.8, 0, 0), (38, 0.1, 0, 1), (7, 1.0, 0, 0), (75, 0.0, 0, 1)),
    ((6, 1.0, 0, 0), (100, 0.0, 0, 1), (20, 0.7, 0, 0), (44, 0.3, 0, 1), (8, 0.8, 0, 0), (35, 0.0, 0, 1), (120, 0.9, 0, 0)),
    # dialogue and other short paragraphs one after another
    ((1, 1.0, 0, 0), (5, 0.0, 1, 1), (48, 0.0, 0, 1), (6, 0.0, 0, 1), (9, 0.0, 0, 1), (4, 0.0, 0, 1), (11, 0.0, 0, 1),
     (7, 0.0, 0, 1), (36, 0.0, 0, 1), (5, 1.0, 0, 0)),
    # dates, labels and notices between links
    ((2, 1.0, 0, 0), (3, 0.0, 0, 0), (4, 1.0, 0, 0), (7, 0.0, 0, 0), (3, 1.0, 0, 0), (2, 0.0, 1, 0), (5, 1.0, 0, 0),
     (8, 0.0, 0, 0), (6, 1.0, 0, 0), (5, 0.0, 1, 0), (1, 1.0, 0, 0), (9, 0.2, 0, 0), (2, 1.0, 0, 0)),
    ((10, 1.0, 0, 0), (4, 0.0, 1, 0), (11, 1.0, 0, 0), (3, 0.0, 1, 0), (20, 1.0, 0, 0), (6, 0.0, 0, 0)),
    ((12, 1.0, 0, 0), (6, 0.0, 0, 0), (14, 1.0, 0, 0), (9, 0.0, 0, 0), (15, 1.0, 0, 0), (14, 0.0, 0, 0), (20, 1.0, 0, 0)),
    # one paragraph between links; a page that begins or ends with text
    ((4, 1.0, 0, 0), (70, 0.0, 0, 1), (3, 1.0, 0, 0)),
    ((2, 1.0, 0, 0), (48, 0.1, 0, 1), (15, 1.0, 0, 0), (200, 0.0, 0, 1), (12, 1.0, 0, 0)),
    ((80, 0.0, 0, 1), (4, 1.0, 0, 0)),
    ((10, 0.0, 1, 1), (45, 0.0, 0, 1), (7, 1.0, 0, 0), (50, 0.0, 0, 1)),
    ((2, 0.0, 1, 1), (60, 0.0, 0, 1), (3, 1.0, 0, 0)),
    ((1, 0.9, 0, 0), (85, 0.0, 0, 1), (9, 0.8, 0, 0)),
    ((10, 0.8, 0, 0), (5, 0.0, 0, 0), (12, 0.9, 0, 0), (4, 0.0, 1, 0), (9, 0.7, 0, 0), (70, 0.0, 0, 1)),
    # headings that are links, one after another
    ((6, 1.0, 1, 0), (8, 1.0, 1, 0), (5, 1.0, 1, 0), (9, 1.0, 1, 0)),
    ((5, 1.0, 0, 0), (110, 0.0, 0, 1), (31, 0.0, 0, 1), (3, 1.0, 0, 0), (4, 0.0, 0, 0), (2, 1.0, 0, 0), (6, 0.3, 0, 0)),
)


def labelled_pages(pages: tuple = PAGES) -> tuple:
    """The blocks of ``pages`` as rows like those of ``LABELLED``."""
    rows = []
    for page in pages:
        ends = ((0, 0.0), *((words, density) for words, density, _, _ in page), (0, 0.0))
        for i, (words, density, heading, main) in enumerate(page):
            rows.append((words, density, *ends[i], *ends[i + 2], heading, 0, main))
    return tuple(rows)


# ---------------------------------------------------------------- the tree


def train_tree(rows: tuple = LABELLED + labelled_pages(), depth: int = 8):
    """A tree of ``(feature, limit, below_or_equal, above)``, its leaves 0 or 1."""
    ones = sum(r[-1] for r in rows)
    if not depth or ones in (0, len(rows)):
        return int(ones * 2 > len(rows))
    best = None
    for f in reversed(range(len(FEATURES))):  # of equal splits the container's
        values = sorted({r[f] for r in rows})
        for low, high in zip(values, values[1:]):
            limit = (low + high) / 2
            left = [r[-1] for r in rows if r[f] <= limit]
            right = [r[-1] for r in rows if r[f] > limit]
            impurity = sum(2 * sum(s) * (len(s) - sum(s)) / len(s) for s in (left, right))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, limit)
    if best is None:
        return int(ones * 2 > len(rows))
    _, f, limit = best
    below = tuple(r for r in rows if r[f] <= limit)
    above = tuple(r for r in rows if r[f] > limit)
    return (f, limit, train_tree(below, depth - 1), train_tree(above, depth - 1))


def decide(tree, features: tuple) -> bool:
    while not isinstance(tree, int):
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return bool(tree)


@lru_cache(maxsize=1)
def _tree():
    return train_tree()


# ---------------------------------------------------------------- blocks


#: Containers outside by a form or a class word alone; those in such a one or named foreign; articles in them.
LOOSE, NAMED, LIFTED = -0.25, -0.5, 2


@lru_cache(maxsize=10_000)
def _container(tag: str, attributes: str) -> float | None:
    """-1, ``LOOSE``, ``NAMED`` or 1 for a container that tells what it holds, else None."""
    if tag in ("body", "html"):
        return None
    if _UNSEEN.search(attributes):
        return -1
    named = " ".join("".join(m) for m in _NAMED.findall(attributes))
    words = {w.lower() for w in _PARTS.findall(named)}
    out = words & OUTSIDE_WORDS
    if words & BESIDE_WORDS:  # says what stands beside it, as in "with-sidebar"
        out -= {"sidebar", "nav", "menu", "footer", "header"}
    if words & INSIDE_WORDS:
        out -= {"header"}  # the heading of an article
    if tag in INSIDE:
        return -1 if out & FOREIGN_WORDS else 1
    if tag in OUTSIDE and tag != "form":
        return -1
    if tag == "form" or out:
        return NAMED if out & FOREIGN_WORDS else LOOSE
    return 1 if words & INSIDE_WORDS else None


def _within(held: float, told: float | None, tag: str) -> float:
    """What a container holds that lies in one that holds ``held``."""
    if told is None or held == -1:
        return held
    if held in (LOOSE, NAMED):
        if told == 1:
            return LIFTED if tag in INSIDE else held
        return NAMED if told == LOOSE else told
    return LIFTED if held == LIFTED and told == 1 else told


def _settled(found: list[tuple[str, int, int, bool, float]]) -> list[int]:
    """The container of each block: -1 outside, 1 inside, 0 not told.

    A name that most of the page's words lie under wraps the page and tells nothing: an article
    in it is inside, and without one, or next to none, its blocks are not told.
    """
    words = dict.fromkeys((-1, NAMED, LOOSE, 0, 1, LIFTED), 0)
    for _, n, linked, _, container in found:
        words[container] += n - linked
    kinds = {NAMED: -1, LOOSE: -1, LIFTED: 1 if words[LIFTED] > words[1] else -1}
    if words[LOOSE] > words[0] + 10 * (words[1] + words[LIFTED]):
        kinds[LOOSE] = 0
    return [kinds.get(b[4], b[4]) for b in found]


def blocks(page: str) -> Iterator[tuple[str, int, int, bool, float]]:
    """Text, words, words within links, heading, container of each flat block."""
    stack: list[tuple[str, float]] = [("", 0)]
    parts: list[str] = []
    linked = 0
    in_link = heading = False
    own: float | None = None  # what the block's own element tells

    def block() -> Iterator[tuple[str, int, int, bool, float]]:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                words = text.count(" ") + 1
                told = -1 if own is not None and own < 0 else stack[-1][1]
                yield text, words, min(words, linked), heading, told

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            text = html.unescape(page[at : token.start()])
            parts.append(text)
            if in_link:
                linked += len(text.split())
        at = token.end()
        if not token[3]:
            continue
        closing, tag = token[2], token[3].lower()
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            parts.append(" ")
        if tag not in BLOCKS:
            continue
        yield from block()
        parts, linked = [], 0
        heading = tag in HEADINGS and not closing
        own = None if closing or tag in CONTAINERS else _container(tag, token[4])
        if tag not in CONTAINERS or token[4].endswith("/"):
            continue
        if not closing:
            if tag == "body":
                del stack[1:]  # an unclosed head ends here
            told, held = _container(tag, token[4]), stack[-1][1]
            if tag == "header" and held in (1, LIFTED):
                told = None  # the heading of an article
            stack.append((tag, _within(held, told, tag)))
        elif any(name == tag for name, _ in stack):
            while stack.pop()[0] != tag:
                pass
    if at < len(page):
        parts.append(html.unescape(page[at:]))
    yield from block()


def main_text(page: str | None) -> str:
    """The main text of one page, its blocks joined by empty lines."""
    found = list(blocks(page or ""))
    density = [b[2] / b[1] for b in found]
    tree, kept = _tree(), []
    containers = _settled(found)
    for i, (text, words, _, heading, _) in enumerate(found):
        before = (found[i - 1][1], density[i - 1]) if i else (0, 0.0)
        after = (found[i + 1][1], density[i + 1]) if i + 1 < len(found) else (0, 0.0)
        if decide(tree, (words, density[i], *before, *after, int(heading), containers[i])):
            kept.append(text)
    return "\n\n".join(kept)


def text_of(page: str) -> Column:
    """A column with the main text of column ``page``."""

    def texts(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(x) for part in text_slices(pages) for x in part], pa.string())

    return F.arrow_udf(texts, StringType())(page)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars``.

    The whole page is read. Null, empty and textless pages give an empty text. Unclosed
    comments, scripts and tags end with the page. Repeated rows come back as often as given;
    other columns are ignored; an empty table gives no rows.
    """
    return (
        pick(pages, "page_id", "url", "html")
        .withColumn("text", text_of("html"))
        .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
    )
