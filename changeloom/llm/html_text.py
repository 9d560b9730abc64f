r"""Main text of web pages.

A page is read tag by tag into flat text blocks: the text between block-level tags.  A block has its number of words and
its link density (share of words inside links), those of the blocks before and after it, and what its open elements
say: inside an element of page furniture (menu, footer, form, advert, comments ...), inside or outside the page's
article element.  Class, id and role count by whole tokens; an article or main element ends the furniture of a marked wrapper
or form around it, not that of a menu, an aside or comments.  A decision tree (Gini, grown here from the small labelled
table ``LABELLED``) tells text from furniture; text blocks are joined in page order.

Pages never leave their row, so there is no shuffle.  The tree is a handful of numbers in the task's closure.

Defined results: a null or empty page and a page without text give the empty string; unclosed and wrongly nested tags are
read as far as they go, unclosed scripts and comments to the page's end; repeated rows give equal rows; an empty table gives
an empty table; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Names of HTML elements.
BLOCK = frozenset(
    "address article aside blockquote body canvas caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frame frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base basefont br col embed frame hr img input keygen link meta param source track wbr".split())
UNSEEN = "script|style|noscript|template|svg|math|textarea|select|iframe|object|audio|video|title|head"
FURNITURE = frozenset("nav aside footer form menu button dialog fieldset label option datalist".split())
#: Furniture that may hold the whole page: an article in it is none.
WRAPPERS = frozenset("form fieldset label".split())
#: Words of class, id and role that mark furniture.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner bar breadcrumb breadcrumbs byline caption-credit "
    "comment comments commentlist consent cookie cookies copyright dfp disclaimer disqus footer footnav form gdpr header "
    "login masthead menu menubar modal nav navbar navigation newsletter notice notification pager pagination popup promo "
    "promoted promotion related replies reply respond search share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription tags teaser toolbar tooltip widget alert complementary contentinfo".split()
)
#: Those of them whose articles are furniture, too.
HELD_MARKS = frozenset("comment comments commentlist disqus related replies reply respond".split())
#: Words of class and id that mark the article where no article or main element is.
ARTICLE_MARKS = frozenset("article articlebody content entry maincontent post story storybody".split())
#: Words that may stand beside a mark in one token (site-footer, comment-list); others (has-sidebar, search-enabled) void it.
BESIDE = frozenset(
    "area author block body bottom box button buttons container global head icons inner item items left link links list main meta "
    "outer page posts reader readers right section site slot text thread title top user users wrap wrapper x".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<closed>svg|math)(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+(?<=/)>"
    rf"|<(?P<unseen>{UNSEEN})(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>.*?(?:</(?P=unseen)\s*>|(?=<body)|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<[/!?a-zA-Z][^>]*>",
    re.S | re.I,
)
_MARK = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "furniture", "article")

#: Labelled blocks: the features above and whether the block is text.  ``article`` is 1 inside the article element, -1 outside of
#: it, 0 where the page has none.
LABELLED = np.array([
    # Inside an article element.
    (120, 0.0, 9, 0.0, 80, 0.0, 0, 1, 1), (64, 0.05, 120, 0.0, 2, 0.0, 0, 1, 1), (1, 0.0, 64, 0.0, 40, 0.0, 0, 1, 1),
    (2, 0.0, 80, 0.0, 90, 0.0, 0, 1, 1), (10, 0.0, 8, 0.0, 95, 0.0, 0, 1, 1), (6, 0.0, 1, 1.0, 70, 0.1, 0, 1, 1),
    (1, 0.0, 30, 0.0, 14, 0.1, 0, 1, 1), (5, 0.0, 60, 0.0, 16, 0.1, 0, 1, 1), (9, 0.0, 1, 1.0, 3, 0.0, 0, 1, 1),
    (200, 0.02, 12, 0.0, 0, 0.0, 0, 1, 1), (30, 0.3, 44, 0.0, 25, 0.0, 0, 1, 1), (14, 0.2, 70, 0.0, 9, 0.0, 0, 1, 1),
    (3, 0.0, 3, 0.0, 2, 0.0, 0, 1, 1), (22, 0.45, 50, 0.0, 30, 0.0, 0, 1, 1), (40, 0.0, 0, 0.0, 0, 0.0, 0, 1, 1),
    (5, 1.0, 60, 0.0, 4, 1.0, 0, 1, 0), (3, 1.0, 5, 1.0, 6, 1.0, 0, 1, 0), (12, 0.92, 80, 0.0, 10, 1.0, 0, 1, 0),
    (7, 0.85, 4, 1.0, 60, 0.0, 0, 1, 0), (2, 1.0, 40, 0.0, 0, 0.0, 0, 1, 0),
    # Furniture, in the article or out of it, long or short.
    (60, 0.0, 80, 0.0, 90, 0.0, 1, 1, 0), (18, 0.0, 60, 0.0, 40, 0.0, 1, 1, 0), (4, 1.0, 30, 0.0, 20, 0.0, 1, 1, 0),
    (8, 0.0, 1, 1.0, 10, 0.0, 1, -1, 0), (9, 0.0, 1, 1.0, 80, 0.0, 1, -1, 0), (14, 0.1, 40, 0.0, 0, 0.0, 1, -1, 0),
    (1, 1.0, 0, 0.0, 1, 1.0, 1, -1, 0), (1, 1.0, 1, 1.0, 8, 0.0, 1, -1, 0), (45, 0.0, 70, 0.0, 38, 0.0, 1, 0, 0),
    (90, 0.0, 45, 0.0, 60, 0.0, 1, 0, 0), (25, 0.0, 4, 0.0, 110, 0.0, 1, 0, 0), (3, 1.0, 3, 1.0, 3, 1.0, 1, 0, 0),
    (150, 0.01, 120, 0.0, 20, 0.0, 1, 0, 0), (120, 0.0, 150, 0.0, 90, 0.0, 1, -1, 0),
    # Outside the article element, nothing marked.
    (1, 1.0, 0, 0.0, 1, 1.0, 0, -1, 0), (8, 0.0, 1, 1.0, 12, 0.0, 0, -1, 0), (14, 0.2, 60, 0.0, 0, 0.0, 0, -1, 0),
    (40, 0.0, 90, 0.0, 3, 1.0, 0, -1, 0), (75, 0.0, 4, 0.0, 80, 0.0, 0, -1, 0), (3, 0.0, 120, 0.0, 0, 0.0, 0, -1, 0),
    # Pages without an article element: text stands in long blocks, and short ones between them.
    (90, 0.0, 8, 0.0, 70, 0.0, 0, 0, 1), (45, 0.1, 90, 0.0, 30, 0.0, 0, 0, 1), (20, 0.0, 45, 0.0, 60, 0.0, 0, 0, 1),
    (18, 0.0, 30, 0.0, 2, 1.0, 0, 0, 1), (60, 0.2, 2, 1.0, 3, 1.0, 0, 0, 1), (48, 0.0, 3, 1.0, 10, 0.0, 0, 0, 1),
    (9, 0.0, 60, 0.0, 80, 0.0, 0, 0, 1), (4, 0.0, 40, 0.0, 55, 0.0, 0, 0, 1), (8, 0.0, 6, 0.0, 70, 0.0, 0, 0, 1),
    (7, 0.0, 1, 1.0, 90, 0.0, 0, 0, 1), (12, 0.1, 50, 0.0, 12, 0.0, 0, 0, 1), (15, 0.0, 18, 0.0, 9, 0.0, 0, 0, 1),
    (2, 0.0, 70, 0.0, 40, 0.0, 0, 0, 1), (30, 0.3, 60, 0.0, 45, 0.0, 0, 0, 1), (25, 0.0, 20, 0.0, 5, 0.0, 0, 0, 1),
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0), (3, 1.0, 2, 1.0, 4, 1.0, 0, 0, 0), (6, 0.5, 3, 1.0, 3, 1.0, 0, 0, 0),
    (10, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0), (14, 0.0, 1, 1.0, 6, 0.0, 0, 0, 0), (5, 0.0, 2, 0.0, 4, 0.0, 0, 0, 0),
    (3, 0.0, 3, 0.0, 0, 0.0, 0, 0, 0), (40, 0.8, 60, 0.0, 20, 0.0, 0, 0, 0), (18, 0.6, 12, 0.5, 16, 0.7, 0, 0, 0),
    (9, 0.9, 70, 0.0, 60, 0.0, 0, 0, 0), (4, 0.0, 1, 0.0, 8, 0.0, 0, 0, 0), (12, 0.4, 5, 1.0, 4, 1.0, 0, 0, 0),
    (11, 0.0, 3, 0.7, 8, 0.0, 0, 0, 0), (6, 0.0, 4, 1.0, 12, 0.0, 0, 0, 0),
])


def grow(table: np.ndarray, depth: int = 8) -> tuple:
    """A tree over rows of features and label: (share of text,) or (feature, bound, tree up to it, tree above it)."""
    x, y = table[:, :-1], table[:, -1]
    share = float(y.mean())
    best = (2 * share * (1 - share) - 1e-9, -1, 0.0)
    for k in range(x.shape[1]) if depth and 0 < share < 1 else ():
        values = np.unique(x[:, k])
        for bound in (values[1:] + values[:-1]) / 2:
            low = x[:, k] <= bound
            p, q, w = y[low].mean(), y[~low].mean(), low.mean()
            best = min(best, (w * 2 * p * (1 - p) + (1 - w) * 2 * q * (1 - q), k, float(bound)))
    _, k, bound = best
    if k < 0:
        return (share,)
    low = x[:, k] <= bound
    return k, bound, grow(table[low], depth - 1), grow(table[~low], depth - 1)


def is_text(tree: tuple, block: tuple) -> bool:
    while len(tree) > 1:
        k, bound, low, high = tree
        tree = low if block[k] <= bound else high
    return tree[0] >= 0.5


class _Open:
    """An open element and what it says of the text below it.  ``held``: articles below are furniture, too; ``article``: 2 in an article
    element, 1 in another that marks the article."""

    __slots__ = ("name", "furniture", "held", "article")

    def __init__(self, name: str, furniture: bool, held: bool, article: int):
        self.name, self.furniture, self.held, self.article = name, furniture, held, article


@lru_cache(4096)
def _marks(value: str) -> frozenset[str]:
    """Marks of the whole tokens of a class, id or role."""
    found = set()
    for token in _CAMEL.sub("-", value).lower().strip("\"'").split():
        words = _WORD.findall(token)
        if all(w in MARKS or w in ARTICLE_MARKS or w in BESIDE for w in words):
            found.update(w for w in words if w not in BESIDE)
        found.add(re.sub("[-_]", "", token))
    return frozenset(found)


def _element(name: str, rest: str, above: _Open | None) -> _Open:
    furniture, held, article = (above.furniture, above.held, above.article) if above else (False, False, 0)
    marks = set()
    if rest:
        for _, value in _MARK.findall(rest):
            marks |= _marks(value)
    own_article = 2 if name == "article" else int(name == "main" or "main" in marks)
    if own_article > article:
        furniture = held
    if name not in ("html", "body") and not own_article:
        # The heading of an article stands in its header.
        marked = marks & MARKS - ({"header"} if article else set())
        element = name in FURNITURE or name == "header" and not article
        hidden = bool(rest and _HIDDEN.search(rest))
        if element or marked or hidden:
            furniture = True
            held = held or hidden or element and name not in WRAPPERS or bool(marks & HELD_MARKS)
        elif marks & ARTICLE_MARKS and name in ("div", "section", "td"):
            article = max(article, int("articlebody" in marks or "article" in marks))
    return _Open(name, furniture, held, max(article, own_article))


def _unended(m: re.Match) -> bool:
    """Whether a comment, or an element whose content is not shown, has no end on the page."""
    if m["unseen"]:
        return not re.search(rf"</{m['unseen']}\s*>\Z", m[0], re.I) and not m.string.startswith("<body", m.end())
    return m[0].startswith("<!--") and not m[0].endswith("-->")


def blocks(html: str) -> list[tuple[str, int, float, int, int]]:
    """Text, words, link density, furniture and article mark of each block."""
    found: list[list] = []
    stack: list[_Open] = []
    parts: list[str] = []
    linked = links = 0
    any_article = hidden = False

    def text(piece: str) -> None:
        nonlocal linked
        parts.append(piece)
        if links and not piece.isspace():
            linked += len(unescape(piece).split())

    def close() -> None:
        nonlocal linked
        if parts:
            words = unescape("".join(parts)).split()
            if words:
                top = stack[-1] if stack else None
                found.append([" ".join(words), len(words), min(1.0, linked / len(words)), int(bool(top and top.furniture)),
                              int(bool(top and top.article))])
        parts.clear()
        linked = 0

    def shut(k: int) -> None:
        """Close the elements from place k on."""
        nonlocal links
        for x in stack[k:]:
            count[x.name] -= 1
            links -= x.name == "a"
        del stack[k:]
        while block_at and block_at[-1] >= k:
            block_at.pop()

    # Open elements by name, and the places of block-level ones: no tag looks through the whole stack in vain.
    count: Counter[str] = Counter()
    block_at: list[int] = []
    at, last = 0, html.rfind(">") + 1
    # No tag begins behind the last bracket; a comment or a script that is still open there hides the rest.
    for m in _TOKEN.finditer(html, 0, last):
        if m.start() > at:
            text(html[at:m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            if m["unseen"] or m["closed"]:
                parts.append(" ")
            hidden = m.end() == last and _unended(m)
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK:
            close()
        if m["end"]:
            if count[name]:
                k = len(stack) - 1
                while stack[k].name != name:
                    k -= 1
                shut(k)
            continue
        if name in BLOCK and block_at:
            # A block-level tag ends an open paragraph, and an item the open item.
            above = stack[block_at[-1]].name
            if above == "p" or name == above in ("li", "dd", "dt", "tr", "td", "th", "option"):
                shut(block_at[-1])
        if name not in VOID and not m["rest"].endswith("/"):
            if name in BLOCK:
                block_at.append(len(stack))
            stack.append(_element(name, m["rest"], stack[-1] if stack else None))
            count[name] += 1
            links += name == "a"
            any_article = any_article or stack[-1].article > 0
    if at < len(html) and not hidden:
        text(html[at:].partition("<!--")[0])
    close()
    return [(t, w, d, f, a if a else -any_article) for t, w, d, f, a in found]


def main_text(html: str | None, tree: tuple) -> str:
    found = blocks(html or "")
    sizes = [(0, 0.0), *((w, d) for _, w, d, _, _ in found), (0, 0.0)]
    return "\n\n".join(
        t for k, (t, w, d, f, a) in enumerate(found) if is_text(tree, (w, d, *sizes[k], *sizes[k + 2], f, a))
    )


def extract(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """Per page: the key columns, ``text`` and ``n_chars``, its code points."""
    tree = grow(LABELLED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                part = batch.slice(s, 512)
                texts = [main_text(x, tree) for x in part.column(len(keys)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(len(keys))), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=[*keys, "text", "n_chars"],
                )

    kinds = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys)
    return pages.select(*keys, F.col(html)).mapInArrow(run, f"{kinds}, text string, n_chars long")
