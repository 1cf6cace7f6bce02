"""Main text of web pages: flat text blocks, told apart by a decision tree.

A page is cut at its block-level tags into flat blocks of text. A block's features are its
number of words and its link density (the share of its words inside links), those of the
blocks before and after it, whether it is a heading, and what its enclosing elements say:
1 inside an article, -1 inside an element for menus, adverts, comments and the like, by tag,
role, class or id, 0 otherwise. A decision tree (splits by Gini impurity) is trained on
``LABELLED``, a small table of labelled pieces of pages, and tells text from the rest.

Enclosing elements, in order:
* any element for other things outweighs an article, and so does an article in an article,
  which holds a reader's comment; a header counts for itself only outside articles;
* an element for other things that holds every block of the page says nothing;
* if by this no block of the page lies in an article, the innermost element decides: a menu
  that was never closed does not swallow the article behind it.

Scripts, styles, titles, form controls, comments and unfinished tags at the end hold no text.
Character references are decoded, white space (of any kind, line-break tags too) inside a
block becomes one space, blocks of text are joined by a line feed in page order.

Defined results: a null or empty page, and one without text, gives an empty text; pages of any
length are read whole; equal texts are kept each time they occur; repeated rows, and rows with
a null or repeated id, are extracted each for themselves; an empty table gives no rows. Only
page_id, url and html are read, further columns of any name are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark nobr picture q ruby rt rb s samp"
    " small source span strike strong sub sup time tt u var wbr br".split()
)
SILENT = frozenset("script style title noscript template iframe object svg canvas audio video select datalist textarea button".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HOLDERS = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset("article main".split())
OTHER = frozenset("nav footer aside form menu dialog".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
# Words of class names and ids that name other things than the article.
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising aside banner breadcrumb breadcrumbs captcha comment comments consent cookie cookies"
    " copyright disclaimer disqus discussion footer form gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay pager"
    " pagination popup promo promotion recommended related replies reply respond search share sharing sidebar signup social sponsor"
    " sponsored subscribe subscription teaser toolbar topbar widget widgets".split()
)
# Such names that say what a page has or lacks, as in has-sidebar.
ABOUT = frozenset("has no with without is js".split())

FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "place", "heading")


@dataclass(frozen=True)
class Holder:
    """An element that says something: strictly, and where only the innermost counts."""

    number: int
    strict: int
    innermost: int


@dataclass
class Block:
    text: str
    words: int
    linked: int
    heading: bool
    inside: tuple[Holder, ...]


def named_other(attributes: dict[str, str | None]) -> bool:
    names = f"{attributes.get('class') or ''} {attributes.get('id') or ''}".lower().split()
    for name in names:
        parts = re.split("[^a-z]+", name)
        if parts[0] not in ABOUT and not OTHER_NAMES.isdisjoint(parts):
            return True
    return (attributes.get("role") or "").lower() in OTHER_ROLES


class BlockReader(HTMLParser):
    """Collects the flat blocks of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self._parts: list[str] = []
        self._linked = 0
        self._link = self._heading = False
        self._open: list[tuple[str, Holder | None]] = []
        self._counts: Counter[str] = Counter()
        self._holders: list[Holder] = []
        self._silent = self._made = 0

    def flush(self) -> None:
        words = "".join(self._parts).split()
        if words:
            self.blocks.append(Block(" ".join(words), len(words), min(self._linked, len(words)), self._heading, tuple(self._holders)))
        self._parts.clear()
        self._linked = 0

    def _holder(self, tag: str, attributes: dict[str, str | None]) -> Holder | None:
        article = any(x.innermost > 0 for x in self._holders)
        kinds = (0, 0)
        if named_other(attributes) or tag in OTHER:
            kinds = (-1, -1)
        elif tag in MAIN:
            kinds = (-1 if tag == "article" and self._counts["article"] else 1, 1)
        elif not article and (tag == "header" or "header" in re.split("[^a-z]+", f"{attributes.get('class')} {attributes.get('id')}".lower())):
            kinds = (-1, -1)
        if not any(kinds):
            return None
        self._made += 1
        return Holder(self._made, *kinds)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.flush()
            self._heading = tag in HEADINGS
            while self._open and self._open[-1][0] in ("p", tag) and self._open[-1][0] not in HOLDERS | SILENT:
                self._pop()
        elif tag == "br":
            self._parts.append(" ")
        elif tag == "a":
            self._link = any(name == "href" for name, _ in attrs)
        if tag in VOID or tag in ("html", "body"):
            return
        holder = self._holder(tag, dict(attrs))
        if holder or tag in HOLDERS or tag in SILENT:
            self._open.append((tag, holder))
            self._counts[tag] += 1
            self._silent += tag in SILENT
            if holder:
                if tag in INLINE:
                    self.flush()
                self._holders.append(holder)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in SILENT or self._silent:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
            self._heading = False
        elif tag == "a":
            self._link = False
        if self._counts[tag]:
            if tag in INLINE:
                self.flush()
            while self._pop() != tag:
                pass
            if tag in HOLDERS:
                self._link = False

    def _pop(self) -> str:
        tag, holder = self._open.pop()
        self._counts[tag] -= 1
        self._silent -= tag in SILENT
        if holder:
            self._holders.remove(holder)
        return tag

    def handle_data(self, data: str) -> None:
        if not self._silent:
            self._parts.append(data)
            if self._link:
                self._linked += len(data.split())

    def parse_comment(self, i: int, report: bool = True) -> int:
        end = super().parse_comment(i, report)
        return end if end >= 0 else len(self.rawdata)

    def parse_marked_section(self, i: int, report: bool = True) -> int:
        return self.parse_bogus_comment(i)


def blocks_of(html: str | None) -> list[Block]:
    html = html or ""
    last = html.rfind("<")
    if last >= 0 and html.find(">", last) < 0 and re.match(r"<[A-Za-z/!?]", html[last : last + 2]):
        html = html[:last]
    reader = BlockReader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.blocks


def places(blocks: Sequence[Block]) -> list[int]:
    """What the enclosing elements say of each block of a page: 1, 0 or -1."""
    held = Counter(x.number for b in blocks for x in b.inside if x.strict < 0)
    whole = {number for number, count in held.items() if count == len(blocks)}
    inside = [[x for x in b.inside if x.number not in whole] for b in blocks]
    strict = [min((x.strict for x in own), default=0) for own in inside]
    return strict if 1 in strict else [own[-1].innermost if own else 0 for own in inside]


def features(blocks: Sequence[Block]) -> np.ndarray:
    """One row of ``FEATURES`` per block of a page; before the first and after the last there are 0 words."""
    own = np.array([[b.words, b.linked / b.words] for b in blocks], np.float64).reshape(-1, 2)
    none = np.zeros((1, 2))
    around = np.concatenate([none, own, none])
    marks = np.array(list(zip(places(blocks), (b.heading for b in blocks), strict=True)), np.float64).reshape(-1, 2)
    return np.concatenate([own, around[:-2], around[2:], marks], axis=1)


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays; a leaf has itself as both children."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    label: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        while True:
            low = rows[np.arange(len(rows)), self.feature[node]] <= self.threshold[node]
            further = np.where(low, self.left[node], self.right[node])
            if (further == node).all():
                return self.label[node]
            node = further


def gini(labels: np.ndarray) -> float:
    share = labels.mean()
    return 2 * share * (1 - share) * len(labels)


def best_split(rows: np.ndarray, labels: np.ndarray) -> tuple[float, int, float] | None:
    """Least impurity of any split: impurity, feature, threshold; the first of equal ones."""
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for threshold in (values[:-1] + values[1:]) / 2:
            low = rows[:, feature] <= threshold
            impurity = gini(labels[low]) + gini(labels[~low])
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, threshold)
    return best


def fit_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 6) -> Tree:
    """A decision tree of at most ``depth`` splits on a path."""
    nodes: list[list] = []

    def grow(own: np.ndarray, left_depth: int) -> int:
        number = len(nodes)
        label = labels[own].mean() > 0.5 if own.any() else False
        nodes.append([0, 0.0, number, number, label])
        split = best_split(rows[own], labels[own]) if left_depth and 0 < labels[own].sum() < own.sum() else None
        if split and split[0] < gini(labels[own]):
            _, feature, threshold = split
            low = rows[:, feature] <= threshold
            nodes[number][:2] = feature, threshold
            nodes[number][2] = grow(own & low, left_depth - 1)
            nodes[number][3] = grow(own & ~low, left_depth - 1)
        return number

    grow(np.ones(len(rows), bool), depth)
    return Tree(*(np.array(x) for x in zip(*nodes, strict=True)))


def labelled_rows(pages: Sequence[Sequence[tuple[int, str]]]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of pages given as (label, piece of HTML), each piece some blocks."""
    rows, labels = [], []
    for pieces in pages:
        reader, known = BlockReader(), []
        for label, piece in pieces:
            reader.feed(piece)
            reader.flush()
            known += [label] * (len(reader.blocks) - len(known))
        rows.append(features(reader.blocks))
        labels += known
    return np.concatenate(rows), np.array(labels, np.float64)


_LONG = "The council met on Tuesday evening and agreed, after three hours of debate, to repair the old stone bridge before the winter floods arrive. "
_MIDDLE = "Nobody in the village could say who had built it. "

#: labelled pieces of pages: 1 is text of the article, 0 is not
LABELLED: tuple[tuple[tuple[int, str], ...], ...] = (
    (
        (0, '<header><a href="/">The Valley Post</a></header><nav><ul><li><a href="/a">News</a></li><li><a href="/b">Sport and leisure</a></li></ul></nav>'),
        (0, f'<div class="cookie-notice"><p>{_LONG}</p></div>'),
        (1, f"<article><h1>Bridge</h1><p>Agreed.</p><p>{_LONG}</p><p>Yes.</p>"),
        (1, f'<p><a href="/m">Minutes of the meeting</a></p><ul><li><a href="/x">One</a></li><li>Two</li></ul><p>{_MIDDLE}</p><p>End.</p></article>'),
        (0, f"<footer><p>{_LONG}{_LONG}</p><p>All rights reserved.</p></footer>"),
    ),
    (
        (0, '<div id="menu"><a href="/a">Home</a><br><a href="/b">Archive</a></div>'),
        (0, f'<div class="ad">{_MIDDLE}</div>'),
        (1, f"<main><h1>Short note</h1><p>{_MIDDLE}</p><p>So be it.</p></main>"),
        (0, f'<section class="comments"><h3>Comments</h3><p>{_LONG}</p><p>Me too.</p><p>{_MIDDLE}{_LONG}</p></section>'),
        (0, "<footer>Impressum</footer>"),
    ),
    (
        (0, f"<aside><h2>About us</h2><p>{_LONG}{_LONG}</p></aside>"),
        (1, "<article><h1>Rain</h1><p>Rain again.</p></article>"),
        (0, f'<form><p>{_MIDDLE}</p><label>Your name</label></form><aside><p>{_LONG}</p></aside>'),
    ),
    (
        (0, '<div><a href="/">Home</a> | <a href="/list">All articles</a></div><div><a href="/en">English</a></div>'),
        (1, f"<h1>How the bridge was mended</h1><p>{_LONG}</p><p>{_MIDDLE}</p><p>{_LONG}{_LONG}</p><h2>The winter</h2><p>{_LONG}</p><p>It held.</p><p>{_LONG}</p>"),
        (0, '<div><a href="/next">Next story</a></div><div>Copyright the authors</div>'),
    ),
    (
        (0, '<table><tr><td><a href="/1">Start</a></td><td><a href="/2">Guest book</a></td></tr></table>'),
        (1, f"<table><tr><td><h2>A long walk</h2>{_LONG}<p>{_LONG}{_MIDDLE}</td></tr></table>"),
        (0, f'<p><a href="/a">{_MIDDLE}</a></p><p><a href="/b">{_LONG}</a></p><p>Page 3</p>'),
    ),
    (
        (0, '<div>Search</div><div><a href="/a">Sign in</a></div><div>12 May</div>'),
        (1, f"<div>{_LONG}{_MIDDLE}</div><div>{_MIDDLE}{_LONG}</div><div>{_LONG}</div>"),
        (0, '<div>Share</div><div>Print</div><ul><li><a href="/r">Related: the flood of last year</a></li><li><a href="/s">Ten bridges</a></li></ul>'),
    ),
    ((0, '<ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul><div>No results</div><div>Contact</div>'),),
)


@cache
def trained_tree() -> Tree:
    return fit_tree(*labelled_rows(LABELLED))


def _extracted(tree: Tree):
    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for html in batch.column("html"):
                blocks = blocks_of(html.as_py())
                chosen = tree.predict(features(blocks)) if blocks else []
                texts.append("\n".join(b.text for b, label in zip(blocks, chosen, strict=True) if label))
                counts.append(len(blocks))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                ["page_id", "url", "text", "n_blocks"],
            )

    return extracted


def main_text(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url, main text and number of flat blocks of every page, by the tree given or the trained one."""
    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_blocks long"
    return pages.select("page_id", "url", "html").mapInArrow(_extracted(tree or trained_tree()), schema)
