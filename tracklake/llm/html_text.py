"""Main text of web pages: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks. Each is described by its number of words and the share of them in links,
the same of the two blocks before and after it, the share of words near it that stand in blocks of running text,
and weak evidence of its place: how many elements on the way from the article (or the page) down to it are marked as
page furniture, whether it stands in a marked article, and whether it is a heading. A decision tree, grown on the driver from the
labelled table in html_blocks.csv, tells article from furniture. Markup, scripts and hidden elements never become blocks.

The table holds blocks of supplied pages, each page as it is and in variants: without any marks, with marks that
mislead (a form, a sidebar or a comment class around the whole page), with links as paragraphs, and so on. A block's
label is whether it belongs to the article; tests/llm/label_blocks.py makes the table.
"""

from __future__ import annotations

import csv
import functools
import pkgutil
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batch, has_columns

FEATURES = [
    "words", "link_share", "words_before", "link_share_before", "words_after", "link_share_after", "place", "furniture", "heading",
    "words_before_2", "link_share_before_2", "words_after_2", "link_share_after_2", "text_near",
]
#: place: 2 in the article, 1 on a page that marks none, 0 outside of the one marked. furniture: elements so marked between
#: the block and its article, or the page, beyond those around every block of the page. text_near: share of the words of NEAR blocks on either side in blocks of RUNNING words and few links.
NEAR, RUNNING = 4, 10
#: Rows of the table in a leaf of the tree, at least.
MIN_LEAF = 3

_BREAKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = set("script style template noscript iframe svg object canvas audio video select button textarea head title".split())
_FURNITURE = set("nav aside footer form menu dialog fieldset".split())
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_ARTICLE_WORDS = set("article articlebody content main post entry story body text".split())
_COMMENT_WORDS = set("comment comments commentlist disqus respond replies reply".split())
_FURNITURE_WORDS = set(
    "ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs consent cookie cookies copyright footer form gdpr login masthead menu menubar modal nav navbar navigation newsletter "
    "notice notices notification alert pager pagination popup promo promotion recommended related search share sharing sidebar side signup social sponsor sponsored subscribe subscription tags toolbar topbar widget".split()
)
_ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
_SPLIT = re.compile(r"[^a-z0-9]+")
#: An article element that is one reader's comment.
_COMMENT = re.compile(r"(?:^|\s)(?:comment|reply)(?:-(?:body|content|item|\d+))?(?:\s|$)")
_WALLS = frozenset("ul ol menu table div section article main aside nav footer header form blockquote".split())
_RESULT_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


class _Blocks(HTMLParser):
    """Collects [text, link words, in article, furniture, heading] of each block in page order.

    Open elements are kept on a stack, with the places of each tag on it, so that an end tag finds its element, or that
    there is none, at once: time is proportional to the page, however badly its tags are nested.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[list] = []
        self.open: list[tuple[str, str, int]] = []  # (tag, kind, furniture counted outside); kind: "", silent, furniture or article
        self.places: dict[str, list[int]] = {}
        self.count = {"silent": 0, "furniture": 0, "article": 0}
        self.links = self.headings = 0
        self.parts: list[str] = []
        self.linked = 0

    def _kind(self, tag: str, attrs: dict[str, str]) -> str:
        if tag in _SILENT or "hidden" in attrs or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
            return "silent"
        if tag in ("html", "body"):
            return ""
        told = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()
        if tag in ("article", "main") or attrs.get("role") in ("main", "article") or attrs.get("itemprop", "").lower() == "articlebody":
            return "furniture" if _COMMENT.search(told) else "article"
        names = set(_SPLIT.split(told))
        if names & _COMMENT_WORDS or tag in _FURNITURE or attrs.get("role") in _ROLES:
            return "furniture"
        if tag == "header" and not self.count["article"]:
            return "furniture"
        if names & _ARTICLE_WORDS and not names & _FURNITURE_WORDS - {"side"}:
            return "article" if tag in ("div", "section", "td") else ""
        if names & _FURNITURE_WORDS or "header" in names and not self.count["article"]:
            return "furniture"
        return ""

    def handle_starttag(self, tag, attrs):
        if tag in _BREAKS:
            self.flush()
        if tag == "br":
            self.parts.append(" ")
        if tag in _VOID:
            return
        if tag == "p" or tag == "li":  # neither holds another of itself directly
            self._close(tag, _WALLS)
        elif tag not in ("head", "title") and self.count["silent"] and self.open and self.open[-1][0] == "head" and tag in _BREAKS:
            self._close("head")
        kind = self._kind(tag, {k: v or "" for k, v in attrs})
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, kind, self.count["furniture"]))
        if kind == "article" and tag in ("article", "main"):
            self.count["furniture"] = 0  # what stands around an article says nothing about what it holds
        self._add(tag, kind, 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in _BREAKS:
            self.flush()
        if tag not in _VOID:
            self._close(tag)

    def _close(self, tag: str, walls: frozenset[str] = frozenset()) -> None:
        own = self.places.get(tag)
        if not own or any(self.places.get(w, [-1])[-1:] > own[-1:] for w in walls):
            return
        place = own[-1]
        while len(self.open) > place:
            name, kind, outside = self.open.pop()
            self.places[name].pop()
            self._add(name, kind, -1)
            if kind == "article" and name in ("article", "main"):
                self.count["furniture"] = outside

    def _add(self, tag: str, kind: str, by: int) -> None:
        if kind:
            self.count[kind] += by
        self.links += by * (tag == "a")
        self.headings += by * (tag in _HEADINGS)

    def handle_data(self, data):
        if not self.count["silent"]:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.split())

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append([text, self.linked, self.count["article"] > 0, self.count["furniture"], self.headings > 0])
        self.parts, self.linked = [], 0


def blocks(html: str) -> list[list]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


def describe(own: list[list]) -> np.ndarray:
    """A row of FEATURES for each block."""
    words = np.array([len(b[0].split()) for b in own], float)
    share = np.minimum(1.0, np.array([b[1] for b in own], float) / np.maximum(words, 1))
    article = np.array([b[2] for b in own])
    place = np.where(article, 2.0, 0.0 if article.any() else 1.0)
    shifted = lambda x, by: np.concatenate([np.zeros(max(0, -by)), x[max(0, by) : len(x) + min(0, by)], np.zeros(max(0, by))])[: len(x)]
    neighbours = [shifted(x, by) for by in (-1, 1, -2, 2) for x in (words, share)]
    running = np.where((words >= RUNNING) & (share < 0.5), words, 0.0)
    around = lambda x: np.convolve(x, np.ones(2 * NEAR + 1))[NEAR : NEAR + len(x)]
    near = around(running) / np.maximum(around(words), 1)
    furniture, heading = (np.array([b[k] for b in own], float) for k in (3, 4))
    return np.stack([words, share, *neighbours[:4], place, furniture - furniture.min(), heading, *neighbours[4:], near], axis=1)


class Tree:
    """A binary decision tree grown by Gini impurity until its leaves are pure, or hold too few rows to be split."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.value = int(2 * y.sum() > len(y))
        self.feature = None
        best = (len(y) * self._gini(y), None, None)
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= cut
                cost = left.sum() * self._gini(y[left]) + (~left).sum() * self._gini(y[~left])
                if cost < best[0] - 1e-9 and min(left.sum(), (~left).sum()) >= MIN_LEAF:
                    best = (cost, f, cut)
        if best[1] is not None:
            _, self.feature, self.cut = best
            left = x[:, self.feature] <= self.cut
            self.low, self.high = Tree(x[left], y[left]), Tree(x[~left], y[~left])

    @staticmethod
    def _gini(y: np.ndarray) -> float:
        p = y.mean() if len(y) else 0.0
        return 2 * p * (1 - p)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The classes of rows of FEATURES; features that are left out at the end of the rows are 0."""
        out = np.empty(len(x), int)
        self._fill(np.pad(x, ((0, 0), (0, max(0, len(FEATURES) - x.shape[1])))), np.arange(len(x)), out)
        return out

    def _fill(self, x: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
        if self.feature is None:
            out[rows] = self.value
        elif len(rows):
            left = x[rows, self.feature] <= self.cut
            self.low._fill(x, rows[left], out)
            self.high._fill(x, rows[~left], out)


def table() -> tuple[np.ndarray, np.ndarray]:
    """The labelled blocks: a row of FEATURES, and whether it belongs to the article."""
    text = pkgutil.get_data(__package__, "html_blocks.csv").decode()
    rows = list(csv.DictReader(text.splitlines()))
    return np.array([[float(r[f]) for f in FEATURES] for r in rows]), np.array([int(r["article"]) for r in rows])


@functools.cache
def tree() -> Tree:
    return Tree(*table())


def main_texts(pages: list[str | None], classifier: Tree | None = None) -> list[str]:
    """The text of each page; the blocks of all of them are classified at once."""
    own = [blocks(html) if html else [] for html in pages]
    some = [b for b in own if b]
    kept = (classifier or tree()).predict(np.concatenate([describe(b) for b in some])).tolist() if some else []
    out, at = [], 0
    for b in own:
        out.append("\n".join([x[0] for x, keep in zip(b, kept[at : at + len(b)], strict=True) if keep]))
        at += len(b)
    return out


def main_text(html: str | None, classifier: Tree | None = None) -> str:
    return main_texts([html], classifier)[0]


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars.

    Null html is empty and gives an empty text; null page_id and url stay null; repeated rows are each
    extracted, to the same text; an empty table gives no rows; other columns are ignored, whatever their names. Pages
    and texts have no upper length: time is proportional to a page. Where two splits of the tree are equally good, the
    first feature and the lowest value count.
    """
    has_columns(pages, "page_id", "url", "html")
    classifier = tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, len(b), 256):
                part = b.slice(a, 256)
                texts = main_texts(part.column(2).to_pylist(), classifier)
                yield batch(_RESULT_ARROW, part.column(0), part.column(1), texts, [len(t) for t in texts])

    return pages.selectExpr("cast(page_id as long) as page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
