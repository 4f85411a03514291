"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into text blocks at block-level tags, in one linear pass. A block is described by its words and
link density, by those of the blocks before and after it, by the kind of container it stands in and, where only the name
of a container or a form speaks against it, by the share of the page's link-free text that the container holds. A small
decision tree, trained here on the labelled table below, tells article text from the rest.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

_BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li legend main menu nav ol optgroup option p pre section select "
    "summary table tbody td textarea tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Text in these is never shown as text of the page.
_HIDDEN = frozenset("script style title noscript template svg iframe object canvas audio video math head".split())
#: What a head may hold; any other tag, and text, ends it.
_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_RAW = frozenset("script style title textarea iframe noscript".split())
#: Elements that end where another begins: those that the start of a tag ends, and the elements beyond which it does not.
_CELLS, _ROWS, _GROUPS = frozenset(["td", "th"]), frozenset(["tr"]), frozenset(["thead", "tbody", "tfoot"])
_TABLE = frozenset(["table"]) | _HIDDEN
_SPECIAL = (_BLOCK | _HIDDEN) - frozenset(["address", "div", "p"])
_TERMS, _ITEMS, _OPTIONS = frozenset(["dt", "dd"]), frozenset(["li"]), frozenset(["option"])
_ENDS = {
    **dict.fromkeys(_CELLS, (_CELLS, _TABLE | _ROWS)),
    "tr": (_CELLS | _ROWS, _TABLE | _GROUPS),
    **dict.fromkeys(_GROUPS, (_CELLS | _ROWS | _GROUPS, _TABLE)),
    **dict.fromkeys(_TERMS, (_TERMS, _SPECIAL - _TERMS)),
    "li": (_ITEMS, _SPECIAL - _ITEMS),
    "option": (_OPTIONS, _SPECIAL - _OPTIONS),
}
#: Blocks that end an open paragraph, unless it lies beyond one of the scope.
_PARAGRAPH = frozenset(["p"])
_ENDS_P = _BLOCK - frozenset("html body button legend option optgroup select textarea".split()) - _CELLS - _ROWS - _GROUPS
_P_SCOPE = _CELLS | _TABLE | frozenset(["button"])
_CHROME = frozenset("nav header footer aside button select textarea dialog menu".split())
#: Containers that may hold controls only, or the whole page.
_FORMS = frozenset("form fieldset".split())
#: Names of containers that never hold the article.
_HINT = re.compile(
    r"\b(ads?|adverts?|advertisements?|advertising|sponsor(ed)?|cookies?|consent|gdpr|popups?|modals?|overlays?|comments?"
    r"|replies|reply|respond|discussion|disqus|sidebars?|menus?|nav|navbar|navigation|breadcrumbs?|footer|related"
    r"|recommend(ed|ations)?|newsletter|subscribe|subscription|pagination|pager|contentinfo|complementary|outbrain|taboola)\b"
)
#: Names that speak against a container, unless it holds most of the page's text or has a name of content too.
_WEAK_HINT = re.compile(
    r"\b(promos?|promotions?|banners?|notices?|alerts?|masthead|topbar|share|sharing|social|signup|login|widgets?|toolbar|legal"
    r"|disclaimer|copyright|search|dialog|skip|teasers?|trending)\b"
)
_CONTENT_HINT = re.compile(r"\b(article|content|post|entry|story|main|body)\b")
_NAMED = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>")
_SPACE = re.compile(r"\s+")

FEATURES = (
    "words", "link_density", "words_before", "links_before", "words_after", "links_after", "chrome", "article", "heading",
    "doubted", "share",
)
#: Blocks with a smaller share of words in links count as text of their container.
DENSE = 0.33

#: Labelled blocks outside doubted containers: the features in order, then 1 for article text. Fixed values.
LABELLED_PLAIN = (
    # words, links; before; after; in chrome, in an article, heading
    (45, 0.0, 30, 0.0, 60, 0.0, 0, 1, 0, 1), (1, 0.0, 40, 0.0, 50, 0.0, 0, 1, 0, 1), (8, 0.0, 12, 0.0, 50, 0.0, 0, 1, 1, 1),
    (2, 0.0, 3, 1.0, 40, 0.0, 0, 1, 1, 1), (120, 0.05, 2, 0.0, 3, 0.0, 0, 1, 0, 1), (3, 0.0, 8, 0.0, 1, 0.0, 0, 1, 0, 1),
    (15, 0.6, 40, 0.0, 35, 0.0, 0, 1, 0, 1), (6, 0.0, 5, 0.0, 0, 0.0, 0, 1, 0, 1), (70, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
    (1, 0.0, 1, 0.0, 1, 0.0, 0, 1, 0, 1), (9, 0.0, 9, 0.0, 4, 0.0, 0, 1, 1, 1), (25, 0.3, 25, 0.1, 3, 0.0, 0, 1, 0, 1),
    (6, 0.0, 40, 0.0, 1, 1.0, 0, 1, 0, 1), (2, 0.0, 1, 1.0, 2, 1.0, 0, 1, 0, 1), (3, 0.0, 1, 1.0, 1, 1.0, 0, 1, 1, 1),
    (12, 0.0, 30, 0.0, 4, 1.0, 0, 1, 0, 1), (1, 0.0, 4, 1.0, 9, 0.5, 0, 1, 0, 1), (5, 0.0, 20, 0.0, 2, 0.0, 0, 1, 0, 1),
    (4, 1.0, 60, 0.0, 4, 1.0, 0, 1, 0, 0), (3, 1.0, 3, 1.0, 3, 1.0, 0, 1, 0, 0), (5, 1.0, 4, 1.0, 30, 0.0, 0, 1, 0, 0),
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0), (2, 1.0, 1, 1.0, 12, 0.0, 1, 0, 0, 0),
    (12, 0.0, 1, 1.0, 8, 0.0, 1, 0, 0, 0), (30, 0.0, 5, 1.0, 30, 0.0, 1, 0, 0, 0), (60, 0.0, 40, 0.0, 70, 0.0, 1, 0, 0, 0),
    (9, 0.0, 50, 0.0, 0, 0.0, 1, 0, 0, 0), (4, 0.0, 10, 0.0, 20, 0.0, 1, 0, 1, 0), (150, 0.0, 20, 0.0, 20, 0.0, 1, 0, 0, 0),
    (40, 0.1, 30, 0.0, 9, 0.0, 1, 1, 0, 0), (3, 0.0, 40, 0.0, 50, 0.0, 1, 1, 1, 0), (18, 0.0, 2, 0.0, 25, 0.0, 1, 1, 0, 0),
    (90, 0.0, 60, 0.0, 60, 0.0, 1, 1, 0, 0), (1, 1.0, 60, 0.0, 1, 1.0, 1, 1, 0, 0), (6, 0.5, 70, 0.0, 40, 0.0, 1, 1, 0, 0),
    (40, 0.0, 35, 0.0, 50, 0.0, 0, 0, 0, 1), (25, 0.1, 4, 0.0, 60, 0.0, 0, 0, 0, 1), (80, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0, 1),
    (18, 0.0, 45, 0.0, 40, 0.0, 0, 0, 0, 1), (12, 0.0, 50, 0.0, 30, 0.0, 0, 0, 0, 1), (5, 0.0, 60, 0.0, 50, 0.0, 0, 0, 0, 1),
    (2, 0.0, 40, 0.0, 30, 0.0, 0, 0, 0, 1), (7, 0.0, 2, 1.0, 45, 0.0, 0, 0, 1, 1), (4, 0.0, 30, 0.0, 30, 0.0, 0, 0, 1, 1),
    (10, 0.0, 1, 1.0, 60, 0.0, 0, 0, 1, 1), (30, 0.2, 60, 0.0, 1, 1.0, 0, 0, 0, 1), (16, 0.0, 20, 0.0, 3, 0.0, 0, 0, 0, 1),
    (15, 0.0, 16, 0.0, 2, 1.0, 0, 0, 0, 1), (13, 0.0, 40, 0.0, 3, 1.0, 0, 0, 0, 1), (14, 0.0, 3, 1.0, 9, 1.0, 0, 0, 0, 1),
    (5, 0.0, 1, 1.0, 18, 0.0, 0, 0, 1, 1), (3, 0.0, 2, 1.0, 25, 0.0, 0, 0, 1, 1), (4, 0.0, 0, 0.0, 20, 0.0, 0, 0, 1, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), (3, 1.0, 2, 1.0, 40, 0.0, 0, 0, 0, 0), (5, 0.8, 60, 0.0, 4, 1.0, 0, 0, 0, 0),
    (2, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0), (4, 0.0, 3, 0.9, 5, 0.5, 0, 0, 0, 0), (20, 0.9, 3, 1.0, 6, 1.0, 0, 0, 0, 0),
    (3, 0.0, 2, 0.0, 2, 0.0, 0, 0, 0, 0), (6, 0.0, 4, 0.0, 0, 0.0, 0, 0, 0, 0), (5, 0.0, 0, 0.0, 3, 1.0, 0, 0, 1, 0),
    (30, 0.7, 4, 1.0, 4, 1.0, 0, 0, 0, 0), (12, 0.6, 50, 0.0, 50, 0.0, 0, 0, 0, 0), (40, 0.6, 50, 0.0, 9, 0.5, 0, 0, 0, 0),
)

#: Labelled blocks of forms and of containers with a weak hint: the features, with the container's share of the page's text
#: before the label. Fixed values.
LABELLED_DOUBTED = (
    (45, 0.0, 30, 0.0, 60, 0.0, 0, 0, 0, 0.95, 1), (8, 0.0, 12, 0.0, 50, 0.0, 0, 1, 1, 0.9, 1), (20, 0.1, 40, 0.0, 20, 0.0, 0, 0, 0, 0.8, 1),
    (30, 0.0, 50, 0.0, 3, 1.0, 0, 1, 0, 0.7, 1), (120, 0.0, 4, 0.0, 90, 0.0, 0, 0, 0, 0.65, 1), (14, 0.0, 30, 0.0, 30, 0.0, 0, 1, 0, 1.0, 1),
    (5, 0.0, 1, 1.0, 18, 0.0, 0, 0, 1, 0.95, 1), (4, 0.0, 1, 1.0, 30, 0.0, 0, 1, 1, 0.8, 1), (3, 0.0, 20, 0.0, 25, 0.0, 0, 1, 0, 0.9, 1), (15, 0.0, 1, 1.0, 30, 0.0, 0, 0, 0, 1.0, 1),
    (6, 0.0, 1, 0.0, 20, 0.0, 0, 1, 0, 0.1, 0), (30, 0.0, 40, 0.0, 40, 0.0, 0, 1, 0, 0.2, 0), (90, 0.0, 60, 0.0, 60, 0.0, 0, 0, 0, 0.3, 0),
    (12, 0.0, 30, 0.0, 8, 0.0, 0, 0, 0, 0.05, 0), (4, 0.0, 10, 0.0, 20, 0.0, 0, 0, 1, 0.02, 0), (150, 0.0, 90, 0.0, 4, 0.0, 0, 0, 0, 0.4, 0),
    (20, 0.2, 50, 0.0, 50, 0.0, 0, 1, 0, 0.15, 0), (3, 1.0, 40, 0.0, 4, 1.0, 0, 0, 0, 0.9, 0), (45, 0.0, 30, 0.0, 9, 0.0, 0, 1, 0, 0.35, 0),
)


LABELLED = tuple((*row[:-1], 0, 1.0, row[-1]) for row in LABELLED_PLAIN) + tuple((*row[:9], 1, *row[9:]) for row in LABELLED_DOUBTED)

Node = tuple  # (feature, threshold, below, above) or (label,)


def train(rows: np.ndarray, labels: np.ndarray, depth: int = 6) -> Node:
    """A decision tree by Gini impurity; a split lies half-way between neighbouring values."""
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0):
        return (int(share >= 0.5),)
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for threshold in (values[:-1] + values[1:]) / 2:
            below = rows[:, feature] <= threshold
            a, b = labels[below], labels[~below]
            impurity = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, feature, threshold, below
    if best is None:
        return (int(share >= 0.5),)
    _, feature, threshold, below = best
    return feature, threshold, train(rows[below], labels[below], depth - 1), train(rows[~below], labels[~below], depth - 1)


@lru_cache(maxsize=1)
def default_tree() -> Node:
    table = np.array(LABELLED, float)
    return train(table[:, :-1], table[:, -1])


def is_article(tree: Node, features: tuple) -> bool:
    while len(tree) > 1:
        feature, threshold, below, above = tree
        tree = below if features[feature] <= threshold else above
    return bool(tree[0])


class _Page:
    """Text blocks of one page, in order: [text, words, words in links, in chrome, in an article, heading, number of the
    innermost doubted container or 0]."""

    def __init__(self, source: str):
        self.blocks: list[list] = []
        self.open: list[tuple[str, bool, bool, bool, bool]] = []  # tag, chrome, article, hidden, doubted
        self.doubted: list[int] = []  # numbers of the open containers that are
        self.containers = 0
        self.depths: defaultdict[str, list[int]] = defaultdict(list)  # of the open elements, by tag
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.link = False
        self.chrome = self.article = self.hidden = 0
        self.heading = False
        self._scan(source)
        self._end_block()

    def _scan(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            start = source.find("<", at)
            if start < 0:
                start = size
            if start > at:
                if self._in_head() and not source[at:start].isspace():
                    self._pop()
                if not self.hidden:
                    self._text(source[at:start])
            if start == size:
                return
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                at = size if end < 0 else end + 3
            elif source[start + 1 : start + 2] in ("!", "?"):
                end = source.find(">", start)
                at = size if end < 0 else end + 1
            elif tag := _TAG.match(source, start) or _LOOSE_TAG.match(source, start):
                at = tag.end()
                name = tag[2].lower()
                if tag[1]:
                    self._close(name)
                else:
                    self._start(name, tag[3])
                    if name in _RAW and not tag[3].endswith("/"):
                        end = re.compile(rf"</{re.escape(name)}\b", re.I).search(source, at)
                        if end is None:  # never closed: all that follows is its raw text
                            return
                        if name == "textarea":
                            self._text(source[at : end.start()])
                        at = end.start()
            elif re.match(r"</?[a-zA-Z]", source[start : start + 3]):
                return  # a tag that the page breaks off in
            else:
                if not self.hidden:
                    self._text("<")
                at = start + 1

    def _text(self, text: str) -> None:
        text = html.unescape(text)
        self.parts.append(text)
        if self.link:
            self.linked.append(text)

    def _end_block(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                words = text.count(" ") + 1
                linked = min(words, len("".join(self.linked).split()))
                doubt = self.doubted[-1] if self.doubted else 0
                self.blocks.append([text, words, linked, self.chrome > 0, self.article > 0, self.heading, doubt])
        self.parts, self.linked = [], []

    def _in_head(self) -> bool:
        return bool(self.open) and self.open[-1][0] == "head"

    def _start(self, name: str, attributes: str) -> None:
        if name not in _HEAD and self._in_head():
            self._pop()
        if name == "br":
            self._text(" ")
            return
        if name in _BLOCK:
            self._end_block()
            self.heading = len(name) == 2 and name[0] == "h" and name[1].isdigit()
        if name == "a":
            self.link = True
            self.linked.append(" ")
        if name in _VOID or attributes.endswith("/") and name not in _BLOCK:
            return
        if self.depths["p"] and (name == "p" or name in _ENDS_P):
            self._end_omitted(_PARAGRAPH, _P_SCOPE)
        if name in _ENDS:
            self._end_omitted(*_ENDS[name])
        hint = weak = content = False
        if attributes and name not in ("html", "body", "main", "article", "a", "p", "span", "b", "i", "em", "strong"):
            said = " ".join("".join(m) for m in _NAMED.findall(attributes)).lower()
            said = re.sub(r"[^a-z]+", " ", said)
            hint, content = bool(_HINT.search(said)), bool(_CONTENT_HINT.search(said))
            weak = not content and bool(_WEAK_HINT.search(said))
        in_article = self.article > 0
        chrome = name in _CHROME and not (name == "header" and in_article) or hint
        article = name in ("article", "main") or content and not hint
        doubted = name in _FORMS or weak
        if name not in _BLOCK and not chrome and not doubted and name not in _HIDDEN:
            return
        self.depths[name].append(len(self.open))
        self.open.append((name, chrome, article, name in _HIDDEN, doubted))
        if doubted:
            self.containers += 1
            self.doubted.append(self.containers)
        self.chrome += chrome
        self.article += article
        self.hidden += name in _HIDDEN

    def _end_omitted(self, ended: frozenset[str], within: frozenset[str]) -> None:
        """End the outermost open element of ``ended`` inside the innermost open one of ``within``."""
        barrier = max((self.depths[name][-1] for name in within if self.depths.get(name)), default=-1)
        outer = len(self.open)
        for name in ended:
            depths = self.depths[name]
            at = bisect_right(depths, barrier)
            if at < len(depths):
                outer = min(outer, depths[at])
        self._pop_to(outer)

    def _pop_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self._pop()

    def _pop(self) -> None:
        name, chrome, article, hidden, doubted = self.open.pop()
        self.depths[name].pop()
        if doubted:
            self.doubted.pop()
        self.chrome -= chrome
        self.article -= article
        self.hidden -= hidden

    def _close(self, name: str) -> None:
        if name == "a":
            self.link = False
            self.linked.append(" ")
        if name in _BLOCK:
            self._end_block()
            self.link = self.heading = False
        if self.depths[name]:
            self._pop_to(self.depths[name][-1])


def blocks(source: str) -> list[tuple[str, tuple]]:
    """Text blocks of a page with their features."""
    found = _Page(source).blocks
    density = [linked / words for _, words, linked, *_ in found]
    text_of: defaultdict[int, int] = defaultdict(int)  # words of link-free blocks, by doubted container
    for (_, words, _, chrome, *_, doubt), links in zip(found, density):
        if not chrome and links < DENSE:
            text_of[doubt] += words
    whole = max(1, sum(text_of.values()))
    out = []
    for i, (text, words, _, chrome, article, heading, doubt) in enumerate(found):
        before = (found[i - 1][1], density[i - 1]) if i else (0, 0.0)
        after = (found[i + 1][1], density[i + 1]) if i + 1 < len(found) else (0, 0.0)
        share = text_of[doubt] / whole if doubt else 1.0
        kinds = (int(chrome), int(article), int(heading), int(doubt > 0))
        out.append((text, (words, density[i], *before, *after, *kinds, share)))
    return out


def main_text(source: str, tree: Node | None = None) -> str:
    tree = tree or default_tree()
    return "\n".join(text for text, features in blocks(source) if is_article(tree, features))


def extract(pages: DataFrame, tree: Node | None = None) -> DataFrame:
    """One row per row of ``pages(page_id, url, html)``: page_id, url, text, n_chars.

    A page without article text, and a null or empty one, gives an empty text. Other columns are ignored; an
    empty table gives an empty result.
    """
    tree = tree or default_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html"):
            texts = [main_text(source, tree) for source in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
