"""Main text of web pages: flat text blocks, classified by a decision tree from neighbours' features."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomline.llm.common import in_batches, only, slices

#: Elements that end a text block where they begin and end.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
#: Elements whose content is no text of the page: RAW ones hold no tags, in code (the first two)
#: their own name may stand; of the others those in OWN_END can end with their first tag.
RAW = ("script", "style", "textarea", "title")
HIDDEN = ("noscript", "template", "select", "svg", "math", "iframe", "canvas", "audio", "video", "button")
OWN_END = frozenset(("svg", "math"))
HEADINGS = frozenset(f"h{i}" for i in range(1, 10))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE_TAGS = frozenset(("article", "main"))
#: Elements around the whole page: their names speak of the page, not of a part of it.
ROOT_TAGS = frozenset(("html", "body"))
FURNITURE_TAGS = frozenset("nav header footer aside form menu dialog".split())
#: Words of class, id and role that name a part around the article; a name is cut at other
#: characters than letters and where a capital follows a small letter.
FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha comment "
    "comments consent contentinfo cookie cookies disclaimer disqus footer form gdpr header login "
    "masthead menu menubar modal nav navbar navigation newsletter notice notices notification pager "
    "pagination paywall popup promo promotion related reply replies search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription tags toolbar topbar widget".split())
ARTICLE_NAMES = frozenset("article content entry main post story".split())
#: Parts whose articles are other people's or other pages'; of those only <main> is the article again.
OTHERS_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising comment comments disqus promo promotion related reply "
    "replies sidebar sponsor sponsored widget".split())
#: has-comments, no-sidebar, tag-notice: what follows these words in a class is said about the element.
ABOUT = frozenset("has no not with without hide hides hidden show shows is category tag term topic author".split())
#: comments-open, sidebar-layout: a class that ends so names a state or the whole page.
STATES = frozenset("closed disabled enabled layout off on open page template theme".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""",
    re.S)
_OPEN = {name: re.compile(rf"<{name}(?=[\s/>])", re.I) for name in (*RAW, *HIDDEN)}
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for name in (*RAW, *HIDDEN)}
_BLOCK_EDGE = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK_TAGS))})(?=[\s/>])", re.I)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


#: Words of the plain blocks of a page without main blocks from which on they are its text.
SHORT_TEXT = 10
#: Furniture by degrees: a wrapper that only its name or <form> makes furniture, a part of OTHERS_NAMES, a tag.
WRAPPER, OTHERS, SEMANTIC = -1, -2, -3


@dataclass
class Block:
    text: str
    words: int
    linked: int  # words inside links
    place: int  # 1: nearest named part is the article, -1: page furniture, 0: neither
    heading: int
    wrapped: bool = False  # furniture by nothing but the name of a wrapper


def _names(attributes: str) -> tuple[set[str], set[str]]:
    """Words that name an element, and those among them that stand alone in class, id or role.

    Words that say something about the element (ABOUT, STATES) and what they speak of are left out.
    """
    names: set[str] = set()
    alone: set[str] = set()
    for value in _NAMES.findall(attributes) if "=" in attributes else ():
        for token in value.strip("\"'").split():
            found = [w.lower() for w in _WORDS.findall(token)]
            if not found or len(found) > 1 and found[-1] in STATES:
                continue
            about = next((i for i, w in enumerate(found) if w in ABOUT), len(found))
            names.update(found[:about])
            if len(found) == 1:
                alone.update(found)
    return names, alone


def _place(tag: str, attributes: str, around: int) -> int:
    """What a tag makes of its content: 1 article, 0 neither, WRAPPER, OTHERS or SEMANTIC furniture.

    Tags win over names. The article can stand in a WRAPPER; the word content alone does not say that
    it does, there the blocks themselves decide. Nothing is the article again inside other furniture.
    """
    if around == SEMANTIC or tag in ROOT_TAGS:
        return around
    if tag in FURNITURE_TAGS and tag != "form":
        return SEMANTIC
    names, alone = _names(attributes)
    if tag == "main" or around > OTHERS and tag == "article":
        return 1
    if OTHERS_NAMES.intersection(names):
        return OTHERS
    if tag == "form" or FURNITURE_NAMES.intersection(names):
        return min(around, WRAPPER)
    if around < 0:
        if around == WRAPPER and (ARTICLE_NAMES - {"content"}).intersection(alone):
            return 1
        return 0 if around == WRAPPER and "content" in alone else around
    return 1 if ARTICLE_NAMES.intersection(names) else around


class _Hidden:
    """Where elements without text end in a page. What is found ahead is kept, so all of it is read once."""

    def __init__(self, page: str):
        self.page = page
        self.ahead: dict[tuple[bool, str], tuple[int, int]] = {}

    def _next(self, closing: bool, name: str, at: int) -> tuple[int, int]:
        """Start and end of the next tag of this name from ``at`` on; behind the page if there is none."""
        found = self.ahead.get((closing, name), (-1, -1))
        if found[0] < at:
            m = (_CLOSE if closing else _OPEN)[name].search(self.page, at)
            found = self.ahead[closing, name] = m.span() if m else (len(self.page) + 1, len(self.page) + 1)
        return found

    def end(self, name: str, at: int, self_closing: bool) -> int:
        """The end of an element whose first tag ends at ``at``.

        Its closing tag. Without one, or if another of its kind begins before it, a self-closing
        element is empty, code takes the rest of the page, a title or text field ends at the next tag
        and others end where the next block begins or ends.
        """
        close, opened = self._next(True, name, at), self._next(False, name, at)
        closed = close[0] < len(self.page)
        if self_closing and (name in OWN_END or not closed or opened[0] < close[0]):
            return at
        if closed and (name in RAW or name in OWN_END or opened[0] > close[0]):
            return close[1]
        if name in RAW[:2]:
            return len(self.page)
        if name in RAW:
            edge = self.page.find("<", at)
            return edge if edge >= 0 else len(self.page)
        edge = _BLOCK_EDGE.search(self.page, at)
        return edge.start() if edge else len(self.page)


def blocks(page: str) -> list[Block]:
    """Cut a page into flat blocks of text.

    References are decoded in text only, white space becomes one space. Comments, declarations
    and the elements in RAW and HIDDEN have no text (see ``_Hidden``); an element left open ends
    with its parent, a comment left open takes the rest of the page. Time is linear in the page.
    """
    out: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    open_tags: list[tuple[str, int]] = []
    count: Counter[str] = Counter()  # of open tags by name
    hidden = _Hidden(page)
    headings = 0

    def end_block() -> None:
        if not pieces:
            return
        text = " ".join("".join(p for p, _ in pieces).split())
        if text:
            linked = len("".join(p for p, in_link in pieces if in_link).split())
            place = open_tags[-1][1] if open_tags else 0
            out.append(Block(text, len(text.split()), linked, max(place, -1), int(headings > 0), place == WRAPPER))
        pieces.clear()

    def close() -> str:
        nonlocal headings
        tag, _ = open_tags.pop()
        count[tag] -= 1
        headings -= tag in HEADINGS
        return tag

    def add(raw: str) -> None:
        if raw:
            pieces.append((html.unescape(raw) if "&" in raw else raw, count["a"] > 0))

    at = 0
    while (m := _TAG.search(page, at)) is not None:
        add(page[at:m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        closing = m.group(1) == "/"
        if tag in _OPEN:
            if not closing:
                pieces.append((" ", False))
                at = hidden.end(tag, at, m.group(3).endswith("/"))
            continue
        if tag in BLOCK_TAGS:
            end_block()
        elif tag == "br":
            pieces.append((" ", count["a"] > 0))
        if tag in VOID:
            continue
        if not closing:
            if tag == "p" and open_tags and open_tags[-1][0] == "p":
                close()
            around = open_tags[-1][1] if open_tags else 0
            open_tags.append((tag, _place(tag, m.group(3), around)))
            count[tag] += 1
            headings += tag in HEADINGS
        elif count[tag]:
            while close() != tag:
                pass
    add(page[at:])
    end_block()
    return out


FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after",
            "link_density_after", "place", "heading", "in_article_page")


def features(found: list[Block]) -> np.ndarray:
    """One row per block: its own and its neighbours' word count and link density, and its place."""
    if not found:
        return np.zeros((0, len(FEATURES)))
    words = np.array([b.words for b in found], float)
    density = np.array([b.linked / b.words for b in found], float)
    place = np.array([b.place for b in found], float)
    before = lambda x: np.concatenate([[0.0], x[:-1]])
    after = lambda x: np.concatenate([x[1:], [0.0]])
    return np.column_stack([
        words, density, before(words), before(density), after(words), after(density), place,
        [b.heading for b in found], np.full(len(found), float((place > 0).any()))])


#: The labelled table: (label, block features in the order of FEATURES), labelled by hand from
#: typical pages. Page furniture around an article, short and long paragraphs in it, headings,
#: link lists in it, and pages that name no article, where length and links must decide.
LABELLED = [
    # pages with a named article: title, paragraphs (long, short, one word), lists with links
    (1, (6, 0, 4, 0, 40, 0, 1, 1, 1)), (1, (60, 0, 6, 0, 80, 0, 1, 0, 1)),
    (1, (1, 0, 60, 0, 30, 0, 1, 0, 1)), (1, (3, 0, 1, 0, 2, 0, 1, 0, 1)),
    (1, (120, .02, 60, 0, 90, 0, 1, 0, 1)), (1, (8, 1, 40, 0, 30, 0, 1, 0, 1)),
    (1, (2, 1, 50, .1, 2, 1, 1, 0, 1)), (1, (25, .4, 90, 0, 10, 0, 1, 0, 1)),
    (1, (300, 0, 5, 0, 9, 0, 1, 0, 1)), (1, (2, 0, 3, 1, 4, 0, 1, 0, 1)),
    (1, (14, 0, 2, 1, 3, 1, 1, 0, 1)), (1, (5, 0, 1, 1, 200, 0, 1, 1, 1)),
    (1, (33, 0, 1, 0, 1, 0, 1, 0, 1)), (1, (4, 0, 0, 0, 0, 0, 1, 0, 1)),
    (1, (1, 0, 4, 0, 17, 0, 1, 0, 1)), (1, (11, .2, 2, .5, 9, 0, 1, 0, 1)),
    (1, (2, .5, 9, 0, 5, .4, 1, 0, 1)), (1, (90, .3, 1, 1, 12, 0, 1, 0, 1)),
    (1, (7, 0, 12, 0, 2, 1, 1, 1, 1)), (1, (18, 0, 3, 0, 100, .1, 1, 0, 1)),
    (1, (150, 0, 150, 0, 150, 0, 1, 0, 1)), (1, (3, 1, 3, 1, 3, 1, 1, 0, 1)),
    (1, (1, 0, 1, 0, 1, 0, 1, 0, 1)), (1, (45, .6, 20, 0, 8, 0, 1, 0, 1)),
    (1, (10, 0, 2, 0, 13, 0, 1, 0, 1)), (1, (70, 0, 0, 0, 4, 1, 1, 0, 1)),
    (1, (9, .1, 80, .1, 0, 0, 1, 0, 1)), (1, (26, 0, 6, .3, 70, .2, 1, 0, 1)),
    (1, (2, 0, 2, 0, 55, 0, 1, 1, 1)), (1, (13, 0, 30, 0, 5, 0, 1, 0, 1)),
    # furniture of such pages: menus, adverts, notices, comments, footers
    (0, (1, 1, 0, 0, 1, 1, -1, 0, 1)), (0, (1, 1, 1, 1, 8, 0, -1, 0, 1)),
    (0, (8, 0, 1, 1, 6, 0, -1, 0, 1)), (0, (30, 0, 1, 1, 60, 0, -1, 0, 1)),
    (0, (12, 0, 70, 0, 0, 0, -1, 0, 1)), (0, (80, 0, 50, 0, 40, 0, -1, 0, 1)),
    (0, (5, 0, 90, 0, 20, 0, -1, 1, 1)), (0, (150, .01, 4, 0, 3, 0, -1, 0, 1)),
    (0, (4, .5, 30, 0, 2, 1, -1, 0, 1)), (0, (2, 0, 2, 0, 40, 0, -1, 0, 1)),
    # outside both, on pages that name an article: stray lines
    (0, (3, 0, 1, 1, 40, 0, 0, 0, 1)), (0, (10, .3, 60, 0, 2, 1, 0, 0, 1)),
    (0, (40, 0, 80, 0, 3, 1, 0, 0, 1)), (0, (2, 1, 2, 1, 2, 1, 0, 0, 1)),
    (0, (5, 0, 0, 0, 1, 1, 0, 1, 1)), (0, (70, .1, 5, 0, 0, 0, 0, 0, 1)),
    # furniture of pages that name no article
    (0, (2, 1, 0, 0, 2, 1, -1, 0, 0)), (0, (40, 0, 2, 1, 70, 0, -1, 0, 0)),
    (0, (9, 0, 80, 0, 0, 0, -1, 0, 0)), (0, (100, .1, 9, 0, 3, 0, -1, 1, 0)),
    (0, (35, 0, 60, 0, 45, 0, -1, 0, 0)), (0, (55, 0, 30, 0, 70, 0, -1, 0, 0)),
    (0, (20, .1, 90, 0, 30, 0, -1, 0, 0)), (0, (75, 0, 45, 0, 60, 0, -1, 0, 0)),
    (0, (42, .05, 33, 0, 25, 0, -1, 0, 0)), (0, (28, 0, 110, 0, 50, 0, -1, 0, 0)),
    (0, (64, 0, 20, 0, 38, 0, -1, 0, 0)), (0, (15, 0, 55, 0, 95, 0, -1, 1, 0)),
    # pages that name no article: text blocks, headings and short paragraphs between them
    (1, (45, 0, 2, 1, 60, 0, 0, 0, 0)), (1, (90, .05, 40, 0, 20, 0, 0, 0, 0)),
    (1, (20, 0, 60, 0, 1, 1, 0, 0, 0)), (1, (16, .1, 30, 0, 50, 0, 0, 0, 0)),
    (1, (6, 0, 3, 1, 50, 0, 0, 1, 0)), (1, (5, 0, 70, 0, 80, 0, 0, 1, 0)),
    (1, (4, 0, 60, 0, 70, 0, 0, 0, 0)), (1, (2, 0, 25, 0, 33, 0, 0, 0, 0)),
    (1, (35, .2, 50, 0, 0, 0, 0, 0, 0)), (1, (200, 0, 0, 0, 0, 0, 0, 0, 0)),
    (0, (2, 1, 2, 1, 3, 1, 0, 0, 0)), (0, (3, 1, 0, 0, 40, 0, 0, 0, 0)),
    (0, (1, 1, 70, 0, 1, 1, 0, 0, 0)), (0, (25, .8, 30, 0, 2, 1, 0, 0, 0)),
    (0, (18, .6, 2, 1, 20, .7, 0, 0, 0)), (0, (60, .9, 4, 1, 4, 1, 0, 0, 0)),
    (0, (3, 0, 1, 1, 2, 1, 0, 0, 0)), (0, (4, 0, 3, 0, 2, 1, 0, 0, 0)),
    (0, (5, 0, 2, 1, 0, 0, 0, 0, 0)), (0, (6, .3, 4, .5, 3, 0, 0, 0, 0)),
    (1, (50, 0, 1, 1, 2, 1, 0, 0, 0)), (1, (75, .1, 3, 1, 5, 0, 0, 0, 0)),
    (1, (30, 0, 0, 0, 25, 0, 0, 0, 0)), (1, (22, .05, 15, 0, 3, 1, 0, 0, 0)),
    (1, (140, 0, 90, 0, 110, 0, 0, 0, 0)), (1, (28, 0, 8, 0, 12, .2, 0, 0, 0)),
    (1, (65, .15, 20, .1, 4, 1, 0, 0, 0)), (1, (40, 0, 120, 0, 6, .5, 0, 0, 0)),
    (1, (7, 0, 45, 0, 38, 0, 0, 0, 0)), (1, (9, 0, 33, .1, 64, 0, 0, 0, 0)),
    (0, (2, 1, 30, 0, 45, 0, 0, 0, 0)), (0, (5, 1, 65, 0, 80, 0, 0, 0, 0)),
    (0, (30, .9, 60, 0, 50, 0, 0, 0, 0)), (0, (45, .7, 2, 1, 70, 0, 0, 0, 0)),
    (0, (12, .5, 40, 0, 22, 0, 0, 0, 0)), (0, (80, .8, 100, 0, 1, 1, 0, 0, 0)),
    (0, (3, 0, 2, 1, 4, 0, 0, 0, 0)), (0, (7, 0, 4, 0, 3, 0, 0, 0, 0)),
    (0, (2, 0, 5, .5, 1, 1, 0, 0, 0)), (0, (6, 0, 0, 0, 3, 1, 0, 0, 0)),
    # long blocks with few links under a wrapper whose name says nothing (place 0), and in the article under it
    (1, (110, 0, 3, 1, 85, .02, 0, 0, 0)), (1, (85, .02, 110, 0, 4, .5, 0, 0, 0)),
    (1, (240, .01, 6, 0, 3, 1, 0, 0, 0)), (1, (95, .05, 3, 1, 130, 0, 1, 0, 1)),
    (1, (130, 0, 95, .05, 5, 1, 1, 0, 1)), (1, (180, .02, 2, 1, 4, 1, 1, 0, 1)),
]


@dataclass
class Tree:
    feature: int = -1
    cut: float = 0.0
    low: "Tree | None" = None
    high: "Tree | None" = None
    main: bool = False

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.low is None:
            return np.full(len(rows), self.main)
        goes_low = rows[:, self.feature] <= self.cut
        out = np.empty(len(rows), bool)
        out[goes_low] = self.low.predict(rows[goes_low])
        out[~goes_low] = self.high.predict(rows[~goes_low])
        return out


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 6, least: int = 2) -> Tree:
    """A binary decision tree by Gini impurity; ties go to the first feature and lowest cut."""
    node = Tree(main=bool(labels.mean() > 0.5))
    if depth == 0 or labels.min() == labels.max():
        return node
    impurity = lambda y: len(y) * 2 * y.mean() * (1 - y.mean()) if len(y) else 0.0
    best = impurity(labels) - 1e-9
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            low = rows[:, f] <= cut
            if min(low.sum(), (~low).sum()) < least:
                continue
            cost = impurity(labels[low]) + impurity(labels[~low])
            if cost < best - 1e-9:
                best, node.feature, node.cut = cost, f, float(cut)
    if node.feature >= 0:
        low = rows[:, node.feature] <= node.cut
        node.low = grow(rows[low], labels[low], depth - 1, least)
        node.high = grow(rows[~low], labels[~low], depth - 1, least)
    return node


def train(labelled=None) -> Tree:
    """The tree of a labelled table, LABELLED by default."""
    labelled = LABELLED if labelled is None else labelled
    return grow(np.array([x for _, x in labelled], float), np.array([y for y, _ in labelled], float))


def main_text(page: str, tree: Tree) -> str:
    """The page's main blocks; if names of wrappers leave none, their blocks are judged without the names.

    A page that still has none may be a short one: its blocks outside furniture of which less than
    half of the words are links, if they are two or more with SHORT_TEXT words together.
    """
    found = blocks(page)
    chosen = tree.predict(features(found))
    if not chosen.any() and any(b.wrapped for b in found):
        found = [replace(b, place=0) if b.wrapped else b for b in found]
        chosen = tree.predict(features(found))
    if not chosen.any():
        plain = np.array([b.place == 0 and 2 * b.linked < b.words for b in found], bool)
        if plain.sum() > 1 and sum(b.words for b, p in zip(found, plain) if p) >= SHORT_TEXT:
            chosen = plain
    return "\n".join(b.text for b, keep in zip(found, chosen) if keep)


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url and text of every page: its main text blocks in page order, one a line.

    A null or empty page, and one without main text, has the empty text. Rows stay as they are,
    repeated ones and null ids too. A page is read whole, in one task; nothing is shuffled.
    """
    tree = tree or train()
    rows = only(pages, "page_id", "url", "html")
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, column="html"):
            texts = [main_text(p, tree) if p else "" for p in piece.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"])

    return in_batches(rows, run, f"page_id {kind}, url string, text string")


def op2_html_text(spark, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
