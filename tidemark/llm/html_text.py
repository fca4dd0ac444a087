"""Main text of web pages from flat text blocks and a decision tree.

A page becomes a flat list of text blocks, cut at block tags. Each has its word
count and link density, those of the blocks before and after it, and what its
enclosing elements say (main content, page furniture, tell-tale class names). A
decision tree, grown from a small labelled table of pages, tells article blocks
from the rest; outside main content and furniture, link densities and word counts decide.

A class, id or role tells furniture by its first or last word (``reader-comments``, ``ad-slot``),
unless it begins with a denial or says what a container has (``no-comments``, ``has-sidebar``); words
with other everyday meanings count alone only. A main element ends what names around it said, and an
article element named as content is not furniture by its other classes. A form is furniture if it
has few words for its fields; a form around a whole page is not.

Defined cases: a null html is an empty one; a page without article blocks has the
empty text; unclosed elements end with their container or the page, and unclosed
comments, scripts and tags reach to its end; repeated rows give repeated results;
an empty table gives an empty result; other columns are ignored.

At scale: a narrow pass, one page at a time; pages never meet.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of

# Element names of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split())
RAW_TAGS = frozenset("script style noscript template iframe object svg canvas textarea noframes audio video head".split())
CLOSED_BY_NEXT = {
    "p": frozenset({"p"}), "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}), "option": frozenset({"option"}),
}
VOID_TAGS = frozenset({"hr"})
SPACE_TAGS = frozenset({"br", "wbr", "img", "input"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE_TAGS = frozenset("nav footer aside menu button select dialog label".split())
FORM_TAGS = frozenset({"form", "fieldset"})
FIELD_TAGS = frozenset("input select textarea button".split())
WORDS_PER_FIELD = 30
# Words of class, id and role attributes that name what an element holds.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices alert newsletter subscribe subscription signup popup modal overlay sidebar side widget widgets related recommended "
    "recommendations share sharing social comment comments reply replies respond disqus discussion nav navbar navigation menu "
    "breadcrumb breadcrumbs footer copyright legal login search searchbox pagination pager tags tagcloud hidden toolbar masthead "
    "topbar contentinfo complementary dialog form".split())
# those that name other things too, or stand before them: counted as a whole name only
ALONE_WORDS = frozenset("side tags alert legal form search hidden".split())
DENIALS = frozenset("has no not non with without is".split())
MAIN_WORDS = frozenset("article content main post entry story body text maincontent articlebody".split())

_MARKUP = re.compile(
    r"""<!--(?P<comment>.*?)(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^'">])*+|[^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    tag: str
    furniture: bool
    named: bool
    main: bool


def _names(attrs: str) -> tuple[bool, bool, bool]:
    """Whether class, id and role name furniture; main content; whether the element is hidden."""
    furniture = main = hidden = False
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            hidden = True
        elif key in ("class", "id", "role"):
            for name in value.split():
                f, c = _means([w.lower() for w in _NAME.findall(name)])
                furniture, main = furniture or f, main or c
    return furniture, main, hidden


def _means(words: list[str]) -> tuple[bool, bool]:
    """Whether a name tells furniture; main content."""
    if not words or words[0] in DENIALS:
        return False, False
    ends = {words[0], words[-1]} if len(words) > 1 else set()
    return words == [words[0]] and words[0] in FURNITURE_WORDS or bool(ends & (FURNITURE_WORDS - ALONE_WORDS)), any(w in MAIN_WORDS for w in words)


def _inherit(tag: str, said: tuple[bool, bool, bool], furniture: bool, named: bool, main: bool) -> tuple[bool, bool, bool]:
    """Flags of an element (in furniture, named so, in main content) from its own names and those around it."""
    called, content, hidden = said
    if tag in ("article", "main") and content:
        called = False
    if tag == "main" and not furniture:
        named = False
    main = main or tag in ("article", "main") or content
    furniture = furniture or tag in FURNITURE_TAGS or (tag == "header" and not main)
    return furniture, named or hidden or (called and tag not in ("body", "html", "main")), main


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order, white space folded, references decoded."""
    # open elements: tag, in furniture, named like furniture, in main content, number of the form around
    stack: list[tuple[str, bool, bool, bool, int]] = [("", False, False, False, 0)]
    forms = [[0, 0]]  # per form: fields, words
    out: list[Block] = []
    form_of: list[int] = []
    parts: list[tuple[str, bool]] = []
    link_from = 0  # stack depth at which a link was opened, 0: none

    def flush() -> None:
        if not parts:
            return
        text = " ".join(entities.unescape("".join(t for t, _ in parts)).split())
        if text:
            linked = sum(len(entities.unescape(t).split()) for t, inside in parts if inside)
            tag, furniture, named, main, form = stack[-1]
            form_of.append(form)
            forms[form][1] += len(text.split(" "))
            out.append(Block(text, len(text.split(" ")), linked, tag, furniture, named, main))
        parts.clear()

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            parts.append((page[at:], bool(link_from)))
            break
        if lt > at:
            parts.append((page[at:lt], bool(link_from)))
        m = _MARKUP.match(page, lt)
        if not m:  # a bare "<" is text
            parts.append(("<", bool(link_from)))
            at = lt + 1
            continue
        at = m.end()
        if m["tag"] is None:
            continue
        tag, end = m["tag"].lower(), bool(m["end"])
        if tag in FIELD_TAGS and not end:
            forms[stack[-1][4]][0] += 1
        if tag in RAW_TAGS:
            if not end and not m["attrs"].endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = stop.end() if stop else n
                if not stop and tag == "head":  # a head without end: up to the body
                    body = re.compile(r"<body\b", re.I).search(page, m.end())
                    at = body.start() if body else n
            parts.append((" ", False))
        elif tag == "a":
            link_from = 0 if end else len(stack)
        elif tag in SPACE_TAGS:
            parts.append((" ", bool(link_from)))
        elif tag in BLOCK_TAGS:
            flush()
            if end:
                depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
                if depth:
                    del stack[depth:]
            else:
                for closed in [CLOSED_BY_NEXT.get(tag)] if tag in CLOSED_BY_NEXT else [CLOSED_BY_NEXT["p"]] if stack[-1][0] == "p" else []:
                    while len(stack) > 1 and stack[-1][0] in closed:
                        stack.pop()
                if tag in ("article", "main"):  # these end a menu or head that was never closed
                    depth = next((k for k in range(1, len(stack)) if stack[k][0] in ("nav", "header")), 0)
                    if depth:
                        del stack[depth:]
                if tag not in VOID_TAGS:
                    _, *flags, form = stack[-1]
                    if tag in FORM_TAGS and not form:
                        form = len(forms)
                        forms.append([0, 0])
                    elif tag in ("article", "main"):
                        form = 0
                    said = _names(m["attrs"]) if m["attrs"] else (False, False, False)
                    if tag in FORM_TAGS:  # a form's name says no more than that it is one
                        said = (False, *said[1:])
                    stack.append((tag, *_inherit(tag, said, *flags), form))
            if link_from > len(stack):
                link_from = 0
    flush()
    for block, form in zip(out, form_of):
        fields, words = forms[form]
        block.furniture = block.furniture or (form > 0 and words < WORDS_PER_FIELD * (fields + 1))
    return out


FEATURES = ("words", "link density", "words before", "link density before", "words after", "link density after",
            "in furniture", "named furniture", "in main", "heading", "list item")


def features(page: list[Block]) -> np.ndarray:
    own = np.array([[b.words, min(b.linked / max(b.words, 1), 1.0)] for b in page], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    flags = np.array([[b.furniture, b.named, b.main, b.tag in HEADINGS, b.tag in ("li", "dt", "dd", "td", "th")] for b in page], float).reshape(-1, 5)
    return np.concatenate([own, np.concatenate([edge, own])[: len(own)], np.concatenate([own, edge])[1:], flags], 1)


# The labelled table: pages as lists of (enclosing elements, words, linked words, 1 for article blocks).
LABELLED: list[list[tuple[str, int, int, int]]] = [
    [("nav ul li", 1, 1, 0)] * 6 + [("div.ad", 9, 0, 0), ("article h1", 7, 0, 1), ("article p", 60, 0, 1), ("article p", 1, 0, 1),
     ("article p", 140, 4, 1), ("article p", 3, 0, 1), ("article p", 25, 0, 1), ("footer", 8, 0, 0)],
    [("header div", 3, 3, 0), ("nav ul li", 2, 2, 0), ("nav ul li", 1, 1, 0), ("main h1", 9, 0, 1), ("main p", 45, 2, 1), ("main ul li", 6, 0, 1),
     ("main ul li", 12, 3, 1), ("main p", 2, 0, 1), ("aside h3", 2, 0, 0), ("aside p", 40, 0, 0), ("aside ul li", 5, 5, 0), ("footer p", 14, 4, 0)],
    [("div.menu ul li", 1, 1, 0), ("div.menu ul li", 2, 2, 0), ("div h1", 5, 0, 1), ("div p", 80, 0, 1), ("div p", 55, 6, 1), ("div p", 30, 0, 1),
     ("div.comments h3", 1, 0, 0), ("div.comments p", 35, 0, 0), ("div.comments p", 60, 1, 0), ("div.footer p", 10, 3, 0)],
    [("div.cookie p", 25, 3, 0), ("div.cookie button", 1, 0, 0), ("article h1", 4, 0, 1), ("article p", 12, 0, 1), ("article blockquote", 30, 0, 1),
     ("article h2", 3, 0, 1), ("article p", 90, 1, 1), ("article section.comments p", 22, 0, 0), ("article section.comments p", 70, 0, 0), ("article aside p", 18, 0, 0)],
    [("div.content h1", 6, 0, 1), ("div.content p", 1, 0, 1), ("div.content p", 2, 0, 1), ("div.content div.share ul li", 1, 1, 0), ("div.content p", 33, 0, 1),
     ("form p", 6, 0, 0), ("form button", 1, 0, 0), ("div.sidebar p", 50, 2, 0), ("div.sidebar ul li", 4, 4, 0)],
    [("div a", 2, 2, 0), ("div a", 3, 3, 0), ("div a", 1, 1, 0), ("div h1", 8, 0, 1), ("div p", 70, 3, 1), ("div p", 48, 0, 1), ("div", 4, 4, 0), ("div", 5, 0, 0)],
    [("td", 2, 2, 0), ("td", 3, 2, 0), ("td p", 64, 1, 1), ("td p", 120, 0, 1), ("td p", 18, 0, 1), ("td p", 44, 2, 1), ("td", 6, 6, 0), ("td", 9, 3, 0)],
    [("article.notice p", 15, 0, 0), ("article h1", 3, 0, 1), ("article p", 8, 8, 1), ("article p", 5, 0, 1), ("article ul li", 4, 4, 1), ("article ul li", 7, 0, 1),
     ("div.related h3", 2, 0, 0), ("div.related ul li", 6, 6, 0), ("footer div", 3, 0, 0), ("footer ul li", 1, 1, 0)],
    [("div h2", 2, 0, 0), ("div ul li", 3, 3, 0), ("div ul li", 4, 4, 0), ("div ul li", 2, 2, 0), ("div p", 3, 0, 0), ("div ul li", 5, 5, 0)],
    [("body", 40, 0, 1), ("body", 95, 2, 1), ("p", 20, 0, 1), ("p", 60, 0, 1)],
    [("div ul li", 2, 2, 0), ("div ul li", 3, 3, 0), ("div h1", 1, 0, 1), ("div p", 58, 0, 1), ("div p", 1, 0, 1), ("div p", 66, 1, 1), ("div p", 3, 0, 1),
     ("div p", 72, 2, 1), ("div p", 2, 0, 1), ("div p", 50, 0, 1), ("div", 3, 3, 0), ("div", 4, 1, 0)],
    [("nav ul li", 1, 1, 0), ("article p", 2, 0, 1)], [("ul li", 3, 3, 0), ("main p", 9, 0, 1)], [("nav p", 4, 4, 0), ("article h1", 4, 0, 1), ("article p", 30, 1, 1)],
    [("article p", 4, 0, 1)], [("main p", 3, 0, 1), ("main aside p", 1, 0, 0), ("main p", 5, 0, 1)], [("article p", 1, 0, 1), ("div.cookie p", 3, 0, 0)],
    [("article p", 2, 0, 1), ("article p", 2, 0, 1)], [("div", 3, 0, 0), ("div ul li", 2, 2, 0), ("article p", 5, 0, 1), ("div", 3, 0, 0)],
    # nothing but densities tells the parts of these
    [("div", 14, 14, 0), ("div", 12, 11, 0), ("div p", 31, 30, 0), ("div p", 36, 2, 1), ("div p", 85, 7, 1), ("div p", 40, 1, 1), ("div p", 42, 40, 0),
     ("div", 18, 17, 0), ("div p", 60, 55, 0)],
    [("td", 22, 22, 0), ("td", 35, 31, 0), ("td", 52, 3, 1), ("td", 110, 9, 1), ("td", 38, 0, 1), ("td", 24, 24, 0), ("td", 48, 44, 0)],
    [("section p", 26, 24, 0), ("section p", 33, 33, 0), ("section h2", 6, 0, 1), ("section p", 34, 4, 1), ("section p", 27, 0, 1), ("section p", 70, 2, 1),
     ("section p", 29, 27, 0), ("section p", 65, 61, 0)],
    [("div.content-has p", 50, 2, 1), ("main.content p", 45, 0, 1), ("main.content p", 2, 0, 1), ("main.content p", 9, 9, 1), ("main.content div.comments p", 95, 0, 0)],
    [("div.newsletter p", 30, 0, 0), ("form label", 3, 0, 0), ("div.banner", 12, 2, 0), ("main h1", 10, 0, 1), ("main p", 4, 4, 1), ("main p", 200, 10, 1),
     ("main div.related p", 24, 0, 0), ("main nav ul li", 2, 2, 0), ("footer", 20, 0, 0)],
]


def labelled() -> tuple[np.ndarray, np.ndarray]:
    xs, ys = [], []
    for page in LABELLED:
        rows = []
        for path, words, linked, label in page:
            tag, furniture, named, main = "", False, False, False
            for element in path.split():
                tag, _, name = element.partition(".")
                furniture, named, main = _inherit(tag, (*_means(name.split("-") if name else []), False), furniture, named, main)
                furniture = furniture or tag in FORM_TAGS
            rows.append(Block("", words, linked, tag, furniture, named, main))
            ys.append(label)
        xs.append(features(rows))
    return np.concatenate(xs), np.array(ys)


@dataclass(frozen=True)
class Tree:
    """A node: a leaf's label, or a feature, a threshold and two subtrees (at most, above)."""

    label: int
    feature: int = -1
    threshold: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.label)
        out, under = np.empty(len(x), np.int64), x[:, self.feature] <= self.threshold
        out[under], out[~under] = self.low.predict(x[under]), self.high.predict(x[~under])
        return out


def grow(x: np.ndarray, y: np.ndarray, depth: int = 9, least: int = 1) -> Tree:
    """Gini splits; flags, being the last features, win ties for their generality."""
    label = int(2 * y.sum() >= len(y))
    if not depth or len(set(y.tolist())) < 2 or len(y) < 2 * least:
        return Tree(label)

    def impurity(part: np.ndarray) -> float:
        p = part.mean() if len(part) else 0.0
        return len(part) * 2 * p * (1 - p)

    best = (impurity(y) - 1e-9, -1, 0.0)
    for f in reversed(range(x.shape[1])):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            under = x[:, f] <= t
            if min(under.sum(), (~under).sum()) >= least and (loss := impurity(y[under]) + impurity(y[~under])) < best[0] - 1e-12:
                best = (loss, f, float(t))
    _, f, t = best
    if f < 0:
        return Tree(label)
    under = x[:, f] <= t
    return Tree(label, f, t, grow(x[under], y[under], depth - 1, least), grow(x[~under], y[~under], depth - 1, least))


def trained() -> Tree:
    return grow(*labelled())


def main_text(page: str, tree: Tree) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n\n".join(b.text for b, y in zip(found, tree.predict(features(found))) if y)


def extract(pages: DataFrame, *, id: str = "page_id", url: str = "url", html: str = "html", tree: Tree | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    model = tree or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h, model) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), text_of(html).alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
