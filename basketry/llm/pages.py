"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into blocks of text at its block-level tags. Each block has a few
numbers: its words, its link density, those of the blocks before and behind it,
and what its enclosing elements say of themselves. A mark on what holds the
page's main text, and an article element that is but a teaser, say nothing. A decision tree, trained on
the small labelled tables below, tells article blocks from the rest.
"""

from __future__ import annotations

import html as html_
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import python_tasks

# Fixed values of HTML: elements without content, elements whose content is not
# text of the page, and elements that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template head title svg math iframe object select textarea "
    "button canvas audio video datalist".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main "
    "menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that an opening one of the same kind, or of the second list, closes.
CLOSED_BY = {
    "p": BLOCKS - {"br"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
AROUND = frozenset("nav header footer aside form menu dialog figure".split())
BODY = frozenset("article main".split())
# Words of class, id and role names that mark what is no article.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|header|footer|"
    r"side-?bar|widget\w*|comments?|disqus|respon[sd]\w*|cookies?|consent|notice\w*|alert|popup|"
    r"modal|overlay|newsletter|subscri\w*|share|sharing|social|related|recommend\w*|"
    r"breadcrumbs?|pagination|pager|login|sign-?up|search|toolbar|masthead|"
    r"contentinfo|complementary|navigation)(?:$|[\s_-])",
    re.I,
)
_NAMES = re.compile(
    r"""(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(\bhidden\b)""", re.I
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden|(?:^|\s)hidden(?:$|\s|=)", re.I)
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)>|[^<]+|<""",
    re.S,
)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

FEATURES = (
    "words", "links", "words_before", "links_before", "words_behind", "links_behind",
    "around", "marked", "in_body", "page_has_body", "heading", "list_item",
)

#: Labelled contexts: link density in hundredths, around, marked, in_body,
#: page_has_body, heading, list_item; then 1 for a block of the article. Their
#: label holds at any size of the block and its neighbours.
CONTEXTS = (
    # the article's paragraphs, headings and lists
    (0, 0, 0, 1, 1, 0, 0, 1),
    (10, 0, 0, 1, 1, 0, 0, 1),
    (45, 0, 0, 1, 1, 0, 0, 1),
    (0, 0, 0, 1, 1, 1, 0, 1),
    (100, 0, 0, 1, 1, 1, 0, 1),
    (0, 0, 0, 1, 1, 0, 1, 1),
    (45, 0, 0, 1, 1, 0, 1, 1),
    # link lists within it
    (100, 0, 0, 1, 1, 0, 0, 0),
    (85, 0, 0, 1, 1, 0, 0, 0),
    (100, 0, 0, 1, 1, 0, 1, 0),
    # side bars and forms within it, adverts, notices and comments within it
    (0, 1, 0, 1, 1, 0, 0, 0),
    (0, 1, 0, 1, 1, 1, 0, 0),
    (30, 1, 0, 1, 1, 0, 1, 0),
    (0, 0, 1, 1, 1, 0, 0, 0),
    (0, 0, 1, 1, 1, 1, 0, 0),
    (30, 0, 1, 1, 1, 0, 1, 0),
    # outside the article of a page that has one
    (0, 0, 0, 0, 1, 1, 0, 0),
    (100, 0, 0, 0, 1, 0, 1, 0),
    (0, 1, 0, 0, 1, 0, 0, 0),
    (100, 1, 0, 0, 1, 0, 1, 0),
    (0, 0, 1, 0, 1, 0, 0, 0),
    # side bars and marked blocks in a teaser's article
    (0, 1, 0, 1, 0, 0, 0, 0),
    (0, 0, 1, 1, 0, 0, 0, 0),
    # menus, footers and marked blocks of a page that names no article
    (0, 1, 0, 0, 0, 0, 0, 0),
    (0, 1, 0, 0, 0, 1, 0, 0),
    (100, 1, 0, 0, 0, 0, 1, 0),
    (0, 0, 1, 0, 0, 0, 0, 0),
    (0, 0, 1, 0, 0, 1, 0, 0),
    (100, 0, 1, 0, 0, 0, 1, 0),
    (85, 0, 0, 0, 0, 0, 0, 0),
    (100, 0, 0, 0, 0, 0, 1, 0),
)
#: Plain blocks of a page that names no article, where sizes decide: words,
#: then words and link density of the block before and of the one behind, label.
PLAIN = (
    (60, 0, 0, 0, 0, 1),
    (60, 2, 100, 2, 100, 1),
    (60, 60, 0, 60, 0, 1),
    (15, 60, 0, 2, 100, 1),
    (15, 2, 100, 60, 0, 1),
    (15, 15, 0, 15, 0, 1),
    (15, 0, 0, 0, 0, 1),
    (4, 60, 0, 60, 0, 1),
    (4, 15, 0, 60, 0, 1),
    (4, 60, 0, 15, 0, 1),
    (1, 60, 0, 60, 0, 1),
    (4, 2, 100, 60, 0, 1),
    (4, 60, 0, 2, 100, 1),
    (4, 60, 0, 0, 0, 1),
    (4, 2, 100, 15, 0, 0),
    (4, 2, 100, 2, 100, 0),
    (4, 0, 0, 2, 100, 0),
    (1, 2, 100, 2, 100, 0),
    (1, 60, 0, 0, 0, 0),
    (1, 0, 0, 2, 100, 0),
)
#: Blocks outside the article of a page that has one, and blocks of a teaser's
#: article: the least words to be one of the main text if both neighbours are
#: text of 15 words or more, and if not. Both flags, then these.
BY_SIZE = (
    (0, 1, 60, 120),
    (1, 0, 15, 60),
)
_SIZES = (1, 4, 15, 60, 120)
_NEIGHBOURS = ((0, 0), (2, 100), (15, 0), (60, 0))
#: A body element holds the article if it has this share of the plain text outside.
BODY_SHARE = 0.25
#: A mark is of a wrapper if it holds so many times the unmarked text, and so many
#: words if it encloses neither an article nor a first heading.
WRAPPER_TIMES, WRAPPER_WORDS = 4, 100


def labelled_table() -> list[tuple]:
    """Rows of FEATURES and the label: contexts at every size, and blocks told by size."""
    rows = [
        (words, links, *before, *behind, *rest)
        for first, *rest in CONTEXTS
        # what encloses a block tells at any link density that it is no article's
        for links in ({first, 0, 30, 100} if not rest[-1] and (rest[:2] != [0, 0] or rest[2] < rest[3]) else {first})
        for words in _SIZES
        for before in _NEIGHBOURS
        for behind in _NEIGHBOURS
    ]
    for in_body, has_body, amid, alone in BY_SIZE:
        for words in _SIZES:
            for before in _NEIGHBOURS:
                for behind in _NEIGHBOURS:
                    least = amid if min(before[0], behind[0]) >= 15 else alone
                    rows += [
                        (words, links, *before, *behind, 0, 0, in_body, has_body, *kind, int(links < 50 and words >= least))
                        for links in (0, 30, 100)
                        for kind in (((0, 0), (1, 0), (0, 1)) if in_body else ((0, 0),))
                    ]
    for words, wb, lb, wa, la, label in PLAIN:
        rows += [(words, links, wb, lb, wa, la, 0, 0, 0, 0, h, 0, label) for links in (0, 30) for h in (0, 1)]
    return rows


@dataclass
class Node:
    """A leaf if it has no feature; else goes low where the feature <= cut."""

    label: int
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


def train(table: list[tuple] | None = None, depth: int = 16) -> Node:
    """A classification tree by Gini impurity."""
    data = np.array(table or labelled_table(), float)

    def grow(rows: np.ndarray, left: int) -> Node:
        labels = rows[:, -1]
        node = Node(int(labels.mean() >= 0.5))
        if left == 0 or labels.min() == labels.max():
            return node
        best = (np.inf, 0, 0.0)
        for f in range(rows.shape[1] - 1):
            values = np.unique(rows[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                side = rows[:, f] <= cut
                impurity = sum(
                    s.sum() * labels[s].mean() * (1 - labels[s].mean()) for s in (side, ~side)
                )
                best = min(best, (impurity, f, cut))
        if best[0] < np.inf:
            _, node.feature, node.cut = best
            side = rows[:, node.feature] <= node.cut
            node.low, node.high = grow(rows[side], left - 1), grow(rows[~side], left - 1)
        return node

    return grow(data, depth)


def classify(tree: Node, values: tuple) -> int:
    while tree.feature >= 0:
        tree = tree.low if values[tree.feature] <= tree.cut else tree.high
    return tree.label


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0  # letters within links
    around: bool = False
    marked: bool = False
    in_body: bool = False
    heading: bool = False
    list_item: bool = False
    text: str = ""
    marks: tuple[int, ...] = ()  # numbers of the marked elements around it
    body: int = 0  # number of the outermost article or main


def _marks(attributes: str) -> bool:
    if not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    return any(
        MARKED.search(_CAMEL.sub("-", next(g for g in m.groups() if g is not None)))
        for m in _NAMES.finditer(attributes)
        if not m[4]
    )


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order, with what encloses them."""
    found: list[Block] = []
    open_: list[tuple[str, bool, tuple[int, ...], int]] = []  # name, around, marks, body
    seen = 0
    leading: set[int] = set()  # marks around an article, main or first heading
    hidden: set[int] = set()
    now = Block()
    links = 0

    def end() -> None:
        nonlocal now
        now.text = " ".join(html_.unescape("".join(now.parts)).split())
        if now.text:
            found.append(now)
        _, around, marks, body = open_[-1] if open_ else ("", False, (), 0)
        now = Block(around=around, marked=bool(marks), in_body=bool(body), marks=marks, body=body)
        names = [name for name, *_ in open_[-4:]]
        now.heading = any(n in ("h1", "h2", "h3", "h4", "h5", "h6") for n in names)
        now.list_item = "li" in names

    at = 0
    while at < len(page):
        token = _TOKEN.match(page, at)
        at = token.end()
        name = token[2]
        if name is None:
            text = token[0]
            if not text.startswith(("<!", "<?")):
                now.parts.append(text)
                if links:
                    now.linked += len(text)
            continue
        name = name.lower()
        if token[1]:
            for depth in range(len(open_) - 1, -1, -1):
                if open_[depth][0] == name:
                    if any(n in BLOCKS for n, *_ in open_[depth:]):
                        del open_[depth:]
                        end()
                    else:
                        del open_[depth:]
                    break
            links = sum(n == "a" for n, *_ in open_)
            continue
        if name in SILENT:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if close:
                at = close.end()
                continue
            if name not in ("head", "button", "noscript", "object", "svg", "select"):
                break  # what follows is all its content
            continue
        if name in BLOCKS:
            while open_ and (open_[-1][0] not in BLOCKS and open_[-1][0] != "a"):
                open_.pop()  # an inline element that was never closed ends here
            while open_ and name in CLOSED_BY.get(open_[-1][0], ()):
                open_.pop()
        if name not in VOID and not token[3].endswith("/"):
            _, around, marks, body = open_[-1] if open_ else ("", False, (), 0)
            seen += 1
            top = name in ("html", "body", *BODY)
            if not top and _marks(token[3]):
                marks = (*marks, seen)
                if _HIDDEN.search(token[3]):
                    hidden.add(seen)
            if not around and (name == "h1" or name in BODY):
                leading.update(marks)
            open_.append(
                (
                    name,
                    around or (name in AROUND and name != "figure" and not (body and name == "header")),
                    marks,
                    body or (seen if name in BODY else 0),
                )
            )
            links += name == "a"
        if name in BLOCKS:
            end()
    end()
    _unmark(found, leading, hidden)
    return found


def _plain(found: list[Block]) -> list[tuple[Block, int]]:
    """Blocks that are neither enclosed nor mostly links, with their words."""
    return [(b, len(b.text.split())) for b in found if not b.around and 2 * b.linked < len(b.text)]


def _unmark(found: list[Block], leading: set[int], hidden: set[int]) -> None:
    """Takes back marks of wrappers: elements that hold nearly all of the text."""
    plain = _plain(found)
    held: dict[int, int] = {}
    for block, words in plain:
        for mark in block.marks:
            held[mark] = held.get(mark, 0) + words
    rest = sum(words for b, words in plain if not b.marks)
    wrappers: set[int] = set()
    for mark in sorted(held):  # outer ones first
        whole = mark in leading or (rest == 0 and held[mark] >= WRAPPER_WORDS)
        if mark not in hidden and whole and held[mark] > WRAPPER_TIMES * rest:
            wrappers.add(mark)
            rest = sum(words for b, words in plain if wrappers.issuperset(b.marks))
    if wrappers:
        for block in found:
            block.marked = not wrappers.issuperset(block.marks)


def _has_body(found: list[Block]) -> bool:
    """Whether an unmarked article or main element holds the article."""
    inside: dict[int, int] = {}
    outside = 0
    for block, words in _plain(found):
        if not block.marked and block.body:
            inside[block.body] = inside.get(block.body, 0) + words
        elif not block.marked and words >= 15:
            outside += words
    return bool(inside) and max(inside.values()) >= BODY_SHARE * outside


def main_text(page: str | None, tree: Node) -> str:
    """The article's blocks, joined by one space; empty if there is none."""
    found = blocks(page or "")
    sizes = [(len(b.text.split()), 100 * min(1.0, b.linked / max(1, len(b.text)))) for b in found]
    has_body = _has_body(found)
    kept = []
    for i, block in enumerate(found):
        before = sizes[i - 1] if i else (0, 0)
        behind = sizes[i + 1] if i + 1 < len(found) else (0, 0)
        values = (
            *sizes[i], *before, *behind, block.around, block.marked, block.in_body,
            has_body, block.heading, block.list_item,
        )
        if classify(tree, values):
            kept.append(block.text)
    return " ".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with text, the main text of each whole page, and n_chars.

    Takes ``html``. A null or empty page, and one without an article, has an
    empty text. White space within a block becomes one space; n_chars counts
    code points. Broken or unclosed markup is read as far as it goes. An empty
    table stays empty. Columns of these names are replaced; no others matter.
    """
    python_tasks(pages.sparkSession)
    tree = train()

    @F.pandas_udf("string")
    def text(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_ in series:
            yield pd.Series([main_text(p, tree) for p in pages_], dtype=object)

    taken = pages.drop("text", "n_chars").withColumn("text", text(F.col("html").cast("string")))
    return taken.withColumn("n_chars", F.char_length("text").cast("long"))
