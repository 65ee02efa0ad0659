"""The main text of web pages: flat text blocks, told apart by a decision tree over shallow features.

A page is cut into blocks at every tag that is not inline.  A block has its number of words and its link density, those of the
blocks before and after it, whether it is a heading, and where it stands by the marks of the page: in furniture (menus, headers,
footers, sidebars, notices, adverts, forms, comments, by tag, role, class or id), inside or outside of the page's article, or in a page
without such marks.  The tree is trained, here, on the labelled blocks of ``mainblocks``; blocks that it takes for main text
are joined in page order.

A header inside of an article is the article's own.  Scripts, styles, comments and the like are no text.  Null and empty pages have
the text ''; a tag that never ends goes on to the end of the page; a ``<`` before anything but a letter, ``/``, ``!`` or ``?``
is text.  White space is what Python's ``str.split`` takes for it, no-break spaces included.  Repeated rows stay as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import give_back, sliced
from seqloom.llm.mainblocks import BLOCKS

# Elements by what they do to the text around them.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
FURNITURE_TAGS = frozenset("nav aside footer form menu dialog noscript select button template svg object audio video canvas head datalist math map".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu header masthead topbar footer sidebar aside breadcrumb breadcrumbs pagination pager "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login search form comment comments disqus reply replies respond reactions "
    "related recommended recommendations share sharing social toolbar widget widgets copyright legal disclaimer alert".split()
)
COMMENT_WORDS = frozenset("ad advert sponsored promo comment comments reply replies related recommended teaser".split())
ARTICLE_NAMES = frozenset("content article post entry story main article-body article-content post-content post-body entry-content main-content page-content story-body body-text".split())
NOT_HELD = frozenset("has with no without not is hide".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an opening tag closes, and what hides it from that.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "body": ({"head"}, set())}

_TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[/!?A-Za-z][^>]*+(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PART = re.compile(r"[a-z]+")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}


def _marks(name: str, rest: str) -> tuple[bool, int]:
    """Whether the element is furniture, and how strongly it marks the article: 3 by tag, 2 as the main part, 1 by name."""
    level = {"article": 3, "main": 2}.get(name, 0)
    furniture = name in FURNITURE_TAGS
    if furniture or not rest or rest.isspace() or name in ("html", "body"):
        return furniture, level
    held = {}
    for key, value in _ATTRIBUTE.findall(rest):
        held.setdefault(key.lower(), unescape(value.strip("\"'")))
    role = held.get("role", "").lower()
    if role in FURNITURE_ROLES or "hidden" in held:
        return True, 0
    level = max(level, {"article": 3, "main": 2}.get(role, 0), 3 if held.get("itemprop", "").lower() == "articlebody" else 0)
    names = f"{held.get('class', '')} {held.get('id', '')}".split()
    if any(n.lower().replace("_", "-") in ARTICLE_NAMES for n in names):
        level = max(level, 1)
    # Names that say article outweigh those of its parts ("post comments-open"), not those of what is no article.
    unwanted = COMMENT_WORDS if level else FURNITURE_WORDS
    for n in names:
        parts = set(_PART.findall(_CAMEL.sub("-", n).lower()))
        if not parts & NOT_HELD and (parts | {n.lower()}) & unwanted:
            return True, 0
    return False, level


def blocks(html: str) -> list[tuple[str, int, int, str, bool]]:
    """(text, words, linked words, place, heading) of each block that has a word, in page order."""
    out: list[tuple[str, int, int, bool, int, bool]] = []
    stack: list[tuple[str, bool, int]] = []
    open_names: Counter = Counter()
    state = {"furniture": 0, "link": 0, "heading": 0}
    levels = [0, 0, 0, 0]
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            words = "".join(pieces).split()
            if words:
                out.append((" ".join(words), len(words), min(linked, len(words)), state["furniture"] > 0, max((k for k in (1, 2, 3) if levels[k]), default=0), state["heading"] > 0))
            pieces.clear()
        linked = 0

    def push(name: str, furniture: bool, level: int) -> None:
        stack.append((name, furniture, level))
        open_names[name] += 1
        state["furniture"] += furniture
        state["heading"] += name in HEADINGS
        levels[level] += 1

    def pop() -> str:
        name, furniture, level = stack.pop()
        open_names[name] -= 1
        state["furniture"] -= furniture
        state["heading"] -= name in HEADINGS
        levels[level] -= 1
        return name

    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        upto = m.start() if m else size
        if upto > at:
            text = unescape(html[at:upto]) if "&" in html[at:upto] else html[at:upto]
            pieces.append(text)
            if state["link"]:
                linked += len(text.split())
        if not m:
            break
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if name in INLINE or "-" in name:
            if name == "a":
                state["link"] = 0 if m["end"] else 1
            continue
        flush()
        state["link"] = 0 if name in ("article", "main", "body") else state["link"]
        if m["end"]:
            if open_names[name]:
                while pop() != name:
                    pass
            continue
        if stack and stack[-1][0] == "p":
            pop()
        if name in CLOSES:
            closed, wall = CLOSES[name]
            if any(open_names[c] for c in closed):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in wall:
                        break
                    if stack[k][0] in closed:
                        while len(stack) > k:
                            pop()
                        break
        if name in RAW:
            end = _ENDS[name].search(html, at)
            at = end.start() if end else size
            continue
        if name in VOID or m["rest"].endswith("/") and name in ("svg", "object", "template"):
            continue
        furniture, level = _marks(name, m["rest"])
        # A header is the page's unless it stands in the article.
        push(name, furniture or name == "header" and not (levels[3] or levels[2]), level)
    flush()
    most = max((x[4] for x in out if not x[3]), default=0)

    def place(furniture: bool, level: int) -> str:
        return "furniture" if furniture else "inside" if most and level == most else "outside" if most > 1 else "plain"

    return [(text, words, links, place(furniture, level), heading) for text, words, links, furniture, level, heading in out]


#: Columns of ``features``.
NAMES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "place", "heading")
#: Where a block stands as a number: out of the article, in a page without marks, in the article.
PLACES = {"furniture": -1.0, "outside": -1.0, "plain": 0.0, "inside": 1.0}


def features(found: list[tuple[int, int, str, bool]]) -> list[tuple[float, ...]]:
    """One row for each block (words, linked words, place, heading) of a page; there is nothing before the first and after the last."""
    shallow = [(float(w), k / w if w else 0.0) for w, k, _, _ in found]
    none = (0.0, 0.0)
    return [
        (*shallow[i], *(shallow[i - 1] if i else none), *(shallow[i + 1] if i + 1 < len(found) else none), PLACES[p], float(h))
        for i, (_, _, p, h) in enumerate(found)
    ]


def labelled(table: str = BLOCKS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a table written like ``mainblocks.BLOCKS``."""
    rows, labels = [], []
    for page in table.strip().split("\n\n"):
        lines = [x.split() for x in page.splitlines()]
        rows += features([(int(w), int(k), place, head == "heading") for _, place, head, w, k in lines])
        labels += [int(x[0]) for x in lines]
    return np.array(rows), np.array(labels)


class Tree:
    """A binary decision tree: splits that lower the Gini impurity most, ties to the first feature and the lower bound."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, depth: int = 12, leaf: int = 1) -> None:
        self.share = float(labels.mean()) if len(labels) else 0.0
        self.feature = -1
        if depth == 0 or self.share in (0.0, 1.0) or len(labels) < 2 * leaf:
            return
        least = len(labels) * 2 * self.share * (1 - self.share) - 1e-9
        for f in range(rows.shape[1]):
            order = np.argsort(rows[:, f], kind="stable")
            x, ones = rows[order, f], np.cumsum(labels[order])
            n = np.arange(1, len(x))
            a, b = ones[:-1] / n, (ones[-1] - ones[:-1]) / (len(x) - n)
            impurity = 2 * (n * a * (1 - a) + (len(x) - n) * b * (1 - b))
            impurity[(x[1:] == x[:-1]) | (n < leaf) | (len(x) - n < leaf)] = np.inf
            k = int(np.argmin(impurity))
            if impurity[k] < least:
                least, self.feature, self.bound = float(impurity[k]) - 1e-9, f, float(x[k] + x[k + 1]) / 2
        if self.feature >= 0:
            low = rows[:, self.feature] <= self.bound
            self.low, self.high = Tree(rows[low], labels[low], depth - 1, leaf), Tree(rows[~low], labels[~low], depth - 1, leaf)

    def score(self, row: tuple[float, ...]) -> float:
        at = self
        while at.feature >= 0:
            at = at.low if row[at.feature] <= at.bound else at.high
        return at.share


def main_text(html: str | None, tree: Tree) -> str:
    if not html:
        return ""
    found = blocks(html)
    rows = features([x[1:] for x in found])
    return " ".join(x[0] for x, row in zip(found, rows, strict=True) if tree.score(row) > 0.5)


def extract(pages: DataFrame, tree: Tree | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for each row; nothing is shuffled."""
    tree = tree or Tree(*labelled())

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2):
            texts = [main_text(h, tree) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
        give_back()

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(kernel, "page_id long, url string, text string, n_chars long")


def query(pages: DataFrame) -> DataFrame:
    return extract(pages)
