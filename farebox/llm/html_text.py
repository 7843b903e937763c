"""The main text of web pages: flat blocks classified by a decision tree."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from farebox.llm.common import column, slices

# Elements whose content is no text of the page, and where that content ends.
SKIPPED = {
    name: re.compile(rf"</{name}\s*>", re.IGNORECASE)
    for name in (
        "script style noscript template iframe object svg textarea select title".split()
    )
}
OPENING = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
STOP = re.compile(r"[<>\"']")
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu "
    "nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
# Elements that are remembered until they end.
CONTAINERS = set(
    "article aside body button center dialog div fieldset figure footer form header html main menu "
    "nav ol section table ul".split()
)
ARTICLE = {"article", "main"}
BOILERPLATE = set("aside button dialog footer form header menu nav".split())
# Whose classes and ids are about the whole page or article.
WHOLE = {"html", "body"} | ARTICLE
# Words in classes and ids that tell such parts where the element does not.
MARKERS = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer header masthead menu nav navbar navigation "
    "newsletter notice pagination popup promo promoted promotion related replies search share "
    "sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
# Words that say what shape a part has, or where it is, beside a marker.
SHAPES = set(
    "aside area bar block bottom box btn button card center column container content cta item inline "
    "inner js label large left link links list main mobile module outer overlay panel placeholder "
    "post posts articles article primary right row rss section secondary site slot small sticky "
    "story stories text title top under unit wrap wrapper page global has is in of the no native "
    "form global head html id leaderboard rectangle sticky tags skyscraper".split()
)
# Elements that hold text of their own. In an article only markers of what is not the
# article's own make them foreign: a paragraph called menu is one of a recipe.
TEXTS = set("blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
ALIEN = set(
    "ad ads adv advert adverts advertisement advertising breadcrumb breadcrumbs consent cookie "
    "cookies disqus newsletter pagination promo promoted promotion share sharing social sponsor "
    "sponsored subscribe toolbar".split()
)


@dataclass
class Block:
    """A run of text between block boundaries."""

    text: str
    words: int
    linked: int
    # 1 inside an article, -1 in a part that is none, 0 elsewhere.
    place: int
    # The outermost part outside articles that a marker made one, by its place in the page.
    marked: int | None = None

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


@dataclass
class Token:
    """A part of a page that is no text: a tag, a comment, or an element that is left out."""

    start: int
    end: int
    # Empty but for tags.
    name: str = ""
    leaving: bool = False
    attributes: str = ""
    # An element that is left out parts the text around it.
    parts: bool = False


def tokens(page: str) -> Iterator[Token]:
    """The tokens of a page in order, in one pass.

    A tag ends at the first > outside quotes, a broken one at the next < outside them or at
    the end of the page; a quote that nothing closes is no quote. Comments, declarations and
    elements that are left out reach to their end, or to the end of the page. Nothing is
    looked at twice, but for a search for each kind of quote that finds none any more.
    """
    unclosed = {"'": False, '"': False}

    def tag_end(at: int) -> int:
        while (stop := STOP.search(page, at)) is not None:
            char, at = stop[0], stop.end()
            if char == ">":
                return at
            if char == "<":
                return at - 1
            close = -1 if unclosed[char] else page.find(char, at)
            if close >= 0:
                at = close + 1
            else:
                unclosed[char] = True
        return len(page)

    def until(end: re.Match | None) -> int:
        return end.end() if end else len(page)

    at = 0
    while (match := OPENING.search(page, at)) is not None:
        start = match.start()
        if match[2] is None:
            mark = "-->" if match[0] == "<!--" else ">"
            found = page.find(mark, match.end())
            at = found + len(mark) if found >= 0 else len(page)
            yield Token(start, at)
            continue
        at = tag_end(match.end())
        name, leaving = match[2].lower(), bool(match[1])
        closed = page[at - 1] == ">"
        attributes = page[match.end() : at - closed]
        if name in SKIPPED and not leaving and closed:
            if not (name == "svg" and attributes.endswith("/")):
                at = until(SKIPPED[name].search(page, at))
            yield Token(start, at, parts=name != "svg" or not attributes.endswith("/"))
        else:
            yield Token(start, at, name, leaving, attributes)


def _marks(names: str) -> set[str]:
    """The markers among class names: those that say nothing else of what the part holds."""
    found = set()
    for name in names.split():
        words = re.findall(r"[a-z]+", name)
        if all(word in MARKERS or word in SHAPES for word in words):
            found.update(MARKERS.intersection(words))
    return found


def _place(name: str, attributes: str, around: int, ignored: bool = False) -> int:
    """Where the content of an element is, given where the element is."""
    if around < 0:
        return around
    if ignored or name in WHOLE:
        attributes = ""
    named = " ".join(filter(None, (part for m in NAMED.findall(attributes) for part in m)))
    marks = _marks(named.lower()) if named else set()
    if around > 0:
        # The heading of an article is part of it.
        marks = marks - {"header"}
        if name in TEXTS:
            marks &= ALIEN
        return -1 if marks or name in BOILERPLATE - {"header"} else around
    if marks or name in BOILERPLATE:
        return -1
    return 1 if name in ARTICLE else 0


def blocks(page: str, ignored: frozenset[int] = frozenset()) -> list[Block]:
    """The blocks of a page in order, those without a word left out.

    Character references are decoded and runs of white space become one space. Tags
    may be missing or cut off. Markers of the tags that begin at ``ignored`` do not count.
    """
    out: list[Block] = []
    stack: list[tuple[str, int, int | None]] = []
    open_names: dict[str, int] = {}
    pieces: list[str] = []
    linked = 0
    in_link = False
    place = own = 0
    marked: int | None = None
    own_marked: int | None = None

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            decoded = html.unescape(raw) if "&" in raw else raw
            pieces.append(decoded)
            if in_link:
                linked += len(decoded.split())

    def close() -> None:
        nonlocal linked
        words = "".join(pieces).split()
        if words:
            out.append(Block(" ".join(words), len(words), min(linked, len(words)), own, own_marked))
        pieces.clear()
        linked = 0

    end = 0
    for token in tokens(page):
        text(page[end : token.start])
        end = token.end
        name, leaving = token.name, token.leaving
        if not name:
            if token.parts:
                close()
            continue
        if name == "a":
            in_link = not leaving
        elif name == "br":
            pieces.append(" ")
        elif name in BLOCKS:
            close()
            in_link = False
            if not leaving:
                inner = _place(name, token.attributes, place, token.start in ignored)
                by_marker = inner < 0 == place and name not in BOILERPLATE
                own_marked = token.start if by_marker else marked
                if name in CONTAINERS:
                    stack.append((name, place, marked))
                    open_names[name] = open_names.get(name, 0) + 1
                    place, marked = inner, own_marked
                own = inner
            else:
                if open_names.get(name):
                    while True:
                        top, place, marked = stack.pop()
                        open_names[top] -= 1
                        if top == name:
                            break
                own, own_marked = place, marked
    text(page[end:])
    close()
    return out


def table(found: list[Block]) -> np.ndarray:
    """The features of each block: its own, and its neighbours' words and link densities."""
    words = np.array([0, *(b.words for b in found), 0], float)
    density = np.array([0, *(b.density for b in found), 0], float)
    inside = np.array([b.place for b in found], float)
    has_article = np.full(len(found), float((inside > 0).any()))
    return np.stack(
        [inside, has_article, words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:],
         density[2:]],
        axis=1,
    )


# Hand-labelled blocks: place, page has an article, words and link density of the block, of
# the one before, of the one after; and whether it is main text.
LABELLED = np.array(
    [
        # Inside an article: headings, long and short paragraphs, beside anything.
        (1, 1, 8, 0, 3, 1, 60, 0, 1), (1, 1, 60, 0, 8, 0, 70, 0, 1), (1, 1, 1, 0, 50, 0, 40, 0, 1),
        (1, 1, 2, 0, 0, 0, 1, 0, 1), (1, 1, 300, 0.02, 40, 0, 12, 0.4, 1), (1, 1, 3, 0, 1, 1, 9, 0, 1),
        (1, 1, 25, 0.3, 80, 0, 90, 0.1, 1), (1, 1, 12, 0, 90, 0, 14, 0.2, 1), (1, 1, 6, 0.5, 40, 0, 33, 0, 1),
        (1, 1, 9, 1, 70, 0, 80, 0, 1), (1, 1, 1, 0, 1, 1, 1, 1, 1), (1, 1, 40, 0, 1, 1, 0, 0, 1),
        # Menus, headers, footers, sidebars, adverts, notices, forms and comments.
        (-1, 1, 1, 1, 1, 1, 1, 1, 0), (-1, 1, 1, 1, 0, 0, 1, 1, 0), (-1, 1, 9, 0, 1, 1, 8, 0, 0),
        (-1, 1, 14, 0, 60, 0, 0, 0, 0), (-1, 1, 80, 0, 90, 0, 30, 0, 0), (-1, 1, 5, 0.6, 20, 0, 4, 1, 0),
        (-1, 0, 1, 1, 1, 1, 1, 1, 0), (-1, 0, 12, 0, 1, 1, 60, 0, 0), (-1, 0, 90, 0, 70, 0, 80, 0, 0),
        (-1, 0, 20, 0.1, 90, 0, 0, 0, 0), (-1, 1, 200, 0, 1, 1, 90, 0, 0), (-1, 0, 3, 0, 0, 0, 3, 0, 0),
        # However much they look like text.
        (-1, 0, 40, 0, 50, 0, 60, 0, 0), (-1, 0, 60, 0, 8, 0, 70, 0, 0), (-1, 0, 30, 0, 2, 1, 40, 0, 0),
        (-1, 0, 18, 0, 60, 0, 50, 0.1, 0), (-1, 0, 7, 0, 2, 1, 60, 0, 0), (-1, 0, 120, 0.2, 3, 1, 3, 1, 0),
        (-1, 0, 22, 0, 0, 0, 0, 0, 0), (-1, 0, 9, 0, 45, 0, 2, 1, 0), (-1, 0, 6, 0, 60, 0, 55, 0, 0),
        (-1, 1, 40, 0, 50, 0, 60, 0, 0), (-1, 1, 25, 0, 40, 0, 35, 0, 0), (-1, 1, 16, 0.2, 20, 0, 18, 0, 0),
        (-1, 1, 45, 0, 60, 0, 0, 0, 0), (-1, 1, 10, 0, 80, 0, 0, 0, 0), (-1, 1, 7, 0, 1, 1, 9, 0, 0),
        (-1, 1, 12, 0, 200, 0, 0, 0, 0), (-1, 1, 30, 0.1, 2, 0, 0, 0, 0), (-1, 1, 8, 0, 30, 0, 45, 0, 0),
        # Beside an article.
        (0, 1, 60, 0, 8, 0, 70, 0, 0), (0, 1, 18, 0, 60, 0, 50, 0.1, 0), (0, 1, 7, 0, 2, 1, 60, 0, 0),
        (0, 1, 22, 0, 0, 0, 0, 0, 0), (0, 1, 6, 0, 60, 0, 55, 0, 0), (0, 1, 120, 0, 40, 0, 3, 1, 0),
        (0, 1, 30, 0, 2, 1, 40, 0, 0), (0, 1, 9, 0, 45, 0, 2, 1, 0), (0, 1, 25, 0.3, 40, 0, 35, 0, 0),
        (0, 1, 3, 0, 0, 0, 1, 1, 0), (0, 1, 12, 0, 1, 1, 8, 0, 0), (0, 1, 40, 0.2, 90, 0, 10, 0.1, 0),
        (0, 1, 5, 0.8, 4, 1, 4, 1, 0), (0, 1, 90, 0, 60, 0, 0, 0, 0), (0, 1, 1, 0, 1, 1, 1, 1, 0),
        # Pages without marked-up articles: by words and links alone.
        (0, 0, 2, 1, 2, 1, 2, 1, 0), (0, 0, 1, 1, 0, 0, 1, 1, 0), (0, 0, 4, 0.9, 3, 1, 50, 0, 0),
        (0, 0, 5, 0.5, 2, 1, 3, 1, 0), (0, 0, 10, 0.8, 60, 0, 8, 0.9, 0), (0, 0, 30, 0.7, 10, 0.9, 12, 0.8, 0),
        (0, 0, 4, 0, 2, 1, 2, 1, 0), (0, 0, 5, 0, 3, 1, 0, 0, 0), (0, 0, 6, 0, 3, 0, 2, 1, 0),
        (0, 0, 8, 0, 0, 0, 3, 1, 0), (0, 0, 12, 0.6, 30, 0, 20, 0, 0), (0, 0, 3, 0, 2, 1, 2, 1, 0),
        (0, 0, 2, 0, 1, 1, 1, 1, 0), (0, 0, 8, 0, 3, 1, 2, 1, 0), (0, 0, 7, 0, 1, 1, 0, 0, 0),
        (0, 0, 60, 0, 8, 0, 70, 0, 1), (0, 0, 45, 0.1, 50, 0, 6, 1, 1), (0, 0, 30, 0, 2, 1, 40, 0, 1),
        (0, 0, 18, 0, 60, 0, 50, 0.1, 1), (0, 0, 6, 0, 60, 0, 55, 0, 1), (0, 0, 3, 0, 40, 0, 90, 0, 1),
        (0, 0, 7, 0, 2, 1, 60, 0, 1), (0, 0, 120, 0.2, 3, 1, 3, 1, 1), (0, 0, 25, 0.3, 40, 0, 35, 0, 1),
        (0, 0, 22, 0, 0, 0, 0, 0, 1), (0, 0, 9, 0, 45, 0, 2, 1, 1), (0, 0, 200, 0, 0, 0, 0, 0, 1),
        (0, 0, 8, 0, 0, 0, 40, 0, 1), (0, 0, 16, 0.2, 20, 0, 18, 0, 1),
        # Short lines among lines without links: speech, lists, verse, headings, last words.
        (0, 0, 1, 0, 6, 0, 5, 0, 1), (0, 0, 2, 0, 12, 0, 10, 0, 1), (0, 0, 2, 0, 3, 0, 2, 0, 1),
        (0, 0, 3, 0, 9, 0, 0, 0, 1), (0, 0, 2, 0, 21, 0, 0, 0, 1), (0, 0, 5, 0, 0, 0, 12, 0, 1),
        (0, 0, 8, 0, 4, 0, 3, 0, 1), (0, 0, 4, 0, 7, 0, 0, 0, 1), (0, 0, 6, 0, 2, 0, 8, 0, 1),
        (0, 0, 1, 0, 1, 0, 1, 0, 1), (0, 0, 7, 0, 4, 0, 0, 0, 1), (0, 0, 3, 0, 0, 0, 4, 0, 1),
        # A heading after a menu, and the last line before one.
        (0, 0, 5, 0, 2, 1, 12, 0, 1), (0, 0, 4, 0, 3, 1, 25, 0, 1), (0, 0, 3, 0, 20, 0, 2, 1, 1),
        (0, 0, 8, 0, 12, 0, 1, 1, 1), (0, 0, 2, 0, 14, 0, 4, 1, 1),
        # Paragraphs before links.
        (0, 0, 16, 0, 5, 0, 2, 1, 1), (0, 0, 25, 0, 3, 0, 1, 1, 1), (0, 0, 40, 0, 6, 0, 2, 1, 1),
        (0, 0, 60, 0, 1, 1, 2, 1, 1), (0, 0, 18, 0, 8, 0, 3, 1, 1), (0, 0, 14, 0, 4, 0, 1, 1, 1),
        (0, 0, 30, 0, 0, 0, 2, 1, 1), (0, 0, 12, 0, 2, 0, 1, 1, 1), (0, 0, 22, 0, 3, 1, 4, 1, 1),
    ]
)


def grow(rows: np.ndarray, labels: np.ndarray):
    """A decision tree: a verdict, or (feature, limit, tree up to it, tree above).

    Splits lessen Gini impurity most, until the rows of a leaf agree; of equal splits
    the first feature and lowest limit are taken. Leaves that cannot be split go by
    their majority, ties against the text.
    """
    share = labels.mean()
    if share in (0, 1):
        return bool(share)
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for limit in (values[:-1] + values[1:]) / 2:
            low = rows[:, feature] <= limit
            cost = sum(
                part.sum() * labels[part].mean() * (1 - labels[part].mean()) for part in (low, ~low)
            )
            if best is None or cost < best[0] - 1e-12:
                best = (cost, feature, limit, low)
    if best is None:
        return bool(share > 0.5)
    _, feature, limit, low = best
    return feature, limit, grow(rows[low], labels[low]), grow(rows[~low], labels[~low])


def judge(tree, rows: np.ndarray) -> np.ndarray:
    """The verdict of the tree on each row."""
    if isinstance(tree, bool):
        return np.full(len(rows), tree)
    feature, limit, below, above = tree
    low = rows[:, feature] <= limit
    out = np.zeros(len(rows), bool)
    out[low] = judge(below, rows[low])
    out[~low] = judge(above, rows[~low])
    return out


def main_text(page: str, tree) -> str:
    """The blocks that the tree takes for main text.

    Where there is none, the marked part with most words is taken for a wrapper of the
    page: its own markers are ignored, and those of the parts in it count. So are
    further ones while they hold most of the page's words.
    """
    found = blocks(page)
    if not found:
        return ""
    kept = judge(tree, table(found))
    ignored: frozenset[int] = frozenset()
    while not kept.any():
        sizes: dict[int, int] = {}
        for block in found:
            if block.marked is not None:
                sizes[block.marked] = sizes.get(block.marked, 0) + block.words
        largest = max(sizes, key=sizes.get, default=None)
        if largest is None or ignored and 2 * sizes[largest] <= sum(b.words for b in found):
            break
        ignored |= {largest}
        found = blocks(page, ignored)
        kept = judge(tree, table(found))
    return "\n".join(block.text for block, good in zip(found, kept, strict=True) if good)


def extracted(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    labelled: np.ndarray = LABELLED,
) -> DataFrame:
    """(id, url, text, n_chars) of every page.

    Blocks that the tree takes for main text are joined by line breaks. Null and empty
    pages, and pages without main text, have an empty text. Repeated rows, rows without
    an id or url, and pages of any length are worked on alike.
    """
    tree = grow(labelled[:, :-1], labelled[:, -1])
    rows = pages.select(
        column(pages, id_column).alias("id"),
        column(pages, url_column).alias("url"),
        column(pages, html_column).cast("string").alias("html"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(page.as_py() or "", tree) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                ["id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long"
    return rows.mapInArrow(work, schema).toDF(id_column, url_column, "text", "n_chars")
