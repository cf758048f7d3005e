"""Main text of web pages from flat text blocks.

A page becomes a flat list of text blocks with their word counts and link
densities; each block is seen together with the block before and after it, and
with the kind of container it stands in. A decision tree, trained here on the
small labelled table below, says which blocks are the article.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare

# --- blocks -----------------------------------------------------------------

# Quotes only delimit after "="; a tag in which they do not end goes to the next ">".
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<([/!?]?)([a-zA-Z\[][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)|[^>])*+)>"""
                  r"""|<([/!?]?)([a-zA-Z\[][^\s/>]*)([^>]*)>?""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NOT_SHOWN = re.compile(r"(?:\A|;)\s*display\s*:\s*none\b")
_PARTS = re.compile(r"[a-z]+")

#: Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template head title textarea select option button svg math iframe "
                   "object canvas audio video".split())

#: Of these, the ones whose content is not parsed for tags.
RAW = frozenset("script style textarea title iframe noscript".split())

#: Elements that begin and end a block.
BREAKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre "
                   "section summary table tbody td tfoot th thead tr ul".split())

#: Elements and words in class, id or role that mark what is not the article.
AROUND = frozenset("nav footer aside form menu dialog".split())
AROUND_WORDS = frozenset("ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments "
                         "complementary consent contentinfo cookie cookies copyright disclaimer disqus footer gdpr "
                         "login masthead menu menubar modal nav navbar navigation newsletter notice notices pager "
                         "pagination popup promo promotion related replies reply respond search share sharing sidebar "
                         "signup skip social sponsor sponsored subscribe tags toolbar widget widgets".split())
WITHIN = frozenset("article main".split())
WITHIN_WORDS = frozenset("article main story post entry".split())

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


@dataclass
class Block:
    text: str
    words: int
    linked: int
    place: int  # 1 in an article, 0 unknown, -1 in a part around it
    heading: bool

    @property
    def links(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _place(name: str, attributes: str, outer: int) -> int:
    """Where an element's content stands, given where the element stands."""
    if outer < 0:
        return -1
    found: dict[str, str] = {}
    for key, value in _ATTRIBUTE.findall(attributes.lower()):
        found.setdefault(key, value[1:-1] if value[:1] in ("'", '"') and value[-1:] == value[:1] else value)
    if (found.get("hidden", "false") != "false" or found.get("aria-hidden") == "true"
            or _NOT_SHOWN.search(found.get("style", ""))):
        return -1
    if name in AROUND or name == "header" and outer < 1:
        return -1
    if name in ("body", "html"):
        return outer
    around = within = weak = part = False
    for word in " ".join(found.get(k, "") for k in ("class", "id", "role")).split():
        parts = set(_PARTS.findall(word))
        around |= bool(parts) and parts <= AROUND_WORDS  # the whole name says so
        within |= word in WITHIN_WORDS
        weak |= not parts.isdisjoint(AROUND_WORDS)
        part |= not parts.isdisjoint(WITHIN_WORDS)
    if name in WITHIN:
        within = within or not weak
    if around or within:
        return int(within) - int(around)
    if weak:
        return 0  # has-sidebar is no sidebar: words and links decide
    return 1 if part else outer


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; unclosed and crossed tags are closed at
    the end of the element around them."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []  # open elements and their place
    text: list[str] = []
    linked: list[str] = []
    silent = links = 0
    heading = False

    def flush() -> None:
        nonlocal heading
        words = html.unescape("".join(text)).split()
        if words:
            n = len(html.unescape("".join(linked)).split())
            out.append(Block(" ".join(words), len(words), min(n, len(words)), stack[-1][1] if stack else 0, heading))
        text.clear()
        linked.clear()
        heading = False

    def say(piece: str) -> None:
        if piece and not silent:
            text.append(piece)
            if links:
                linked.append(piece)

    at = 0
    while m := _TAG.search(page, at):
        say(page[at:m.start()])
        at = m.end()
        kind, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name or kind in ("!", "?"):
            continue
        name = name.lower()
        if not m[0].endswith(">"):
            break  # the page ends within a tag
        if name in BREAKS:
            flush()
        elif name == "br":
            say(" ")
        if kind == "/":
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                for gone, _ in stack[depth:]:
                    silent -= gone in SILENT
                    links -= gone == "a"
                del stack[depth:]
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        if name == "a" and links:  # links do not nest
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "a":
                    del stack[i]
                    links -= 1
                    break
        stack.append((name, _place(name, attributes, stack[-1][1] if stack else 0)))
        heading = heading or name in ("h1", "h2", "h3", "h4", "h5", "h6")
        silent += name in SILENT
        links += name == "a"
        if name in RAW:
            end = re.compile(rf"</{name}", re.I).search(page, at)
            at = end.start() if end else len(page)
        if name == "p" and len(stack) > 1 and stack[-2][0] == "p":
            del stack[-2]  # a paragraph ends where the next begins
    else:
        say(page[at:])
    flush()
    return out


# --- decision tree ----------------------------------------------------------

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "place", "heading"]

#: Labelled blocks: the features above, and 1 for a block of the article. Link
#: densities are in percent here.
LABELLED = [
    # paragraphs and headings in an article, long and short, also beside other parts
    (120, 0, 8, 0, 90, 0, 1, 0, 1), (60, 2, 120, 0, 45, 0, 1, 0, 1), (3, 0, 80, 0, 60, 0, 1, 0, 1),
    (1, 0, 40, 0, 40, 0, 1, 0, 1), (2, 0, 0, 0, 200, 0, 1, 1, 1), (10, 0, 6, 100, 30, 0, 1, 1, 1),
    (9, 0, 8, 0, 150, 0, 1, 1, 1), (45, 10, 9, 0, 12, 0, 1, 0, 1), (12, 50, 40, 5, 40, 0, 1, 0, 1),
    (4, 100, 30, 0, 25, 0, 1, 0, 1), (6, 0, 10, 0, 7, 0, 1, 0, 1), (300, 1, 5, 0, 6, 100, 1, 0, 1),
    (7, 0, 0, 0, 0, 0, 1, 0, 1), (20, 30, 20, 30, 20, 30, 1, 0, 1), (15, 0, 25, 0, 9, 0, 1, 0, 1),
    # parts around an article, whatever their length
    (1, 100, 0, 0, 1, 100, -1, 0, 0), (1, 100, 1, 100, 1, 100, -1, 0, 0), (2, 100, 1, 100, 12, 0, -1, 0, 0),
    (12, 0, 2, 100, 10, 0, -1, 0, 0), (40, 0, 1, 100, 9, 0, -1, 0, 0), (15, 0, 60, 0, 0, 0, -1, 0, 0),
    (8, 0, 90, 0, 0, 0, -1, 0, 0), (80, 0, 5, 0, 70, 0, -1, 0, 0), (150, 2, 100, 0, 90, 0, -1, 0, 0),
    (3, 0, 40, 0, 40, 0, -1, 1, 0), (5, 0, 12, 0, 80, 0, -1, 1, 0), (30, 20, 6, 50, 30, 20, -1, 0, 0),
    (25, 0, 0, 0, 0, 0, -1, 0, 0), (60, 0, 120, 0, 15, 0, -1, 0, 0), (6, 100, 120, 0, 6, 100, -1, 0, 0),
    # pages without marked parts: running text is long and has few links
    (80, 0, 8, 0, 70, 0, 0, 0, 1), (40, 5, 80, 0, 60, 0, 0, 0, 1), (25, 0, 60, 0, 30, 5, 0, 0, 1),
    (18, 0, 40, 0, 55, 0, 0, 0, 1), (120, 10, 3, 100, 2, 100, 0, 0, 1), (30, 20, 50, 0, 40, 0, 0, 0, 1),
    (16, 0, 30, 0, 20, 0, 0, 0, 1), (200, 0, 0, 0, 0, 0, 0, 0, 1), (35, 0, 12, 0, 3, 100, 0, 0, 1),
    (6, 0, 45, 0, 50, 0, 0, 0, 1), (4, 0, 60, 0, 35, 0, 0, 0, 1), (9, 0, 30, 0, 80, 5, 0, 0, 1),
    (7, 0, 2, 100, 60, 0, 0, 1, 1), (8, 0, 5, 0, 90, 0, 0, 1, 1), (5, 0, 40, 0, 40, 0, 0, 1, 1),
    (1, 100, 0, 0, 1, 100, 0, 0, 0), (2, 100, 3, 100, 2, 100, 0, 0, 0), (5, 100, 4, 100, 40, 0, 0, 0, 0),
    (30, 90, 10, 100, 12, 80, 0, 0, 0), (12, 60, 80, 0, 10, 70, 0, 0, 0), (3, 0, 0, 0, 2, 100, 0, 0, 0),
    (4, 0, 2, 100, 3, 0, 0, 0, 0), (9, 0, 60, 0, 0, 0, 0, 0, 0), (5, 0, 6, 100, 5, 100, 0, 0, 0),
    (8, 0, 3, 0, 4, 0, 0, 0, 0), (6, 40, 5, 0, 3, 100, 0, 0, 0), (20, 55, 15, 60, 20, 50, 0, 0, 0),
    (3, 0, 10, 100, 8, 100, 0, 1, 0), (2, 0, 3, 100, 4, 100, 0, 1, 0), (7, 0, 4, 0, 5, 0, 0, 0, 0),
]
# Blocks of the same shapes in a marked article are the article, and in a part
# around it they are not, whatever they look like.
LABELLED += [(*row[:6], place, row[7], int(place > 0)) for place in (1, -1) for row in LABELLED if row[6] == 0]


@dataclass
class Node:
    feature: int = -1
    threshold: float = 0.0
    low: Node | None = None
    high: Node | None = None
    article: bool = False


def train(rows=None, depth: int = 6) -> Node:
    """A tree by the least Gini impurity; ties go to the earlier feature and the
    lower threshold."""
    table = np.array(LABELLED if rows is None else rows, dtype=float)
    x, y = table[:, :-1].copy(), table[:, -1]
    x[:, [1, 3, 5]] /= 100
    return _grow(x, y, depth)


def _grow(x: np.ndarray, y: np.ndarray, depth: int) -> Node:
    if depth == 0 or y.min() == y.max():
        return Node(article=bool(y.mean() >= 0.5))
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            low = x[:, f] <= cut
            impurity = sum(s.size * 2 * s.mean() * (1 - s.mean()) for s in (y[low], y[~low]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, cut, low)
    if best is None:
        return Node(article=bool(y.mean() >= 0.5))
    _, f, cut, low = best
    return Node(f, float(cut), _grow(x[low], y[low], depth - 1), _grow(x[~low], y[~low], depth - 1))


def is_article(tree: Node, row: list[float]) -> bool:
    while tree.feature >= 0:
        tree = tree.low if row[tree.feature] <= tree.threshold else tree.high
    return tree.article


def main_text(page: str, tree: Node) -> str:
    """The article's blocks in page order, one on a line."""
    found = blocks(page)
    edge = Block("", 0, 0, 0, False)
    out = []
    for before, b, after in zip([edge, *found], found, [*found[1:], edge], strict=False):
        row = [b.words, b.links, before.words, before.links, after.words, after.links, b.place, float(b.heading)]
        if is_article(tree, row):
            out.append(b.text)
    return "\n".join(out)


def extract_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page, from the whole html.

    Null or empty html gives an empty text; rows with a null or repeated id stay
    rows of their own; other columns are ignored. One narrow pass, no shuffle."""
    prepare(pages.sparkSession)
    tree = train()
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                        pages[html_col].alias("html"))

    def run(batches):
        for batch in batches:
            texts = [main_text(h or "", tree) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
