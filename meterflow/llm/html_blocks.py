"""Main text of web pages: flat text blocks judged by a small decision tree.

A page is cut into blocks of text without nested structure. Of each block and of its two
neighbours the word count and link density are taken, with what the page's own markup says
about the place (menu, comment, article). A decision tree, grown once on the small labelled
table below, tells article from boilerplate.

Defined results: a null or empty page, or one without article blocks, gives an empty text;
markup that is cut off or not closed is read as far as it goes; repeated pages are read one
by one. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterflow.llm.common import column, pieces

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "set_apart", "in_article", "heading")

#: Blocks labelled by hand: the features in order, then 1 for article text.
LABELLED = np.array([
    # menus, footers and the like: set apart by the markup, of any length
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (2, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0), (3, 1.0, 2, 1.0, 9, 0.0, 1, 0, 0, 0),
    (9, 0.0, 3, 1.0, 12, 0.0, 1, 0, 0, 0), (8, 0.0, 60, 0.0, 0, 0.0, 1, 0, 0, 0), (35, 0.0, 80, 0.0, 4, 0.0, 1, 0, 0, 0),
    (60, 0.0, 1, 0.0, 45, 0.0, 1, 0, 0, 0), (120, 0.0, 2, 0.0, 30, 0.0, 1, 0, 0, 0), (4, 0.0, 120, 0.0, 25, 0.0, 1, 0, 1, 0),
    # the same inside an article: adverts, comments, related links
    (12, 0.0, 70, 0.0, 90, 0.0, 1, 1, 0, 0), (40, 0.0, 90, 0.0, 30, 0.0, 1, 1, 0, 0), (150, 0.0, 4, 0.0, 60, 0.0, 1, 1, 0, 0),
    (3, 1.0, 80, 0.0, 4, 1.0, 1, 1, 0, 0), (5, 0.0, 80, 0.0, 30, 0.0, 1, 1, 1, 0), (2, 0.0, 40, 0.0, 1, 0.0, 1, 1, 0, 0),
    # article text, in an element that says so: long, short, with some links, headings
    (80, 0.0, 9, 0.0, 60, 0.0, 0, 1, 0, 1), (45, 0.05, 80, 0.0, 30, 0.0, 0, 1, 0, 1), (1, 0.0, 60, 0.0, 90, 0.0, 0, 1, 0, 1),
    (2, 0.0, 1, 0.0, 1, 0.0, 0, 1, 0, 1), (6, 0.0, 9, 0.0, 80, 0.0, 0, 1, 1, 1), (9, 0.0, 3, 1.0, 50, 0.0, 0, 1, 1, 1),
    (200, 0.02, 6, 0.0, 0, 0.0, 0, 1, 0, 1), (25, 0.3, 50, 0.0, 60, 0.1, 0, 1, 0, 1), (12, 0.2, 40, 0.1, 15, 0.0, 0, 1, 0, 1),
    (14, 0.5, 60, 0.0, 70, 0.0, 0, 1, 0, 1), (4, 0.0, 0, 0.0, 4, 0.0, 0, 1, 0, 1), (60, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
    (3, 0.6, 70, 0.0, 80, 0.0, 0, 1, 0, 1), (1, 1.0, 60, 0.0, 60, 0.0, 0, 1, 0, 1), (8, 0.0, 12, 0.0, 6, 1.0, 0, 1, 0, 1),
    # no such element: long blocks with few links are article text
    (70, 0.0, 5, 0.0, 90, 0.0, 0, 0, 0, 1), (40, 0.05, 60, 0.0, 50, 0.0, 0, 0, 0, 1), (30, 0.1, 45, 0.0, 20, 0.1, 0, 0, 0, 1),
    (25, 0.0, 30, 0.0, 0, 0.0, 0, 0, 0, 1), (110, 0.2, 2, 1.0, 6, 0.0, 0, 0, 0, 1), (22, 0.0, 8, 0.0, 28, 0.0, 0, 0, 0, 1),
    # and short ones beside long ones too, headings before long ones
    (7, 0.0, 40, 0.0, 55, 0.0, 0, 0, 0, 1), (3, 0.0, 60, 0.0, 45, 0.0, 0, 0, 0, 1), (10, 0.0, 70, 0.0, 35, 0.0, 0, 0, 0, 1),
    (6, 0.0, 2, 1.0, 60, 0.0, 0, 0, 1, 1), (8, 0.0, 40, 0.0, 50, 0.0, 0, 0, 1, 1), (5, 0.0, 3, 0.0, 80, 0.0, 0, 0, 1, 1),
    # short blocks among short ones, and blocks of links, are not
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), (1, 1.0, 60, 0.0, 1, 1.0, 0, 0, 0, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0),
    (5, 0.0, 2, 0.0, 4, 0.0, 0, 0, 0, 0), (6, 0.9, 30, 0.0, 5, 1.0, 0, 0, 0, 0), (30, 0.9, 4, 1.0, 3, 1.0, 0, 0, 0, 0),
    (45, 0.7, 6, 0.8, 7, 0.9, 0, 0, 0, 0), (3, 0.0, 0, 0.0, 4, 1.0, 0, 0, 1, 0), (8, 0.0, 3, 1.0, 2, 0.0, 0, 0, 0, 0),
    (9, 0.0, 50, 0.0, 0, 0.0, 0, 0, 0, 0), (7, 0.3, 45, 0.0, 3, 1.0, 0, 0, 0, 0), (5, 1.0, 40, 0.0, 50, 0.0, 0, 0, 0, 0),
], dtype=float)


def grow(rows: np.ndarray, depth: int = 8, least: int = 1) -> tuple:
    """A decision tree by Gini impurity: (feature, threshold, low side, high side) or a share."""
    y = rows[:, -1]
    if depth == 0 or len(rows) < 2 * least or len(set(y)) < 2:
        return (float(y.mean()),)
    best = None
    for j in range(rows.shape[1] - 1):
        values = np.unique(rows[:, j])
        for cut in (values[:-1] + values[1:]) / 2:
            low = y[rows[:, j] <= cut]
            high = y[rows[:, j] > cut]
            if min(len(low), len(high)) >= least:
                impurity = sum(len(s) * s.mean() * (1 - s.mean()) for s in (low, high))
                if best is None or impurity < best[0] - 1e-12:
                    best = impurity, j, cut
    if best is None or best[0] >= len(y) * y.mean() * (1 - y.mean()) - 1e-12:
        return (float(y.mean()),)
    _, j, cut = best
    side = rows[:, j] <= cut
    return j, float(cut), grow(rows[side], depth - 1, least), grow(rows[~side], depth - 1, least)


def chance(tree: tuple, block: tuple) -> float:
    while len(tree) > 1:
        tree = tree[2] if block[tree[0]] <= tree[1] else tree[3]
    return tree[0]


_BREAKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul video audio canvas object".split())
#: Elements that are remembered while open; the others need not be closed to be understood.
_HELD = frozenset(
    "address article aside blockquote button center details dialog div dl fieldset figure footer form header main menu nav "
    "noscript ol section select span table td ul h1 h2 h3 h4 h5 h6 p".split())
_RAW = frozenset("script style title textarea template svg math noframes xmp iframe object canvas video audio noscript".split())
_APART = frozenset("nav footer aside form menu dialog button select fieldset".split())
_HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_APART_HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|adverts?|advert[a-z]*|banner|sponsor[a-z]*|promo[a-z]*|side-?bar|cookies?|consent|gdpr|notice|alert|"
    r"comments?|disqus|repl(?:y|ies)|respond|nav|navbar|navigation|menu|footer|masthead|breadcrumbs?|share|sharing|social|"
    r"related|recommend[a-z]*|newsletter|subscribe|signup|login|popup|modal|overlay|widget|toolbar|pagination|pager|tags|"
    r"copyright|disclaimer|skip|search)(?:$|[\s_-])")
_ARTICLE_HINT = re.compile(
    r"(?:^|[\s_-])(?:article|article-?body|post|post-?body|entry|entry-?content|story|main|main-?content|content|body-?text)(?:$|[\s_-])")
#: Names that tell of the layout around an element, not of what it is; hints that wrappers of
#: whole pages bear too, and names of an article's own body, which are told apart from them.
_LAYOUT_NAME = re.compile(r"(?:^|(?<=\s))(?:[a-z0-9]+[_-])?(?:has|with|without|no)[_-]\S+")
_LAYOUT_HINT = re.compile(r"(?:^|[\s_-])(?:side-?bar|widget|nav|navbar|navigation|menu|search|toolbar|social|share|sharing)(?=$|[\s_-])")
_BODY_HINT = re.compile(r"(?:^|[\s_-])(?:(?:article|post|entry|story)-?(?:body|content)|main-?content|body-?text)(?:$|[\s_-])")
#: How firmly a place is set apart: by a layout hint, by another hint, by what it is.
_LAYOUT, _HINTED, _FIRM = 1, 2, 3
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?>(?:"[^"]*"|'[^']*'|[^'">])*)|[^>]*)(?:>|\Z)""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/]|$))""", re.IGNORECASE)


def _place(name: str, attributes: str, inside: bool) -> tuple[int, bool, int]:
    """How firmly an element sets its content apart, whether it holds an article, and up to
    which mark of the elements around it that ends theirs."""
    apart, article = _FIRM * (name in _APART or (name == "header" and not inside)), name in ("article", "main")
    ends = _HINTED if name == "main" else _LAYOUT if article else 0
    if attributes and not attributes.isspace():
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                value = _LAYOUT_NAME.sub("", value).strip()
                body = _BODY_HINT.search(value) and name not in _HEADS
                other = _LAYOUT_HINT.sub(" ", value)
                if _APART_HINT.search(other) or (value in ("header", "site-header", "page-header") and not inside):
                    apart = max(apart, _HINTED)
                elif _APART_HINT.search(value) and not (body and "widget" in value):
                    apart = max(apart, _LAYOUT)
                elif _ARTICLE_HINT.search(value) and name not in _HEADS:
                    article, ends = True, max(ends, _LAYOUT if body else 0)
            elif key == "role":
                apart, article = max(apart, _FIRM * (value in _ROLES)), article or value in ("main", "article")
                ends = max(ends, {"main": _HINTED, "article": _LAYOUT}.get(value, 0))
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
                apart = _FIRM
    return apart, article and not apart, 0 if apart else ends


def blocks(page: str) -> list[tuple[str, float, bool, bool, bool]]:
    """Text, link density, set apart, in an article and heading, of each block in order."""
    out: list[tuple[str, float, bool, bool, bool]] = []
    text: list[str] = []
    words_linked = 0
    held: list[tuple[str, int, bool, bool]] = []
    apart, article, heading, link = 0, False, False, False
    at, n = 0, len(page)
    lower = None

    def add(part: str) -> None:
        nonlocal words_linked
        if "&" in part:
            part = html.unescape(part)
        text.append(part)
        if link:
            words_linked += len(part.split())

    def close() -> None:
        nonlocal words_linked
        if text:
            words = "".join(text).split()
            text.clear()
            if words:
                out.append((" ".join(words), min(1.0, words_linked / len(words)), apart > 0, article, heading))
        words_linked = 0

    while at < n:
        m = _MARKUP.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>"))
            continue
        name, ends = m[2].lower(), bool(m[1])
        if name in _RAW and not ends:
            if name in _BREAKS or name in ("title", "script", "style"):
                close()
            if not m[3].endswith("/") or name not in ("svg", "math"):
                lower = page.lower() if lower is None else lower
                lower = lower if len(lower) == n else re.sub("[A-Z]+", lambda x: x[0].lower(), page)
                stop = lower.find(f"</{name}", at)
                at = n if stop < 0 else stop
            continue
        if name == "br":
            text.append(" ")
            continue
        if name == "a":
            link = not ends
            continue
        if name in _BREAKS:
            close()
        if name not in _HELD or name in _VOID:
            continue
        if ends:
            place = next((i for i in range(len(held) - 1, -1, -1) if held[i][0] == name), None)
            if place is None:
                continue
            close() if name in _BREAKS else None
            _, apart, article, heading = held[place]
            del held[place:]
            link = link and name not in _BREAKS
        else:
            if held and held[-1][0] == "p" and name in _BREAKS:
                _, apart, article, heading = held.pop()
            a, b, over = _place(name, m[3], article)
            if (a or b) and name == "span":
                close()
            held.append((name, apart, article, heading))
            if 0 < apart <= over:  # a main part is the article; else word counts and links decide
                apart, article = 0, over == _HINTED
            else:
                apart, article = max(apart, a), article or b
            heading = heading or name in _HEADS
    close()
    return out


def main_text(page: str | None, tree: tuple) -> str:
    """Blocks that the tree takes for article text, a blank line between them."""
    found = blocks(page or "")
    size = [len(b[0].split()) for b in found]
    rows = []
    for i, b in enumerate(found):
        before = (size[i - 1], found[i - 1][1]) if i else (0, 0.0)
        after = (size[i + 1], found[i + 1][1]) if i + 1 < len(found) else (0, 0.0)
        rows.append((size[i], b[1], *before, *after, b[2], b[3], b[4]))
    return "\n\n".join(b[0] for b, row in zip(found, rows, strict=True) if chance(tree, row) >= 0.5)


def extract(pages: DataFrame, labelled: np.ndarray = LABELLED) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    tree = grow(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "html"):
            texts = [main_text(p, tree) for p in column(part, "html").to_pylist()]
            yield pa.record_batch(
                [column(part, "page_id"), column(part, "url"), pa.array(texts, type=pa.string()), pa.array(map(len, texts), type=pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
