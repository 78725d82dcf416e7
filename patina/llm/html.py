"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped first: each block element becomes a line, and what can never be main
text (menus, notices, scripts and the like) becomes empty lines, unless the text before and
after it stands in one parent or in one article. Every line has a weight, which is its
length; elements change the weight but keep no line and drop none of those left. Weights
summed over a sliding window of lines then surge where main text begins and dive where it
ends; the lines in between are kept whole.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from patina.llm.shared import ship, text_slices

WINDOW = 3  # lines of one block
SURGE = 86  # weight of a window with which main text begins
MARKED = 100  # weight that a main element adds to each of its lines
OUTSIDE = 0.125  # weight of a character outside main elements on pages that have some

# Names that HTML or common page templates give to parts of a page.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
NOT_TEXT = frozenset(
    "nav header footer aside form button select menu dialog head audio video canvas map datalist".split()
)
MAIN = frozenset(["article", "main"])
IN_PARENT = frozenset(  # blocks whose lines belong to the element around them
    "address blockquote caption center dd dir dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr li ol p pre "
    "table tbody td tfoot th thead tr ul".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
    "newsletter subscribe subscription sidebar nav navbar navigation breadcrumb breadcrumbs masthead footer comment "
    "comments disqus pagination pager".split()
)
OFTEN_BOILERPLATE = frozenset(  # inside a main element their text may still be the article's
    "banner notice notices popup modal overlay menu header reply replies respond share sharing social related "
    "recommended widget toolbar login signup search alert".split()
)
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
CLOSED_BY_SAME = {
    "li": frozenset(["ul", "ol", "menu", "dir"]),
    "dt": frozenset(["dl"]),
    "dd": frozenset(["dl"]),
    "tr": frozenset(["table"]),
    "td": frozenset(["table"]),
    "th": frozenset(["table"]),
    "option": frozenset(["select", "datalist"]),
}
SIBLINGS = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th")}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")
_ARTICLE = re.compile(r"<article[\s/>]", re.I)
# Skips: by attributes that leave a doubt, by attributes or a form, which may wrap a page, and by other elements.
DOUBT, SOFT, HARD = 0.5, 1, 2


def boilerplate(name: str, attributes: str) -> float:
    """How surely an element's name, class, id or role says that it isn't main text; 0 if it doesn't."""
    if name in NOT_TEXT:
        return SOFT if name == "form" else HARD
    if name in MAIN or name in ("body", "html") or "=" not in attributes or 'role="main"' in attributes:
        return 0
    found = 0
    for kind, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if kind.lower() == "role":
            if BOILERPLATE_ROLES.intersection(value.split()):
                return SOFT
            continue
        words = _WORDS.split(value)
        if BOILERPLATE_WORDS.intersection(words):
            return SOFT
        if OFTEN_BOILERPLATE.intersection(words):
            found = DOUBT
    return found


class Line(NamedTuple):
    """``linked`` if all of its text is in links; ``doubt`` numbers the element that may be boilerplate."""

    text: str
    main: bool = False
    linked: bool = False
    parent: int = 0
    doubt: int = 0


class _Lines:
    """Lines of a page in order."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.plain = False  # some text of the line stands outside links

    def add(self, text: str, linked: bool) -> None:
        self.parts.append(text)
        if not linked and not text.isspace():
            self.plain = True

    def end(self, main: bool, parent: int, doubt: int) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                self.lines.append(Line(text, main, not self.plain, parent, doubt))
        self.parts, self.plain = [], False

    def gap(self) -> None:
        """Empty lines, enough to make every window over them dive."""
        self.lines.extend([Line("")] * self.window)


class _Open(NamedTuple):
    """An open element and how text in it is read."""

    name: str
    skip: float
    main: bool
    parent: int
    doubt: int


def page_lines(page: str, articles: bool = False, window: int = WINDOW) -> list[Line]:
    """Strip markup.

    Gaps stand where a main element begins and ends and, outside main elements, for what is
    left out. A main element ends a skip that it inherits. With ``articles`` an article does so
    too, where the skip comes from attributes or a form and not from a menu, an aside or the like.
    """
    lines = _Lines(window)
    top = _Open("", 0, False, 0, 0)
    open_tags: list[_Open] = []
    count: Counter[str] = Counter()
    parents = doubts = 0

    def pop_to(place: int) -> None:
        nonlocal top
        for tag in open_tags[place:]:
            count[tag.name] -= 1
        was = top
        del open_tags[place:]
        top = open_tags[-1] if open_tags else _Open("", 0, False, 0, 0)
        if (was.skip and not top.skip and not top.main) or (was.main and not top.main):
            lines.end(was.main, was.parent, was.doubt)
            lines.gap()

    def close_open(names, scope) -> None:
        """Close an element that the next tag ends, unless one of ``scope`` stands between."""
        if not any(count[n] > 0 for n in names):
            return
        for k in range(len(open_tags) - 1, -1, -1):
            if open_tags[k].name in names:
                pop_to(k)
                return
            if open_tags[k].name in scope:
                return

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at and not top.skip:
            lines.add(page[at : token.start()], count["a"] > 0)
        at = token.end()
        name = (token["name"] or token["name2"] or token["raw"] or "").lower()
        if not name or token["raw"]:
            continue
        closing = bool(token["close"] or token["close2"])
        if name == "br":
            if not top.skip:
                lines.add(" ", True)
            continue
        block = name in BLOCKS
        if block:
            lines.end(top.main, top.parent, top.doubt)
        if closing:
            if count[name] > 0:
                place = len(open_tags) - 1
                while open_tags[place].name != name:
                    place -= 1
                pop_to(place)
            continue
        if name in VOID:
            continue
        if block and name != "option":
            close_open(("p",), frozenset(["table", "td", "th", "button", "caption", "object"]))
        if name in CLOSED_BY_SAME:
            close_open(SIBLINGS.get(name, (name,)), CLOSED_BY_SAME[name])
        rest = token["rest"] if token["rest"] is not None else (token["rest2"] or "")
        _, skip, main, parent, doubt = top
        starts = boilerplate(name, rest)
        if starts == DOUBT:
            if main and not doubt:
                doubts += 1
                doubt = doubts
            starts = 0 if main else SOFT
        if starts and not skip:
            lines.end(main, parent, doubt)
            if not main:
                lines.gap()
        marked = name in MAIN or 'role="main"' in rest
        if marked and not main and (name != "article" or (articles and skip == SOFT)):
            skip = 0
        if block and name not in IN_PARENT:
            parents += 1
            parent = parents
        skip = max(skip, starts)
        if marked and not skip and not main:
            main = True
            lines.gap()
        top = _Open(name, skip, main, parent, doubt)
        open_tags.append(top)
        count[name] += 1
    if not top.skip:
        lines.add(page[at:], count["a"] > 0)
    lines.end(top.main, top.parent, top.doubt)
    return lines.lines


def surges(weights: list[float], window: int = WINDOW, surge: float = SURGE) -> list[tuple[int, int]]:
    """Line ranges [start, end) between a surge of the window sums and their dive to nothing."""
    found, start = [], None
    for i, weight in enumerate(weights):
        held = sum(weights[i : i + window])
        if start is None and held > surge and weight:
            start = i
        elif start is not None and not held:
            found.append((start, i))
            start = None
    if start is not None:
        found.append((start, len(weights)))
    return found


def main_text(page: str | None, window: int = WINDOW, surge: float = SURGE) -> str:
    """The blocks of a page's main text, one line each; empty if there are none.

    A line weighs its length. A main element (article, main) adds ``MARKED`` to each of its lines, so
    they surge by default, and on a page with such lines a character outside counts only
    ``OUTSIDE``. Lines outside that are all link weigh nothing. A removed element inside one
    parent's text or a main element counts as absent, and between two kept lines of a parent
    its short lines are kept. An element inside a main element whose attributes may mean
    boilerplate stays only if its own text surges at the weight of outside text. If no
    window surges, the page is so short that all of its lines are kept.

    Where the only articles stand in elements whose attributes say boilerplate, these may be
    wrappers of the page or lists of teasers: the longer of both readings is taken.
    """
    lines = page_lines(page or "", window=window)
    text = _dense_text(lines, window, surge)
    if any(line.main for line in lines) or not _ARTICLE.search(page or ""):
        return text
    inside = page_lines(page or "", articles=True, window=window)
    if not any(line.main for line in inside):
        return text
    return max(text, _dense_text(inside, window, surge), key=len)


def _dense_text(lines: list[Line], window: int, surge: float) -> str:
    """Text where windows surge."""
    lines = _without_inner_gaps(_without_doubtful(lines, window, surge))
    marks = any(line.main for line in lines)
    ranges = surges([_weight(line, marks) for line in lines], window, surge)
    if not ranges:
        return "\n".join(line.text for line in lines if line.text)
    kept = {i for start, end in ranges for i in range(start, end) if lines[i].text}
    held: dict[int, tuple[int, int]] = {}  # first and last kept line of a parent
    for i in sorted(kept):
        held[lines[i].parent] = (held.get(lines[i].parent, (i, i))[0], i)
    for i, line in enumerate(lines):
        first, last = held.get(line.parent, (i, i))
        if line.text and not line.linked and first < i < last:
            kept.add(i)
    return "\n".join(lines[i].text for i in sorted(kept))


def _weight(line: Line, marks: bool) -> float:
    if line.main:
        return len(line.text) + MARKED
    return 0 if line.linked else len(line.text) * (OUTSIDE if marks else 1)


def _without_doubtful(lines: list[Line], window: int, surge: float) -> list[Line]:
    """Lines without those of elements that may be boilerplate and whose own text doesn't surge."""
    own: dict[int, list[float]] = {}
    for line in lines:
        if line.doubt:
            own.setdefault(line.doubt, []).append(_weight(line._replace(main=False), True))
    gone = {k for k, weights in own.items() if not surges(weights, window, surge)}
    return [line for line in lines if line.doubt not in gone]


def _without_inner_gaps(lines: list[Line]) -> list[Line]:
    """Lines without the empty ones between two lines of the same parent."""
    found: list[Line] = []
    gap: list[Line] = []
    for line in lines:
        if not line.text:
            gap.append(line)
            continue
        if gap and not (found and found[-1].parent == line.parent and found[-1].main == line.main):
            found.extend(gap)
        gap = []
        found.append(line)
    return found + gap


def extract_main_text(
    pages: DataFrame, html_column: str = "html", keep: list[str] | None = None, text_column: str = "text"
) -> DataFrame:
    """Add the main text of every page to its columns ``keep`` (all but the html by default).

    Null or empty html gives empty text. Every row stays, repeated ones too; a column named
    as the text is replaced. Pages are read whole, in parts of a batch by size.
    """
    ship(pages.sparkSession)
    held = [c for c in (keep if keep is not None else pages.columns) if c not in (html_column, text_column)]
    rows = pages.select(*held, html_column)
    schema = T.StructType([*[rows.schema[c] for c in held], T.StructField(text_column, T.StringType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, html_column):
                texts = [main_text(page) for page in batch.column(html_column).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in held), pa.array(texts, pa.string())], names=[*held, text_column]
                )

    return rows.mapInArrow(extract, schema)
