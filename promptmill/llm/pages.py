"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page is read once, tag by tag, into a flat list of blocks: text between block-level tags, with the
part of it that is inside links.  A block's features are its words and link density, those of the
blocks before and after it, whether it is a heading or list item, and what the page says about
where it stands: inside an article or main element, inside an element for menus, headers, footers,
sidebars or forms, or inside one that its class, id or role names so, unless that would put the page's
own article outside (see ``main_text``).  A decision tree, grown from the
labelled blocks of ``EXAMPLES``, keeps a block or drops it.

Defined cases: a null or empty page, and one without a kept block, has an empty text; unclosed tags,
comments and scripts are read as browsers do (the latter two to the end); what buttons, selects,
objects, drawings, templates and noscript hold is dropped up to their own end tag or that of an
element around them, and nothing is dropped for one without an end tag; repeated rows stay; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
# Elements whose end matters: what stands between their tags is inside them.
_NESTING = frozenset("article aside body div dialog fieldset footer form header main menu nav ol section table td tr ul".split())
_CONTENT = frozenset(("article", "main"))
_OUTSIDE = frozenset("aside dialog footer form header menu nav".split())
_CONTENT_ROLES = frozenset(("main", "article"))
_OUTSIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# Words in class or id.
_CONTENT_WORDS = frozenset("article articlebody body content entry main maincontent post story text".split())
_OUTSIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disclaimer disqus feedback footer form gdpr legal login masthead menu modal nav navbar navigation newsletter notice "
    "notices pager pagination paywall popup promo promotion promoted recommended related reply replies respond responses search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
# Those that tell an article or main element to be none.
_READER_WORDS = frozenset("ad ads advert comment comments promo recommended related reply replies sponsored".split())
# Elements whose inside is no text of the page.
_DROPPED = frozenset("button noscript object select svg template".split())
_TAG = re.compile(
    r"<!--.*?(?:-->|(?P<comment>\Z))"
    r"|<(?P<raw>script|style|iframe|textarea|title)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|(?P<unended>\Z))"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[a-z/!?][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.IGNORECASE)
# What follows one of these in a class tells how a page is laid out, not what the element is.
_LAYOUT = frozenset("has no with without".split())
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

NOWHERE, INSIDE, OUTSIDE = 0, 1, 2
# What made an element outside for good: a name, a name of what readers or others wrote, being hidden.
UNNAMED, NAMED, READERS, HIDDEN = 0, 1, 2, 3


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    where: int = NOWHERE
    heading: bool = False
    item: bool = False
    #: The innermost element around it that a name, or being a form, puts outside (-1: none).
    wrapper: int = -1
    text: str = ""
    words: int = 0
    links: float = 0.0


@dataclass
class Wrapper:
    """An element that a name, or being a form, puts outside."""

    at: int  # tag position
    parent: int  # the one around it, or -1
    cause: int


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    wrappers: list[Wrapper] = field(default_factory=list)


def _names(text: str) -> set[str]:
    """The words of a class or id; of each name, those before a layout word."""
    words = set()
    for name in text.split():
        for word in map(str.lower, _NAME_PARTS.findall(name)):
            if word in _LAYOUT:
                break
            words.add(word)
    return words


def _standing(name: str, rest: str, where: int, named: int, lift: bool = False, void: bool = False) -> tuple[int, int]:
    """Where the inside of an element stands, and what made it outside for good.

    A main element, with ``lift`` also an article, is not outside for the name of an element around it;
    with ``void`` the element's own name and being a form say nothing.
    """
    if named == HIDDEN:
        return OUTSIDE, HIDDEN
    found = {}
    for key, *values, hidden in _ATTRIBUTE.findall(rest):
        found[(key or hidden).lower()] = next((v for v in values if v), "")
    style = found.get("style", "").replace(" ", "").lower()
    role = found.get("role", "").lower()
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
        return OUTSIDE, HIDDEN
    is_main, is_article = name == "main" or role == "main", name == "article" or role == "article"
    if named and not (is_main or (lift and named == NAMED and is_article)):
        return OUTSIDE, named
    if name == "body" or void:
        return where, UNNAMED  # its classes describe the whole page
    words = _names(found.get("class", "")) | _names(found.get("id", ""))
    telling = words & _OUTSIDE_WORDS & (_READER_WORDS if name in _CONTENT else _OUTSIDE_WORDS)
    if telling or role in _OUTSIDE_ROLES:
        return OUTSIDE, READERS if telling & _READER_WORDS or not telling else NAMED
    if name in _CONTENT or role in _CONTENT_ROLES or (name in ("div", "section", "td") and words & _CONTENT_WORDS):
        return INSIDE, UNNAMED
    if name in _OUTSIDE:
        # The header of an article holds its heading.
        return (INSIDE if name == "header" and where == INSIDE else OUTSIDE), UNNAMED
    return where, UNNAMED


def _dropped_spans(tags: list[re.Match]) -> dict[int, int]:
    """Where the inside of dropped elements starts and ends; one without an end tag has no inside."""
    opened: dict[str, list[int]] = {}
    spans: dict[int, int] = {}
    for tag in tags:
        name = (tag["name"] or "").lower()
        if name not in _DROPPED:
            continue
        if not tag["close"]:
            if not (name == "svg" and tag["rest"].endswith("/")):
                opened.setdefault(name, []).append(tag.end())
        elif opened.get(name):
            spans[opened[name].pop()] = tag.start()
    return spans


class _Nest:
    """Names of open elements; knows which are open without a search."""

    def __init__(self) -> None:
        self.stack: list[tuple] = []
        self.count: Counter[str] = Counter()

    def open(self, name: str, *state: object) -> None:
        self.stack.append((name, *state))
        self.count[name] += 1

    def close(self, name: str) -> tuple:
        """Closes the innermost element of that name, and those in it; what was noted when it was opened."""
        while True:
            last, *state = self.stack.pop()
            self.count[last] -= 1
            if last == name:
                return tuple(state)


def read_page(page: str | None, lift: bool = False, void: frozenset[int] = frozenset()) -> Page:
    """All blocks of a page that have text; elements at the positions ``void`` are not judged by name."""
    page = page or ""
    result = Page()
    found, wrappers = result.blocks, result.wrappers
    nest, inner = _Nest(), _Nest()
    where, named, heading, item, in_link = NOWHERE, UNNAMED, False, False, False
    wrapped, holds = -1, True
    block = Block()

    def close() -> None:
        nonlocal block
        block.text = " ".join("".join(block.parts).split())
        if block.text:
            block.words = len(block.text.split())
            block.links = len("".join("".join(block.linked).split())) / len(block.text.replace(" ", ""))
            found.append(block)
        block = Block(where=where, heading=heading, item=item, wrapper=wrapped)

    def add(text: str) -> None:
        if text:
            text = html.unescape(text)
            block.parts.append(text)
            if in_link:
                block.linked.append(text)

    # After the last ">" is no tag; a search for one would go to the end from every "<".
    end = page.rfind(">") + 1
    tags = list(_TAG.finditer(page, 0, end))
    spans = _dropped_spans(tags)
    at, dropped_to = 0, 0
    for tag in tags:
        if at >= dropped_to:
            add(page[at : tag.start()])
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            continue
        closing, rest = bool(tag["close"]), tag["rest"]
        if at <= dropped_to:
            if name in _NESTING and not closing:
                inner.open(name)
            elif inner.count[name]:
                inner.close(name)
            elif closing and name in _NESTING and nest.count[name]:
                dropped_to = 0  # the end of an element around the dropped one
            if dropped_to:
                continue
        elif at in spans:
            dropped_to, inner = spans[at], _Nest()
        if name == "a":
            in_link = not closing and bool(rest)
        elif name == "br":
            add(" ")
        if name not in _BLOCK:
            continue
        if closing:
            if name in _NESTING and nest.count[name]:
                where, named, wrapped, holds = nest.close(name)
            heading, item = False, False if name in ("li", "ul", "ol", "menu") else item
        else:
            if name in _NESTING:
                nest.open(name, where, named, wrapped, holds)
                where, named = _standing(name, rest, where, named, lift, tag.start() in void)
                form = name == "form" and where == OUTSIDE and not named
                if where != OUTSIDE or named == HIDDEN:
                    wrapped, holds = -1, True
                elif wrapped < 0 and (named or form):
                    wrappers.append(Wrapper(tag.start(), -1, named or NAMED))
                    wrapped = len(wrappers) - 1
                elif wrapped >= 0 and holds:
                    # What it would be if those around it said nothing.
                    alone, cause = _standing(name, rest, NOWHERE, UNNAMED, lift)
                    if alone == OUTSIDE and (cause or name == "form"):
                        wrappers.append(Wrapper(tag.start(), wrapped, cause or NAMED))
                        wrapped = len(wrappers) - 1
                    holds = alone == NOWHERE or (alone == OUTSIDE and wrappers[wrapped].at == tag.start())
            heading = len(name) == 2 and name[0] == "h" and name[1].isdigit()
            item = name == "li" or (item and name not in _NESTING)
        in_link = in_link and name not in _NESTING
        close()
        if not closing and name not in _NESTING and rest:
            # A paragraph or list item may be named on its own.
            block.where = _standing(name, rest, where, named)[0]
    if not tags or (tags[-1]["comment"] is None and tags[-1]["unended"] is None):
        add(page[at:].partition("<!--")[0])
    close()
    return result


# One labelled block a line: where it stands (0 nowhere special, 1 inside, 2 outside), whether the page
# has an inside at all, heading, list item, words and link density of the block, of the one
# before and of the one after (0 words: none), and 1 for main text.
EXAMPLES = """
1 1 0 0 60 0.0 8 0.0 70 0.0 1
1 1 1 0 8 0.0 1 1.0 12 0.0 1
1 1 1 0 10 0.0 9 0.0 1 0.0 1
1 1 0 0 1 0.0 90 0.0 80 0.0 1
1 1 0 0 2 0.0 12 0.0 0 0.0 1
1 1 0 0 120 0.1 40 0.0 9 0.3 1
1 1 0 0 30 0.4 50 0.0 60 0.0 1
1 1 0 0 3 1.0 40 0.0 60 0.0 1
1 1 0 0 6 1.0 80 0.0 7 0.0 1
1 1 0 1 7 0.0 30 0.0 8 0.0 1
1 1 0 1 9 0.2 8 0.0 11 0.0 1
1 1 0 1 2 0.0 6 0.0 3 0.0 1
1 1 0 1 12 0.0 10 0.0 40 0.1 1
1 1 0 0 5 0.0 4 0.0 6 0.0 1
1 1 0 0 200 0.0 0 0.0 0 0.0 1
1 1 0 0 1 0.0 0 0.0 0 0.0 1
1 1 0 1 3 1.0 2 1.0 4 1.0 0
1 1 0 1 2 1.0 30 0.0 3 1.0 0
1 1 0 1 5 1.0 4 1.0 50 0.0 0
1 1 0 1 4 0.9 6 1.0 2 0.9 0
2 1 0 1 1 1.0 0 0.0 1 1.0 0
2 1 0 1 1 1.0 1 1.0 8 0.0 0
2 1 0 0 9 0.0 1 1.0 10 0.0 0
2 1 0 0 40 0.0 50 0.0 60 0.0 0
2 1 0 0 120 0.0 6 0.0 90 0.0 0
2 1 1 0 3 0.0 80 0.0 20 0.0 0
2 1 0 0 12 0.1 70 0.0 0 0.0 0
2 1 0 0 1 0.0 2 0.0 3 0.0 0
2 0 0 0 30 0.0 40 0.0 10 0.0 0
2 0 0 0 8 0.5 60 0.0 0 0.0 0
2 0 1 0 2 0.0 5 0.0 25 0.0 0
2 0 0 1 2 1.0 2 1.0 2 1.0 0
2 0 0 0 100 0.0 70 0.0 80 0.0 0
0 1 0 0 9 0.0 1 1.0 12 0.0 0
0 1 0 0 40 0.0 10 0.0 60 0.0 0
0 1 0 0 90 0.0 60 0.0 70 0.0 0
0 1 1 0 5 0.0 70 0.0 20 0.0 0
0 1 0 1 3 1.0 3 1.0 3 1.0 0
0 1 0 0 2 0.5 80 0.0 0 0.0 0
0 0 0 0 60 0.0 7 0.0 70 0.0 1
0 0 0 0 45 0.1 50 0.0 3 1.0 1
0 0 0 0 25 0.0 5 0.9 40 0.0 1
0 0 0 0 21 0.0 20 0.0 1 1.0 1
0 0 0 0 18 0.0 40 0.0 3 1.0 1
0 0 0 0 35 0.0 2 1.0 2 1.0 1
0 0 0 0 16 0.1 3 1.0 30 0.0 1
0 0 0 0 22 0.2 30 0.0 24 0.0 1
0 0 1 0 8 0.0 2 1.0 50 0.0 1
0 0 1 0 3 0.0 45 0.0 60 0.0 1
0 0 0 0 6 0.0 60 0.0 70 0.0 1
0 0 0 0 3 0.0 80 0.0 35 0.0 1
0 0 0 0 9 0.0 40 0.0 30 0.1 1
0 0 0 1 10 0.0 30 0.0 12 0.0 1
0 0 0 0 80 0.0 0 0.0 0 0.0 1
0 0 0 0 4 0.0 0 0.0 0 0.0 1
0 0 0 0 1 0.0 0 0.0 0 0.0 1
0 0 0 0 12 0.0 0 0.0 25 0.0 1
0 0 0 1 2 1.0 2 1.0 2 1.0 0
0 0 0 1 1 1.0 0 0.0 1 1.0 0
0 0 0 0 4 1.0 3 1.0 60 0.0 0
0 0 0 0 30 0.9 10 1.0 40 0.0 0
0 0 0 0 25 0.7 4 0.5 12 0.8 0
0 0 0 0 5 0.0 2 1.0 3 1.0 0
0 0 0 0 7 0.3 60 0.0 0 0.0 0
0 0 0 0 6 0.0 3 0.6 4 1.0 0
0 0 0 0 3 0.0 4 1.0 8 0.5 0
0 0 1 0 2 0.0 40 0.0 2 1.0 0
0 0 1 0 2 0.0 3 1.0 3 1.0 0
0 0 0 0 9 0.5 8 0.6 5 0.5 0
"""


@dataclass
class Tree:
    """A binary decision tree in arrays; leaves have feature -1."""

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    high: list[int] = field(default_factory=list)
    keep: list[bool] = field(default_factory=list)

    def decide(self, row: tuple[float, ...]) -> bool:
        node = 0
        while self.feature[node] >= 0:
            node = self.low[node] if row[self.feature[node]] <= self.cut[node] else self.high[node]
        return self.keep[node]


def grow(examples: str = EXAMPLES) -> Tree:
    """A tree whose splits lower the Gini impurity most, until its leaves are pure."""
    table = np.array([list(map(float, line.split())) for line in examples.strip().splitlines()])
    tree = Tree()

    def add(rows: np.ndarray) -> int:
        node = len(tree.feature)
        labels = table[rows, -1]
        for column, value in zip((tree.feature, tree.cut, tree.low, tree.high), (-1, 0.0, -1, -1)):
            column.append(value)
        tree.keep.append(bool(labels.mean() >= 0.5))
        best = None
        if labels.min() != labels.max():
            for f in range(table.shape[1] - 1):
                values = np.unique(table[rows, f])
                for cut in (values[:-1] + values[1:]) / 2:
                    left = table[rows, f] <= cut
                    impurity = sum(s.size * s.mean() * (1 - s.mean()) for s in (labels[left], labels[~left]))
                    if best is None or impurity < best[0] - 1e-12:
                        best = impurity, f, cut, left
        if best is not None:
            _, tree.feature[node], tree.cut[node], left = best
            tree.low[node] = add(rows[left])
            tree.high[node] = add(rows[~left])
        return node

    add(np.arange(len(table)))
    return tree


def _kept(found: list[Block], tree: Tree) -> list[str]:
    inside = any(b.where == INSIDE for b in found)
    sizes = [(0, 0.0), *((b.words, b.links) for b in found), (0, 0.0)]
    return [
        b.text
        for i, b in enumerate(found, 1)
        if tree.decide((b.where, inside, b.heading, b.item, *sizes[i], *sizes[i - 1], *sizes[i + 1]))
    ]


#: A wrapper with that part of the page's unlinked words outside the wrappers in it is judged before these.
_OWN_WORDS = 0.125


def _misnamed(page: Page, kept: bool, readers: bool) -> list[int]:
    """The wrappers to judge by their blocks: those that hold most of the page's unlinked words.

    They are nested; the list ends with the first that has words of its own, and before the first one
    of what readers or others wrote unless ``readers`` says that such a one was judged already.  That may
    be most of a page; it counts only where nothing else is kept.
    """
    wrappers = page.wrappers
    own = [0.0] * len(wrappers)
    total = 0.0
    for b in page.blocks:
        unlinked = b.words * (1 - b.links)
        total += unlinked
        if b.wrapper >= 0:
            own[b.wrapper] += unlinked
    held = own[:]
    for i in range(len(wrappers) - 1, -1, -1):
        if wrappers[i].parent >= 0:
            held[wrappers[i].parent] += held[i]
    chosen: list[int] = []
    for i, wrapper in enumerate(wrappers):
        if wrapper.parent != (chosen[-1] if chosen else -1) or 2 * held[i] <= total:
            continue
        if wrapper.cause == READERS and (kept or (chosen and not readers)):
            break
        readers = readers or wrapper.cause == READERS
        chosen.append(i)
        if own[i] >= _OWN_WORDS * total:
            break
    return chosen


def main_text(page: str | None, tree: Tree) -> str:
    """The kept blocks of a page, one a line.

    Names of elements may mislead.  On a page without an inside, an article within a named element is
    one; if there is still none, elements that are outside by name, or forms, and hold most of the
    page's unlinked words are judged by their blocks.  Nested ones are judged together, up to one with
    words of its own, so a page is read a bounded number of times, however deep they nest.
    """
    read = read_page(page)
    lift, void, readers = False, frozenset(), False
    while read.wrappers and not any(b.where == INSIDE for b in read.blocks):
        if not lift:
            lift = True
        else:
            chosen = [read.wrappers[i] for i in _misnamed(read, bool(_kept(read.blocks, tree)), readers)]
            if not chosen:
                break
            void |= {w.at for w in chosen}
            readers = readers or any(w.cause == READERS for w in chosen)
        read = read_page(page, lift, void)
    return "\n".join(_kept(read.blocks, tree))


def main_texts(pages: DataFrame) -> DataFrame:
    """Rows page_id, url, text of ``pages`` (page_id, url, html)."""
    tree = grow()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                texts = [main_text(page.as_py(), tree) for page in part.column(2)]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])

    chosen = pages.select("page_id", "url", "html")
    return chosen.mapInArrow(batches, f"page_id {chosen.schema['page_id'].dataType.simpleString()}, url string, text string")
