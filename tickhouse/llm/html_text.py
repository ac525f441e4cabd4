"""Main text of web pages: flat text blocks judged by a small decision tree.

A page is cut at block-level tags into blocks of text. A block is described by
its number of words and its share of linked words, the same of the block before
and after it, and the elements around it; a decision tree trained on the table
of labelled blocks below says which blocks are the article. Elements made for
menus, forms and the like, and those made for the article, decide by themselves, and
so does a container with a class or id that names nothing but comments, a sidebar, a
notice or an advert; any other word in a class or id is a hint, and inside the article
words and links decide.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Comments, declarations and tags; possessive, so that no try goes over a page twice.
_OTHER = r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
_NAME = r"<(/?)([a-zA-Z][^\s/>]*+)"
_TAG = re.compile(
    _OTHER + "|" + _NAME + r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>", re.S)
_OPENS = re.compile("</?[a-zA-Z]")
# The same where quotes do not keep a tag open.
_LOOSE = re.compile(_OTHER + "|" + _NAME + r"([^>]*+)>", re.S)
_NAMED = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# HTML elements by what they mean for the flow of text.
RAW = frozenset("script style noscript template textarea select svg iframe object math "
                "canvas audio video title".split())
TO_THE_END = frozenset("script style textarea title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark "
    "meter nobr output picture q rp rt ruby s samp small source span strike strong sub sup "
    "time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
APART = frozenset("nav footer aside form button dialog menu head fieldset".split())
MAIN = frozenset("article main".split())
# End tags that HTML lets a page leave out: what a start tag closes, and the elements
# that it does not reach beyond.
_TABLE, _CELL = frozenset(["table"]), frozenset("caption table td th".split())
_ROW = frozenset("caption colgroup tr td th".split())
_SECTION = _ROW | frozenset("tbody thead tfoot".split())
CLOSES = {
    "tr": (_ROW, _TABLE), "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tbody": (_SECTION, _TABLE), "thead": (_SECTION, _TABLE), "tfoot": (_SECTION, _TABLE),
    "option": (frozenset(["option"]), frozenset(["datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["datalist"])),
}
CLOSES["th"] = CLOSES["td"]
ITEMS = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"])}
# Elements between an item and the next one that do not begin a list of their own.
WITHIN_ITEM = frozenset("address div p".split())
ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search "
    "section summary table ul".split())
_AROUND_P = _CELL | frozenset(["button"])
# An end tag of these does not reach beyond the elements named.
END_SCOPE = {"p": _AROUND_P, "li": _CELL | frozenset("ol ul menu".split()), "dt": _CELL | {"dl"},
             "dd": _CELL | {"dl"}, "td": _TABLE, "th": _TABLE, "tr": _TABLE}
APART_WORDS = frozenset(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion nav "
    "navbar navigation menu breadcrumb breadcrumbs sidebar side rail footer header masthead "
    "topbar comment comments respond reply replies disqus discussion cookie cookies consent "
    "notice notices alert popup modal overlay newsletter subscribe signup login search share "
    "sharing social related recommended widget toolbar pagination pager copyright legal "
    "contentinfo complementary".split())
MAIN_WORDS = frozenset("article content main post entry story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Ids in these are anchors of the text, unless they are made of such words alone.
ANCHORED = HEADINGS | frozenset(["section"])
_WORDS = re.compile(r"[a-z]+")
# Classes and ids that leave no doubt on an element that holds others.
CONTAINERS = frozenset("div section aside ol ul".split())
_CLASS_APART = re.compile(
    r"comments?|commentlist|comments?-(?:area|body|list|section|thread|wrapper)|disqus[\w-]*|respond"
    r"|replies|sidebar|sidebar-[\w-]+|(?:left|right|page|site)-sidebar|cookies?(?:-[\w-]+)?"
    r"|consent(?:-[\w-]+)?|notices?|[\w]+-notice|advert[\w-]*|ads?|ad-[\w-]+|sponsored"
    r"|newsletter(?:-[\w-]+)?")
_ID_APART = re.compile(r"comments?|comment-?list|disqus_thread|respond|replies|sidebar|newsletter")
Block = tuple[str, int, int, bool, int, bool]


def _marks(name: str, attributes: str, in_main: bool) -> tuple[bool, bool, bool]:
    """What an element says of its text: apart, perhaps apart, main."""
    words, roles, certain = set(), set(), False
    if "=" in attributes and name not in ("html", "body"):
        for m in _NAMED.finditer(attributes):
            kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            found = _WORDS.findall(value)
            if name in CONTAINERS and kind != "role":
                whole = _CLASS_APART if kind == "class" else _ID_APART
                certain = certain or any(map(whole.fullmatch, value.split()))
            if kind == "id" and name in ANCHORED and (
                    name in HEADINGS or not APART_WORDS.issuperset(found)):
                continue
            (roles if kind == "role" else words).update(found)
    main = name in MAIN or bool((words | roles) & MAIN_WORDS)
    # The header of a main element is its own.
    telling = APART_WORDS - {"header"} if main or name in HEADINGS else APART_WORDS
    free = name not in MAIN
    # What is said to be main as well, such as a sponsored post, is not certain.
    apart = name in APART or (free and bool(roles & telling)) or (certain and not main) or (
        name == "header" and not in_main)
    return apart, free and bool(words & telling), main


class _Markup:
    """The tags of a page in order. Every part of the page is searched a bounded number
    of times, however many tags are left open."""

    def __init__(self, page: str):
        self.page, self.tag = page, _TAG
        self.last = page.rfind(">")
        self.unclosed: set[str] = set()

    def after(self, at: int) -> re.Match | None:
        """The first tag, comment or declaration from ``at`` on."""
        page = self.page
        at = page.find("<", at)
        while at >= 0:
            if at > self.last and page[at + 1:at + 2] not in ("!", "?"):
                # No tag ends any more; what opens a comment or declaration reaches the end.
                at = min((p for p in (page.find("<!", at), page.find("<?", at)) if p >= 0),
                         default=-1)
                continue
            found = self.tag.match(page, at)
            if found is None and self.tag is _TAG and _OPENS.match(page, at):
                # From here to the end every ">" is in quotes, so quotes mean nothing here.
                self.tag = _LOOSE
                found = _LOOSE.match(page, at)
            if found is not None:
                return found
            at = page.find("<", at + 1)
        return None

    def end_of(self, name: str, at: int) -> int:
        """Behind the end tag of a raw element, or -1. One that is missing stays so."""
        if name in self.unclosed or at > self.last:
            return -1
        close = re.compile(rf"</{name}[^>]*>", re.I).search(self.page, at, self.last + 1)
        if close is None:
            self.unclosed.add(name)
        return close.end() if close else -1


def blocks(page: str) -> list[Block]:
    """(text, words, linked words, inside an apart element, number of the outermost
    element around it that a word of a class or id sets apart or 0, inside a main one)."""
    out: list[Block] = []
    pieces: list[str] = []
    linked: list[str] = []
    # Open elements as (name, apart, hinted, main); where in it each name is open, and what
    # may hold items; counts of apart, hinted and main ones, and of outermost hinted ones.
    stack: list[tuple[str, bool, bool, bool]] = []
    places: dict[str, list[int]] = defaultdict(list)
    fences: list[int] = []
    open_apart = open_hinted = open_main = hints = in_link = 0
    at, size, markup = 0, len(page), _Markup(page)

    def last(names: frozenset[str]) -> int:
        return max((places[n][-1] for n in names if places[n]), default=-1)

    def close_from(place: int) -> None:
        nonlocal open_apart, open_hinted, open_main
        while len(stack) > place >= 0:
            top, apart, hinted, main = stack.pop()
            places[top].pop()
            if fences and fences[-1] == len(stack):
                fences.pop()
            open_apart -= apart
            open_hinted -= hinted
            open_main -= main

    def close_before(name: str) -> None:
        """Elements that end where ``name`` begins."""
        if places["head"]:
            close_from(places["head"][-1])
        if name in ITEMS and fences and stack[fences[-1]][0] in ITEMS[name]:
            close_from(fences[-1])
        if name in ENDS_P and places["p"] and places["p"][-1] > last(_AROUND_P):
            close_from(places["p"][-1])
        if name in CLOSES:
            closed, beyond = CLOSES[name]
            edge = last(beyond)
            close_from(min((p for n in closed for p in places[n][-1:] if p > edge), default=-1))

    def close_block() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                links = len(" ".join(linked).split()) if linked else 0
                out.append((text, text.count(" ") + 1, links, open_apart > 0,
                            hints if open_hinted else 0, open_main > 0))
            pieces.clear()
            linked.clear()

    while at < size:
        found = markup.after(at)
        stop = found.start() if found else size
        if stop > at:
            piece = page[at:stop]
            if "&" in piece:
                piece = entities.unescape(piece)
            if places["head"] and not piece.isspace():
                close_block()
                close_from(places["head"][-1])
            pieces.append(piece)
            if in_link:
                linked.append(piece)
        if not found:
            break
        at = found.end()
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        if found[1]:
            if name == "a":
                in_link = 0
            if name not in INLINE:
                close_block()
                if places[name] and places[name][-1] > last(END_SCOPE.get(name, frozenset())):
                    close_from(places[name][-1])
            continue
        if name in RAW and not found[3].endswith("/"):
            behind = markup.end_of(name, at)
            if behind >= 0:
                at = behind
            elif name in TO_THE_END:
                at = size
            continue
        if name == "br":
            pieces.append(" ")
        elif name == "a":
            in_link = 1
        elif name not in INLINE:
            close_block()
            if name in VOID:
                if name == "hr":
                    close_before(name)
                continue
            close_before(name)
            if found[3].endswith("/"):
                continue
            apart, hinted, main = _marks(name, found[3], open_main > 0)
            places[name].append(len(stack))
            if name not in WITHIN_ITEM and "-" not in name:
                fences.append(len(stack))
            stack.append((name, apart, hinted, main))
            open_apart += apart
            hints += hinted and not open_hinted
            open_hinted += hinted
            open_main += main
    close_block()
    return out


def features(found: list[Block]) -> np.ndarray:
    """words, link density, the same before and after, apart, hinted, main: a row a block.

    A block of a hinted element has neighbours inside that element only.
    """
    if not found:
        return np.empty((0, 9))
    words = np.array([b[1] for b in found], float)
    density = np.array([b[2] for b in found], float) / words
    hint = np.array([b[4] for b in found])
    around = np.zeros((len(found) + 2, 2))
    around[1:-1, 0], around[1:-1, 1] = words, density
    before, after = around[:-2].copy(), around[2:].copy()
    other = hint[1:] != hint[:-1]
    before[1:][other & (hint[1:] > 0)] = 0
    after[:-1][other & (hint[:-1] > 0)] = 0
    return np.column_stack([words, density, before, after,
                            [b[3] for b in found], hint > 0, [b[5] for b in found]])


# Labelled blocks outside any telling element: words, link density, words and link
# density of the block before, of the block after, and whether it is the article's.
_UNMARKED = (
    # Menus, crumbs and other links.
    (1, 1.0, 1, 1.0, 40, 0.0, 0), (3, 1.0, 2, 1.0, 2, 1.0, 0), (4, 1.0, 60, 0.0, 5, 1.0, 0),
    (2, 1.0, 0, 0.0, 60, 0.0, 0), (5, 1.0, 3, 1.0, 90, 0.0, 0), (1, 1.0, 0, 0.0, 51, 0.0, 0),
    (8, 0.9, 2, 1.0, 120, 0.0, 0), (3, 1.0, 75, 0.0, 66, 0.0, 0), (14, 0.8, 1, 1.0, 70, 0.0, 0),
    (12, 0.9, 3, 1.0, 9, 1.0, 0), (25, 0.8, 3, 1.0, 30, 0.9, 0), (6, 0.7, 4, 1.0, 2, 0.5, 0),
    # Articles without them: paragraphs, and headings before them.
    (40, 0.0, 6, 0.0, 60, 0.0, 1), (90, 0.02, 40, 0.0, 85, 0.0, 1),
    (60, 0.2, 90, 0.0, 3, 1.0, 1), (25, 0.0, 30, 0.0, 45, 0.0, 1),
    (18, 0.0, 70, 0.0, 64, 0.1, 1), (7, 0.0, 2, 1.0, 44, 0.0, 1),
    (6, 0.0, 45, 0.0, 52, 0.0, 1), (3, 0.0, 66, 0.0, 71, 0.0, 1),
    (200, 0.0, 5, 0.0, 0, 0.0, 1), (33, 0.25, 1, 1.0, 47, 0.0, 1),
    (16, 0.0, 0, 0.0, 19, 0.0, 1), (22, 0.0, 21, 0.0, 0, 0.0, 1),
    # Short lines that stand among links or at the end of a page.
    (5, 0.0, 3, 1.0, 2, 1.0, 0), (4, 0.0, 1, 1.0, 6, 1.0, 0),
    (6, 0.0, 80, 0.0, 0, 0.0, 0), (3, 0.0, 4, 0.3, 0, 0.0, 0),
    (8, 0.0, 55, 0.0, 5, 0.8, 0), (2, 0.0, 5, 0.0, 3, 0.0, 0),
)


# Labelled blocks of the article's element that a class or id word hints are not its own,
# in the same columns; neighbours are those under the same hint.
_HINTED = (
    # Buttons, adverts, lists of links, lines that a reader wrote.
    (1, 0.0, 0, 0.0, 0, 0.0, 0), (2, 0.0, 0, 0.0, 0, 0.0, 0), (3, 0.0, 4, 0.0, 2, 0.0, 0),
    (6, 0.0, 12, 0.0, 0, 0.0, 0), (12, 0.0, 0, 0.0, 0, 0.0, 0), (12, 0.0, 3, 0.0, 14, 0.0, 0),
    (14, 0.1, 2, 0.0, 3, 1.0, 0), (4, 1.0, 0, 0.0, 5, 1.0, 0), (6, 1.0, 5, 1.0, 0, 0.0, 0),
    (30, 0.9, 0, 0.0, 0, 0.0, 0), (45, 0.8, 3, 0.0, 40, 0.9, 0), (120, 1.0, 2, 0.0, 90, 1.0, 0),
    (3, 0.0, 0, 0.0, 60, 0.9, 0), (5, 1.0, 40, 0.0, 60, 0.0, 0), (8, 0.0, 50, 0.9, 0, 0.0, 0),
    (11, 0.0, 30, 0.9, 3, 0.0, 0), (13, 0.0, 12, 0.0, 14, 0.0, 0), (9, 0.0, 0, 0.0, 60, 0.9, 0),
    (13, 0.0, 3, 0.0, 30, 0.9, 0), (18, 0.0, 60, 0.9, 0, 0.0, 0), (20, 0.0, 14, 0.0, 12, 0.0, 0),
    (2, 0.0, 90, 0.9, 60, 0.9, 0), (7, 0.0, 45, 0.9, 2, 0.0, 0), (5, 0.6, 90, 0.0, 2, 0.0, 0),
    (150, 0.7, 60, 0.0, 60, 0.0, 0), (4, 1.0, 60, 0.0, 0, 0.0, 0), (5, 0.9, 0, 0.0, 60, 0.0, 0),
    # Paragraphs with few links, and the short lines and headings beside them.
    (28, 0.0, 0, 0.0, 0, 0.0, 1), (30, 0.0, 3, 0.0, 4, 0.0, 1), (45, 0.1, 2, 0.0, 60, 0.0, 1),
    (90, 0.0, 0, 0.0, 0, 0.0, 1), (150, 0.2, 4, 1.0, 3, 1.0, 1), (60, 0.2, 6, 0.0, 90, 0.0, 1),
    (40, 0.0, 45, 0.0, 5, 1.0, 1), (200, 0.0, 30, 0.9, 0, 0.0, 1),
    (1, 0.0, 0, 0.0, 30, 0.0, 1), (2, 0.0, 0, 0.0, 40, 0.0, 1), (4, 0.0, 12, 0.0, 90, 0.0, 1),
    (12, 0.0, 28, 0.0, 0, 0.0, 1), (14, 0.1, 60, 0.1, 30, 0.0, 1), (6, 0.0, 90, 0.0, 40, 0.1, 1),
    (10, 0.0, 45, 0.0, 6, 0.0, 1), (3, 0.0, 30, 0.0, 150, 0.0, 1),
    (7, 0.0, 60, 0.0, 0, 0.0, 1), (5, 0.0, 30, 0.0, 0, 0.0, 1), (2, 0.0, 90, 0.0, 3, 0.0, 1),
    (11, 0.0, 0, 0.0, 28, 0.0, 1), (13, 0.0, 3, 0.0, 90, 0.0, 1), (20, 0.0, 40, 0.0, 2, 0.0, 1),
    (8, 0.0, 45, 0.0, 60, 0.9, 1), (18, 0.1, 60, 0.9, 45, 0.0, 1),
)


def _labelled() -> tuple:
    """The rows above, and what the elements around a block decide: inside a menu,
    form or the like it is not the article's, whatever its words; in the element that
    holds the article it is, down to a word or a link; under a hint outside of that
    element it is not."""
    around = ((0, 0.0), (2, 1.0), (60, 0.0))
    marked = [
        (words, density, *before, *after, apart, hinted, main, int(not apart and not hinted))
        for words in (1, 4, 30, 150) for density in (0.0, 0.3, 1.0)
        for before in around for after in around
        for apart, hinted, main in (
            (1, 0, 0), (1, 0, 1), (1, 1, 0), (1, 1, 1), (0, 1, 0), (0, 0, 1))
    ]
    return (*[(*row[:-1], 0, 0, 0, row[-1]) for row in _UNMARKED],
            *[(*row[:-1], 0, 1, 1, row[-1]) for row in _HINTED], *marked)


LABELLED = _labelled()


def grow(x: np.ndarray, y: np.ndarray, depth: int = 9) -> tuple | int:
    """A tree of (column, bound, at most, above) that halves Gini impurity greedily."""
    if depth == 0 or y.min() == y.max():
        return int(2 * y.sum() >= len(y))

    def impurity(part: np.ndarray) -> float:
        p = part.mean()
        return len(part) * p * (1 - p)

    best = None
    for column in range(x.shape[1]):
        values = np.unique(x[:, column])
        for bound in (values[1:] + values[:-1]) / 2:
            below = x[:, column] <= bound
            cost = impurity(y[below]) + impurity(y[~below])
            if best is None or cost < best[0] - 1e-12:
                best = (cost, column, float(bound), below)
    if best is None:
        return int(2 * y.sum() >= len(y))
    _, column, bound, below = best
    return (column, bound, grow(x[below], y[below], depth - 1),
            grow(x[~below], y[~below], depth - 1))


def judge(tree: tuple | int, x: np.ndarray) -> np.ndarray:
    """The tree's label of each row."""
    if isinstance(tree, int):
        return np.full(len(x), tree, bool)
    column, bound, low, high = tree
    below = x[:, column] <= bound
    out = np.empty(len(x), bool)
    out[below], out[~below] = judge(low, x[below]), judge(high, x[~below])
    return out


@lru_cache
def trained(labelled: tuple = LABELLED) -> tuple:
    rows = np.array(labelled, float)
    return grow(rows[:, :-1], rows[:, -1])


def main_text(page: str | None, tree: tuple | None = None) -> str:
    found = blocks(page or "")
    kept = judge(tree or trained(), features(found))
    return "\n\n".join(b[0] for b, k in zip(found, kept, strict=True) if k)


def extract(pages: DataFrame, labelled: tuple = LABELLED) -> DataFrame:
    """page_id, url, text and n_chars of every page; the empty text if none is left.

    A null or empty page has an empty text. Nothing is shuffled.
    """
    tree = trained(labelled)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), tree) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", "html").mapInArrow(
        each, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
