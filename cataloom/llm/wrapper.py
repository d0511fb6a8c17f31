"""Main text of web pages by wrappers induced from the pages of each host.

Every page becomes a tree of elements. One page of a host, taken by a hash, is the host's
reference; all its other pages are aligned with it by simple tree matching (the greatest
order-preserving match of equal labels, top down). Pages that fit it badly are of another layout:
one of them becomes the next reference, until every page has one that it fits. Summed over all
pages, a node of the reference is template if its text hardly ever changes, and a slot if it
does. The region of content is what holds the page's article and main elements, if most of the
varying text is in them, or else is found by descending to the container that holds most of it.
Equal trees count once. Near copies, that differ from the reference in less than a tenth of the
text, only count where too few other pages say something, nothing inside an article is template
by them, and those that differ in a few characters (a date, a counter) do not count.

From a page come the blocks of what is aligned with the region, without template nodes and
without what its markup names as a menu, header, footer, sidebar, notice, advert, form,
script, style or comments. A page that cannot be aligned, or the only one of its layout, is
searched for its own region in the same way.

Character references are decoded, white space inside a block (line breaks included) becomes
one space, blocks are joined by line feeds. Null html counts as empty and has empty text.
Pages without a host share one. Only trees without text, or compressed pages, are shuffled.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.storage import materialize, scratch_path

EVIDENCE = 5  # pages besides the reference that must agree before a node is template, or all
#: if there are fewer; of near copies two at least
FITS = 0.5  # share of the texts of the smaller tree that are aligned in pages of one layout
CONSTANT = 0.9  # share of them with the same text
NEAR = 0.9  # share of a page's text from which equal text makes it a near copy
SLIGHT = 40  # differing characters up to which a near copy says nothing
DOMINANT = 0.6  # share of the varying text that draws the region into a container

# Sizes of steps, without effect on results.
CELLS = 1 << 16  # larger pairs of child lists are aligned by whole rows
BLOCK = 64  # rows of such a pair that are held at once,
MARKS = 32  # and of those before them, on each level
AT_ONCE = 512  # trees of a host that may become references in one round
NODES = 1 << 17  # nodes that these have together, if they are several
PART = 1 << 12  # nodes of a host that are aligned in one part, or as many as its references have
SHAPES = 1 << 18  # shapes and scores that a worker remembers

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
#: Boilerplate only up to an end tag of their own; what follows one that has none is kept.
BRACKETS = frozenset("svg template noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split()
)
CONTENT = frozenset("main article".split())
SECTIONS = CONTENT | {"section"}
CONTAINERS = frozenset("html body main article section div td table tbody tr center".split())
BOILERPLATE = frozenset(
    "head title nav header footer aside form script style noscript template iframe svg button "
    "select textarea input dialog menu object canvas".split()
)
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar".split()
)
BOILERPLATE_NAMES = re.compile(
    r"(?!(?:has|with|no|without|is)[-_])"
    r"(?:(?:ads?|advert\w*|adsense|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|"
    r"newsletter|subscri\w+|signup|login|sidebar|menu|nav|navbar|navigation|breadcrumbs?|header|"
    r"footer|masthead|share|sharing|social|related|recommend\w*|promo\w*|sponsor\w*|comments?|"
    r"disqus|respond|repl(?:y|ies)|widget|toolbar|pagination|pager|copyright|skip)(?:[-_].*)?$|"
    r".*[-_](?:ads?|advert|comments?|sidebar-?\d*|newsletter)$)"
)
#: Of these, the ones that a phrase inside an article can have.
_WORD_NAMES = re.compile(r"ads?|advert|adsense|share|sharing|social|sponsored|promo|comments?|widget|skip")
#: Left out without ending the block around them.
ASIDE_IN_TEXT = frozenset(
    "script style noscript template iframe svg button select textarea input object canvas".split()
)
NEVER_BOILERPLATE = frozenset("html body main article".split())
#: An element whose start ends another that is still open.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
STOPS = frozenset("html body table ul ol dl select article section div".split())

MAX_DEPTH = 200  # the content of elements nested more deeply is put into the last above them

_OTHER = r"<!--.*?(?:-->|$)|<[!?][^>]*+>|"
_NAME = r"<(/?)([A-Za-z][^\s/>]*+)"
#: With the attributes if they are plain to see; _end finds the end of all others.
_TAG = re.compile(
    rf"{_OTHER}{_NAME}(?:((?:[^>\"']++|\"[^\"]{{0,9999}}+\"|'[^']{{0,9999}}+')*+)>)?+", re.DOTALL
)
_TAG_START = re.compile(rf"{_OTHER}{_NAME}()", re.DOTALL)
_UNQUOTED = re.compile(r"[^>\"']*+")
#: Other quoted values are passed over, with what looks like an attribute in them.
_ATTRIBUTE = re.compile(
    r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))|"[^"]*"|'[^']*'""", re.I
)


@dataclass(slots=True)
class Node:
    tag: str
    label: int
    boilerplate: bool
    #: Text and child nodes in page order.
    content: list = field(default_factory=list)
    by_element: bool = False  # boilerplate by the name of its element alone


def parse(page: str) -> Node:
    """A tree of the page; markup that is not well formed is read as browsers mostly do."""
    root = Node("html", 0, False)
    open_ = Open([root])
    at, last, doomed, tags = 0, page.rfind(">"), set(), _TAG
    closes = page.rfind("]]>")
    # Markup ends at the last ">"; behind it only a comment may begin.
    while at <= last and (match := tags.search(page, at, last + 1)):
        start, stop, name = match.start(), match.end(), match[2]
        attributes = match[3]
        if name is not None and not attributes and page[stop - 1] != ">":
            end = _end(page, stop, doomed)
            if end < 0:  # a quote never closes
                end = page.find(">", stop)
                tags = _TAG_START
            attributes, stop = page[stop:end], end + 1
        if start > at:
            open_[-1].content.append(page[at:start])
        at = stop
        if name is None:
            said = match[0]
            if said.startswith("<!--") and not (said.endswith("-->") and len(said) > 6):
                at = len(page)  # a comment that never ends
            elif said.startswith("<![CDATA[") and start + 9 <= closes:
                at = page.find("]]>", start + 9) + 3
                open_[-1].content.append(html.escape(page[start + 9 : at - 3]))
            continue
        name = name.lower()
        if match[1]:
            if open_.has(name):
                for i in range(len(open_) - 1, 0, -1):
                    if open_[i].tag == name:
                        open_.close(i, own=True)
                        break
            continue
        if name == "html":
            continue
        _close_implied(open_, name)
        node = _node(name, attributes, open_.has("article") or open_.has("main"))
        if name == "h1" and open_.has("header") and open_.has("article"):
            _keep_title(open_)
        open_[-1].content.append(node)
        closed = attributes.endswith("/")
        if name in RAW and not (closed and open_.has("svg")):
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID and not closed:
            open_.add(node)
    if at < len(page):
        comment = page.find("<!--", at)
        open_[-1].content.append(page[at : comment if comment >= 0 else len(page)])
    open_.close(1)
    return root


def _end(page: str, at: int, doomed: set[int]) -> int:
    """Where the ``>`` of a tag is, outside its quotes, or -1 if one of these never closes.
    ``doomed`` has the quotes from which no end is reached; with it, no part of a page is read
    twice in vain."""
    met = []
    while True:
        at = _UNQUOTED.match(page, at).end()
        if at < len(page) and page[at] == ">":
            return at
        closing = -1 if at >= len(page) or at in doomed else page.find(page[at], at + 1)
        if at < len(page):
            met.append(at)
        if closing < 0:
            doomed.update(met)
            return -1
        at = closing + 1


class Open(list[Node]):
    """Elements that are open, the root first."""

    def __init__(self, nodes: list[Node]):
        super().__init__(nodes)
        self._counts: defaultdict[str, int] = defaultdict(int)

    def has(self, tag: str) -> bool:
        return self._counts[tag] > 0

    def add(self, node: Node) -> None:
        """Opens an element just put into the last. Very deep ones share the content of the last,
        so that the tree does not get deeper; boilerplate keeps its own."""
        if len(self) >= MAX_DEPTH and not node.boilerplate:
            node = Node(node.tag, node.label, False, self[-1].content)
        self._counts[node.tag] += 1
        self.append(node)

    def close(self, at: int, own: bool = False) -> None:
        """Closes elements from ``at`` on, the first of them by its own end tag or not."""
        for i in range(len(self) - 1, at - 1, -1):
            node = self.pop()
            self._counts[node.tag] -= 1
            if node.tag in BRACKETS and not (own and i == at):
                node.boilerplate = False
            shared = i >= MAX_DEPTH and node.content is self[-1].content
            if shared and node.tag not in INLINE and isinstance(node.content[-1], str):
                node.content.append(Node(node.tag, node.label, False))  # ends the block


def _close_implied(open_: Open, name: str) -> None:
    if name in ENDS:
        if not any(map(open_.has, ENDS[name])):
            return
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in ENDS[name]:
                open_.close(i)
                break
            if open_[i].tag in STOPS:
                break
    elif open_.has("p") and not (name in INLINE or name in VOID or name in ASIDE_IN_TEXT):
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag == "p":
                open_.close(i)
                break
            if open_[i].tag not in INLINE:
                break


def _keep_title(open_: Open) -> None:
    """A header within an article is content if it has the title."""
    for node in reversed(open_):
        if node.tag == "header" and node.by_element:
            node.boilerplate = False
        if node.tag == "article":
            break


def _node(name: str, attributes: str, in_content: bool = False) -> Node:
    """``in_content``: within main or article, where a longer name that only begins like one of
    boilerplate does not tell of a phrase."""
    boilerplate = by_element = name in BOILERPLATE
    kind = ""
    told = BOILERPLATE_NAMES.match
    if in_content and name in INLINE:
        told = _WORD_NAMES.fullmatch
    if "=" in attributes:
        for match in _ATTRIBUTE.finditer(attributes):
            if not match[1]:
                continue
            key, value = match[1].lower(), (match[2] or match[3] or match[4] or "").lower()
            names = value.split()
            kind += f" {key}={value}" if key != "id" else ""
            if name in NEVER_BOILERPLATE:
                continue
            if key == "role":
                said = not BOILERPLATE_ROLES.isdisjoint(names)
                boilerplate, by_element = boilerplate | said, by_element and not said
            else:
                said = any(told(n) for n in names)
                boilerplate, by_element = boilerplate | said, by_element and not said
    return Node(name, zlib.crc32((name + kind).encode()), boilerplate, by_element=by_element)


def pieces(node: Node) -> list[str | Node]:
    """Texts and block-level nodes below a node in page order, inline elements opened up."""
    if all(isinstance(c, str) for c in node.content):
        return node.content
    found: list[str | Node] = []
    opened = [iter(node.content)]
    while opened:
        for c in opened[-1]:
            if isinstance(c, str):
                found.append(c)
            elif c.tag == "br":
                found.append(" ")
            elif c.boilerplate and (c.tag in INLINE or c.tag in ASIDE_IN_TEXT):
                continue
            elif c.tag in INLINE:
                opened.append(iter(c.content))
                break
            else:
                found.append(c)
        else:
            opened.pop()
    return found


@dataclass
class Tree:
    """Block-level skeleton of a page in document order: what alignment needs."""

    labels: np.ndarray  # uint32
    sizes: np.ndarray  # nodes of each subtree, itself included
    texts: np.ndarray  # crc of own text, 0 if it has none
    lengths: np.ndarray
    flags: np.ndarray  # 1 boilerplate, 2 container, 4 main or article, 8 section or these,
    # 16 article

    def __post_init__(self) -> None:
        n = len(self.labels)
        self.kids: list[list[int]] = [[] for _ in range(n)]
        self.shapes = [0] * n
        label, size = self.labels.tolist(), self.sizes.tolist()
        for i in range(n - 1, -1, -1):
            at, end, own = i + 1, i + size[i], []
            while at < end:
                own.append(at)
                at += size[at]
            self.kids[i] = own
            self.shapes[i] = shape(label[i], tuple(self.shapes[k] for k in own))

    def pack(self) -> bytes:
        columns = (self.labels, self.sizes, self.texts, self.lengths, self.flags)
        return zlib.compress(np.stack([c.astype("<u4") for c in columns]).tobytes(), 1)

    @staticmethod
    def unpack(packed: bytes) -> Tree:
        return Tree(*np.frombuffer(zlib.decompress(packed), "<u4").reshape(5, -1))


TEXT_RUN = zlib.crc32(b"#text")


def skeleton(root: Node) -> tuple[Tree, list[str]]:
    """The tree, and the text of each node: of blocks without blocks inside, and of the runs of
    text between blocks, which become nodes. Boilerplate has no nodes below it."""
    rows: list[list[int]] = []
    texts: list[str] = []

    def add(label: int, text: str, flags: int) -> int:
        rows.append([label, 1, zlib.crc32(text.encode()) if text else 0, len(text), flags])
        texts.append(text)
        return len(rows) - 1

    def begin(node: Node) -> bool:
        """Adds a node; whether there are nodes below it, which are then in ``open_``."""
        own = [] if node.boilerplate else pieces(node)
        flags = node.boilerplate + 2 * (node.tag in CONTAINERS)
        flags += 4 * (node.tag in CONTENT) + 8 * (node.tag in SECTIONS) + 16 * (node.tag == "article")
        if own is node.content or all(isinstance(x, str) for x in own):
            add(node.label, plain(own), flags)
            return False
        open_.append((add(node.label, "", flags), iter([*own, None]), []))
        return True

    # Of what is open: its row (-1 if it shares that of an element above it, being nested very
    # deeply), what is left of its pieces, and the run of text before the next block.
    open_: list[tuple[int, Iterator[str | Node | None], list[str]]] = []
    begin(root)
    while open_:
        at, rest, run = open_[-1]
        for x in rest:
            if isinstance(x, str):
                run.append(x)
                continue
            if text := plain(run):
                add(TEXT_RUN, text, 0)
            run.clear()
            if x is None:
                if at >= 0:
                    rows[at][1] = len(rows) - at
                open_.pop()
                break
            if len(open_) >= MAX_DEPTH and not x.boilerplate:
                open_.append((-1, iter([*pieces(x), None]), []))
                break
            if begin(x):
                break
    return Tree(*np.array(rows, np.int64).T.astype(np.uint32)), texts


def plain(run: list[str]) -> str:
    return " ".join(html.unescape("".join(run)).split())


_SHAPES: dict[tuple, int] = {}
_LABEL_OF: list[tuple[int, tuple[int, ...], int]] = []
_SCORES: dict[tuple[int, int], int] = {}


def shape(label: int, kids: tuple[int, ...]) -> int:
    """A number for a subtree's labels, the same for equal subtrees of one process."""
    key = (label, kids)
    if key not in _SHAPES:
        _SHAPES[key] = len(_LABEL_OF)
        _LABEL_OF.append((label, kids, 1 + sum(_LABEL_OF[k][2] for k in kids)))
    return _SHAPES[key]


def forget_shapes() -> None:
    """Start again once many shapes were met; trees made before must not be used any more."""
    _SHAPES.clear()
    _LABEL_OF.clear()
    _SCORES.clear()


def score(a: int, b: int) -> int:
    """Nodes in the greatest match of two shapes."""
    if a == b:
        return _LABEL_OF[a][2]
    if a > b:
        a, b = b, a
    known = _SCORES.get((a, b))
    if known is None:
        (label_a, kids_a, _), (label_b, kids_b, _) = _LABEL_OF[a], _LABEL_OF[b]
        if label_a != label_b:
            known = 0
        else:
            pairs = align(kids_a, kids_b, (0,) * len(kids_a), (0,) * len(kids_b))
            known = 1 + sum(score(kids_a[i], kids_b[j]) for i, j in pairs)
        if len(_SCORES) > SHAPES:
            _SCORES.clear()
        _SCORES[a, b] = known
    return known


def align(a, b, said_a, said_b) -> list[tuple[int, int]]:
    """Pairs of positions in two lists of shapes, in order, with the greatest total score; of
    equal totals the one in which more pairs say the same."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head] and said_a[head] == said_b[head]:
        head += 1
    tail = 0
    while (
        tail < min(len(a), len(b)) - head
        and a[-1 - tail] == b[-1 - tail]
        and said_a[-1 - tail] == said_b[-1 - tail]
    ):
        tail += 1
    pairs = [(i, i) for i in range(head)]
    x, y = (list(zip(s, t, strict=True))[head : len(s) - tail] for s, t in ((a, said_a), (b, said_b)))
    if x and y:
        middle = _align_long(x, y) if len(x) * len(y) > CELLS else _align_all(x, y)
        pairs += [(head + i, head + j) for i, j in middle]
    return pairs + [(len(a) - tail + i, len(b) - tail + i) for i in range(tail)]


MUCH = 1 << 20  # a node counts for more than all that is said


def _align_all(x, y) -> list[tuple[int, int]]:
    best = [[0] * (len(y) + 1)]
    for p, t in x:
        above, row = best[-1], [0]
        left = 0
        for j, (q, u) in enumerate(y):
            nodes = score(p, q)
            most = above[j] + nodes * MUCH + (t == u and nodes > 0)
            if above[j + 1] > most:
                most = above[j + 1]
            if left > most:
                most = left
            row.append(most)
            left = most
        best.append(row)
    pairs, i, j = [], len(x), len(y)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def _align_long(x, y) -> list[tuple[int, int]]:
    """The pairs that ``_align_all`` finds, for long lists.

    Scores are found once for all shapes of a label. A row of totals follows from the one above by
    whole-row steps, only where a greatest match can pass: what the heads and the tails could
    score at most must reach what a simple match scores. Of most rows nothing is kept; they are
    made again, from the last one kept, on the way back.
    """
    labels = [[_LABEL_OF[p][0] for p, _ in z] for z in (x, y)]
    shared = set(labels[0]) & set(labels[1])
    at_x, at_y = ([i for i, l in enumerate(z) if l in shared] for z in labels)
    x, y = [x[i] for i in at_x], [y[j] for j in at_y]
    if not x or not y:
        return []
    label_x, label_y = (np.array([_LABEL_OF[p][0] for p, _ in z], np.int64) for z in (x, y))
    said_x, said_y = (np.array([t for _, t in z], np.int64) for z in (x, y))
    place_x, place_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    most_x, most_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    nodes: dict[int, np.ndarray] = {}
    for label in shared:
        own, other = np.flatnonzero(label_x == label), np.flatnonzero(label_y == label)
        rows, place_x[own] = np.unique([x[i][0] for i in own], return_inverse=True)
        columns, place_y[other] = np.unique([y[j][0] for j in other], return_inverse=True)
        table = nodes[label] = np.empty((len(rows), len(columns)), np.int32)
        for i, p in enumerate(rows.tolist()):
            for j, q in enumerate(columns.tolist()):
                table[i, j] = score(p, q)
        most_x[own] = table.max(axis=1)[place_x[own]]
        most_y[other] = table.max(axis=0)[place_y[other]]
    heads_x = np.concatenate([[0], np.cumsum(most_x * MUCH + np.isin(said_x, said_y))])
    heads_y = np.concatenate([[0], np.cumsum(most_y * MUCH + np.isin(said_y, said_x))])
    least = sum(
        int(nodes[int(label_x[i])][place_x[i], place_y[j]]) * MUCH + int(said_x[i] == said_y[j])
        for i, j in _align_runs(x, y)
    )
    begin = np.searchsorted(heads_y, least - heads_x[-1] + heads_x)
    end = np.searchsorted(heads_y, heads_y[-1] - least + heads_x, side="right")
    begin, end, never = begin.tolist(), end.tolist(), -(1 << 62)

    def below_(i: int, above: np.ndarray) -> np.ndarray:
        """The totals with ``i + 1`` of x, from those with ``i``."""
        best = np.full(end[i + 1] - begin[i + 1], never)
        lo, hi = begin[i + 1], min(end[i], end[i + 1])
        best[: max(0, hi - lo)] = above[lo - begin[i] : max(lo, hi) - begin[i]]
        lo, hi = max(begin[i], begin[i + 1] - 1), min(end[i], end[i + 1] - 1)  # columns before the pair
        if lo < hi:
            same = np.flatnonzero(label_y[lo:hi] == label_x[i]) + lo
            gain = nodes[int(label_x[i])][place_x[i], place_y[same]] * np.int64(MUCH)
            gain += said_y[same] == said_x[i]
            at = same + 1 - begin[i + 1]
            best[at] = np.maximum(best[at], above[same - begin[i]] + gain)
        return np.maximum.accumulate(best)

    pairs = []

    def back(first: int, above: np.ndarray, last: int, j: int) -> int:
        """Collects the pairs from (last, j) up to the row ``first``; the column reached there."""
        if last - first > BLOCK:
            step, marks = -(-(last - first) // MARKS), []
            for i in range(first, last):
                if (i - first) % step == 0:
                    marks.append((i, above))
                above = below_(i, above)
            for i, row in reversed(marks):
                j = back(i, row, last, j)
                last = i
            return j
        rows = [above]
        for i in range(first, last):
            rows.append(below_(i, rows[-1]))
        i = last
        while i > first and j:
            here, over = rows[i - first], rows[i - 1 - first]
            total = here[j - begin[i]]
            if begin[i - 1] <= j < end[i - 1] and over[j - begin[i - 1]] == total:
                i -= 1
            elif j > begin[i] and here[j - 1 - begin[i]] == total:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((at_x[i], at_y[j]))
        return j

    back(0, np.zeros(end[0] - begin[0], np.int64), len(x), len(y))
    return pairs[::-1]


def _align_runs(x, y) -> list[tuple[int, int]]:
    """A simple match: equal labels in a row are paired in order, runs in order of label."""
    places = defaultdict(list)
    for j, (q, _) in enumerate(y):
        places[_LABEL_OF[q][0]].append(j)
    pairs, last = [], -1
    for i, (p, _) in enumerate(x):
        own = places.get(_LABEL_OF[p][0], ())
        at = bisect_left(own, last + 1)
        if at < len(own):
            last = own[at]
            pairs.append((i, last))
    return pairs


def match(page: Tree, reference: Tree) -> np.ndarray:
    """For each node of the page the node of the reference it is aligned with, or -1."""
    to = np.full(len(page.labels), -1)
    said, says = page.texts.tolist(), reference.texts.tolist()
    stack = [(0, 0)] if page.labels[0] == reference.labels[0] else []
    while stack:
        p, r = stack.pop()
        to[p] = r
        own, other = page.kids[p], reference.kids[r]
        pairs = align(
            [page.shapes[k] for k in own],
            [reference.shapes[k] for k in other],
            [said[k] for k in own],
            [says[k] for k in other],
        )
        stack += [(own[i], other[j]) for i, j in pairs if page.labels[own[i]] == reference.labels[other[j]]]
    return to


def fits(page: Tree, reference: Tree, to: np.ndarray) -> float:
    """Share of the texts of the smaller tree that are aligned."""
    said = page.texts != 0
    fewer = min(said.sum(), (reference.texts != 0).sum())
    return float((said & (to >= 0) & (reference.texts[to] != 0)).sum() / fewer) if fewer else 0.0


def evidence(page: Tree, reference: Tree, to: np.ndarray) -> tuple[bool, dict[int, tuple[int, int, int]]]:
    """Whether the page is a near copy of the reference, and of each reference node: pages, pages
    with the same text, varying characters."""
    text = (page.texts != 0) & (to >= 0)
    same = text & (page.texts == reference.texts[to])
    all_, equal_ = int(page.lengths.sum()), int(page.lengths[same].sum())
    near = equal_ >= NEAR * all_
    found: dict[int, tuple[int, int, int]] = {}
    if near and all_ - equal_ <= SLIGHT:
        return near, found
    parents = _parents(page)
    for i in np.flatnonzero(page.texts != 0).tolist():
        at = i
        while to[at] < 0 and at:
            at = parents[at]
        r = max(0, int(to[at]))
        n, k, chars = found.get(r, (0, 0, 0))
        matched = at == i and to[i] >= 0
        equal = bool(same[i])
        found[r] = (n + matched, k + equal, chars + (0 if equal else int(page.lengths[i])))
    return near, found


def _parents(tree: Tree) -> list[int]:
    parents = [0] * len(tree.labels)
    for i, kids in enumerate(tree.kids):
        for k in kids:
            parents[k] = i
    return parents


def below(tree: Tree, weight: np.ndarray) -> list[float]:
    """Of each node: the weight of its subtree."""
    sums = np.concatenate([[0.0], np.cumsum(weight, dtype=np.float64)])
    at = np.arange(len(weight))
    return (sums[at + tree.sizes] - sums[at]).tolist()


def named(tree: Tree, sums: list[float]) -> list[int]:
    """The outermost main and article elements that hold weight."""
    found, end = [], 0
    for i in np.flatnonzero(tree.flags & 4).tolist():
        if i >= end and sums[i] and not tree.flags[i] & 1:
            found.append(i)
            end = i + int(tree.sizes[i])
    return found


def common(tree: Tree, nodes: list[int]) -> int:
    """The innermost node around all of some nodes."""
    first, last = min(nodes), max(nodes)
    at = 0
    while at != first:
        inner = next(k for k in tree.kids[at] if k <= first < k + tree.sizes[k])
        if last >= inner + tree.sizes[inner]:
            break
        at = inner
    return at


def region(tree: Tree, weight: np.ndarray) -> int:
    """What holds all main and article elements, if most of the weight is in them; else the
    container with most of the weight, by descending while one child dominates and only weight
    of other plain containers is left behind: no paragraphs, headings or sections."""
    sums = below(tree, weight)
    content = named(tree, sums)
    if content and sum(sums[i] for i in content) >= DOMINANT * sums[0]:
        return common(tree, content)
    at = 0
    while True:
        choices = [k for k in tree.kids[at] if tree.flags[k] & 2 and not tree.flags[k] & 1]
        best = max(choices, key=lambda k: sums[k], default=None)
        if best is None or not sums[at] or sums[best] < DOMINANT * sums[at] or tree.flags[at] & 4:
            return at
        if any(sums[k] and k != best and tree.flags[k] & 10 != 2 for k in tree.kids[at]):
            return at
        at = best


@dataclass
class Wrapper:
    """A host's reference with what all its pages say about the nodes."""

    tree: Tree
    root: int
    template: np.ndarray

    @staticmethod
    def of(tree: Tree, counts: list[tuple[int, bool, int, int, int]]) -> Wrapper:
        """``counts`` of a node -1 are those of pages."""
        far, near = np.zeros((2, 3, len(tree.labels)))
        others = [0, 0]
        for node, copy, *numbers in counts:
            if node < 0:
                others[copy] += numbers[0]
            else:
                (near if copy else far)[:, node] += numbers
        every = far + near
        enough = min(EVIDENCE, max(1, others[0]))
        template = (far[0] >= enough) & (far[1] >= CONSTANT * far[0])
        enough_ = min(EVIDENCE, max(2, sum(others)))
        few = (far[0] < enough) & (every[0] >= enough_) & (every[1] >= CONSTANT * every[0])
        for i in np.flatnonzero(tree.flags & 16).tolist():
            few[i : i + int(tree.sizes[i])] = False
        template |= few
        weight = next((w for w in (far[2], every[2]) if w.any()), tree.lengths)
        return Wrapper(tree, region(tree, weight), template)

    @staticmethod
    def read(reference: bytes, root: int, template: bytes) -> Wrapper:
        tree = Tree.unpack(reference)
        bits = np.unpackbits(np.frombuffer(template, np.uint8), count=len(tree.labels))
        return Wrapper(tree, root, bits.astype(bool))


def best(tree: Tree, wrappers: list[Wrapper]) -> tuple[Wrapper | None, np.ndarray]:
    """The first of a host's wrappers that a page fits, or else the one it fits best, and what
    the page's nodes are aligned with."""
    most, found = -1.0, (None, np.full(len(tree.labels), -1))
    for wrapper in wrappers:
        to = match(tree, wrapper.tree)
        fit = fits(tree, wrapper.tree, to)
        if fit > most:
            most, found = fit, (wrapper, to)
        if fit >= FITS:
            break
    return found


def extract(page: str, wrappers: list[Wrapper] | None) -> str:
    tree, texts = skeleton(parse(page))
    wrapper, to = best(tree, wrappers or [])
    varies = tree.texts != 0
    if wrapper:
        varies &= ~((to >= 0) & wrapper.template[to] & (tree.texts == wrapper.tree.texts[to]))
    at = np.flatnonzero(to == wrapper.root) if wrapper else []
    weight = tree.lengths * varies
    root = int(at[0]) if len(at) else region(tree, weight)
    if wrapper and not tree.lengths[root : root + tree.sizes[root]].any():
        root = region(tree, weight)
    # The page may have more articles than the reference.
    content = named(tree, below(tree, weight))
    if any(i <= root < i + tree.sizes[i] for i in content):
        root = common(tree, [root, *content])
    return "\n".join(texts[i] for i in range(root, root + int(tree.sizes[root])) if varies[i])


def host(url_col: str):
    """Host of a URL in lower case, without user and port; empty if there is none."""
    found = F.regexp_extract(F.lower(F.col(url_col)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(found, F.lit(""))


def trees(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host``, ``page`` (hash of the markup), ``key`` (hash of the tree), ``nodes`` and ``tree``
    of every page with text."""
    page = F.col(html_col).cast("string")
    source = pages.select(
        host(url_col).alias("host"), F.unhex(F.md5(page)).alias("page"), page.alias("html")
    ).where(F.length("html") > 0)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forget_shapes()
            packed, nodes, said = [], [], []
            for p in batch.column(2):
                tree = skeleton(parse(p.as_py()))[0]
                packed.append(tree.pack())
                nodes.append(len(tree.labels))
                said.append(bool(tree.lengths.any()))
            made = pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array([hashlib.md5(p).digest() for p in packed], pa.binary()),
                    pa.array(nodes, pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                names=["host", "page", "key", "nodes", "tree"],
            )
            yield made.filter(pa.array(said, pa.bool_()))

    kinds = "host string, page binary, key binary, nodes bigint, tree binary"
    return materialize(source.mapInArrow(parsed, kinds), "trees")


def induce(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per layout of a host: the reference tree, the region's node, and which nodes are
    template."""
    return _induce(trees(pages, url_col, html_col))[0]


def _rounds() -> Iterator[tuple[int, int]]:
    """The first layout of each round and how many there may be; most hosts need one."""
    first, many = 0, 1
    while True:
        yield first, many
        first, many = first + many, min(2 * many, AT_ONCE)


def _once(trees_: DataFrame) -> DataFrame:
    return trees_.select("host", "key", "nodes", "tree").dropDuplicates(["host", "key"])


def _induce(trees_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The wrappers, and ``host``, ``key``, ``layout`` of the trees whose layout is not 0."""
    spark = trees_.sparkSession
    made = materialize(_once(trees_), "once")
    taken, results = scratch_path(spark, "references"), scratch_path(spark, "compared")
    for first, many in _rounds():
        references = materialize(_references(made, first, many), "references", f"{taken}/{first}")
        compared = materialize(_compare(made, references), "compared", f"{results}/{first}")
        made = compared.where("tree is not null").select("host", "key", "nodes", "tree")
        if made.isEmpty():
            break
    # All rounds together.
    references, compared = (
        spark.read.schema(df.schema).option("recursiveFileLookup", True).parquet(path)
        for df, path in ((references, taken), (compared, results))
    )
    return _judge(references, compared), _members(compared)


def _members(compared: DataFrame) -> DataFrame:
    return compared.where("key is not null and layout > 0").select("host", "key", "layout")


def _assign(trees_: DataFrame, wrappers: DataFrame) -> DataFrame:
    """``host``, ``key``, ``layout`` of the trees whose first layout of given ones is not 0; -1 for
    those that fit none."""
    spark = trees_.sparkSession
    last = wrappers.agg(F.max("layout")).first()[0]
    made, results = materialize(_once(trees_), "once"), scratch_path(spark, "compared")
    for first, many in _rounds():
        references = wrappers.where(F.col("layout").between(first, first + many - 1)).select(
            "host",
            "layout",
            (8 * F.length("template")).cast("bigint").alias("nodes"),  # a bit for each
            F.col("reference").alias("tree"),
        )
        compared = materialize(_compare(made, references), "compared", f"{results}/{first}")
        made = compared.where("tree is not null").select("host", "key", "nodes", "tree")
        if last is None or first + many > last:
            break
    every = spark.read.schema(compared.schema).option("recursiveFileLookup", True).parquet(results)
    return _members(every).unionByName(made.select("host", "key", F.lit(-1).cast("bigint").alias("layout")))


class References:
    """Some references of a host in their order."""

    def __init__(self) -> None:
        self.layouts: dict[bytes, int] = {}
        self._begin()

    def _begin(self) -> None:
        if len(_LABEL_OF) + len(_SCORES) > SHAPES:
            forget_shapes()
        self._trees: list[tuple[int, Tree, int]] = []
        self._places: defaultdict[int, list[tuple[int, int]]] = defaultdict(list)
        self._full = SHAPES
        for packed, layout in self.layouts.items():
            self._index(layout, packed)

    def _index(self, layout: int, packed: bytes) -> None:
        tree = Tree.unpack(packed)
        paths = text_paths(tree)
        for path, n in paths.items():
            self._places[path].append((len(self._trees), n))
        self._trees.append((layout, tree, paths.total()))
        self._full += len(tree.labels)

    def add(self, layout: int, packed: bytes) -> None:
        self.layouts[packed] = layout
        self._index(layout, packed)

    def first(self, packed: bytes) -> tuple[int, Tree, Tree, np.ndarray] | None:
        """The first reference that a tree fits: its layout, the tree, the reference, and what the
        tree's nodes are aligned with."""
        if len(_LABEL_OF) + len(_SCORES) > self._full:
            self._begin()
        tree = Tree.unpack(packed)
        for i in self._possible(tree):
            layout, reference, _ = self._trees[i]
            to = match(tree, reference)
            if fits(tree, reference, to) >= FITS:
                return layout, tree, reference, to
        return None

    def _possible(self, tree: Tree) -> list[int]:
        """Without those that share too few paths: texts on different ones are never aligned."""
        if len(self._trees) < 2:
            return list(range(len(self._trees)))
        paths, shared = text_paths(tree), [0] * len(self._trees)
        for path, n in paths.items():
            for i, m in self._places.get(path, ()):
                shared[i] += min(n, m)
        most = paths.total()
        return [i for i, n in enumerate(shared) if n and n >= FITS * min(most, self._trees[i][2])]


def text_paths(tree: Tree) -> Counter[int]:
    """How many texts there are under the same labels from the root down."""
    label = tree.labels.tolist()
    paths = [hash((0, label[0]))] * len(label)
    for i, kids in enumerate(tree.kids):
        for k in kids:
            paths[k] = hash((paths[i], label[k]))
    return Counter(paths[i] for i in np.flatnonzero(tree.texts).tolist())


def _references(made: DataFrame, first: int, many: int) -> DataFrame:
    """``host``, ``layout``, ``nodes``, ``tree``: what become references among the first ``many`` trees left of
    each host. As later trees have no say in it, these are the same as if taken one by one."""
    # Not the page with the least hash alone: a short page says little about the others, and a
    # very long one is sent along with each part of them.
    size = F.length("tree")
    kind = F.when(size.between(100, 4000), 0).when(size > 4000, 1).otherwise(2)
    ranked = Window.partitionBy("host").orderBy(kind, F.xxhash64("tree"), "tree")
    prefix = made.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= many)
    if many == 1:
        return prefix.select("host", F.lit(first).cast("bigint").alias("layout"), "nodes", "tree")
    so_far = Window.partitionBy("host").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    prefix = prefix.withColumn("held", F.sum("nodes").over(so_far)).where(f"place = 1 or held <= {NODES}")

    def leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, found = None, References()
        for batch in batches:
            new = []
            for host_, layout, _, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if host_ != name:
                    name, found = host_, References()
                new.append(found.first(packed) is None)
                if new[-1]:
                    found.add(layout, packed)
            yield batch.filter(pa.array(new, pa.bool_()))

    return (
        prefix.select("host", (F.col("place") + (first - 1)).cast("bigint").alias("layout"), "nodes", "tree")
        .repartition("host")
        .sortWithinPartitions("host", "layout")
        .mapInArrow(leaders, "host string, layout bigint, nodes bigint, tree binary")
    )


def _compare(made: DataFrame, references: DataFrame) -> DataFrame:
    """Of each tree the first reference that it fits: rows with ``key`` and ``layout``; what the
    trees of a layout say: rows with ``node``; the trees that fit none: rows with ``tree``."""
    # Large hosts are dealt to several parts, each with the references before the trees.
    size = F.greatest("held", F.lit(PART))
    parts = (
        made.groupBy("host")
        .agg(F.sum("nodes").alias("own"))
        .join(references.groupBy("host").agg(F.sum("nodes").alias("held")), "host", "left")
        .select("host", (F.col("own") / size).cast("bigint").alias("last"))
    )
    rows = (
        references.join(parts, "host")
        .select("host", F.explode(F.sequence(F.lit(0), "last")).alias("part"), "layout", "tree")
        .unionByName(
            made.join(parts, "host").select(
                "host", F.pmod(F.xxhash64("key"), F.col("last") + 1).alias("part"), "key", "nodes", "tree"
            ),
            allowMissingColumns=True,
        )
        .select("host", "part", "layout", "key", "nodes", "tree")
        .repartition("host", "part")
        .sortWithinPartitions("host", "part", F.asc_nulls_last("layout"))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, references_ = None, References()
        for batch in batches:
            totals: dict[tuple[str, int, int, bool], list[int]] = defaultdict(lambda: [0, 0, 0])
            found: list[dict] = []
            columns = (c.to_pylist() for c in batch.columns)
            for name, part, layout, key, nodes, packed in zip(*columns, strict=True):
                if (name, part) != at:
                    at, references_ = (name, part), References()
                if layout is not None:
                    references_.add(layout, packed)
                    continue
                layout = references_.layouts.get(packed)
                if layout is None:
                    fitting = references_.first(packed)
                    if fitting is None:
                        found.append({"host": name, "key": key, "nodes": nodes, "tree": packed})
                        continue
                    layout, *aligned = fitting
                    near, said = evidence(*aligned)
                    if said:
                        said[-1] = (1, 0, 0)
                    for node, counts in said.items():
                        total = totals[name, layout, node, near]
                        for i in range(3):
                            total[i] += counts[i]
                if layout:
                    found.append({"host": name, "key": key, "layout": layout})
            names = ("host", "layout", "node", "near", "pages", "same", "chars")
            found += [dict(zip(names, (*k, *v), strict=True)) for k, v in totals.items()]
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    schema = pa.schema(
        [
            ("host", pa.string()),
            ("layout", pa.int64()),
            ("key", pa.binary()),
            ("node", pa.int64()),
            ("near", pa.bool_()),
            *((c, pa.int64()) for c in ("pages", "same", "chars", "nodes")),
            ("tree", pa.binary()),
        ]
    )
    kinds = (
        "host string, layout bigint, key binary, node bigint, near boolean, pages bigint, same bigint, "
        "chars bigint, nodes bigint, tree binary"
    )
    return rows.mapInArrow(compare, kinds)


def _judge(references: DataFrame, compared: DataFrame) -> DataFrame:
    counted = (
        compared.where("node is not null")
        .groupBy("host", "layout", "node", "near")
        .agg(*(F.sum(c).alias(c) for c in ("pages", "same", "chars")))
        .groupBy("host", "layout")
        .agg(F.collect_list(F.struct("node", "near", "pages", "same", "chars")).alias("said"))
    )  # a layout has as many nodes as its reference
    judged = references.join(counted, ["host", "layout"], "left").select("host", "layout", "tree", "said")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forget_shapes()
            roots, templates = [], []
            for reference, said in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                made_ = Wrapper.of(Tree.unpack(reference), [tuple(x.values()) for x in said or []])
                roots.append(made_.root)
                templates.append(np.packbits(made_.template).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(roots, pa.int32()), pa.array(templates, pa.binary())],
                names=["host", "layout", "reference", "root", "template"],
            )

    kinds = "host string, layout bigint, reference binary, root int, template binary"
    return materialize(judged.mapInArrow(judge, kinds), "wrappers")


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    wrappers: DataFrame | None = None,
) -> DataFrame:
    """``id_col``, ``url_col``, ``text`` and ``n_chars`` (code points) of every page. With wrappers
    from other pages, a page that fits none of its host's is searched alone."""
    trees_ = trees(pages, url_col, html_col)
    if wrappers is None:
        wrappers, others = _induce(trees_)
    else:
        others = _assign(trees_, wrappers)
    others = materialize(
        trees_.join(others, ["host", "key"]).select("host", "page", "layout").distinct(), "others"
    )
    markup = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    source = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        host(url_col).alias("host"),
        F.unhex(F.md5(markup)).alias("page"),
        markup.alias("html"),
    )
    packed = T.StructType([*source.schema.fields[:4], T.StructField("packed", T.BinaryType())])
    result = T.StructType(
        [*source.schema.fields[:2], *T.StructType.fromDDL("text string, n_chars bigint")]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            pages_ = [tool.compress(p.as_py().encode()) for p in batch.column(4)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(pages_, pa.binary())], names=packed.names
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            forget_shapes()
            known: dict[tuple[str, int], list[Wrapper]] = {}
            texts, held = [], 0
            for i, at in enumerate(zip(*(batch.column(c).to_pylist() for c in ("host", "layout")), strict=True)):
                if held > NODES or len(_LABEL_OF) + len(_SCORES) > SHAPES:
                    forget_shapes()
                    known.clear()
                    held = 0
                if at not in known:
                    wrapper = [batch.column(c)[i].as_py() for c in ("reference", "root", "template")]
                    known[at] = [Wrapper.read(*wrapper)] if wrapper[0] else []
                    held += sum(len(w.tree.labels) for w in known[at])
                page = tool.decompress(batch.column("packed")[i].as_py()).decode()
                texts.append(extract(page, known[at]) if page else "")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=result.names,
            )

    found = (
        source.mapInArrow(pack, packed)
        .join(others, ["host", "page"], "left")
        .withColumn("layout", F.coalesce("layout", F.lit(0).cast("bigint")))
        .join(wrappers, ["host", "layout"], "left")
        .select("id", "url", "host", "layout", "packed", "reference", "root", "template")
        .mapInArrow(run, result)
    )
    return found.toDF(id_col, url_col, "text", "n_chars")
