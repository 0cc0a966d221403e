"""Small HTML trees: parsing, blocks of text, and simple tree matching."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b
from heapq import heapify, heappop, heappush
from html import unescape
from itertools import islice, pairwise
from math import isqrt
from typing import NamedTuple

import numpy as np

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object canvas audio video xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
ASIDE = frozenset("nav aside footer form button select menu dialog label fieldset input".split())
#: A start tag of the key ends an open element of these, up to the nearest of the limits.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = frozenset("ul ol dl table select div section article main body html".split())
#: Words in class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments commentary cookie cookies "
    "consent disqus footer header masthead menu modal nav navbar navigation newsletter notice notification pagination popup "
    "promo promoted promotion related respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget "
    "alert complementary contentinfo search".split()
)

#: A whole tag without ``<`` in its attributes; a try looks no farther than the next ``<``.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>\"']*+)((?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>")
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_UNQUOTED = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"(?i)\b(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


@lru_cache(4096)
def _marks(attributes: str) -> tuple[str, bool]:
    """(class, id and role without numbers, whether they mark what is not the article) of a tag."""
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    names = " ".join(values.get(k, "") for k in ("class", "id", "role")).lower()
    marked = bool(names.strip()) and not MARKS.isdisjoint(re.split(r"[^a-z]+", names))
    shown = values.get("style", "").replace(" ", "").lower()
    marked |= "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in shown
    return re.sub("[0-9]+", "0", names.strip()), marked


class Node:
    __slots__ = ("tag", "label", "marked", "children")

    def __init__(self, tag: str, attributes: str = "") -> None:
        self.tag, self.label, self.marked = tag, tag, False
        self.children: list[Node | str] = []
        if attributes and not attributes.isspace():
            marks = _marks if len(attributes) < 200 else _marks.__wrapped__
            names, self.marked = marks(attributes)
            if names:
                self.label = f"{tag}.{names}"


class Tokens:
    """Tags of a page from left to right; no character is looked at more than a few times.

    A tag ends at the first ``>`` that isn't quoted.  If quotes run to the end of the page, they are
    ignored from then on.  A comment that isn't closed takes the rest; after the last ``>`` all is text.
    """

    def __init__(self, html: str) -> None:
        self.html, self.at, self.quotes, self.last = html, 0, True, html.rfind(">")

    def end(self, at: int) -> int:
        """Position of the ``>`` that ends the tag whose name ends here."""
        start = at
        while self.quotes:
            at = _UNQUOTED.match(self.html, at).end()
            if at < len(self.html) and self.html[at] == ">":
                return at
            closing = self.html.find(self.html[at], at + 1) if at < len(self.html) else -1
            if closing < 0:
                self.quotes = False
            at = closing + 1
        return self.html.find(">", start)

    def next(self) -> tuple[str, bool, str, str] | None:
        """(text before, whether it is an end tag, name, attributes) of the next tag; None at the last ``>``."""
        html, start = self.html, self.at
        at = start
        while True:
            at = html.find("<", at)
            m = at >= 0 and _TAG.match(html, at)
            if m:
                self.at = m.end()
                ending, name, attributes = m.groups()
                return html[start:at], bool(ending), name.lower(), attributes
            if at < 0 or at > self.last and not html.startswith("<!--", at):
                return None
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                self.at = len(html) if end < 0 else end + 3
                return html[start:at], False, "", ""
            if html[at + 1 : at + 2] in ("!", "?"):
                self.at = html.find(">", at) + 1
                return html[start:at], False, "", ""
            m = _NAME.match(html, at + 1)
            if m:
                end = self.end(m.end())
                self.at = end + 1
                return html[start:at], bool(m[1]), m[2].lower(), html[m.end() : end]
            at += 1


def parse(html: str) -> Node:
    """A tree of any text and depth; elements that are never closed end where their parent does."""
    root = Node("html")
    path = [root]
    opened: dict[str, int] = {}
    tokens = Tokens(html)

    def close(k: int) -> None:
        for x in path[k:]:
            opened[x.tag] -= 1
        del path[k:]

    while True:
        token = tokens.next()
        if token is None:
            path[-1].children.append(html[tokens.at :])
            return root
        text, ending, tag, attributes = token
        if text:
            path[-1].children.append(text)
        if not tag:
            continue
        if ending:
            if path[-1].tag == tag and len(path) > 1:
                opened[tag] -= 1
                del path[-1]
            elif opened.get(tag):
                close(next(k for k in range(len(path) - 1, 0, -1) if path[k].tag == tag))
            continue
        if tag in ("html", "body", "head"):
            continue
        if opened.get("p") and tag in BLOCK:  # ends a paragraph that is open
            for k in range(len(path) - 1, 0, -1):
                if path[k].tag == "p":
                    close(k)
                    break
                if path[k].tag in BLOCK:
                    break
        if tag in ENDS and any(opened.get(x) for x in ENDS[tag]):
            for k in range(len(path) - 1, 0, -1):
                if path[k].tag in ENDS[tag]:
                    close(k)
                    break
                if path[k].tag in LIMITS and path[k].tag != "table":
                    break
        node = Node(tag, attributes)
        path[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, tokens.at)
            tokens.at = end.end() if end else len(html)
        elif tag not in VOID and not attributes.endswith("/"):
            path.append(node)
            opened[tag] = opened.get(tag, 0) + 1


def aside(node: Node, within: bool) -> bool:
    """Whether tag or class words tell that an element isn't the article's; a header may be, inside one."""
    if node.tag in RAW or node.tag in ASIDE or node.tag == "header" and not within:
        return True
    return node.marked and node.tag not in ("article", "main", "html")


def digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


#: Label of a run of text.
TEXT = "#"
# How matchings are computed; none of these changes what is found.
#: Pairs of children up to which their lists are matched node by node, not row by row.
CELLS = 1 << 12
#: Pairs of nodes from which on they are told by kinds.
ALL_CELLS = 1 << 20
#: Nodes of a kind whose texts are told by pair.
SMALL = 256
#: Numbers of a long row that are compared one after the other, in stripes.
FOLD = 16
#: Numbers of tables that are kept until pairs are chosen; others are computed again.
KEPT_CELLS = 1 << 22


class Shape:
    """A tree for matching, of one page or of a wrapper: elements with their label, and runs of text as leaves.

    ``text`` is the digest of a leaf's text; in a wrapper it is the only one that can stand on more than half of
    the leaf's pages, ``votes`` ahead of all others.  ``pages`` counts the pages that have the node.
    """

    __slots__ = ("label", "text", "pages", "votes", "children", "size", "key", "plain")

    def __init__(self, label: str, text: int = 0, pages: int = 1, votes: int = 1) -> None:
        self.label, self.text, self.pages, self.votes = label, text, pages, votes
        self.children: list[Shape] = []
        self.size = self.key = 0
        self.plain = False

    def nodes(self) -> list[Shape]:
        """All nodes, parents first, in page order."""
        out, stack = [], [self]
        while stack:
            at = stack.pop()
            out.append(at)
            if at.children:
                stack += at.children[::-1]
        return out

    def seal(self) -> Shape:
        """Weigh all subtrees; equal ones, texts included, get equal keys."""
        weigh(self.nodes())
        return self

    def flat(self) -> list:
        """[label, text, pages, votes, number of children] of each node, parents first."""
        return [[x.label, x.text, x.pages, x.votes, len(x.children)] for x in self.nodes()]

    @staticmethod
    def grown(flat: list) -> Shape:
        root = Shape(*flat[0][:4])
        left = [(root, flat[0][4])]
        for *own, n in flat[1:]:
            while not left[-1][1]:
                left.pop()
            parent, k = left.pop()
            left.append((parent, k - 1))
            parent.children.append(Shape(*own))
            left.append((parent.children[-1], n))
        return root.seal()


def weigh(nodes: list[Shape]) -> None:
    """Weigh the subtrees of nodes, parents first; what is below them else is weighed already."""
    for x in reversed(nodes):
        children = x.children
        if children:
            x.size = 1 + sum([c.size for c in children])
            x.key = hash((x.label, x.text, *[c.key for c in children]))
            x.plain = len(children) == 1 and children[0].label == TEXT
        else:
            x.size = 2 if x.label == TEXT else 1
            x.key = hash((x.label, x.text))
            x.plain = False


class Block(NamedTuple):
    """A run of text of an element: whether it is mostly links, the innermost
    element around it that is voted aside (-1 if none), and whether it is in an article or main element."""

    text: str
    linked: bool
    vote: int
    article: bool
    main: bool


class Votes:
    """Elements voted aside: of each, the one around it (-1 if none) and whether the outermost is in an article or main."""

    def __init__(self) -> None:
        self.above: list[int] = []
        self.inner: list[bool] = []

    def add(self, above: int, inner: bool) -> int:
        self.above.append(above)
        self.inner.append(inner if above < 0 else self.inner[above])
        return len(self.above) - 1


class Run:
    """Text of one element that no other block interrupts."""

    __slots__ = ("parts", "linked", "shape", "vote", "article", "main")

    def __init__(self, shape: Shape, vote: int, article: bool, main: bool) -> None:
        self.parts: list[str] = []
        self.linked, self.shape, self.vote, self.article, self.main = 0, shape, vote, article, main

    def end(self, out: list[Block]) -> None:
        if not self.parts:
            return
        text = " ".join(unescape("".join(self.parts)).split())
        if text:
            out.append(Block(text, self.linked * 2 > len(text), self.vote, self.article, self.main))
            self.shape.children.append(Shape(TEXT, digest(text)))
        self.parts.clear()
        self.linked = 0


def read(root: Node) -> tuple[list[Block], Votes, Shape]:
    """All blocks of text in page order, what is voted aside, and the tree for matching, whose texts are the blocks in
    this order; no text is left out but raw ones."""
    out: list[Block] = []
    votes = Votes()
    top = Shape(root.label)
    run = Run(top, -1, False, False)
    stack = [(iter(root.children), run, False, True)]
    while stack:
        children, run, link, ends = stack[-1]
        for child in children:
            if isinstance(child, str):
                run.parts.append(child)
                run.linked += len(child) * link
            elif child.tag == "br" or child.tag in RAW:
                run.parts.append(" ")
            else:
                within = run.article or run.main
                voted = aside(child, within)
                vote = votes.add(run.vote, within) if voted else run.vote
                if child.tag in BLOCK:
                    run.end(out)
                    shape = Shape(child.label)
                    run.shape.children.append(shape)
                    own = Run(shape, vote, run.article or child.tag == "article", run.main or child.tag == "main")
                    stack.append((iter(child.children), own, link, True))
                elif voted:
                    run.parts.append(" ")
                    stack.append((iter(child.children), Run(run.shape, vote, run.article, run.main), link or child.tag == "a", True))
                else:
                    stack.append((iter(child.children), run, link or child.tag == "a", False))
                break
        else:
            stack.pop()
            if ends:
                run.end(out)
    return out, votes, top.seal()


def weight(found: list[Block]) -> int:
    """Characters of blocks that aren't mostly links."""
    return sum(len(b.text) for b in found if not b.linked)


def elected(found: list[Block], votes: Votes, least: float) -> list[Block]:
    """The blocks that tags and class words leave, outside of asides and in the article (else main) if there is one.

    A vote that would leave less than a share ``least`` of the text is void: then asides count as the page's
    own, those with most text first, until enough is left.
    """
    total = weight(found)
    own, under = [0] * len(votes.above), [0] * len(votes.above)
    inside: list[list[int]] = [[] for _ in votes.above]
    for b in found:
        if b.vote >= 0 and not b.linked:
            own[b.vote] += len(b.text)
    heap: list[tuple[int, int]] = []
    for v in range(len(own) - 1, -1, -1):
        under[v] += own[v]
        above = votes.above[v]
        if above >= 0:
            under[above] += under[v]
            inside[above].append(v)
        else:
            heap.append((-under[v], v))
    heapify(heap)
    open_ = {-1}
    kept = [b for b in found if b.vote < 0]
    in_article = weight([b for b in found if (b.article or b.main) and (b.vote < 0 or votes.inner[b.vote])])
    has = weight(kept)
    marked = weight([b for b in kept if b.article or b.main])
    held: dict[int, int] = Counter()
    for b in found:
        if b.vote >= 0 and not b.linked and (b.article or b.main):
            held[b.vote] += len(b.text)
    while heap and total and not (marked and marked >= least * in_article or has and has >= least * total):
        if not heap[0][0]:
            break
        _, v = heappop(heap)
        open_.add(v)
        has += own[v]
        marked += held[v]
        for k in inside[v]:
            heappush(heap, (-under[k], k))
    kept = [b for b in found if b.vote in open_]
    for some in ([b for b in kept if b.article], [b for b in kept if b.main]):
        if some and weight(some) >= least * weight(kept):
            return some
    return [b for b in kept if not b.linked] or kept  # no article element: menus are mostly links


Kind = Callable[[Shape, Shape], tuple[int, int]]
Weights = dict[tuple[int, int], int]


def _middle(x: Shape, y: Shape) -> tuple[int, int, int]:
    """Children that are equal in front, and the ends of both lists without those equal at the back.

    No matching weighs more than one that matches these with each other."""
    a, b = x.children, y.children
    front, p, q = 0, len(a), len(b)
    while front < min(p, q) and a[front].key == b[front].key:
        front += 1
    while min(p, q) > front and a[p - 1].key == b[q - 1].key:
        p, q = p - 1, q - 1
    return front, p, q


class Rows:
    """Weights of the best matchings in order of the first i and j of two lists, row by row."""

    def __init__(self, a: list[Shape], b: list[Shape], weights: Weights, kind: Kind) -> None:
        above = [0] * (len(b) + 1)
        self.rows = [above]
        labels = {d.label for d in b}
        for c in a:
            label, key, plain, below = c.label, c.key, c.plain, c.children
            if label not in labels:  # numbers don't fall along a row, so nothing changes
                self.rows.append(above)
                continue
            left, row = 0, [0]
            for d, both, best in zip(b, above, islice(above, 1, None), strict=False):
                if label == d.label:
                    if key == d.key:
                        both += c.size
                    elif plain and d.plain:  # elements of one text each, which differ
                        both += 2
                    else:
                        both += weights.get(kind(c, d), 1) if below and d.children else 1
                    if both > best:
                        best = both
                if best > left:
                    left = best
                row.append(left)
            self.rows.append(row)
            above = row
        self.total, self.cells = above[-1], len(a) * len(b)

    def rows_to(self, i: int) -> tuple[int, list]:
        """(number of the first row, rows up to the i-th at least)."""
        return 0, self.rows

    def end(self) -> None:
        """Lets go what was needed for the pairs."""

    def of(self, a: list[Shape], b: list[Shape]) -> Iterator[tuple[Shape, Shape]]:
        """The pairs of the best matching, of these lists or of others of the same kinds."""
        i, j = len(a), len(b)
        first, rows = self.rows_to(i)
        while i and j:
            if i == first:
                first, rows = self.rows_to(i)
            row, above = rows[i - first], rows[i - first - 1]
            if row[j] == above[j]:
                i -= 1
            elif row[j] == row[j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                yield a[i], b[j]
        self.end()


class Row:
    """A row of a long table: the number of column 1 + FOLD * q + r is at [r + 1, q], that of the column before at [r, q]."""

    __slots__ = ("folded",)

    def __init__(self, folded: np.ndarray) -> None:
        self.folded = folded

    def __getitem__(self, j: int) -> int:
        return int(self.folded[(j - 1) % FOLD + 1, (j - 1) // FOLD]) if j else 0


class LongRows(Rows):
    """The same for long lists: rows are arrays, and one in ``step`` is kept, from which those after it are computed again."""

    def __init__(self, a: list[Shape], b: list[Shape], weights: Weights, kind: Kind) -> None:
        self.a, self.b, self.weights, self.kind = a, b, weights, kind
        self.step = isqrt(len(a)) + 1
        self.width = -(-len(b) // FOLD)
        self.equal: dict[int, list[int]] = {}
        #: Of each label, the places of its nodes; of those with children, a node of every content and its places.
        self.places: dict[str, list[int]] = {}
        self.below: dict[str, dict[int, tuple[Shape, list[int]]]] = {}
        self.plain: dict[str, dict[int, tuple[Shape, list[int]]]] = {}
        for j, d in enumerate(b):
            at = j % FOLD * self.width + j // FOLD
            self.equal.setdefault(d.key, []).append(at)
            self.places.setdefault(d.label, []).append(at)
            if d.children and not d.plain:
                self.below.setdefault(d.label, {}).setdefault(d.key, (d, []))[1].append(at)
            if d.plain:
                self.plain.setdefault(d.label, {}).setdefault(d.key, (d, []))[1].append(at)
        self.least: dict[tuple[str, bool], np.ndarray] = {}
        self.known: dict[int, np.ndarray] = {}
        #: Where rows are put; two take turns until pairs are chosen.
        self.space: np.ndarray | None = np.empty((2, FOLD + 1, self.width), np.int32)
        row = Row(np.zeros((FOLD + 1, self.width), np.int32))
        self.kept = [row]
        for first in range(0, len(a), self.step):
            for row in self.following(row, first):
                pass
            row = Row(row.folded.copy())
            self.kept.append(row)
        self.space = None
        self.total, self.cells = row[len(b)], FOLD * self.width * len(self.kept)

    def least_weights(self, label: str, plain: bool) -> np.ndarray:
        """Weights of a node of the label with each of the other list, but for what is below them."""
        found = self.least.get((label, plain))
        if found is None:
            found = np.zeros(FOLD * self.width, np.int32)
            found[self.places.get(label, [])] = 1
            if plain:
                for _, at in self.plain.get(label, {}).values():
                    found[at] = 2
            self.least[label, plain] = found
        return found

    def weights_of(self, c: Shape) -> np.ndarray:
        """Weights of a node with each of the other list, but for equal ones."""
        if not c.children or c.label not in self.places or c.plain and c.label not in self.below:
            return self.least_weights(c.label, c.plain)
        found = self.known.get(c.key)
        if found is None:
            found = self.least_weights(c.label, c.plain).copy()
            some = [*self.below.get(c.label, {}).values(), *(() if c.plain else self.plain.get(c.label, {}).values())]
            weights = [self.weights.get(self.kind(c, d), 1) for d, _ in some]
            found[[k for _, at in some for k in at]] = np.repeat(weights, [len(at) for _, at in some])
            if (len(self.known) + 1) * len(self.b) > KEPT_CELLS:
                self.known.clear()
            self.known[c.key] = found
        return found

    def following(self, above: Row, first: int) -> Iterator[Row]:
        """The rows after the first-th, up to the next that is kept."""
        for k, c in enumerate(self.a[first : first + self.step]):
            before, over = above.folded[:-1], above.folded[1:]
            folded = self.space[k % len(self.space)]
            row = folded[1:]
            np.add(before, self.weights_of(c).reshape(before.shape), out=row)
            equal = self.equal.get(c.key)
            if equal:
                row.reshape(-1)[equal] = before.reshape(-1)[equal] + c.size
            np.maximum(row, over, out=row)
            for x, y in pairwise(row):
                np.maximum(x, y, out=y)
            folded[0, 0] = 0
            np.maximum.accumulate(row[-1, :-1], out=folded[0, 1:])
            np.maximum(row, folded[0], out=row)
            above = Row(folded)
            yield above

    def rows_to(self, i: int) -> tuple[int, list]:
        if self.space is None:
            self.space = np.empty((self.step, FOLD + 1, self.width), np.int32)
        k = (i - 1) // self.step
        return k * self.step, [self.kept[k], *self.following(self.kept[k], k * self.step)]


    def end(self) -> None:
        self.space = None


def _rows(a: list[Shape], b: list[Shape], weights: Weights, kind: Kind) -> Rows:
    return (Rows if len(a) * len(b) <= CELLS else LongRows)(a, b, weights, kind)


class Kinds:
    """What decides the weight of two nodes: their labels, and the texts that both have.

    Texts of one of them alone match none, whatever they are, so pairs of items of two lists are of few kinds.  Texts are
    told by pair where the nodes are small, else by tree.
    """

    def __init__(self, a: Shape, b: Shape) -> None:
        trees = [x.nodes() for x in (a, b)]
        ours, theirs = ({x.text for x in nodes if x.label == TEXT} for nodes in trees)
        shared = ours & theirs
        self.numbers: dict[tuple, int] = {}
        #: By kind, what it is made of, and its texts if it is small.
        self.parts: list[tuple] = []
        self.texts: list[frozenset | None] = []
        self.known: dict[int, int] = {}
        self.parted: dict[tuple[int, frozenset], int] = {}
        for nodes in trees:
            for x in reversed(nodes):
                below = (x.text if x.text in shared else None,) if x.label == TEXT else tuple([self.known[id(c)] for c in x.children])
                self.known[id(x)] = self.number(x.label, below, x.size <= SMALL)

    def number(self, label: str, below: tuple, small: bool) -> int:
        found = self.numbers.setdefault((label, below), len(self.parts))
        if found == len(self.parts):
            self.parts.append((label, below))
            if label == TEXT:
                self.texts.append(frozenset(below) - {None})
            else:
                self.texts.append(frozenset().union(*[self.texts[k] for k in below]) if small else None)
        return found

    def within(self, k: int, texts: frozenset) -> int:
        """A small kind with no other texts than these."""
        if self.texts[k] <= texts:
            return k
        texts &= self.texts[k]
        found = self.parted.get((k, texts))
        if found is None:
            label, below = self.parts[k]
            found = self.number(label, (None,) if label == TEXT else tuple([self.within(x, texts) for x in below]), True)
            self.parted[k, texts] = found
        return found

    def __call__(self, x: Shape, y: Shape) -> tuple[int, int]:
        k, m = self.known[id(x)], self.known[id(y)]
        ours, theirs = self.texts[k], self.texts[m]
        if ours is None or theirs is None:
            return k, m
        both = ours & theirs
        return self.within(k, both), self.within(m, both)


def _keys(x: Shape, y: Shape) -> tuple[int, int]:
    return x.key, y.key


def _weights(a: Shape, b: Shape, kind: Kind) -> tuple[Weights, dict[tuple[int, int], Rows]]:
    """Weight of the largest matching of every two kinds of elements that can be matched, and the tables of their children,
    as many as are kept."""
    order = {kind(a, b): (a, b)}
    left = [(a, b)]
    while left:
        x, y = left.pop()
        front, p, q = _middle(x, y)
        if front == p or front == q:
            continue
        mine: dict[str, dict[int, Shape]] = {}
        for c in x.children[front:p]:
            if c.children:
                mine.setdefault(c.label, {})[c.key] = c
        if not mine:
            continue
        other: dict[str, tuple[dict[int, Shape], dict[int, Shape]]] = {}
        for d in y.children[front:q]:
            if d.children and d.label in mine:
                other.setdefault(d.label, ({}, {}))[d.plain][d.key] = d
        for label, (rich, plain) in other.items():
            for k, c in mine[label].items():
                for some in (rich,) if c.plain else (rich, plain):
                    for m, d in some.items():
                        if k != m and (both := kind(c, d)) not in order:
                            order[both] = c, d
                            left.append((c, d))
    weights: Weights = {}
    tables: dict[tuple[int, int], Rows] = {}
    cells = 0
    # What is below an element is smaller; elements of one kind are of one size.
    for both, (x, y) in sorted(order.items(), key=lambda e: e[1][0].size):
        front, p, q = _middle(x, y)
        weights[both] = 1 + sum([c.size for c in x.children[:front]]) + sum([c.size for c in x.children[p:]])
        if front < p and front < q:
            rows = _rows(x.children[front:p], y.children[front:q], weights, kind)
            weights[both] += rows.total
            if cells + rows.cells <= KEPT_CELLS:
                cells += rows.cells
                tables[both] = rows
    return weights, tables


def simple_tree_matching(a: Shape, b: Shape) -> list[tuple[Shape, Shape]]:
    """The pairs of nodes of the heaviest matching of two trees with the same root label.

    Matched nodes have one label, keep their order, and their parents match; a pair counts one, or two if
    it is of equal texts.  Trees and lists of any size are matched whole.  Time grows with the product of lists
    between whose ends nodes differ, a row of a long list at a time, and pairs of one kind are weighed once; memory grows
    with the lists, their longest times the root of the other.
    """
    kind = Kinds(a, b) if a.key != b.key and a.size * b.size > ALL_CELLS else _keys
    weights, tables = ({}, {}) if a.key == b.key else _weights(a, b, kind)
    out, stack = [], [(a, b)]
    while stack:
        x, y = stack.pop()
        if x.key == y.key:
            out += zip(x.nodes(), y.nodes(), strict=True) if x.children else [(x, y)]
            continue
        out.append((x, y))
        if not x.children or not y.children:
            continue
        if x.plain and y.plain:
            out.append((x.children[0], y.children[0]))
            continue
        front, p, q = _middle(x, y)
        stack += zip(x.children[:front], y.children[:front], strict=True)
        stack += zip(x.children[p:], y.children[q:], strict=True)
        if front == p or front == q:
            continue
        rows = tables.get(kind(x, y))
        if rows is None:
            rows = _rows(x.children[front:p], y.children[front:q], weights, kind)
        stack += rows.of(x.children[front:p], y.children[front:q])
    return out
