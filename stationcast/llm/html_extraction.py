"""HTML extraction by wrapper induction.

Pages of one host are aligned by simple tree matching, in blocks of bounded size, into a
wrapper: a tree whose nodes know on how many pages they stand and which text could be constant.
The wrappers of a host's blocks are aligned with each other, round by round, into one.  Then every
page is matched with its host's wrapper.  A leaf whose text is the same on most pages of the host
is template, and goes from the pages whose leaf it is; the other leaves are slots, and what stands
in them, or has no place in the wrapper, is content.
Tags and class words are a second vote among what varies: blocks in an article are preferred,
and asides go, unless little of the page's text would be left.  Pages of one host and body are
copies and count once.  A page of which nothing varies keeps what is no aside.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.session import written

from .base import gathered, table
from .dom import TEXT, Shape, digest, elected, parse, read, simple_tree_matching, weigh

#: Pages that are aligned with each other, about.
BLOCK_PAGES = 64
#: Wrappers that are aligned with each other at once.
BLOCK_WRAPPERS = 16
#: Nodes on a smaller part of a block's pages leave its wrapper, which so stays of the size of a few pages.
RARE = 0.25
#: A text is template if it stands at its leaf on this part of a host's different pages, and on so many.
SHARE = 0.6
LEAST_PAGES = 4
#: Tags and class words are void where they would leave less than this part of a page's text.
LEAST_TEXT = 0.1


class Wrapper:
    """The tree of the pages aligned so far."""

    __slots__ = ("root", "places")

    def __init__(self, first: Shape) -> None:
        self.root = first
        #: By node, its place among the nodes, once it is asked for.
        self.places: dict[int, int] | None = None

    def add(self, other: Shape) -> None:
        """Align a page, or another wrapper; nodes without a partner are inserted after those before them."""
        pairs = simple_tree_matching(self.root, other)
        partner = {id(y): x for x, y in pairs}
        self.places = None
        grows = []  # parents first; what is below equal nodes stays
        for x, y in pairs:
            if x.key != y.key:
                grows.append(x)
                place = {id(c): i for i, c in enumerate(x.children)}
                grown, at = [], 0
                for child in y.children:
                    if id(child) in partner:
                        i = place[id(partner[id(child)])] + 1
                        grown += x.children[at:i]
                        at = i
                    else:
                        grown.append(child)
                x.children = grown + x.children[at:]
        for x, y in pairs:
            x.pages += y.pages
            if x.text == y.text:
                x.votes += y.votes
            elif y.votes > x.votes:  # the text that may be on more than half of the pages, as majority votes tell
                x.text, x.votes = y.text, y.votes - x.votes
            else:
                x.votes -= y.votes
        weigh(grows)

    def pruned(self, share: float) -> Shape:
        """The tree without nodes on less than a share of the pages."""
        self.places = None
        stack = [self.root]
        while stack:
            at = stack.pop()
            at.children = [c for c in at.children if c.pages >= share * self.root.pages]
            stack += at.children
        return self.root.seal()

    def counts(self) -> Iterator[tuple[int, int]]:
        """(leaf, pages) of the leaves, by their place among the nodes."""
        for i, node in enumerate(self.root.nodes()):
            if node.label == TEXT:
                yield i, node.pages

    def constants(self, page: Shape) -> Iterator[tuple[int, int]]:
        """(leaf, block) where the page has the text that may be constant: place of the leaf among the
        wrapper's nodes, and of the block in the page."""
        if self.places is None:
            self.places = {id(x): i for i, x in enumerate(self.root.nodes())}
        block = {id(y): i for i, y in enumerate(y for y in page.nodes() if y.label == TEXT)}
        for x, y in simple_tree_matching(self.root, page):
            if y.label == TEXT and x.text == y.text:
                yield self.places[id(x)], block[id(y)]


def hosted(pages: DataFrame) -> DataFrame:
    """Pages with their host (empty if the url has none)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"), F.col("html").cast("string"), host.alias("host"))


def page_shapes(pages: DataFrame) -> DataFrame:
    """(host, page_id, body, shape): the tree of each page for matching, and a digest of its texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for host, page, html in zip(*(batch.column(c) for c in ("host", "page_id", "html")), strict=True):
                found, votes, shape = read(parse(html.as_py()))
                body = digest("\n".join(b.text for b in elected(found, votes, LEAST_TEXT)))
                yield host.as_py(), page.as_py(), body, json.dumps(shape.flat(), separators=(",", ":"))

    schema = pa.schema([("host", pa.string()), ("page_id", pa.int64()), ("body", pa.int64()), ("shape", pa.string())])
    found = pages.where("html is not null").select("host", "page_id", "html")
    return found.mapInArrow(lambda b: gathered(rows(b), schema), "host string, page_id long, body long, shape string")


def grown(flat: str) -> Shape:
    return Shape.grown(json.loads(flat))


def induce(rows: pa.Table) -> pa.Table:
    """The wrapper of a block of pages, or of wrappers."""
    shapes = map(grown, sorted(rows["shape"].to_pylist()))
    wrapper = Wrapper(next(shapes))
    for shape in shapes:
        wrapper.add(shape)
    flat = json.dumps(wrapper.pruned(RARE).flat(), separators=(",", ":"))
    return pa.table({"host": rows["host"][:1].cast(pa.string()), "block": rows["block"][:1].cast(pa.int64()), "shape": pa.array([flat], pa.string())})


def matches(pages: pa.Table, wrappers: pa.Table) -> pa.Table:
    """Pages of a block on which each leaf of the host's wrapper has its constant text."""
    found: Counter = Counter()
    if wrappers.num_rows and pages.num_rows:
        wrapper = Wrapper(grown(wrappers["wrapper"][0].as_py()))
        for page in pages["shape"].to_pylist():
            found.update(leaf for leaf, _ in wrapper.constants(grown(page)))
    hosts = [pages["host"][0].as_py()] * len(found) if found else []
    return pa.table({"host": pa.array(hosts, pa.string()), "leaf": pa.array(list(found), pa.int64()), "n": pa.array(list(found.values()), pa.int64())})


def wrappers_of(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(host, wrapper, template): each host's wrapper and the leaves of it that are template."""
    # Of copies, the least page_id's; a host's different pages don't depend on its size.
    first = F.min_by("shape", F.struct("page_id", F.xxhash64("shape"))).alias("shape")
    different = written(page_shapes(pages).groupBy("host", "body").agg(first), "shapes")
    sizes = different.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    sizes = written(sizes.withColumn("blocks", F.ceil(F.col("pages") / BLOCK_PAGES)), "sizes")
    blocked = different.join(sizes, "host").select("host", "shape", F.pmod(F.xxhash64("body"), "blocks").alias("block"))
    known = written(blocked.groupBy("host", "block").applyInArrow(induce, "host string, block long, shape string"), "wrappers")
    left = sizes.agg(F.max("blocks")).first()[0] or 0
    while left > 1:
        above = known.withColumn("block", F.floor(F.col("block") / BLOCK_WRAPPERS))
        known = written(above.groupBy("host", "block").applyInArrow(induce, "host string, block long, shape string"), "wrappers")
        left = -(-left // BLOCK_WRAPPERS)
    known = known.select("host", F.col("shape").alias("wrapper"))
    each = known.join(sizes, "host").select("host", "wrapper", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    counts = blocked.groupBy("host", "block").cogroup(each.groupBy("host", "block")).applyInArrow(matches, "host string, leaf long, n long")
    counts = counts.groupBy("host", "leaf").agg(F.sum("n").alias("n")).join(sizes, "host")
    constant = counts.where((F.col("n") >= LEAST_PAGES) & (F.col("n") >= share * F.col("pages")))
    return known.join(constant.groupBy("host").agg(F.collect_list("leaf").alias("template")), "host")


def main_text(html: str, wrapper: Wrapper | None = None, template: Iterable[int] = ()) -> str:
    """The page's blocks that are not template, less those voted aside, joined by empty lines."""
    found, votes, shape = read(parse(html))
    varying = found
    if wrapper:
        leaves = set(template)
        gone = {block for leaf, block in wrapper.constants(shape) if leaf in leaves}
        varying = [b for i, b in enumerate(found) if i not in gone]
    chosen = elected(varying, votes, LEAST_TEXT) or elected([b for b in found if b.vote < 0], votes, LEAST_TEXT)
    return "\n\n".join(b.text for b in chosen)


EXTRACTED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def extracted(pages: pa.Table, wrappers: pa.Table) -> pa.Table:
    """Main texts of a block of a host's pages."""
    wrapper, template = None, ()
    if wrappers.num_rows:
        wrapper, template = Wrapper(grown(wrappers["wrapper"][0].as_py())), wrappers["template"][0].as_py()
    texts = [main_text(html.as_py() or "", wrapper, template) for html in pages["html"]]
    return pa.Table.from_arrays([pages["page_id"].cast(pa.int64()), pages["url"].cast(pa.string()), pa.array(texts, pa.string())], schema=EXTRACTED)


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url and the main text (empty if none).

    Every row gives a row; null html is empty.  Hosts of fewer than a few different pages have
    no template.  Repeated rows count once for templates.  Other columns are ignored.
    """
    pages = hosted(pages)
    known = written(wrappers_of(pages), "templates")
    blocks = pages.groupBy("host").agg(F.ceil(F.count("*") / BLOCK_PAGES).alias("blocks")).join(known.select("host"), "host", "left_semi")
    blocks = written(blocks, "blocks")
    # Pages of hosts without a template need no partner; they spread by their number alone.
    numbered = pages.withColumn("_row", F.xxhash64(F.monotonically_increasing_id())).join(blocks, "host", "left")
    alone = numbered.where("blocks is null").select("page_id", "url", "html")
    blocked = numbered.where("blocks is not null").select("host", "page_id", "url", "html", F.pmod("_row", "blocks").alias("block"))
    each = known.join(blocks, "host").select("host", "wrapper", "template", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    wrapped = blocked.groupBy("host", "block").cogroup(each.groupBy("host", "block")).applyInArrow(extracted, "page_id long, url string, text string")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for page, url, html in zip(*(batch.column(c) for c in ("page_id", "url", "html")), strict=True):
                yield page.as_py(), url.as_py(), main_text(html.as_py() or "")

    return wrapped.unionByName(alone.mapInArrow(lambda b: gathered(rows(b), EXTRACTED), "page_id long, url string, text string"))


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
