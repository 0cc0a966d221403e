"""Benchmark decontamination with suffix arrays of the training documents.

Documents are cut into shards, and each shard's words get a suffix array: the places of words
in the order of the word sequences that begin there.  Every suffix of every benchmark item is
binary-searched in it, word by word, which gives its longest verbatim match and all places of
it, and the places of the item's windows.  A document hit by a window is contaminated.

The suffix array leaves out places where neither the word nor its successor lets a benchmark
suffix match, and orders the rest to the depth of the longest item; both leave every search's
outcome as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.session import written

from .base import ALPHANUMERIC, row_blocks, table, text_buffer, word_hashes

WINDOW = 10
#: Bytes of documents that a shard holds; a longer document is a shard of its own.
SHARD_BYTES = 4 << 20
#: Words of benchmark items that are searched at once; more are searched in further blocks.
BLOCK_WORDS = 2_000_000


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Blocks of items: item_ids, word hashes of all, and where each item begins and the last ends.

    Items come to the driver a block at a time.  Items without words are left out.
    """
    ids, words, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where("text is not null")
    for row in rows.toLocalIterator():
        data, offsets = text_buffer(pa.array([row["text"]]))
        hashes = word_hashes(data, offsets, ALPHANUMERIC)[0]
        if len(hashes):
            ids.append(row["item_id"])
            words.append(hashes)
            size += len(hashes)
        if size >= block_words:
            yield ids, np.concatenate(words), np.cumsum([0, *map(len, words)])
            ids, words, size = [], [], 0
    if ids:
        yield ids, np.concatenate(words), np.cumsum([0, *map(len, words)])


def suffix_order(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """The places, ordered by the words that follow from each, to a depth.

    Groups of equal beginnings are refined by one further word at a time; those of one place
    are done.  ``words`` ends with ``depth`` words at least that no document has.
    """
    order = places[np.argsort(words[places], kind="stable")]
    group = np.zeros(len(order), dtype=np.int64)
    group[1:] = np.cumsum(words[order[1:]] != words[order[:-1]])
    active = np.arange(len(order))
    for k in range(1, depth):
        g = group[active]
        same = np.zeros(len(g), dtype=bool)
        same[1:] |= g[1:] == g[:-1]
        same[:-1] |= g[1:] == g[:-1]
        active, g = active[same], g[same]
        if not len(active):
            break
        keys = words[order[active] + k]
        by = np.lexsort((keys, g))
        order[active] = order[active][by]
        keys = keys[by]
        new = np.zeros(len(g), dtype=np.int64)
        new[1:] = np.cumsum((g[1:] != g[:-1]) | (keys[1:] != keys[:-1]))
        group[active] = new  # only compared within the active places
    return order


def bound(words: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Binary search, for all queries at once, of the word wanted at a depth within [low, high)."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        found = words[order[np.minimum(middle, len(order) - 1)] + depth]
        right = open_ & ((found <= wanted) if after else (found < wanted))
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)


def search(words: np.ndarray, order: np.ndarray, items: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """For every item suffix: longest match, its range of the order, and the range at the window's length.

    A suffix shorter than the window has a window range only if it is its whole item.
    """
    lengths = np.diff(bounds)
    starts = np.arange(len(items))
    item = np.repeat(np.arange(len(lengths)), lengths)
    left = bounds[1:][item] - starts
    needs = np.minimum(window, lengths[item])
    n = len(items)
    longest, low, high = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, len(order))
    window_low, window_high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    alive = np.arange(n)
    for k in range(int(left.max(initial=0))):
        alive = alive[left[alive] > k]
        wanted = items[starts[alive] + k]
        a = bound(words, order, low[alive], high[alive], k, wanted, after=False)
        b = bound(words, order, a, high[alive], k, wanted, after=True)
        hit = b > a
        alive, a, b = alive[hit], a[hit], b[hit]
        if not len(alive):
            break
        longest[alive], low[alive], high[alive] = k + 1, a, b
        full = needs[alive] == k + 1
        window_low[alive[full]], window_high[alive[full]] = a[full], b[full]
    return item, longest, low, high, window_low, window_high


def matches(documents: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The columns to keep of every document, and ``_found``: what of the benchmark it holds.

    ``_found.n_words`` counts its words; ``_found.spans`` are the maximal runs (start, length)
    of words inside occurrences of windows; ``_found.items`` are, for each item with occurring
    windows, item_id, the length of its longest verbatim match in the document's shard, and
    the word where its first window begins here.

    Every row gives a row.  Null and empty texts have no words.  An item shorter than the
    window, but with words, is one window; repeated items are found each.  Benchmarks of more
    than ``block_words`` are searched block after block, and a block's outcome is written.
    """
    kept = documents.select("text", *[c for c in keep if c != "text"])
    empty = "struct(0L as n_words, cast(array() as array<struct<start:long,length:long>>) as spans, cast(array() as array<struct<item_id:string,longest:long,start:long>>) as items)"
    found = kept.withColumn("_found", F.expr(empty))
    blocks = item_blocks(benchmark, block_words)
    block = next(blocks, ([None], np.zeros(1, np.uint64), np.array([0, 1])))
    while block is not None:
        following = next(blocks, None)
        out = found if following else found.select("_found", *keep)
        found = found.mapInArrow(searcher(*block, window, out.columns), out.schema)
        if following:
            found = written(found, "matches")
        block = following
    return found.select(*keep, "_found")


def searcher(ids: list, items: np.ndarray, bounds: np.ndarray, window: int, columns: list[str]):
    """A function on Arrow batches that adds what one block of items has in their texts."""
    depth = int(np.diff(bounds).max())
    vocabulary = np.unique(items)
    # A word that no item has stands between documents.
    gap = np.setdiff1d(np.arange(len(vocabulary) + 1, dtype=np.uint64), vocabulary)[0]
    inner = np.ones(len(items), dtype=bool)
    inner[bounds[1:] - 1] = False
    at = np.flatnonzero(inner)
    pairs = np.unique(items[at] * np.uint64(3) + items[np.minimum(at + 1, len(items) - 1)])
    singles = np.unique(items[bounds[:-1][np.diff(bounds) == 1]])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for i, j in row_blocks(offsets, SHARD_BYTES):
                hashes, rows, _, _ = word_hashes(data, offsets[i : j + 1], ALPHANUMERIC)
                part = batch.slice(i, j - i)
                found = shard(hashes, rows, part.column("_found").to_pylist())
                arrays = [pa.array(found, FOUND) if c == "_found" else part.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

    def shard(hashes: np.ndarray, rows: np.ndarray, before: list[dict]) -> list[dict]:
        n = len(before)
        counts = np.bincount(rows, minlength=n)
        begins = np.cumsum(counts) - counts + np.arange(n)
        words = np.full(len(hashes) + n + depth + 1, gap, dtype=np.uint64)
        places = np.arange(len(hashes)) + rows
        words[places] = hashes
        candidates = places[np.isin(hashes, vocabulary)]
        here = np.isin(words[candidates] * np.uint64(3) + words[candidates + 1], pairs) | np.isin(words[candidates], singles)
        order = suffix_order(words, candidates[here], depth)
        out = [x | {"n_words": int(k)} for x, k in zip(before, counts, strict=True)]
        if not len(order):
            return out
        item, longest, _, _, low, high = search(words, order, items, bounds, window)
        best = np.zeros(len(ids), np.int64)
        np.maximum.at(best, item, longest)
        hit = np.flatnonzero(high > low)
        sizes = (high - low)[hit]
        which = np.repeat(hit, sizes)
        at = order[np.arange(int(sizes.sum())) + np.repeat(low[hit] - (np.cumsum(sizes) - sizes), sizes)]
        row = np.searchsorted(begins, at, side="right") - 1
        start, item = at - begins[row], item[which]
        width = np.minimum(window, np.diff(bounds)[item])
        by = np.lexsort((start, item, row))
        row, start, item, width = row[by], start[by], item[by], width[by]
        cuts = np.flatnonzero(np.diff(row, prepend=-1, append=n))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            x = out[row[a]]
            old = x["spans"]
            s = np.concatenate([start[a:b], [y["start"] for y in old]]).astype(np.int64)
            e = np.concatenate([start[a:b] + width[a:b], [y["start"] + y["length"] for y in old]]).astype(np.int64)
            first = a + np.flatnonzero(np.diff(item[a:b], prepend=-1))
            new = [{"item_id": ids[item[k]], "longest": int(best[item[k]]), "start": int(start[k])} for k in first]
            x |= {"spans": [{"start": p, "length": q - p} for p, q in merged(s, e)], "items": x["items"] + new}
        return out

    return find


FOUND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
        ("items", pa.list_(pa.struct([("item_id", pa.string()), ("longest", pa.int64()), ("start", pa.int64())]))),
    ]
)


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the ranges, which may overlap or touch."""
    by = np.argsort(starts, kind="stable")
    starts, reach = starts[by], np.maximum.accumulate(ends[by])
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]]))
    return list(zip(starts[new].tolist(), reach[np.append(new[1:], len(starts)) - 1].tolist(), strict=True))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated."""
    found = matches(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), benchmark, ["doc_id"], window)
    ids = F.array_sort(F.transform("_found.items", lambda x: x["item_id"]))
    ids = F.filter(ids, lambda x: x.isNotNull())
    hit = F.aggregate("_found.spans", F.lit(0).cast("long"), lambda n, x: n + x["length"])
    return found.select(
        "doc_id",
        F.col("_found.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"),
        (F.size("_found.spans") > 0).alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that hold no window of any item, with all their columns.

    Texts alone are searched, and only the hashes of contaminated ones come back; the
    documents that have such a text are then left out.
    """
    first, second = (lambda x: F.xxhash64(x)), (lambda x: F.xxhash64(F.lit(1), x))
    texts = documents.select(F.col("text").cast("string").alias("text")).where("text is not null")
    texts = texts.select(first("text").alias("h1"), second("text").alias("h2"), "text")
    hits = matches(texts, benchmark, ["h1", "h2"], window).where(F.size("_found.spans") > 0)
    hits = written(hits.select("h1", "h2").distinct(), "contaminated")
    text = documents["text"].cast("string")
    return documents.join(hits, (first(text) == hits["h1"]) & (second(text) == hits["h2"]), "left_anti")


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


OP8_SQL = r"""
WITH lowered AS (
  SELECT 'd' AS kind, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
words AS (SELECT kind, id, coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM lowered),
windows AS (
  SELECT kind, id, unnest(range(1, len(w) - least(k, len(w)) + 2)) AS i, k, w
  FROM words, (SELECT DISTINCT least(10, len(w)) AS k FROM words WHERE kind = 'b' AND len(w) > 0) WHERE len(w) >= k),
items AS (SELECT DISTINCT id AS item_id, k, array_to_string(w[i:i+k-1], ' ') AS s FROM windows WHERE kind = 'b' AND k = least(10, len(w))),
places AS (SELECT id AS doc_id, i, k, array_to_string(w[i:i+k-1], ' ') AS s FROM windows WHERE kind = 'd'),
hits AS (SELECT doc_id, i, k, item_id FROM places JOIN items USING (k, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
per AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.id AS doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words d LEFT JOIN hit ON d.id = hit.doc_id LEFT JOIN per ON d.id = per.doc_id WHERE d.kind = 'd'
"""
