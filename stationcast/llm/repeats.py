"""Suffix-array deduplication: remove bytes of substrings that occur earlier, keeping the first.

A string of ``length`` bytes that also starts earlier (smaller doc_id, or same document,
earlier start) is a repeat.  The earlier matches come from longest-previous-factor arrays:
in the suffix order of a bucket of segments, each suffix's previous and next neighbours of
smaller position hold its longest earlier match.

All suffixes of a corpus don't fit one order, so texts are cut into segments by anchors: in
each string of ``length`` bytes, the place of the least hash among its ``GRAM``-byte strings.
Equal strings have equal anchors, so they meet in the bucket of their anchor's hash; a
segment is the bytes of all strings that share one anchor.  Of segments that are equal
byte by byte, all but the first are repeats, and only the first goes on; only where an anchor
has several different segments are bytes fetched and suffixes sorted.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.session import written

from .base import BLOCK_BYTES, BYTE_VALUES, gathered, mixed, part_hashes, prefix_sums, row_blocks, table, text_buffer
from .decontamination import merged

LENGTH = 100
#: Bytes of the strings whose hashes choose anchors.
GRAM = 24
#: Anchors that a bucket holds about.
BUCKET_ROWS = 400_000
#: Segments that a bucket of the suffix sorting holds about.
BUCKET_SEGMENTS = 20_000

KEY = "doc_id long, mark long"  # a document: its id, and a hash of its text should rows share one
#: ``rest`` is the segment's hash and width, or where a range ends.
ANCHORS = f"bucket int, {KEY}, low int, hash long, rest long"
WIDTH = 8  # bits
RANGES = f"{KEY}, low int, high int"


def mark_of(text: bytes | np.ndarray) -> int:
    return int.from_bytes(blake2b(text, digest_size=8).digest(), "little", signed=True)


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones, by doubling."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Hash, segment hash, first and last start of the strings of each anchor of a text.

    Strings with the same anchor start next to each other.  Long texts are taken in parts
    that overlap, so that every string's start falls in one part.
    """
    out = []
    for at in range(0, len(data) - length + 1, BLOCK_BYTES):
        part = data[at : at + BLOCK_BYTES + length - 1]
        n = len(part) - length + 1
        sums = prefix_sums(part, BYTE_VALUES)
        grams = np.arange(len(part) - GRAM + 1)
        hashes = part_hashes(sums, grams, grams + GRAM)
        # Equal hashes within a string: the first place wins.
        places = np.uint64((1 << 24) - 1)
        least = sliding_minimum((hashes & ~places) | grams.astype(np.uint64), length - GRAM + 1)
        chosen = (least & places).astype(np.int64)
        cuts = np.flatnonzero(np.diff(chosen, prepend=-1, append=-1))
        low, high = cuts[:-1], cuts[1:] - 1
        out.append((hashes[chosen[low]], part_hashes(sums, low, high + length), low + at, high + at))
        assert high[-1] == n - 1
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def anchor_rows(documents: DataFrame, buckets: int, length: int) -> DataFrame:
    """Anchors of all texts, and ranges known to be repeats: rows whose hash is null.

    Within a batch, only the first of equal segments goes on; others are repeats at once, so
    a passage that many documents share meets in a bucket once a batch at most.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            ids = batch.column("doc_id")
            for i, j in row_blocks(offsets):
                found, docs, marks = [], [], []
                for r in range(i, j):
                    text = data[offsets[r] : offsets[r + 1]]
                    if len(text) >= length:
                        found.append(anchors(text, length))
                        docs.append(np.full(len(found[-1][0]), r))
                        marks.append(np.full(len(found[-1][0]), mark_of(text), np.int64))
                if found:
                    yield rows(ids, np.concatenate(docs), np.concatenate(marks), *(np.concatenate(x) for x in zip(*found, strict=True)))

    def rows(ids, docs, marks, hashes, segments, low, high) -> pa.RecordBatch:
        own = ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)[docs]
        by = np.lexsort((low, own, segments, hashes))
        h, s, o, lo = hashes[by], segments[by], own[by], low[by]
        again = np.zeros(len(by), dtype=bool)
        again[1:] = (h[1:] == h[:-1]) & (s[1:] == s[:-1])
        first = np.maximum.accumulate(np.where(again, 0, np.arange(len(by))))
        again &= (o[first] < o) | (lo[first] < lo)
        once, known = by[~again], np.sort(by[again])
        # Known ranges that follow each other are one; they go anywhere.
        new = np.ones(len(known), dtype=bool)
        new[1:] = (docs[known[1:]] != docs[known[:-1]]) | (low[known[1:]] != high[known[:-1]] + 1)
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(known)) - 1 if len(known) else start
        begins, ends = known[start], known[end]
        taken = np.concatenate([once, begins])
        width = (high - low)[once].astype(np.uint64)
        rest = np.concatenate([((segments[once] >> np.uint64(WIDTH)) << np.uint64(WIDTH) | width).astype(np.int64), high[ends]])
        spread = mixed(docs[begins].astype(np.uint64) + hashes[begins])
        bucket = np.concatenate([hashes[once], spread]) % np.uint64(buckets)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket.astype(np.int32)),
                ids.take(pa.array(docs[taken])),
                pa.array(marks[taken]),
                pa.array(low[taken].astype(np.int32)),
                pa.array(hashes[taken].astype(np.int64), mask=np.arange(len(taken)) >= len(once)),
                pa.array(rest),
            ],
            names=["bucket", "doc_id", "mark", "low", "hash", "rest"],
        )

    return documents.mapInArrow(find, ANCHORS)


def decide(rows: pa.Table) -> pa.Table:
    """Of a bucket's anchors: ranges that repeat, and segments to be compared byte by byte.

    Column ``group`` is null for a range; else the segment's anchor hash.
    """
    place, rest = rows["low"].to_numpy().astype(np.int64), rows["rest"].to_numpy()
    whole = rows["hash"].combine_chunks()
    known = whole.is_null().to_numpy(zero_copy_only=False)
    at = np.flatnonzero(~known)
    h, s = whole.fill_null(0).to_numpy()[at], rest[at] >> WIDTH
    own, low = rows["doc_id"].fill_null(-(1 << 63)).to_numpy()[at], place[at]
    by = np.lexsort((low, own, s, h))
    h, s, own, low, at = h[by], s[by], own[by], low[by], at[by]
    n = len(by)
    new_hash = np.ones(n, dtype=bool)
    new_hash[1:] = h[1:] != h[:-1]
    new = new_hash.copy()
    new[1:] |= s[1:] != s[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    again = ~new & ((own[first] < own) | (low[first] < low))
    # Segments of an anchor that has several.
    group = np.cumsum(new_hash) - 1
    several = np.bincount(group, weights=new, minlength=1)[group] > 1 if n else np.zeros(0, bool)
    compared = several & ~again
    take = np.flatnonzero(again | compared)
    row = np.concatenate([at[take], np.flatnonzero(known)])
    low = place[row]
    high = np.where(known[row], rest[row], low + (rest[row] & ((1 << WIDTH) - 1)))
    asked = np.zeros(len(row), dtype=bool)
    asked[: len(take)] = compared[take]
    return pa.table(
        {
            "doc_id": rows["doc_id"].take(pa.array(row)),
            "mark": rows["mark"].take(pa.array(row)),
            "low": pa.array(low.astype(np.int32)),
            "high": pa.array(high.astype(np.int32)),
            "group": pa.array(whole.fill_null(0).to_numpy()[row], mask=~asked),
        }
    )


def suffix_array(data: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of the ``length`` bytes from each, and how far each agrees with the one before.

    Eight bytes are compared at a time; groups of one are done.  Agreement counts whole
    eights, then the rest, to ``length``.
    """
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    steps = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]

    def key(at: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(eights[at]).view(">u8").ravel().astype(np.uint64)

    order = places.copy()
    group = np.zeros(len(order), np.int64)
    agrees = np.zeros(len(order), np.int64)
    active = np.arange(len(order))
    for step in steps:
        g = group[active]
        same = np.zeros(len(g), dtype=bool)
        same[1:] |= g[1:] == g[:-1]
        same[:-1] |= g[1:] == g[:-1]
        active, g = active[same], g[same]
        if not len(active):
            break
        keys = key(order[active] + step)
        by = np.lexsort((keys, g))
        order[active] = order[active][by]
        keys = keys[by]
        differ = (g[1:] != g[:-1]) | (keys[1:] != keys[:-1])
        group[active] = np.concatenate([[0], np.cumsum(differ)])
        agrees[active[1:][~differ]] = min(step + 8, length)
    return order, agrees


def previous_smaller(values: np.ndarray, agrees: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the nearest one before of smaller value (else -1), and their agreement.

    Pointers skip entries known to be no smaller, so chains halve from round to round.
    """
    n = len(values)
    to = np.arange(n) - 1
    common = agrees.copy()
    while True:
        skip = np.flatnonzero((to >= 0) & (values[np.maximum(to, 0)] >= values))
        if not len(skip):
            return to, np.where(to >= 0, common, 0)
        common[skip] = np.minimum(common[skip], common[to[skip]])
        to[skip] = to[to[skip]]


def longest_previous(data: np.ndarray, places: np.ndarray, ranks: np.ndarray, length: int) -> np.ndarray:
    """Longest earlier match of each place, to ``length``; ranks say which place is earlier."""
    order, agrees = suffix_array(data, places, length)
    at = np.empty(int(places.max()) + 1, np.int64)
    at[places] = np.arange(len(places))
    values = ranks[at[order]]
    _, before = previous_smaller(values, agrees)
    back = np.concatenate([agrees[1:], [0]])[::-1]
    _, after = previous_smaller(values[::-1], back)
    out = np.empty(len(places), np.int64)
    out[at[order]] = np.maximum(before, after[::-1])
    return out


def compare(rows: pa.Table, length: int) -> pa.Table:
    """Ranges of starts whose strings occur earlier among a bucket's segments."""
    data, offsets = text_buffer_binary(rows["bytes"])
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes - length + 1, 0))
    counts = np.maximum(sizes - length + 1, 0)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    places = (offsets[:-1] - offsets[0])[owner] + within
    own = rows["doc_id"].fill_null(-(1 << 63)).to_numpy()
    start = rows["low"].to_numpy().astype(np.int64)[owner] + within
    docs = np.unique(own, return_inverse=True)[1][owner]
    by = np.lexsort((start, docs))
    ranks = np.empty(len(by), np.int64)
    new = np.ones(len(by), dtype=bool)
    new[1:] = (docs[by][1:] != docs[by][:-1]) | (start[by][1:] != start[by][:-1])
    ranks[by] = np.cumsum(new)
    repeats = longest_previous(data[offsets[0] :], places, ranks, length) >= length if len(places) else np.zeros(0, bool)
    hit = np.flatnonzero(repeats)
    breaks = np.ones(len(hit), dtype=bool)
    breaks[1:] = (np.diff(hit) != 1) | (owner[hit][1:] != owner[hit][:-1])
    first = np.flatnonzero(breaks)
    last = np.append(first[1:], len(hit)) - 1 if len(hit) else first
    which = pa.array(owner[hit[first]])
    return pa.table(
        {
            "doc_id": rows["doc_id"].take(which),
            "mark": rows["mark"].take(which),
            "low": pa.array(start[hit[first]].astype(np.int32)),
            "high": pa.array(start[hit[last]].astype(np.int32)),
        }
    )


def text_buffer_binary(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks().cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8), offsets


def shrunk(documents: DataFrame) -> DataFrame:
    """Documents with the hash of their text and compressed bytes."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [(x.as_py() or "").encode() for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([mark_of(t) for t in texts], pa.int64()), pa.array([press.compress(t) for t in texts], pa.binary())],
                names=["doc_id", "mark", "packed"],
            )

    return documents.mapInArrow(shrink, f"{KEY}, packed binary")


def of_document(small: DataFrame, other: DataFrame, how: str) -> DataFrame:
    other = other.withColumnsRenamed({"doc_id": "_doc", "mark": "_mark"})
    joined = small.join(other, small["doc_id"].eqNullSafe(other["_doc"]) & (small["mark"] == other["_mark"]), how)
    return joined.drop("_doc", "_mark")


def repeated_ranges(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """Ranges (doc_id, mark, low, high) of starts of all strings that occur earlier."""
    spark = documents.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * least, total // (BUCKET_ROWS * (length - GRAM) // 2))
    found = anchor_rows(documents, buckets, length)
    decided = written(found.groupBy("bucket").applyInArrow(decide, f"{RANGES}, group long"), "decided")
    asked = decided.where("group is not null")
    wanted = asked.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("group", "low", "high")).alias("wanted"))
    number = max(4 * least, asked.count() // BUCKET_SEGMENTS)

    schema = pa.schema([("bucket", pa.int32()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("low", pa.int32()), ("bytes", pa.binary())])

    def segments_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for doc, mark, packed, places in zip(*(batch.column(c) for c in ("doc_id", "mark", "packed", "wanted")), strict=True):
                doc, mark, text = doc.as_py(), mark.as_py(), press.decompress(packed.as_py())
                group, low, high = (places.values.field(k).to_numpy() for k in range(3))
                for g, p, q in zip((group % number).tolist(), low.tolist(), high.tolist(), strict=True):
                    yield g, doc, mark, p, text[p : q + length]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return gathered(segments_of(batches), schema)

    segments = of_document(shrunk(documents), wanted, "inner").mapInArrow(cut, f"bucket int, {KEY}, low int, bytes binary")
    segments = segments.distinct()
    more = segments.groupBy("bucket").applyInArrow(lambda rows: compare(rows, length), RANGES)
    return decided.where("group is null").drop("group").union(more)


def without_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, spans (start, length) and kept (its remaining bytes).

    Every row gives a row; null counts as empty.  Texts shorter than ``length`` keep all.
    Rows that share a doc_id have their earlier starts count as earlier; repeated rows
    have the same outcome.  Null doc_ids come before all others.  Other columns are ignored.
    """
    documents = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ranges = repeated_ranges(documents, length)
    ranges = ranges.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))

    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("n_removed", pa.int64()),
            ("n_spans", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
            ("kept", pa.binary()),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for doc, packed, places in zip(*(batch.column(c) for c in ("doc_id", "packed", "ranges")), strict=True):
                text = kept = press.decompress(packed.as_py())
                spans = []
                if places.is_valid:
                    low, high = (places.values.field(k).to_numpy().astype(np.int64) for k in range(2))
                    spans = merged(low, high + length)
                    edges = [0, *(x for span in spans for x in span), len(text)]
                    kept = b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
                yield doc.as_py(), len(text), len(text) - len(kept), len(spans), [{"start": a, "length": b - a} for a, b in spans], kept

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return gathered(rows(batches), schema)

    out = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,length:long>>, kept binary"
    return of_document(shrunk(documents), ranges, "left").mapInArrow(remove, out)


def op10_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = without_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
