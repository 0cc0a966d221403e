"""Helpers that the training-data operators share: text buffers, word hashes, links to classes.

The numpy functions work on one Arrow batch inside a task, whole texts at a time, in blocks
of bounded size.  Words and windows are compared by 64-bit hashes of their bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.session import written

#: Bytes of text that a block of documents holds; a longer document is a block of its own.
BLOCK_BYTES = 2 << 20
#: Bytes of text whose words are hashed at once; sums and powers take many times as much, and powers are kept.
HASH_BYTES = 1 << 18

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(columns: list[str], stem: str) -> str:
    """A column name that none of the columns has, whatever the case."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def findable(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package from where it lies.

    On a cluster the package is installed, or given to spark-submit by --py-files.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LOWER_VALUES = BYTE_VALUES[LOWER]


def word_bytes(*gaps: tuple[int, int]) -> np.ndarray:
    """Which bytes belong to words, given the ranges of those that don't."""
    inside = np.ones(256, dtype=bool)
    for first, last in gaps:
        inside[first : last + 1] = False
    return inside


#: Words are runs of anything but ASCII white space.
SPACED = word_bytes((0x20, 0x20), (0x09, 0x0D))
#: Words are runs of digits, letters and non-ASCII characters, once A-Z are lower case.
ALPHANUMERIC = word_bytes((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1), modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(have)
    return have[:n]


def prefix_sums(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Polynomial sums of all prefixes of the bytes; a part's hash follows from two of them."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * powers(_BASE, len(data)), out=sums[1:])
    return sums


def part_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the parts [start, end) by content and length."""
    inverse = powers(_BASE_INVERSE, len(sums))
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _ODD)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and where each row begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together are within the limit, or single longer ones."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def gathered(rows: Iterator[tuple], schema: pa.Schema, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows, each of about so many bytes of strings and binaries at most."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, bytes | str))
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def word_hashes(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray, values: np.ndarray = _LOWER_VALUES) -> tuple[np.ndarray, ...]:
    """Hash, row, start and end of each word; bounds are where rows begin and the last ends.

    ASCII capitals count as lower case, unless the values of bytes are BYTE_VALUES.  Long texts
    are hashed in parts cut between words.
    """
    first, last = int(bounds[0]), int(bounds[-1])
    data = data[first:last]
    bounds = bounds - first
    if not len(data):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    word = inside[data]
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = False, word[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = False, word[1:]
    edges = bounds[:-1][(bounds[:-1] < bounds[1:])]
    before[edges] = False
    after[edges[edges > 0] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    hashes = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASH_BYTES, side="right")))
        at = starts[i]
        sums = prefix_sums(data[at : ends[j - 1]], values)
        hashes[i:j] = part_hashes(sums, starts[i:j] - at, ends[i:j] - at)
        i = j
    rows = np.searchsorted(bounds, starts, side="right") - 1
    return hashes, rows, starts, ends


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, k * int(_ODD) % (1 << 64), dtype=np.uint64)
    for i, factor in enumerate(powers(0xA0761D6478BD642F, k + 1)[1:]):
        total += words[i : i + n] * factor
    return mixed(total)


def sequence_hash(words: np.ndarray) -> np.ndarray:
    """Hash of the whole sequence, as one value."""
    return window_hashes(words, len(words))


def classes(edges: DataFrame, name: str = "classes") -> DataFrame:
    """Connected components: (node, root) for every node of the edges (a, b), root the least.

    Large-star and small-star rounds; each round's edges are written, so a lost executor
    costs one round.  No node's neighbours are gathered: least neighbours are aggregated,
    then joined back.  Ends when a round leaves the edges as they were.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = mark(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(least, "a")
        small = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(linked.select("a", F.col("m")))
        edges = written(small.where("a <> b").distinct(), name)
        now = mark(edges)
        if now == seen:
            break
        seen = now
    # Every edge leads to its root now; roots stand for themselves.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
