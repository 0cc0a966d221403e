"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

A document's set holds its distinct word n-grams.  Two sets link when 100 * intersection is
at least ``percent`` * union.  Every step is exact:

1. Sets that share too few n-grams among their least-hashed ones can't link with any other
   and leave; this needs a part of each set only.
2. For the rest, the global order is by class of document frequency, then hash.  N-grams of one set
   alone come first and can't be shared, so only the others are kept.
3. Sets that link must share an n-gram among their first ones (prefix filter) and be of
   similar size (length filter); positions bound the overlap (positional filter).  First,
   every set is compared with one set for each of its first n-grams: the one with the fewest
   n-grams of its own, which is the text that near copies were made from if it is there.  Then,
   only sets of different classes that share an n-gram are, so near copies form no pairs within.
4. The order is cut into fragments.  Overlaps of candidate pairs are counted in each fragment
   apart and summed per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from operator import and_

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.session import written

from .base import SPACED, classes, row_blocks, sequence_hash, table, text_buffer, window_hashes, word_hashes

#: Frequency classes of the global order: n-grams of up to 3, 7, 15 and more documents.
CLASSES = 4
#: Bits of an n-gram's hash in its place in the global order; the frequency class stands above them.
ORDER_BITS = 60
#: Share of a set, in hundredths, that the first step looks at beyond what may differ.
AHEAD = 5
#: 64-bit words of a set's sketch.
SKETCH_WORDS = 8


def sets_of(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; with fewer words, the sequence as one."""
    data, offsets = text_buffer(column)
    for i, j in row_blocks(offsets):
        hashes, rows, _, _ = word_hashes(data, offsets[i : j + 1], SPACED)
        cuts = np.searchsorted(rows, np.arange(j - i + 1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            words = hashes[a:b]
            yield np.unique(window_hashes(words, n) if len(words) >= n else sequence_hash(words) if len(words) else words)


def signature(grams: np.ndarray) -> int:
    return int.from_bytes(blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def ahead(size: int, percent: int) -> tuple[int, int]:
    """How many least-hashed n-grams to look at, and how many of them a partner must share."""
    may_differ = size - -(-percent * size // 100)
    need = AHEAD * size // 100 + 1
    return min(size, may_differ + need), min(size, may_differ + need) - may_differ


def row_name(columns: list[str]) -> F.Column:
    """What rows are known by: the doc_id or, if there is a column ``mark``, both, null doc_ids last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark") if "mark" in columns else F.col("doc_id")


def set_table(documents: DataFrame, n: int, percent: int) -> DataFrame:
    """Columns of documents but text, size, sig (of the set; null if empty) and least.

    ``least`` has the upper halves of the set's least hashes; it is null where a batch has had
    the same set before.
    """
    keys = [c for c in documents.columns if c != "text"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, sigs, least = [], [], []
            for grams in sets_of(batch.column("text"), n):
                sig = signature(grams) if len(grams) else None
                sizes.append(len(grams))
                sigs.append(sig)
                least.append(None if sig is None or sig in seen else (grams[: ahead(len(grams), percent)[0]] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                seen.add(sig)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array(sizes, pa.int64()), pa.array(sigs, pa.int64()), pa.array(least, pa.list_(pa.int32()))],
                names=[*keys, "size", "sig", "least"],
            )
            if len(seen) > 500_000:
                seen.clear()

    return documents.mapInArrow(measure, ", ".join(f"{k} long" for k in keys) + ", size long, sig long, least array<int>")


def gram_rows(documents: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(sig, size, gram) for the sets that are wanted; texts move compressed."""
    keys = [c for c in documents.columns if c != "text"]

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [press.compress(t.encode()) if (t := x.as_py()) else b"" for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(texts, pa.binary())], names=[*keys, "text"])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = pa.array([press.decompress(b).decode() if (b := x.as_py()) else "" for x in part.column("text")], pa.large_string())
                # Rows of one doc_id may differ.
                found = [(s, g) for g, s in zip(sets_of(texts, n), part.column("sig").to_pylist(), strict=True) if signature(g) == s]
                if found:
                    sizes = [len(g) for _, g in found]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat([s for s, _ in found], sizes)),
                            pa.array(np.repeat(sizes, sizes)),
                            pa.array(np.concatenate([g for _, g in found]).astype(np.int64)),
                        ],
                        names=["sig", "size", "gram"],
                    )

    small = documents.where("text is not null").mapInArrow(shrink, ", ".join(f"{k} long" for k in keys) + ", text binary")
    # With a broadcast, both functions' Python workers would stand side by side in each task.
    found = small.join(wanted.hint("merge"), row_name(keys).eqNullSafe(wanted["rep"]))
    return found.select("sig", "text").mapInArrow(grow, "sig long, size long, gram long")


def not_below(*columns: str) -> F.Column:
    """That no column is below its least value of a group: true always, but known to Spark only when it runs.

    Comparisons alone would be taken as a filter of nulls on one side, whose shuffle were another then.
    """
    return reduce(and_, [F.coalesce(F.col(c) >= F.col(f"least_{c}"), F.lit(True)) for c in columns])


def possible(sets: DataFrame, percent: int) -> DataFrame:
    """Distinct sets that may link with another: (sig, rep) with the least row of each."""
    may_differ = F.col("size") - F.ceil(F.col("size") * percent / 100)
    smallest = F.ceil(F.col("size") * percent / 100)  # partner, which looks less far ahead
    need = F.floor(smallest * AHEAD / 100) + 1
    need = F.least("size", may_differ + need) - may_differ
    row = F.coalesce("doc_id", F.lit(0)).alias("row")
    grams = sets.where("least is not null and sig is not null").select(row, "sig", need.alias("need"), F.explode("least").alias("gram")).repartition("gram")
    # The join uses all columns of both sides, so that one shuffle serves them.
    shared = grams.groupBy("gram").agg(*[F.min(c).alias(f"least_{c}") for c in ("row", "sig", "need")], F.max("sig").alias("hi"))
    some = grams.join(shared.where("least_sig <> hi"), "gram").where(not_below("row", "sig", "need"))
    some = some.groupBy("row", "sig").agg(F.count("*").alias("n"), F.min("need").alias("need"))
    some = some.where("n >= need").select("sig").distinct()
    return sets.where("sig is not null").join(some, "sig", "left_semi").groupBy("sig").agg(F.min(row_name(sets.columns)).alias("rep"))


def ordered_sets(grams: DataFrame, percent: int, way: str | None = None) -> DataFrame:
    """Sets that share enough n-grams with others: (sig, size, held), the shared ones in global order.

    An n-gram is told by its place in the order, a number of its frequency class and its hash.  ``way`` is
    a hint for the join of n-grams with their counts.
    """
    grams = grams.where("gram is not null and sig is not null and size is not null").repartition("gram")
    # The join uses all columns of both sides, so that one shuffle serves them.
    shared = grams.groupBy("gram").agg(F.count("*").alias("df"), *[F.min(c).alias(f"least_{c}") for c in ("sig", "size")]).where("df > 1")
    rank = F.least(F.floor(F.log2("df")).cast("long"), F.lit(CLASSES))
    place = F.shiftleft(rank, ORDER_BITS).bitwiseOR(F.col("gram").bitwiseAND((1 << ORDER_BITS) - 1))
    found = grams.join(shared.hint(way) if way else shared, "gram").where(not_below("sig", "size"))
    held = found.select("sig", "size", place.alias("place")).groupBy("sig", "size").agg(F.sort_array(F.collect_set("place")).alias("held"))
    held = held.where(100 * F.size("held") >= percent * F.col("size"))
    return written(held, "ranked")


def first_grams(held: DataFrame, percent: int, *more: str) -> DataFrame:
    """The sets' first n-grams (gram, sig, size, at), one of which any two that link share, with more columns of the sets.

    ``alone`` tells how many of a set's n-grams no other set has.
    """
    # Of the whole set's first n-grams, those of this set alone come before all others.
    alone = F.col("size") - F.size("held")
    first = (F.col("size") - F.ceil(F.col("size") * percent / 100) + 1 - alone).cast("int")
    heads = held.where(first > 0).select("sig", "size", alone.alias("alone"), *more, F.posexplode(F.slice("held", 1, first)).alias("at", "gram"))
    return heads.select("gram", "sig", "size", (F.col("at") + F.col("alone")).alias("at"), "alone", *more)


def ranked_sets(grams: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Shared n-grams in global order as fragments (sig, size, frag, grams), first ones (see first_grams), and whole sets."""
    held = ordered_sets(grams, percent)
    # Fragments are ranges of the order: each class, halved by hash.
    part = lambda x: F.shiftright(x, ORDER_BITS - 1)
    own = F.filter("held", lambda x: part(x) == F.col("frag"))
    frags = held.withColumn("frag", F.explode(F.array_distinct(F.transform("held", part))))
    frags = frags.select("sig", "size", "frag", own.alias("grams"))
    return frags, first_grams(held, percent), held


def near(percent: int) -> F.Column:
    """Length filter, and the bound that the positions of a shared n-gram set to the overlap.

    Of what stands before it, a set's n-grams of its own are not shared.
    """
    before = F.least(F.col("x.at") - F.col("x.alone"), F.col("y.at") - F.col("y.alone"))
    rest = F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at"))
    sizes = (100 * F.col("x.size") >= percent * F.col("y.size")) & (100 * F.col("y.size") >= percent * F.col("x.size"))
    return sizes & ((100 + percent) * (before + rest) >= percent * (F.col("x.size") + F.col("y.size")))


def sketch(words: int) -> F.Column:
    """For each of so many 64 slots, whether an odd number of the set's shared n-grams falls there, as longs."""
    word = "aggregate(held, 0L, (s, g) -> s ^ if(pmod(shiftright(g, 6), {n}) = {k}, shiftleft(1L, cast(g & 63 as int)), 0L))"
    return F.array(*[F.expr(word.format(n=words, k=k)) for k in range(words)])


def alike(percent: int, words: int) -> F.Column:
    """That the least number of n-grams in which two sets differ does not rule a link out.

    Each slot in which their sketches differ holds one at least, and n-grams of one set alone add to them.
    """
    slots = sum((F.bit_count(F.col("x.bits")[k].bitwiseXOR(F.col("y.bits")[k])) for k in range(words)), F.lit(0))
    differ = F.col("x.alone") + F.col("y.alone") + slots
    return (100 + percent) * differ <= (100 - percent) * (F.col("x.size") + F.col("y.size"))


def overlaps(pairs: DataFrame, frags: DataFrame) -> DataFrame:
    """(a, b, m, n, k): sizes of the sets of pairs, and their overlaps, summed over the fragments."""
    left = frags.select(F.col("sig").alias("a"), F.col("size").alias("m"), "frag", F.col("grams").alias("ours"))
    right = frags.select(F.col("sig").alias("b"), F.col("size").alias("n"), "frag", F.col("grams").alias("theirs"))
    parts = pairs.join(left, "a").join(right, ["b", "frag"])
    parts = parts.select("a", "b", "m", "n", F.size(F.array_intersect("ours", "theirs")).alias("k"))
    return parts.groupBy("a", "b").agg(F.sum("k").alias("k"), F.first("m").alias("m"), F.first("n").alias("n"))


def linking(found: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose overlaps meet the threshold."""
    return found.where(100 * F.col("k") >= percent * (F.col("m") + F.col("n") - F.col("k"))).select("a", "b")


def linked_classes(frags: DataFrame, heads: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """Classes (node, root) of all links, found from as many links as give the same classes.

    First, every set is compared with the center of each of its first n-grams.  Then sets of
    different classes that share an n-gram are, but for those that their distances to its
    center tell apart: the Jaccard distance is a metric, so sets whose distances to the center
    differ by more than links may be long can't link.  Of the others, near copies that are not
    near enough, most are told apart by sketches of the sets (see alike).
    """
    heads = written(heads, "heads")
    center = heads.groupBy("gram").agg(F.min(F.struct("alone", "sig", "size", "at")).alias("y"), F.count("*").alias("df")).where("df > 1")
    center = written(center.select("gram", "y"), "centers")
    stars = heads.alias("x").join(center.select("gram", "y.*").alias("y"), "gram").where("x.sig <> y.sig").where(near(percent))
    stars = stars.select(F.greatest("x.sig", "y.sig").alias("a"), F.least("x.sig", "y.sig").alias("b")).distinct()
    known = written(overlaps(stars, frags), "known")
    linked = written(linking(known, percent), "links")
    of = classes(linked)
    heads = heads.join(of.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    counts = heads.groupBy("gram", "root").agg(F.count("*").alias("n"))
    mixed = counts.groupBy("gram").agg(F.max_by("root", F.struct("n", "root")).alias("top"), F.count("*").alias("k")).where("k > 1")
    heads = heads.join(mixed.select("gram", "top"), "gram").join(center.select("gram", F.col("y.sig").alias("center")), "gram")
    distance = known.select("a", "b", (1 - F.col("k") / (F.col("m") + F.col("n") - F.col("k"))).alias("known"))
    heads = heads.withColumns({"a": F.greatest("sig", "center"), "b": F.least("sig", "center")}).join(distance, ["a", "b"], "left")
    bits = held.join(heads.select("sig").distinct(), "sig", "left_semi").select("sig", sketch(SKETCH_WORDS).alias("bits"))
    heads = heads.join(bits, "sig")
    heads = written(heads.select("gram", "sig", "size", "at", "alone", "bits", "root", "top", F.when(F.col("sig") == F.col("center"), 0.0).otherwise(F.col("known")).alias("away")), "mixed")
    # Every pair of different classes has a side outside the n-gram's largest class.
    x, y = heads.where("root <> top").alias("x"), heads.alias("y")
    apart = F.coalesce(F.abs(F.col("x.away") - F.col("y.away")), F.lit(0.0)) > 1 - percent / 100 + 1e-9
    may = ~apart & near(percent) & alike(percent, SKETCH_WORDS)
    cross = x.join(y, (F.col("x.gram") == F.col("y.gram")) & may & F.expr("x.root <> y.root and (y.root = y.top or x.sig > y.sig)"))
    cross = cross.select(F.greatest("x.sig", "y.sig").alias("a"), F.least("x.sig", "y.sig").alias("b")).distinct()
    cross = cross.join(known.select("a", "b"), ["a", "b"], "left_anti")
    cross = written(linking(overlaps(cross, frags), percent), "links")
    return of if cross.isEmpty() else classes(linked.union(cross))


def first_rows(documents: DataFrame, n: int, percent: int) -> DataFrame:
    """Per document: its columns but text, size, and first, the least row of its component (see row_name).

    ``first`` is null if the text has no n-grams.
    """
    sets = written(set_table(documents, n, percent), "sets")
    wanted = written(possible(sets, percent), "possible")
    frags, heads, held = ranked_sets(gram_rows(documents, wanted, n), percent)
    of = linked_classes(frags, heads, held, percent)
    own = sets.where("sig is not null").groupBy("sig").agg(F.min(row_name(sets.columns)).alias("rep"))
    own = own.join(of.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    own = written(own, "roots")
    least = own.groupBy("root").agg(F.min("rep").alias("first"))
    named = own.join(least, "root").select("sig", "first")
    return sets.join(named, "sig", "left").drop("sig", "least")


def jaccard_components(documents: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least doc_id reachable by links, itself included).

    Every row gives a row.  Null, empty and white-space texts have no n-grams and link with
    nothing; texts of fewer words than n are one n-gram.  Equal sets link.  Rows that share a
    doc_id are texts of their own.  A null doc_id reaches the least other doc_id of its
    component, if there is one.  Other columns are ignored.
    """
    found = first_rows(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), n, percent)
    return found.select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("first", "doc_id").alias("component_id"))


def later_copies(documents: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, mark) of the rows whose component has an earlier row; mark is the hash of the text.

    Rows are ordered by doc_id, nulls last, then mark, so rows that share a doc_id are decided apart.
    """
    found = first_rows(documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), F.col("text").cast("string")), n, percent)
    return found.where(F.col("first").isNotNull() & (row_name(found.columns) != F.col("first"))).select("doc_id", "mark").distinct()


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS g FROM words),
grams AS (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, l.component_id FROM sets s JOIN least l ON s.doc_id = l.a
"""
