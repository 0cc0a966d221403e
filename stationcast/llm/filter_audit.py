"""Audit of how filters interact: what each removes at each place of every order of them.

1. Texts are measured whole: words, distinct words, capitals, code points, marks, a digest.
2. Conditions turn measures into a mask of the filters that a document fails.  Documents of one
   part and mask behave alike, so they become one cell with counts; there are 2**n masks at most.
3. Each cell is folded, by higher-order functions, through the array of all orders: an aggregate
   carries along whether the cell is still there, and gives a struct of weighted counts for each
   step.  A part's structs are merged by elementwise sums.

The array of orders is a literal of the plan, which every task gets; with five filters it holds
120 orders, and a cell gives 600 structs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import BYTE_VALUES, SPACED, mixed, row_blocks, table, text_buffer, word_hashes

#: What a filter fails, over the columns of measures(); None: the text of a smaller doc_id.
CONDITIONS: dict[str, str | None] = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_capitals > 2 * n_points",
    "D": "n_marks > 0",
    "E": None,
}
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

_CAPITAL = np.zeros(256, dtype=np.uint8)
_CAPITAL[65:91] = 1
_POINT = np.ones(256, dtype=np.uint8)
_POINT[0x80:0xC0] = 0
_MARK = np.zeros(256, dtype=np.uint8)
_MARK[list(b"#$%&*|")] = 1
_ODD = np.uint64(0x9E3779B97F4A7C15)


def row_sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the flags of each row; bounds are where rows begin and the last ends."""
    sums = np.zeros(len(bounds) - 1, dtype=np.int64)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        sums[full] = np.add.reduceat(flags, bounds[full], dtype=np.int64)
    return sums


def measures(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, part, digest of the text, n_words, n_distinct, n_capitals, n_points, n_marks.

    Null text counts as empty, null source as an empty part.  Words are runs of anything but
    ASCII white space, case-sensitive, and distinct by 64-bit hash.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for i, j in row_blocks(offsets):
                part = batch.slice(i, j - i)
                bounds = offsets[i : j + 1]
                hashes, rows, _, _ = word_hashes(data, bounds, SPACED, BYTE_VALUES)
                _, first = np.unique(mixed(hashes + rows.astype(np.uint64) * _ODD), return_index=True)
                bytes_, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
                digests = [blake2b(bytes_[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("part"),
                        pa.array(digests, pa.binary()),
                        pa.array(np.bincount(rows, minlength=j - i)),
                        pa.array(np.bincount(rows[first], minlength=j - i)),
                        *(pa.array(row_sums(kind[bytes_], bounds)) for kind in (_CAPITAL, _POINT, _MARK)),
                    ],
                    names=["doc_id", "part", "digest", "n_words", "n_distinct", "n_capitals", "n_points", "n_marks"],
                )

    source = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    own = documents.select(F.col("doc_id").cast("long"), source, F.col("text").cast("string"))
    return own.mapInArrow(
        measure,
        "doc_id long, part string, digest binary, n_words long, n_distinct long, n_capitals long, n_points long, n_marks long",
    )


def cells(documents: DataFrame, labels: DataFrame, conditions: dict[str, str | None] = CONDITIONS) -> DataFrame:
    """(part, mask, n, good, toxic): documents of a part that fail just the filters of the mask.

    Copies of a text are counted per digest, part and label before they move, so a text that
    a third of the documents share is a few rows.  Rows that share a doc_id are documents of
    their own; none is a copy of another of the same doc_id, and null doc_ids neither are
    copies nor make any.  Labels that repeat a doc_id count as 1 if one of them is.
    """
    bit = {name: 1 << k for k, name in enumerate(conditions)}
    told = [F.when(F.expr(c), bit[name]).otherwise(0) for name, c in conditions.items() if c is not None]
    mask = sum(told[1:], told[0]) if told else F.lit(0)
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c) for c in ("quality", "toxic")])
    rows = measures(documents).select("doc_id", "part", "digest", mask.alias("mask")).join(known, "doc_id", "left")
    kind = ["digest", "part", "mask", "quality", "toxic"]
    own = rows.groupBy("doc_id", *kind).agg(F.count("*").alias("n"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    nameless = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0))
    alike = own.groupBy(*kind).agg(F.sum("n").alias("n"), first.alias("first"), nameless.alias("nameless"))
    repeat = [bit[name] for name, c in conditions.items() if c is None]
    if repeat:
        least = alike.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
        original = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0) + F.col("nameless")
        alike = alike.join(least, "digest").withColumn("original", original)
        both = F.array(
            F.struct(F.col("mask"), F.col("original").alias("n")),
            F.struct((F.col("mask") + sum(repeat)).alias("mask"), (F.col("n") - F.col("original")).alias("n")),
        )
        alike = alike.select("part", "quality", "toxic", F.inline(both)).where("n > 0")
    weight = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).cast("long")
    return alike.groupBy("part", "mask").agg(F.sum("n").cast("long").alias("n"), weight("quality").alias("good"), weight("toxic").alias("toxic"))


def literal_text(items: Iterable) -> str:
    return f"array({','.join(map(str, items))})"


def literal(items: Iterable) -> Column:
    """An array literal, parsed at once."""
    return F.expr(literal_text(items))


def folded(orders: list[tuple[int, ...]]) -> Column:
    """What a cell gives: a struct of counts for each step of each order, one after the other."""
    zero = F.lit(0).cast("long")
    empty = F.array().cast(f"array<struct<{','.join(f'{c}:bigint' for c in COUNTS)}>>")

    def step(held: Column, bit: Column) -> Column:
        here, fails = held["here"], F.col("mask").bitwiseAND(bit) > 0
        when = lambda told, c: F.when(told, F.col(c)).otherwise(zero)
        counts = F.struct(
            when(here & ~fails, "n").alias("kept"),
            when(here & fails, "n").alias("removed"),
            when(~here & fails, "n").alias("redundant"),
            when(F.col("mask") == bit, "n").alias("unique_fails"),
            when(here & fails, "good").alias("good_lost"),
            when(here & fails, "toxic").alias("toxic_lost"),
        )
        return F.struct((here & ~fails).alias("here"), F.concat(held["steps"], F.array(counts)).alias("steps"))

    start = F.struct(F.lit(True).alias("here"), empty.alias("steps"))
    all_ = literal([literal_text(o) for o in orders])
    return F.flatten(F.transform(all_, lambda o: F.aggregate(o, start, step, lambda held: held["steps"])))


def interactions(found: DataFrame, names: list[str]) -> DataFrame:
    """From cells: part, filter_order, step, and the counts of COUNTS and shapley; zeros included."""
    orders = list(permutations(range(len(names))))
    size = len(names) * len(orders)
    each = found.select("part", folded([tuple(1 << k for k in o) for o in orders]).alias("counts"))
    none = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS]), size)
    plus = lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS])
    # A part has 2**n cells at most.
    merged = each.groupBy("part").agg(F.aggregate(F.collect_list("counts"), none, lambda a, b: F.zip_with(a, b, plus)).alias("counts"))
    of = literal([str(k) for o in orders for k in o])
    removed = lambda k: F.aggregate(
        F.filter("counts", lambda _, at: F.get(of, at) == k), F.lit(0).cast("long"), lambda total, x: total + x["removed"]
    )
    merged = merged.withColumn("shapley", F.array(*[removed(k) for k in range(len(names))]))
    rows = merged.select("part", "shapley", F.posexplode("counts").alias("at", "x"))
    spelled = F.split(F.lit(" ".join("".join(names[k] for k in o) for o in orders)), " ")
    return rows.select(
        "part",
        F.get(spelled, F.floor(F.col("at") / len(names)).cast("int")).alias("filter_order"),
        (F.col("at") % len(names) + 1).cast("int").alias("step"),
        "x.*",
        F.get("shapley", F.get(of, "at")).alias("shapley"),
    )


def audit(documents: DataFrame, labels: DataFrame, conditions: dict[str, str | None] = CONDITIONS) -> DataFrame:
    """Counts for every part, order of the filters and step; see measures, cells and interactions.

    Filters are named by one letter each; there may be six at most, as their orders are listed.
    Without documents there are no rows.  Other columns are ignored.
    """
    if not 0 < len(conditions) <= 6 or any(len(name) != 1 or name == " " for name in conditions):
        raise ValueError("one to six filters, each named by one letter")
    return interactions(cells(documents, labels, conditions), list(conditions))


def op11_filter_interaction_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


OP11_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT doc_id, part, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs),
firsts AS (SELECT t, min(doc_id) AS f FROM docs GROUP BY t),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT d.part, coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 2 * length(d.t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN d.doc_id > f.f THEN 'E' ELSE '' END AS mask
  FROM words d JOIN firsts f ON d.t = f.t LEFT JOIN known k ON d.doc_id = k.doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
told AS (
  SELECT part, mask, n, good, toxic, o, step, o[step] AS l, contains(mask, o[step]) AS fails,
    len(list_filter(range(1, step), lambda i: contains(mask, o[i]))) = 0 AS here FROM cells, steps),
counts AS (
  SELECT part, o, step, l, sum(CASE WHEN here AND NOT fails THEN n ELSE 0 END) AS kept, sum(CASE WHEN here AND fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails AND NOT here THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = l THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN here AND fails THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN here AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM told GROUP BY part, o, step, l)
SELECT part, o AS filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley
FROM counts
"""
