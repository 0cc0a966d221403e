"""Vector codes: each part of a vector becomes the number of its nearest codebook entry.

Vectors are whole numbers, cut into parts, and each part's codebook is refined by rounds of
assignment and averaging.  A part's nearest entry is found in a geometric near-neighbour access
tree (GNAT) over the codebook: a node holds split points, the other entries go to the region
of their nearest split point, and for every split point and region the range of distances
between them is kept.  A query computes its distances to the split points; a region goes, with
all that is below it, if for some split point no distance of the range can be within the best
found so far.  Regions go only if they must be farther: bounds are rounded outwards, and equal
squared distances, which are whole numbers, go to the lower index.

Codebooks are bounded by entries times width and sent to every task; sums of a round are
added up per task, then by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Entries that a leaf of the tree holds, and split points of a node, at most.
LEAF = 12
SPLITS = 16
#: Components that are worked on at once, about.
BLOCK = 1 << 20
#: Far more than what rounding can do to a distance.
SLACK = 2.0**-45


def largest(width: int) -> int:
    """Bound on whole components, below which every error of so many is a long."""
    return 1 << ((62 - max(1, width).bit_length()) // 2 - 1)


def whole_matrix(column: pa.Array, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are vectors of the width with finite components, and their floor(scale * x)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    fits = pc.equal(pc.list_value_length(column), width).fill_null(False)
    rows = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
    values = column.filter(fits).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), width)  # null is NaN
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(values * float(scale))
        good = (np.abs(values) <= largest(width)).all(axis=1)
    return rows[good], values[good].astype(np.int64)


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors: in doubles where these can't pass 2**53."""
    if not x.size or not y.size:
        return np.zeros((len(x), len(y)), dtype=np.int64)
    most = float(max(np.abs(x).max(), np.abs(y).max(), 1))
    kind = np.float64 if 4 * most * most * x.shape[1] < 2.0**53 else np.int64
    x, y = x.astype(kind), y.astype(kind)
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)).astype(np.int64)


@dataclass
class Node:
    """Split points, or the entries of a leaf, by ascending index; regions below, and ranges[i, j] to region j."""

    entries: np.ndarray
    regions: list[Node | None]
    low: np.ndarray
    high: np.ndarray


def gnat(book: np.ndarray, entries: np.ndarray | None = None) -> Node:
    """The tree over the entries of a codebook, all of them by default."""
    entries = np.arange(len(book)) if entries is None else entries
    if len(entries) <= LEAF:
        return Node(entries, [], np.zeros((0, 0)), np.zeros((0, 0)))
    # Split points that are far from each other, beginning with the first entry.
    chosen = [0]
    nearest = squared_distances(book[entries], book[entries[:1]])[:, 0]
    for _ in range(min(SPLITS, max(2, int(len(entries) ** 0.5))) - 1):
        nearest[chosen] = -1
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared_distances(book[entries], book[entries[chosen[-1:]]])[:, 0])
    splits = np.sort(entries[chosen])
    rest = np.setdiff1d(entries, splits)
    distances = squared_distances(book[rest], book[splits])
    region = distances.argmin(axis=1)
    regions: list[Node | None] = []
    low, high = np.zeros((len(splits), len(splits))), np.zeros((len(splits), len(splits)))
    for j in range(len(splits)):
        inside = region == j
        regions.append(gnat(book, rest[inside]) if inside.any() else None)
        if inside.any():
            low[:, j] = np.sqrt(distances[inside].min(axis=0)) * (1 - SLACK)
            high[:, j] = np.sqrt(distances[inside].max(axis=0)) * (1 + SLACK)
    return Node(splits, regions, low, high)


def nearest_entries(tree: Node, book: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of each query's nearest entry, ties to the lower index, and how many distances were computed."""
    best = np.full(len(queries), np.iinfo(np.int64).max)
    index = np.zeros(len(queries), dtype=np.int64)
    computed = 0

    def visit(node: Node, who: np.ndarray) -> None:
        nonlocal computed
        distances = squared_distances(queries[who], book[node.entries])
        computed += distances.size
        at = distances.argmin(axis=1)
        found, entry = distances[np.arange(len(who)), at], node.entries[at]
        better = (found < best[who]) | ((found == best[who]) & (entry < index[who]))
        best[who[better]], index[who[better]] = found[better], entry[better]
        if not node.regions:
            return
        roots = np.sqrt(distances)
        below, above = roots * (1 - SLACK), roots * (1 + SLACK)
        for own in (True, False):  # a query's nearest region first, which brings the others' bound down
            for j, region in enumerate(node.regions):
                if region is None:
                    continue
                some = np.flatnonzero((at == j) == own)
                reach = (np.sqrt(best[who[some]]) * (1 + SLACK))[:, None]
                gone = (below[some] - reach > node.high[:, j]) | (above[some] + reach < node.low[:, j])
                some = some[~gone.any(axis=1)]
                if len(some):
                    visit(region, who[some])

    if len(queries):
        visit(tree, np.arange(len(queries)))
    return index, best, computed


def bounds(width: int, parts: int) -> list[tuple[int, int]]:
    return [(k * width // parts, (k + 1) * width // parts) for k in range(parts)]


@dataclass
class Codebooks:
    """The entries of each part, which decode a code."""

    books: list[np.ndarray]
    width: int
    scale: int

    def table(self, spark: SparkSession) -> DataFrame:
        """(part, entry, components) of all entries."""
        rows = [(p, e, x.tolist()) for p, book in enumerate(self.books) for e, x in enumerate(book)]
        return spark.createDataFrame(rows, "part int, entry int, components array<long>")

    def sha256(self) -> str:
        return sha256(",".join(str(v) for book in self.books for v in book.ravel().tolist()).encode()).hexdigest()

    def decode(self, codes: DataFrame) -> DataFrame:
        """The codes with ``vector``: the midpoints of the entries' components on the scale of the vectors."""
        books, scale = [(b + 0.5) / self.scale for b in self.books], self.width

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [np.concatenate([b[v] for b, v in zip(books, bytes.fromhex(c), strict=True)]) for c in batch.column("code").to_pylist()]
                held = pa.array([r[:scale] for r in rows], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, held], names=[*batch.schema.names, "vector"])

        return codes.mapInArrow(fill, codes.withColumn("vector", F.array().cast("array<double>")).schema)


def own_columns(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").cast("long"), "label", F.col("embedding").cast("array<double>"))


def first_codebooks(embeddings: DataFrame, parts: int, entries: int, scale: int) -> Codebooks | None:
    """Those of the least vec_ids, nulls last, ties by the vectors; None if no vector is kept."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    kept = own_columns(embeddings).where(F.col("embedding").isNotNull() & F.forall("embedding", good))
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    least = kept.orderBy(*order).limit(1).collect()
    if not least:
        return None
    width = len(least[0]["embedding"])
    inside = F.forall("embedding", lambda x: F.abs(F.floor(x * scale)) <= largest(width))
    rows = kept.where((F.size("embedding") == width) & inside).orderBy(*order).limit(entries).collect()
    if not rows:
        return None
    whole = np.floor(np.array([r["embedding"] for r in rows]).reshape(len(rows), width) * float(scale)).astype(np.int64)
    return Codebooks([whole[:, a:b].copy() for a, b in bounds(width, parts)], width, scale)


def refined(embeddings: DataFrame, found: Codebooks) -> Codebooks:
    """One round: every part goes to its nearest entry, and entries become the floor of their parts' mean."""
    books, width, scale = found.books, found.width, found.scale
    cuts = bounds(width, len(books))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [gnat(b) for b in books]
        sums = [np.zeros((len(b), b.shape[1] + 1), dtype=np.int64) for b in books]  # the last column counts
        for batch in batches:
            for at in range(0, batch.num_rows, step := max(1, BLOCK // max(1, width))):
                _, whole = whole_matrix(batch.column("embedding").slice(at, step), width, scale)
                for book, tree, total, (a, b) in zip(books, trees, sums, cuts, strict=True):
                    index, _, _ = nearest_entries(tree, book, whole[:, a:b])
                    np.add.at(total, index, np.column_stack([whole[:, a:b], np.ones(len(whole), np.int64)]))
        keys = [(p, e) for p, total in enumerate(sums) for e in np.flatnonzero(total[:, -1]).tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in keys], pa.int32()),
                pa.array([e for _, e in keys], pa.int32()),
                pa.array([sums[p][e].tolist() for p, e in keys], pa.list_(pa.int64())),
            ],
            names=["part", "entry", "sums"],
        )

    each = embeddings.select("embedding").mapInArrow(add, "part int, entry int, sums array<long>")
    total = each.select("part", "entry", F.posexplode("sums").alias("at", "x")).groupBy("part", "entry", "at").agg(F.sum("x").alias("x"))
    total = total.groupBy("part", "entry").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("x"))
    new = [b.copy() for b in books]
    for row in total.select("part", "entry", F.col("x.x").alias("x")).collect():  # entries times width, at most
        new[row["part"]][row["entry"]] = np.array(row["x"][:-1], dtype=np.int64) // row["x"][-1]
    return Codebooks(new, width, scale)


def fitted(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks after so many rounds over all vectors; None if no vector is kept."""
    if not 0 < entries <= 256 or parts < 1:
        raise ValueError("a part's entries are numbered by two hex digits: 1 to 256")
    found = first_codebooks(embeddings, parts, entries, scale)
    for _ in range(rounds if found else 0):
        found = refined(own_columns(embeddings), found)
    return found


def encoded(embeddings: DataFrame, found: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) of every kept vector: entries in part order, and its squared distance to them."""
    books, width, scale = found.books, found.width, found.scale
    cuts = bounds(width, len(books))
    own = own_columns(embeddings)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [gnat(b) for b in books]
        for batch in batches:
            for at in range(0, batch.num_rows, step := max(1, BLOCK // max(1, width))):
                part = batch.slice(at, step)
                rows, whole = whole_matrix(part.column("embedding"), width, scale)
                near = [nearest_entries(t, b, whole[:, x:y]) for t, b, (x, y) in zip(trees, books, cuts, strict=True)]
                codes = np.column_stack([n[0] for n in near]).astype(np.uint8)
                kept = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [kept.column("vec_id"), kept.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(sum(n[1] for n in near), pa.int64())],
                    names=["vec_id", "label", "code", "error"],
                )

    kinds = own.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema
    return own.mapInArrow(code, kinds)


def vector_codes(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error and codebooks_sha256.

    Vectors that are null or hold null or non-finite components are dropped.  So are those of
    another width than the vector of the least vec_id, which has no parts in common with it,
    and those with whole components whose squares wouldn't fit a long (for 64 components,
    beyond 2**26).  A width that parts don't divide gives parts that differ by one component.
    Rows that repeat a vec_id, or have none, are vectors of their own; null ids come last among
    the first entries.  ``label_error`` adds the errors of equal labels, nulls together (null
    beyond long).  Without kept vectors there are no rows.  Other columns are ignored.
    """
    found = fitted(embeddings, parts, entries, rounds, scale)
    if found is None:
        return embeddings.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    codes = encoded(embeddings, found)
    sums = codes.groupBy(F.col("label").alias("of_label")).agg(F.try_sum("error").alias("label_error"))
    codes = codes.join(sums, F.col("label").eqNullSafe(F.col("of_label")))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(found.sha256()).alias("codebooks_sha256"))


def op13_vector_code_compression(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes(table(spark, folder, "embeddings"))


def _rounds_sql(rounds: int) -> str:
    assign = """a{k} AS MATERIALIZED (
  SELECT p.vec_id, p.part, min((p.xx - 2 * list_inner_product(p.x, b.x) + list_inner_product(b.x, b.x))::BIGINT * 256 + b.entry) AS m
  FROM parts p JOIN b{k} b ON p.part = b.part GROUP BY p.vec_id, p.part)"""
    mean = """,
s{k} AS (SELECT a.part, a.m % 256 AS entry, unnest(p.x) AS v, unnest(range(0, len(p.x))) AS pos FROM a{k} a JOIN parts p ON a.vec_id = p.vec_id AND a.part = p.part),
t{k} AS (SELECT part, entry, pos, sum(v)::BIGINT AS s, count(*)::BIGINT AS n FROM s{k} GROUP BY part, entry, pos),
m{k} AS (SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY pos) AS x FROM t{k} GROUP BY part, entry),
b{next} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m ON b.part = m.part AND b.entry = m.entry),
"""
    return "".join(assign.format(k=k) + (mean.format(k=k, next=k + 1) if k < rounds else "") for k in range(rounds + 1))


OP13_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (SELECT vec_id, v, len(v) // 4 AS d, unnest(range(0, 4)) AS part FROM kept),
parts AS MATERIALIZED (
  SELECT vec_id, part, v[part * d + 1 : part * d + d] AS x, list_inner_product(v[part * d + 1 : part * d + d], v[part * d + 1 : part * d + d]) AS xx FROM cut),
b0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM parts
  QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= 256),
{_rounds_sql(4)},
codes AS (
  SELECT vec_id, string_agg(printf('%02x', (m % 256)::INTEGER), '' ORDER BY part) AS code, sum(m // 256)::BIGINT AS error FROM a4 GROUP BY vec_id)
SELECT c.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda v: v::BIGINT), ','), ',' ORDER BY part, entry)) FROM b4) AS codebooks_sha256
FROM codes c JOIN kept k ON c.vec_id = k.vec_id
"""
