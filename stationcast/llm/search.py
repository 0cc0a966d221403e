"""Exact top-k search: tiled matrix products of queries and shards of candidates.

Queries and candidates are gathered into blocks of bounded size, and each query block meets
each candidate block in one tile.  A tile is one matrix product, of which the k best scores
per query are kept; the lists of a query are then merged as a tree, a few at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import table

#: Rows of a block, about.
QUERY_BLOCK = 512
SHARD_BLOCK = 4096
#: Lists that one step of the merge joins.
FAN_IN = 32


def blocks(vectors: DataFrame, rows: int, prefix: str) -> tuple[DataFrame, DataFrame]:
    """Vectors (id, x) of a width in blocks of about so many rows: width, {prefix}_block, ids and all components; and (width, number)."""
    vectors = vectors.withColumn("width", F.size("x"))
    number = vectors.groupBy("width").agg(F.ceil(F.count("*") / rows).cast("int").alias("number"))
    block = F.pmod(F.xxhash64("id", "x", *[c for c in vectors.columns if c == "copy"]), "number").cast("int")
    held = vectors.join(number, "width").groupBy("width", block.alias(f"{prefix}_block"))
    held = held.agg(F.sort_array(F.collect_list(F.struct("id", "x"))).alias("rows"))
    return held.select(
        "width", f"{prefix}_block", F.col("rows.id").alias(f"{prefix}_ids"), F.flatten("rows.x").alias(f"{prefix}_x")
    ), number


def best_of_tile(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to smaller ids; candidates stand in the order of their ids."""
    allowed = ids != own
    scores, ids = scores[allowed], ids[allowed]
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > edge)
        equal = np.flatnonzero(scores == edge)[: k - len(above)]
        keep = np.concatenate([above, equal])
        scores, ids = scores[keep], ids[keep]
    by = np.lexsort((ids, -scores))
    return scores[by], ids[by]


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly: in doubles where they can't pass 2**53, else as integers."""
    if not queries.size or not candidates.size:
        return np.zeros((len(queries), len(candidates)), dtype=np.int64)
    largest = float(np.abs(queries).max()) * float(np.abs(candidates).max()) * queries.shape[1]
    if largest < 2.0**53:
        return (queries @ candidates.T).astype(np.int64)
    if largest < 2.0**62:
        return queries.astype(np.int64) @ candidates.astype(np.int64).T
    whole = lambda m: np.array([[int(v) for v in row] for row in m], dtype=object)
    return np.clip(whole(queries) @ whole(candidates).T, -(2**63) + 1, 2**63 - 1).astype(np.int64)


def top_k(queries: DataFrame, candidates: DataFrame, k: int, query_block: int = QUERY_BLOCK, shard_block: int = SHARD_BLOCK) -> DataFrame:
    """The k candidates of highest inner product for each query: query_id, rank, vec_id, score.

    Both sides have columns id (long) and x (array of whole-numbered doubles).  Ties go to the
    smaller id; a candidate with the query's id is left out; fewer than k candidates are all
    returned.  Vectors of other lengths than the query's don't meet it, whatever their number.  Rows
    that repeat an id are candidates each; as queries of a length they count once, by the first in order of x.  Scores beyond
    the range of long are held at its ends.
    """
    queries = queries.groupBy("id", F.size("x").alias("width")).agg(F.min("x").alias("x")).select("id", "x")
    # Of rows that are all alike, k at most can be among the k best.
    copies = F.sequence(F.lit(1), F.least(F.count("*"), F.lit(k)))
    candidates = candidates.groupBy("id", "x").agg(copies.alias("copies")).select("id", "x", F.explode("copies").alias("copy"))
    left, _ = blocks(queries, query_block, "q")
    right, shards = blocks(candidates, shard_block, "c")
    left = left.join(shards, "width").withColumn("c_block", F.explode(F.sequence(F.lit(0), F.col("number") - 1))).drop("number")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                shape = lambda c: row[c].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                q_ids, c_ids, width = shape("q_ids"), shape("c_ids"), row["width"].as_py()
                scores = products(shape("q_x").reshape(len(q_ids), width), shape("c_x").reshape(len(c_ids), width))
                best = [best_of_tile(scores[j], c_ids, q, k) for j, q in enumerate(q_ids)]
                lists = [[{"score": a, "vec_id": b} for a, b in zip(s.tolist(), v.tolist(), strict=True)] for s, v in best]
                kind = pa.list_(pa.struct([("score", pa.int64()), ("vec_id", pa.int64())]))
                n = len(q_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids), pa.array(np.full(n, width, np.int32)), pa.array(np.full(n, row["c_block"].as_py(), np.int32)), pa.array(lists, kind)],
                    names=["query_id", "width", "shard", "best"],
                )

    met = left.join(right, ["width", "c_block"]).repartition(F.xxhash64("width", "q_block", "c_block"))
    lists = met.mapInArrow(search, "query_id long, width int, shard int, best array<struct<score:long,vec_id:long>>")
    most = shards.agg(F.max("number")).first()[0] or 0
    while most > 1:
        most = -(-most // FAN_IN)
        lists = lists.groupBy("query_id", "width", F.floor(F.col("shard") / FAN_IN).cast("int").alias("shard"))
        lists = lists.agg(merge(F.flatten(F.collect_list("best")), k).alias("best"))
    out = lists.select("query_id", F.posexplode("best").alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def merge(lists: Column, k: int) -> Column:
    """The k best of some lists' entries, of which each brings k at most."""
    order = F.array_sort(F.transform(lists, lambda x: F.struct((-x["score"]).alias("less"), x["vec_id"].alias("vec_id"))))
    return F.transform(F.slice(order, 1, k), lambda x: F.struct((-x["less"]).alias("score"), x["vec_id"].alias("vec_id")))


def whole_vectors(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """(id, x) with components floor(scale * x); vectors that are null or hold null or
    non-finite components, or have no vec_id, take no part."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good)
    # Kept as doubles: floor() of a double gives a long, which large components would pass.
    whole = lambda v: F.when(F.abs(v) < 2.0**50, F.floor(v * float(scale)).cast("double")).otherwise(v * float(scale))
    return kept.select(F.col("vec_id").cast("long").alias("id"), F.transform(x, whole).alias("x"))


def op7_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = whole_vectors(table(spark, folder, "embeddings"))
    return top_k(vectors.where(F.col("id") % 20 == 0), vectors, 20)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
