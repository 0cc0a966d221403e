"""Near duplicates of embeddings by NN-descent: a neighbour graph, refined until it settles.

1. Equal vectors become one point with a weight.
2. Every point gets a list of neighbours from blocks of points that follow each other in a few
   random orders (by the signs of random projections).
3. Rounds of NN-descent: the neighbours of a point, forward and backward, are compared with
   each other, and each takes those that are nearer than what its list has.  Only pairs with an
   entry that is new since the last round are compared.
4. A list that is full of neighbours beyond the threshold is saturated and doubles.
5. Recall is audited against a search of all points for a sample; the graph is started anew from
   further orders and refined again where it is too low.
6. Pairs beyond the threshold are links.  Lists and rounds use half precision; a link whose
   half-precision cosine is within its error of the threshold is decided in double precision.

Points whose list is saturated at WIDEST lie in groups of copies too large for lists, and have
an exact way of their own.  They are put under leaders within half the threshold's angle, so
all points of a leader link with each other and are counted, not paired.  The leaders are
compared with all points, block by block: by the triangle inequality a point links with all
points of a leader, or with none, and only the rest is compared in tiles.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationcast.session import written

from .base import classes, table

THRESHOLD = 0.9
#: Neighbours of a list to begin with, and of one that was doubled as often as lists are.
NEIGHBOURS = 8
WIDEST = 128
#: Backward neighbours that take part in a round; others do in other rounds.
BACKWARD = 16
ORDERS = 4
BLOCK = 256
ROUNDS = 12
#: A graph has settled when fewer than this share of its entries are new.
SETTLED = 0.002
#: Points whose links are searched for among all points, and the recall that they must show.
SAMPLE = 256
RECALL = 0.98
#: Times that the graph may be started from further orders.
STARTS = 4
#: What half precision can change a cosine by, and what doubles can change an angle by.
MARGIN = 2.0**-9
EPSILON = 1e-9
#: Bytes of leaders that are compared with all points at once.
LEADER_BYTES = 4 << 20


def packed(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as binaries."""
    matrix = np.ascontiguousarray(matrix)
    size = matrix.itemsize * matrix.shape[1]
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(size)
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(matrix.tobytes())])


def unpacked(column: pa.Array, kind: type) -> np.ndarray:
    """A matrix of the binaries, which are of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return np.frombuffer(data.tobytes(), dtype=kind).reshape(len(column), -1)


def whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold all rows of their keys; rows come in the order of the key."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        keys = held.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield held.slice(0, cut).combine_chunks()
        held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def runs_of(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where runs of equal keys begin and end."""
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])) if len(keys) else np.zeros(1, int)
    return zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)


def own_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x, h1, h2): vectors that can link are known by two hashes of their components; others have none."""
    own = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    good = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    good = F.col("x").isNotNull() & good
    return own.withColumn("h1", F.when(good, F.xxhash64("x"))).withColumn("h2", F.when(good, F.xxhash64(F.lit(1), "x")))


def points_of(own: DataFrame) -> DataFrame:
    """(id, vec_id, weight, h1, h2, width, half, exact): the different vectors that can link, in unit length."""
    kept = own.where("h1 is not null").groupBy("x", "h1", "h2").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"))

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.diff(batch.column("x").offsets.to_numpy())
            for width in np.unique(widths):
                part = batch.take(pa.array(np.flatnonzero(widths == width)))
                m = part.column("x").flatten().to_numpy().reshape(part.num_rows, width)
                m = m / np.abs(m).max(axis=1)[:, None]
                m /= np.sqrt((m * m).sum(axis=1))[:, None]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("vec_id", "weight", "h1", "h2")), pa.array(np.full(len(m), width, np.int32)), packed(m.astype(np.float16)), packed(m)],
                    names=["vec_id", "weight", "h1", "h2", "width", "half", "exact"],
                )

    found = kept.mapInArrow(scale, "vec_id long, weight long, h1 long, h2 long, width int, half binary, exact binary")
    return written(found.withColumn("id", F.monotonically_increasing_id()), "points")


def in_order(points: DataFrame, order: int, column: str, kind: type) -> DataFrame:
    """(id, width, column), partitions and rows sorted by the signs of random projections.

    Points of equal signs are many where copies are; their ids' hashes spread them.
    """

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            keys = np.zeros(len(widths), dtype=np.int64)
            for width in np.unique(widths):
                own = np.flatnonzero(widths == width)
                planes = np.random.default_rng([order, int(width)]).normal(size=(int(width), 30)).astype(np.float32)
                signs = unpacked(batch.column(column).take(pa.array(own)), kind).astype(np.float32) @ planes > 0
                keys[own] = signs @ (1 << np.arange(30)[::-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], names=[*batch.schema.names, "signs"])

    keyed = points.select("id", "width", column).mapInArrow(project, f"id long, width int, {column} binary, signs long")
    by = ["width", "signs", "salt"]
    parts = max(1, min(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), points.count() // (8 * BLOCK)))
    return keyed.withColumn("salt", F.xxhash64("id", F.lit(order))).repartitionByRange(parts, *by).sortWithinPartitions(*by).select("id", "width", column)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Blocks of up to BLOCK rows of one width, in the order in which they come."""
    held = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        whole = 0
        for a, b in runs_of(held.column("width").to_numpy()):
            last = b == held.num_rows
            for i in range(a, b, BLOCK):
                if last and i + BLOCK > b:
                    break
                yield held.slice(i, min(BLOCK, b - i)).combine_chunks()
                whole = min(i + BLOCK, b)
        held = held.slice(whole)
    if held is not None:
        for a, b in runs_of(held.column("width").to_numpy()):
            yield held.slice(a, b - a).combine_chunks()


def capacity(beyond: np.ndarray, neighbours: int, widest: int) -> np.ndarray:
    """How long lists are with so many neighbours beyond the threshold: doubled while they are saturated."""
    size = np.full(len(beyond), neighbours)
    while (more := (beyond >= size) & (size < widest)).any():
        size[more] = np.minimum(2 * size[more], widest)
    return size


def from_blocks(points: DataFrame, orders: range, low: float, neighbours: int, widest: int) -> DataFrame:
    """(id, nbr, sim): the nearest points of each point's blocks."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches):
            ids = block.column("id").to_numpy()
            m = unpacked(block.column("half"), np.float16).astype(np.float32)
            sims = m @ m.T
            np.fill_diagonal(sims, -2)
            size = np.minimum(capacity((sims >= low).sum(axis=1), neighbours, widest), len(ids) - 1)
            by = np.argsort(-sims, axis=1)[:, : max(0, size.max())]
            row, at = np.nonzero(np.arange(by.shape[1]) < size[:, None])
            near = by[row, at]
            yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(ids[near]), pa.array(sims[row, near])], names=["id", "nbr", "sim"])

    each = [in_order(points, k, "half", np.float16).mapInArrow(compare, "id long, nbr long, sim float") for k in orders]
    return reduce(DataFrame.unionByName, each)


def lists(found: DataFrame, low: float, neighbours: int, widest: int) -> DataFrame:
    """(id, nbr, sim, fresh, size): each point's nearest neighbours of those found, as many as its list holds."""
    once = found.groupBy("id", "nbr").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    first = Window.partitionBy("id").orderBy(F.col("sim").desc(), "nbr")
    most = once.withColumn("at", F.row_number().over(first)).where(F.col("at") <= widest)
    most = most.withColumn("beyond", F.sum((F.col("sim") >= low).cast("int")).over(Window.partitionBy("id")))
    sizes = [neighbours]
    while sizes[-1] < widest:
        sizes.append(min(2 * sizes[-1], widest))
    size: Column = F.lit(widest)
    for k in reversed(sizes[:-1]):
        size = F.when(F.col("beyond") < k, k).otherwise(size)
    return written(most.withColumn("size", size).where("at <= size").drop("at", "beyond"), "lists")


def round_of(points: DataFrame, graph: DataFrame, number: int) -> DataFrame:
    """(id, nbr, sim): neighbours of neighbours that are nearer than what the lists of their points have."""
    own = graph.groupBy("id").agg(F.when(F.count("*") >= F.max("size"), F.min("sim")).otherwise(-2.0).cast("float").alias("worst"))
    known = points.select("id", "half").join(own, "id", "left").select(F.col("id").alias("x"), "half", F.coalesce("worst", F.lit(-2.0)).cast("float").alias("worst"))
    forward = graph.select(F.col("id").alias("z"), F.col("nbr").alias("x"), "fresh")
    turn = Window.partitionBy("z").orderBy(F.col("fresh").desc(), F.xxhash64("x", F.lit(number)))
    backward = graph.select(F.col("nbr").alias("z"), F.col("id").alias("x"), "fresh").withColumn("at", F.row_number().over(turn))
    near = forward.unionByName(backward.where(F.col("at") <= BACKWARD).drop("at"))
    near = near.groupBy("z").agg(F.collect_set(F.struct("x", "fresh")).alias("near")).where(F.exists("near", lambda v: v["fresh"]))
    near = near.select("z", F.inline("near")).join(known, "x")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_runs(batches, "z"):
            xs, fresh, worst = (part.column(c).to_numpy() for c in ("x", "fresh", "worst"))
            halves = part.column("half").to_pylist()
            out: list[tuple[np.ndarray, ...]] = []
            for a, b in runs_of(part.column("z").to_numpy()):
                half = np.frombuffer(b"".join(halves[a:b]), dtype=np.float16).reshape(b - a, -1).astype(np.float32)
                sims = half @ half.T
                meets = (fresh[a:b, None] | fresh[a:b]) & (sims > worst[a:b, None]) & (xs[a:b, None] != xs[a:b])
                i, j = np.nonzero(meets)
                out.append((xs[a + i], xs[a + j], sims[i, j]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["id", "nbr", "sim"])

    met = near.select("z", "x", "fresh", "worst", "half").repartition("z").sortWithinPartitions("z")
    return met.mapInArrow(meet, "id long, nbr long, sim float")


def neighbour_graph(points: DataFrame, held: DataFrame | None, orders: range, low: float, neighbours: int = NEIGHBOURS, widest: int = WIDEST) -> DataFrame:
    """The lists of all points, from blocks of some orders and what was held before, refined until they settle."""
    found = from_blocks(points, orders, low, neighbours, widest).withColumn("fresh", F.lit(True))
    if held is not None:
        found = found.unionByName(held.select("id", "nbr", "sim", F.lit(False).alias("fresh")))
    graph = lists(found, low, neighbours, widest)
    for k in range(ROUNDS):
        entries, fresh = graph.agg(F.count("*"), F.count_if("fresh")).first()
        if fresh <= SETTLED * entries:
            break
        more = round_of(points, graph, k).withColumn("fresh", F.lit(True))
        graph = lists(more.unionByName(graph.select("id", "nbr", "sim", F.lit(False).alias("fresh"))), low, neighbours, widest)
    return graph


def cosines(batches: Iterator[pa.RecordBatch], left: str, right: str) -> Iterator[pa.RecordBatch]:
    """The columns but for two of unit vectors, and their cosine."""
    for batch in batches:
        x, y = (batch.column(c).to_pylist() for c in (left, right))
        sims = [float(np.frombuffer(a) @ np.frombuffer(b)) for a, b in zip(x, y, strict=True)]
        keep = [c for c in batch.schema.names if c not in (left, right)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sims, pa.float64())], names=[*keep, "cos"])


def links_of(graph: DataFrame, points: DataFrame, threshold: float) -> DataFrame:
    """(a, b): pairs of the graph with a cosine of the threshold or more, a < b."""
    pairs = graph.where(F.col("sim") >= threshold - MARGIN).select(F.least("id", "nbr").alias("a"), F.greatest("id", "nbr").alias("b"), "sim")
    pairs = written(pairs.groupBy("a", "b").agg(F.max("sim").alias("sim")), "pairs")
    sure = pairs.where(F.col("sim") >= threshold + MARGIN).select("a", "b")
    close = pairs.where(F.col("sim") < threshold + MARGIN).select("a", "b")
    close = close.join(points.select(F.col("id").alias("a"), F.col("exact").alias("x")), "a").join(points.select(F.col("id").alias("b"), F.col("exact").alias("y")), "b")
    close = close.mapInArrow(lambda batches: cosines(batches, "x", "y"), "b long, a long, cos double")
    return written(sure.unionByName(close.where(F.col("cos") >= threshold).select("a", "b")), "links")


def under_leaders(points: DataFrame, half_angle: float) -> DataFrame:
    """(id, leader): points under a point within the angle, themselves if they lead.

    Blocks of points in some order choose the points that cover most others.  Then the leaders
    alone go through another order, and whoever was under one that gives way is compared with
    the new leader, and leads itself if it is too far away.
    """
    least = float(np.cos(half_angle))

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches):
            ids = block.column("id").to_numpy()
            m = unpacked(block.column("exact"), np.float64)
            near = m @ m.T >= least
            np.fill_diagonal(near, True)
            leader, left = np.arange(len(ids)), np.ones(len(ids), dtype=bool)
            for i in np.argsort(-near.sum(axis=1), kind="stable"):
                if left[i]:
                    leader[near[i] & left] = i
                    left &= ~near[i]
            moves = np.flatnonzero(leader != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[moves]), pa.array(ids[leader[moves]])], names=["leader", "new"])

    vectors = points.select("id", "exact")
    under = points.select("id", F.col("id").alias("leader"))
    leaders, n = points, points.count()
    for k in range(ROUNDS):
        moves = written(in_order(leaders, 1000 + k, "exact", np.float64).mapInArrow(cover, "leader long, new long"), "moves")
        moved = under.join(moves, "leader").join(vectors.withColumnRenamed("exact", "x"), "id")
        moved = moved.join(vectors.select(F.col("id").alias("new"), F.col("exact").alias("y")), "new")
        moved = moved.select("id", "new", "x", "y").mapInArrow(lambda batches: cosines(batches, "x", "y"), "id long, new long, cos double")
        moved = moved.select("id", F.when(F.col("cos") >= least, F.col("new")).otherwise(F.col("id")).alias("leader"))
        under = written(under.join(moves, "leader", "left_anti").select("id", "leader").unionByName(moved), "under")
        leaders = points.join(under.where("id = leader").select("id"), "id", "left_semi")
        before, n = n, leaders.count()
        if n > 0.9 * before:
            break
    return under


def met_by_leaders(points: DataFrame, leaders: DataFrame, angle: float) -> DataFrame:
    """(id, leader, sure): points that link with all points of a leader for sure, or may with some.

    Leaders (leader, width, exact, reach) come to the driver a block at a time; every block is
    compared with all points, and its outcome is written.
    """
    out, block, size = [], [], 0

    def compare(rows: list) -> DataFrame:
        ids = np.array([r["leader"] for r in rows])
        widths = np.array([r["width"] for r in rows])
        reach = np.array([r["reach"] for r in rows])
        of = {w: (np.flatnonzero(widths == w), np.array([np.frombuffer(r["exact"]) for r in rows if r["width"] == w])) for w in set(widths.tolist())}

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own, width = batch.column("id").to_numpy(), batch.column("width").to_numpy()
                for w, (at, m) in of.items():
                    here = np.flatnonzero(width == w)
                    for i in range(0, len(here), 1024):
                        some = here[i : i + 1024]
                        apart = np.arccos(np.clip(unpacked(batch.column("exact").take(pa.array(some)), np.float64) @ m.T, -1, 1))
                        row, col = np.nonzero(apart - reach[at] <= angle + EPSILON)
                        sure = (apart + reach[at] <= angle - EPSILON)[row, col]
                        yield pa.RecordBatch.from_arrays([pa.array(own[some[row]]), pa.array(ids[at[col]]), pa.array(sure)], names=["id", "leader", "sure"])

        return written(points.select("id", "width", "exact").mapInArrow(meet, "id long, leader long, sure boolean"), "met")

    for row in leaders.toLocalIterator():
        block.append(row)
        size += len(row["exact"])
        if size >= LEADER_BYTES:
            out.append(compare(block))
            block, size = [], 0
    if block:
        out.append(compare(block))
    return reduce(DataFrame.unionByName, out)


def compared_in_tiles(unsure: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(id, leader, n, back): weights of links between points and a leader's points that nothing else tells.

    Both sides are cut by hash into blocks, and each two blocks of a leader make a tile.  ``n``
    is what a point links with; where a point isn't saturated, the members get its weight as
    well, with ``back``.
    """

    def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
        many = rows.groupBy("leader").agg(F.ceil(F.count("*") / size).alias("many"))
        rows = rows.join(many, "leader").withColumn("block", F.pmod(F.xxhash64("id"), "many"))
        return rows.groupBy("leader", "block").agg(F.collect_list(F.struct("id", "weight", "saturated", "exact")).alias(name)).drop("block")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, other = (batch.column(c)[i].as_py() for c in ("points", "members"))
                x, y = (np.array([np.frombuffer(r["exact"]) for r in side]) for side in (one, other))
                linked = x @ y.T >= threshold
                linked &= np.array([r["id"] for r in one])[:, None] != np.array([r["id"] for r in other])
                there = linked @ np.array([r["weight"] for r in other])
                back = np.array([0 if r["saturated"] else r["weight"] for r in one]) @ linked
                ids = [r["id"] for r in one] + [r["id"] for r in other]
                leader = batch.column("leader")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([leader] * len(ids), pa.int64()), pa.array(np.concatenate([there, back]), pa.int64()), pa.array([False] * len(one) + [True] * len(other))],
                    names=["id", "leader", "n", "back"],
                )

    tiles = blocks(unsure, BLOCK, "points").join(blocks(members, 4 * BLOCK, "members"), "leader")
    return tiles.select("leader", "points", "members").mapInArrow(multiply, "id long, leader long, n long, back boolean").where("n > 0")


def saturated_links(points: DataFrame, saturated: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Weights (id, n) of all links that a saturated point has a part in, itself included, and edges (a, b) of the same classes."""
    angle = float(np.arccos(threshold))
    dense = written(points.join(saturated, "id", "left_semi"), "dense")
    under = under_leaders(dense, angle / 2 - EPSILON)
    vectors = dense.select(F.col("id").alias("leader"), F.col("width"), F.col("exact").alias("y"))
    members = written(dense.select("id", "weight", "exact").join(under, "id").withColumn("saturated", F.lit(True)), "members")
    apart = members.select("id", "weight", "leader", "exact").join(vectors, "leader").select("leader", "width", "weight", "exact", "y")
    apart = apart.mapInArrow(lambda batches: cosines(batches, "exact", "y"), "leader long, width int, weight long, cos double")
    # Cosines of a point with itself are 1 but for rounding.
    reach = F.acos(F.least(F.min("cos"), F.lit(1.0))) + EPSILON / 4
    sizes = written(apart.groupBy("leader", "width").agg(reach.alias("reach"), F.sum("weight").alias("total")), "leaders")
    leaders = sizes.join(vectors.select("leader", F.col("y").alias("exact")), "leader")
    met = written(met_by_leaders(points, leaders, angle).join(saturated.withColumn("saturated", F.lit(True)), "id", "left"), "met")
    met = met.withColumn("saturated", F.coalesce("saturated", F.lit(False)))
    sure = met.where("sure").join(sizes.select("leader", "total"), "leader")
    others = met.where("sure and not saturated").join(points.select("id", "weight"), "id").groupBy("leader").agg(F.sum("weight").alias("n"))
    unsure = met.where("not sure").select("id", "leader", "saturated").join(points.select("id", "weight", "exact"), "id")
    tiles = written(compared_in_tiles(unsure, members, threshold), "tiles")
    counts = sure.select("id", F.col("total").alias("n")).unionByName(members.join(others, "leader").select("id", "n"))
    edges = sure.select(F.col("id").alias("a"), F.col("leader").alias("b")).unionByName(tiles.where("not back").select(F.col("id").alias("a"), F.col("leader").alias("b")))
    return counts.unionByName(tiles.select("id", "n")), edges


def linked_points(points: DataFrame, graph: DataFrame, threshold: float, widest: int = WIDEST) -> tuple[DataFrame, DataFrame]:
    """Weights of the links of points (id, n, saturated), and edges (a, b) of the same classes as the links."""
    links = links_of(graph, points, threshold)
    saturated = graph.where(F.col("sim") >= threshold - MARGIN).groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") >= widest).select("id")
    saturated = written(saturated, "saturated")
    some = not saturated.isEmpty()
    if some:
        dense, edges = saturated_links(points, saturated, threshold)
        for side in ("a", "b"):
            links = links.join(saturated.withColumnRenamed("id", side), side, "left_anti")
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("other")))
    counts = both.join(points.select(F.col("id").alias("other"), F.col("weight").alias("n")), "other").select("id", "n")
    edges = links.select("a", "b").unionByName(edges) if some else links.select("a", "b")
    counts = (counts.unionByName(dense) if some else counts).groupBy("id").agg(F.sum("n").alias("n"))
    counts = counts.join(saturated.withColumn("saturated", F.lit(True)), "id", "left")
    return written(counts.select("id", "n", F.coalesce("saturated", F.lit(False)).alias("saturated")), "counts"), edges


def recall(points: DataFrame, counts: DataFrame, threshold: float, sample: int = SAMPLE) -> float:
    """The share of the links of a sample that was found: random points, and as many with links.

    The sample's links are searched for among all points; they are counted, not listed.
    """
    own = F.when(F.col("saturated"), F.col("n") - F.col("weight")).otherwise(F.coalesce("n", F.lit(0))).alias("n")
    known = points.select("id", "width", "weight", "exact").join(counts, "id", "left")
    drawn = known.orderBy(F.xxhash64("id")).limit(sample).unionByName(known.where("n is not null").orderBy(F.xxhash64("id")).limit(sample))
    rows = drawn.select("id", "width", "exact", own).distinct().collect()  # two times the sample, at most
    ids, widths = np.array([r["id"] for r in rows]), np.array([r["width"] for r in rows])
    of = {w: (np.flatnonzero(widths == w), np.array([np.frombuffer(r["exact"]) for r in rows if r["width"] == w])) for w in set(widths.tolist())}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            own, width, weight = (batch.column(c).to_numpy() for c in ("id", "width", "weight"))
            for w, (at, m) in of.items():
                here = np.flatnonzero(width == w)
                for i in range(0, len(here), 1024):
                    some = here[i : i + 1024]
                    linked = m @ unpacked(batch.column("exact").take(pa.array(some)), np.float64).T >= threshold
                    linked &= ids[at][:, None] != own[some]
                    total[at] += linked @ weight[some]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["id", "n"])

    true = points.select("id", "width", "weight", "exact").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    true = {r["id"]: r["n"] for r in true.collect()}
    all_ = sum(true.values())
    return sum(min(r["n"], true.get(r["id"], 0)) for r in rows) / all_ if all_ else 1.0


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS, widest: int = WIDEST) -> DataFrame:
    """Per vector: vec_id, n_links, component_id and kept; see the module.

    Every row gives a row, and rows that repeat a vector or a vec_id are vectors of their own,
    each linked with its copies.  Vectors that are null, empty or zero, or hold null or non-finite
    components, link with nothing, nor do vectors of different widths.  A component without any
    vec_id has none.  ``kept`` compares vec_id with component_id, null with null as equal.  Other
    columns are ignored.  Warns if the sample's recall stays below RECALL.
    """
    if not 0 < threshold < 1:
        raise ValueError("a cosine between 0 and 1")
    own = own_vectors(embeddings)
    points = points_of(own)
    graph = None
    for start in range(STARTS):
        graph = neighbour_graph(points, graph, range(start * ORDERS, (start + 1) * ORDERS), threshold - MARGIN, neighbours, widest)
        counts, edges = linked_points(points, graph, threshold, widest)
        found = recall(points, counts, threshold)
        if found >= RECALL:
            break
    else:
        warnings.warn(f"recall of near duplicates is {found:.3f}", stacklevel=2)
    of = written(classes(edges), "classes")
    least = of.join(points.select(F.col("id").alias("node"), "vec_id"), "node").groupBy("root").agg(F.min("vec_id").alias("least"))
    of = of.join(least, "root").select(F.col("node").alias("id"), "least")
    n = F.coalesce("n", F.lit(0)) + F.when(F.col("saturated"), 0).otherwise(F.col("weight")) - 1
    told = points.select("id", "vec_id", "weight", "h1", "h2").join(counts, "id", "left").join(of, "id", "left")
    told = told.select("h1", "h2", n.cast("long").alias("n_links"), F.coalesce("least", "vec_id").alias("least"))
    rows = own.select("vec_id", "h1", "h2").join(told, ["h1", "h2"], "left")
    rows = rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("least")).alias("component_id"))
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op12_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))


#: Links are few on tables without copies, so all pairs can be listed; for tests and small tables.
OP12_SQL = """
WITH RECURSIVE kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM kept a JOIN kept b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, coalesce(l.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN least c ON e.vec_id = c.a LEFT JOIN links l ON e.vec_id = l.a
"""
