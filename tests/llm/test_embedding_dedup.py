"""Near duplicates of embeddings against all pairs, in lists and beyond them."""

import numpy as np
import pytest

from stationcast.llm.embedding_dedup import capacity, near_duplicates, points_of, own_vectors, under_leaders

SCHEMA = "vec_id long, embedding array<double>, id long, weight string"


def recount(rows, threshold=0.9):
    """(vec_id, n_links, component_id, kept) by all pairs of rows."""
    fine = [x is not None and len(x) > 0 and None not in x and bool(np.isfinite(x).all()) and any(x) for _, x in rows]
    unit = [np.array(x) / np.abs(x).max() if f else None for (_, x), f in zip(rows, fine, strict=True)]
    unit = [None if u is None else u / np.sqrt(u @ u) for u in unit]
    n = len(rows)
    linked = [[j for j in range(n) if j != i and fine[i] and fine[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, open_ = {i}, [i]
        while open_:
            new = [j for j in linked[open_.pop()] if j not in seen]
            seen.update(new)
            open_ += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((rows[i][0], len(linked[i]), least, rows[i][0] == least))
    return sorted(out, key=str)


def compare(spark, rows, **settings):
    embeddings = spark.createDataFrame([(i, None if x is None else [None if v is None else float(v) for v in x], 3, "own") for i, x in rows], SCHEMA)
    found = near_duplicates(embeddings.repartition(3), **settings).collect()
    assert sorted((tuple(r) for r in found), key=str) == recount(rows)


def groups(seed, sizes, width=24, spread=0.25):
    """Copies around a center, whose distances reach over the threshold, and as many that have none."""
    rng = np.random.default_rng(seed)
    out = []
    for n in sizes:
        center = rng.normal(size=width)
        out += [center + spread * rng.normal(size=width) for _ in range(n)]
    return out + list(rng.normal(size=(len(out), width)))


def test_lists_hold_all_links(spark):
    vectors = groups(1, [2] * 60 + [3, 5, 9, 17, 40])
    compare(spark, [(len(vectors) - k, v.tolist()) for k, v in enumerate(vectors)])


@pytest.mark.parametrize("spread", [0.03, 0.2, 0.3])
def test_groups_beyond_the_widest_list(spark, spread):
    """Tight groups are counted by leader; wide ones need tiles, and have links with points of short lists."""
    vectors = groups(2, [90, 30, 3, 2, 2], spread=spread)
    compare(spark, [(k, v.tolist()) for k, v in enumerate(vectors)], neighbours=4, widest=16)


def test_nulls_repeats_widths_and_odd_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(5, same), (5, same), (6, same), (7, [2.0, 4.0, 6.0]), (None, same), (8, [1.0, 2.0]), (9, [2.0, 4.1]), (10, None), (11, [])]
    rows += [(12, [0.0] * 3), (13, [1.0, None, 2.0]), (14, [float("nan")] * 3), (15, [float("inf"), 1.0, 1.0]), (16, [1e300, 2e300, 3e300])]
    rows += [(17, [1e-300, 2e-300, 3e-300]), (None, [-5.0, 1.0, 0.0]), (None, [-5.0, 1.0, 0.0]), (18, [-0.0, 0.0, 1.0]), (19, [0.0, -0.0, 1.0])]
    compare(spark, rows)


def test_many_equal_vectors(spark):
    vectors = groups(3, [4] * 10)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)] + [(1000 + k, vectors[0].tolist()) for k in range(300)]
    compare(spark, rows, neighbours=2, widest=4)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_lists_double_while_they_are_saturated():
    assert capacity(np.array([0, 7, 8, 16, 31, 32, 500]), 8, 128).tolist() == [8, 8, 16, 32, 32, 64, 128]


def test_leaders_are_within_the_angle(spark):
    vectors = groups(4, [600, 50], spread=0.05)
    points = points_of(own_vectors(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")))
    under = under_leaders(points, 0.22)
    unit = {r.id: np.frombuffer(r.exact) for r in points.collect()}
    rows = under.collect()
    assert sorted(r.id for r in rows) == sorted(unit)
    assert all(unit[r.id] @ unit[r.leader] >= np.cos(0.22) - 1e-12 for r in rows)
    assert {r.leader for r in rows} == {r.id for r in rows if r.id == r.leader}
    assert len({r.leader for r in rows}) < 670  # of the 1,300 points, the 650 alone lead themselves
