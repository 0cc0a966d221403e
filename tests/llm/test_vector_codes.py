"""Codes against a plain search of every entry, and what the tree leaves out."""

from hashlib import sha256

import numpy as np
import pytest

from stationcast.llm.vector_codes import encoded, fitted, gnat, nearest_entries, squared_distances, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, part int"


@pytest.mark.parametrize("spread", [0, 1, 3, 1000, 1 << 27])
def test_tree_finds_the_nearest_entry_and_the_lower_index_of_ties(spread):
    rng = np.random.default_rng(spread)
    for n, width in ((1, 3), (12, 2), (13, 2), (256, 4), (256, 1), (200, 0)):
        book = rng.integers(-spread, spread + 1, (n, width))
        queries = np.concatenate([book, rng.integers(-spread, spread + 1, (100, width)), book + rng.integers(0, 2, book.shape)])
        index, best, _ = nearest_entries(gnat(book), book, queries)
        each = [[sum((int(a) - int(b)) ** 2 for a, b in zip(q, e, strict=True)) for e in book] for q in queries]
        assert index.tolist() == [d.index(min(d)) for d in each]
        assert best.tolist() == [min(d) for d in each]


def test_tree_leaves_out_far_regions():
    rng = np.random.default_rng(5)
    book = (rng.integers(-1000, 1000, (16, 1, 16)) + rng.integers(-40, 41, (16, 16, 16))).reshape(256, 16)
    queries = book[rng.integers(0, 256, 2000)] + rng.integers(-10, 11, (2000, 16))
    index, _, computed = nearest_entries(gnat(book), book, queries)
    assert (index == squared_distances(queries, book).argmin(axis=1)).all()
    assert computed < 0.25 * 2000 * 256


def recount(rows, parts, entries, rounds):
    kept = [(i, np.floor(np.array(x) * 1024).astype(int).tolist(), label) for i, x, label in rows if x and None not in x and np.isfinite(x).all()]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    d = len(kept[0][1]) // parts
    cut = lambda x, p: x[p * d : p * d + d]
    books = [[cut(r[1], p) for r in first] for p in range(parts)]

    def nearest(x, book):
        each = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book]
        return each.index(min(each)), min(each)

    for _ in range(rounds):
        for p, book in enumerate(books):
            of = [nearest(cut(r[1], p), book)[0] for r in kept]
            for e in range(len(book)):
                mine = [cut(r[1], p) for r, k in zip(kept, of, strict=True) if k == e]
                if mine:
                    book[e] = [sum(v) // len(mine) for v in zip(*mine, strict=True)]
    out = []
    for i, x, label in kept:
        near = [nearest(cut(x, p), book) for p, book in enumerate(books)]
        out.append((i, "".join(f"{n:02x}" for n, _ in near), sum(e for _, e in near), label))
    digest = sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(((i, c, e, sum(o[2] for o in out if o[3] == label), digest) for i, c, e, label in out), key=str)


def test_codes_equal_a_recount(spark):
    rng = np.random.default_rng(1)
    rows = [(i * 3 % 61, rng.normal(size=8).round(3).tolist(), None if i % 7 == 0 else i % 3) for i in range(61)]
    rows += [(7, rows[7][1], 1), (7, rows[8][1], 1), (None, rows[9][1], None), (70, [5.0] * 8, 1), (71, [5.0] * 8, 2)]
    rows += [(80, None, 1), (81, [1.0, None] * 4, 1), (82, [float("nan")] * 8, 1), (83, [float("inf")] * 8, 1)]
    embeddings = spark.createDataFrame([(*r, "own", 9) for r in rows], SCHEMA).repartition(3)
    found = vector_codes(embeddings, parts=2, entries=10, rounds=3)
    assert sorted((tuple(r) for r in found.collect()), key=str) == recount(rows, 2, 10, 3)


def test_other_widths_and_huge_components_are_left_out(spark):
    rows = [(1, [0.5, 0.25, 1.0], 1), (2, [1.0] * 4, 1), (3, [1e300, 0.0, 0.0], 1), (4, [], 1), (5, [0.5, 0.25, 0.0], None)]
    embeddings = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
    assert [(r.vec_id, r.code, r.error) for r in vector_codes(embeddings, parts=2).orderBy("vec_id").collect()] == [(1, "0000", 0), (5, "0001", 0)]


def test_codes_decode(spark):
    rows = [(i, [i / 8, -i / 4, 0.5, 1.0], 0, "", 0) for i in range(20)]
    embeddings = spark.createDataFrame(rows, SCHEMA)
    books = fitted(embeddings, parts=2, rounds=1)
    decoded = books.decode(encoded(embeddings, books).select("vec_id", "code")).collect()
    assert all(np.abs(np.array(r.vector) - rows[r.vec_id][1]).max() <= 1 / 1024 for r in decoded) and len(decoded) == 20
    assert books.table(spark).count() == 40


def test_empty_table(spark):
    assert vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert vector_codes(spark.createDataFrame([(1, None, 1, "", 0)], SCHEMA)).count() == 0
