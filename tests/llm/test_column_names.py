"""Operators and stages on tables whose own columns have the names that are used inside."""

import corpus_pipeline
import numpy as np
import pytest
from stationcast.llm import decontamination, line_dedup, search, sharding

NAMES = ["gone", "_mark", "_doc", "_d", "_m", "_key", "_size", "_row", "_run", "_n", "_at", "_before", "_found", "_language", "mark", "own", "other", "rest", "h1", "h2", "language", "sig", "first"]
TEXTS = ["a b c d e f g h i j\nsecond line", "a b c d e f g h i j\nsecond line of it", None, "", "the quick brown fox jumps over the lazy dog again and again", "a b c d e f g h i j"]


def clashing(spark):
    rows = [(k, t, "en", *[f"{n}{k}" for n in NAMES]) for k, t in enumerate(TEXTS)]
    rows += [(None, TEXTS[0], "en", *NAMES), (None, "of its own, all alone", "en", *NAMES)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"{n} string" for n in NAMES))


def kept_columns(found, documents):
    """Every row has the values that its document had."""
    own = {(r.doc_id, r.gone): r for r in documents.collect()}
    for r in found.collect():
        assert all(r[n] == own[r.doc_id, r.gone][n] for n in NAMES)


def test_lines(spark):
    documents = clashing(spark)
    found = line_dedup.without_lines(documents)
    assert found.columns == [*documents.columns, "n_lines", "n_removed"] and found.count() == documents.count()
    kept_columns(found, documents)


def test_sharding(spark):
    documents = clashing(spark)
    found = sharding.shards(documents, sharding.text_key(), line_dedup.F.expr("coalesce(octet_length(text), 0) + 1L"), 3)
    assert found.columns == [*documents.columns, "shard", "slot"] and found.count() == documents.count()
    kept_columns(found, documents)


def test_decontamination(spark):
    documents = clashing(spark)
    benchmark = spark.createDataFrame([("x", "A b c d e f g h i j"), ("y", "nothing of the kind")], "item_id string, text string")
    kept = decontamination.clean(documents, benchmark)
    assert kept.columns == documents.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 2), (False, 3), (False, 4), (True, 0)]
    kept_columns(kept, documents)


@pytest.mark.parametrize("stage", [1, 2])
def test_stages(spark, stage):
    documents = clashing(spark)
    kept = corpus_pipeline.STAGES[stage][1](spark, documents, "/root/testdata/sf0.001")
    assert kept.columns == documents.columns
    kept_columns(kept, documents)


def test_searches_of_many_widths_and_repeated_ids(spark):
    rows = [(k, [float(k % 7), *[1.0] * (k % 1200)]) for k in range(1300)] + [(5, [3.0] * 4)] * 40 + [(7, [2.0] * 4)]
    vectors = spark.createDataFrame(rows, "id long, x array<double>")
    got = search.top_k(vectors.where("id % 20 = 0 or id = 7"), vectors, 20, query_block=4, shard_block=8).collect()
    want = {}
    for q, x in rows:
        if q % 20 == 0 or q == 7:
            scores = sorted((-int(np.dot(x, y)), i) for i, y in rows if len(x) == len(y) and i != q)[:20]
            want[q, len(x)] = [(i, -s) for s, i in scores]
    assert sorted((r.query_id, r.vec_id, r.score) for r in got) == sorted((q, i, s) for (q, _), found in want.items() for i, s in found)


def test_shards_hold_equal_bytes_in_the_order_of_the_key(spark):
    rng = np.random.default_rng(8)
    rows = [(None if k % 5 == 0 else k, "x" * int(n)) for k, n in enumerate(rng.integers(0, 400, 3000))] + [(None, "same text")] * 3000
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sharding.shards(documents, sharding.text_key(), line_dedup.F.expr("octet_length(text) + 1L"), 8).collect()
    assert sorted((str(r.doc_id), r.text) for r in found) == sorted((str(i), t) for i, t in rows)
    total = sum(len(t) + 1 for _, t in rows)
    for s in range(8):
        mine = [r for r in found if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        # At either end, by the tolerance or a row.
        assert abs(sum(len(r.text) + 1 for r in mine) - total / 8) <= 2 * (sharding.TOLERANCE * total / 8 + 400)
