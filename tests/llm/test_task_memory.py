"""What a task holds beside its rows stays small."""

import tracemalloc

import pyarrow as pa

from stationcast.llm import base, ngram_join


def test_words_are_hashed_in_small_parts():
    data, offsets = base.text_buffer(pa.array(["some words of a text " * 100_000]))
    base._POWERS.clear()
    tracemalloc.start()
    hashes = base.word_hashes(data, offsets, base.SPACED)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(hashes) == 500_000 and len(set(hashes.tolist())) == 5
    assert sum(x.nbytes for x in base._POWERS.values()) < 16 << 20
    assert peak < 50 << 20


def test_compressing_and_growing_are_in_different_stages(spark):
    documents = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    wanted = spark.range(1).selectExpr("id as rep", "id as sig")
    plan = ngram_join.gram_rows(documents, wanted, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") >= 2 and "BroadcastHashJoin" not in plan
