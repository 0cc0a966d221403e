"""Registered queries equal their SQL, and the pipeline keeps what it should."""

import corpus_pipeline
import pytest
from oracle import compare, connect
from stationcast.llm.language import fit, held_out, identify
from stationcast.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    problem, _ = compare(name, QUERIES[name], ORACLES[name], spark, connect(FOLDER), FOLDER)
    assert problem is None, problem


def test_language_is_found_for_held_out_documents(spark):
    found = QUERIES["op6_language_id"](spark, FOLDER).where("held_out")
    known = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = found.join(known, "doc_id").where("lang is not null and lang_pred <> 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)


def test_pipeline(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs, kept = documents, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == documents.columns
        docs = spark.createDataFrame(docs.collect(), documents.schema)
        kept.append(docs.count())
    assert documents.count() >= kept[0] >= kept[1] >= kept[2] >= kept[3] > 0
    rows = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in rows.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_language_model_is_the_same_for_any_partitions(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    models = [fit(documents.repartition(n).where(~held_out()), sample=20) for n in (1, 5)]
    assert models[0].languages == models[1].languages and models[0].floor == models[1].floor
    assert (models[0].centroids == models[1].centroids).all()


def test_rejected_documents_are_shown(spark):
    found = QUERIES["op6_language_id"](spark, FOLDER)
    assert {r.rejected for r in found.where("lang_pred = 'und'").collect()} <= {True}
    model = fit(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    odd = spark.createDataFrame([(1, "zq xj qz jx " * 30), (2, ""), (3, None)], "doc_id long, text string")
    assert [r["_language"].rejected for r in identify(odd, model, ["doc_id"]).orderBy("doc_id").collect()] == [True, True, True]
