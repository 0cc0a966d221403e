"""A training corpus from documents, in five stages: language, lines, near copies, benchmark, packing.

Each stage is a function of (spark, docs, folder of tables).  Its result is written as
Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.llm.base import findable, free_name, table
from stationcast.llm.decontamination import clean
from stationcast.llm.language import fit, held_out, identify
from stationcast.llm.line_dedup import without_lines
from stationcast.llm.ngram_join import later_copies
from stationcast.llm.packing import packed
from stationcast.session import written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier doesn't reject."""
    findable(spark)
    model = fit(docs.select("doc_id", "text", "lang").where(~held_out()))
    name = free_name(docs.columns, "language")
    return identify(docs, model, docs.columns, name).where(~F.col(f"{name}.rejected")).drop(name)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that repeat earlier ones; documents that have none left go."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    own = docs.select("doc_id", "text", F.struct(F.lit(0), *[docs[f"`{c}`"] for c in rest]).alias("rest"))
    found = without_lines(own).where("n_removed < n_lines")
    found = found.select(*[F.col(c if c in ("doc_id", "text") else f"rest.`{c}`") for c in docs.columns])
    return found.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else found


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first row of each group of near copies, by word 5-grams at 80 hundredths.

    Rows are decided one by one, by doc_id (nulls last) and hash of the text: different texts
    under one doc_id, or under none, are documents of their own.  Only rows equal in both are one.
    """
    findable(spark)
    gone = later_copies(docs.select("doc_id", "text"), n=5, percent=80)
    name = free_name(docs.columns, "mark")
    rows = docs.withColumn(name, F.xxhash64("text"))
    kept = rows.join(gone, rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows[name] == gone["mark"]), "left_anti")
    return kept.dropDuplicates(["doc_id", name]).drop(name)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no benchmark window."""
    findable(spark)
    return clean(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the documents in training sequences."""
    findable(spark)
    return packed(docs)


STAGES = [
    ("language", known_language),
    ("lines", distinct_lines),
    ("near copies", distinct_documents),
    ("benchmark", no_benchmark),
    ("packing", sequences),
]

#: Classification and packing can't be stated in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
