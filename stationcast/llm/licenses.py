"""License scans: license phrases by word, and blocks of text that contain license templates.

Blocks are lines and, where a paragraph has several of them, overlapping runs of its words across the
line breaks, so that each passage as long as the longest template stands whole in one.  A block meets a template if it holds at least a given share of the
template's distinct words (containment).  The join is exact: the templates' words are ordered
by how many blocks of the corpus have them, rarest first; a block that meets a template has
one of the template's first words (prefix filter), enough of the templates' words at all
(length filter), and enough of them from that word on (positional filter).  What remains is
verified.  All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.session import written

from .base import table

# The phrases and labels of the base scan.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices that licenses ask for, as their words, and their labels.
TEMPLATES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
]

#: Share of a template's distinct words, in hundredths, that a block must hold.
PERCENT = 85

GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Between paragraphs: lines without words.
BLANK = r"\n" + GAP[:-1] + r"*\n"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: str | Column) -> Column:
    return F.translate(text, CAPITALS, SMALL)


def words(text: str | Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def blocks(documents: DataFrame, vocabulary: list[str], longest: int) -> DataFrame:
    """(doc_id, mark, block, held): lines and runs of words, and the words of the vocabulary that each has.

    Runs are of paragraphs of several lines: twice ``longest`` words, from every ``longest``-th on.
    """
    known = F.array(*map(F.lit, vocabulary))
    texts = documents.where("text is not null").select("doc_id", F.xxhash64("text").alias("mark"), lowered("text").alias("t"))
    lines = texts.select("doc_id", "mark", F.posexplode(F.split("t", "\n")).alias("n", "s"))
    # As a generated column, so that filters on it don't compute it again.
    lines = lines.select("doc_id", "mark", F.struct(F.lit(0).alias("paragraph"), "n").alias("block"), F.explode(F.array(F.array_intersect(words("s"), known))).alias("held"))
    paragraphs = texts.select("doc_id", "mark", F.posexplode(F.split("t", BLANK)).alias("p", "s")).where(F.instr("s", "\n") > 0)
    paragraphs = paragraphs.select("doc_id", "mark", (F.col("p") + 1).alias("paragraph"), F.explode(F.array(words("s"))).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - longest, F.lit(1)) - 1, F.lit(longest))
    runs = F.transform(starts, lambda at: F.array_intersect(F.slice("w", at + 1, 2 * longest), known))
    runs = paragraphs.select("doc_id", "mark", "paragraph", F.posexplode(runs).alias("n", "held"))
    return lines.union(runs.select("doc_id", "mark", F.struct("paragraph", "n").alias("block"), "held"))


def template_matches(documents: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """(doc_id, mark, block, label, containment) for every block and template that meet."""
    spark = documents.sparkSession
    sets = [(sorted(set(text.split())), label) for text, label in templates]
    vocabulary = sorted({w for own, _ in sets for w in own})
    least = min(-(-percent * len(own) // 100) for own, _ in sets)
    held = written(blocks(documents, vocabulary, max(len(text.split()) for text, _ in templates)).where(F.size("held") >= least), "blocks")
    counts = {r["w"]: r["n"] for r in held.select(F.explode("held").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: k for k, w in enumerate(order)}
    ranks = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    ordered = held.select("doc_id", "mark", "block", F.sort_array(F.transform("held", lambda w: F.get(F.array(*map(F.lit, range(len(order)))), ranks[w]))).alias("held"))
    heads, whole = [], []
    for k, (own, label) in enumerate(sets):
        mine = sorted(rank[w] for w in own)
        need = -(-percent * len(mine) // 100)
        whole.append((k, label, need, mine))
        heads += [(r, k, at) for at, r in enumerate(mine[: len(mine) - need + 1])]
    head = spark.createDataFrame(heads, "word int, template int, at int")
    full = spark.createDataFrame(whole, "template int, label string, need int, words array<int>")
    # The templates are a parameter: their tables are small whatever the documents are.
    found = ordered.select("*", F.posexplode("held").alias("place", "word")).join(F.broadcast(head), "word").join(F.broadcast(full), "template")
    rest = F.least(F.size("held") - F.col("place"), F.size("words") - F.col("at"))
    found = found.where(F.size("held") >= F.col("need")).where(rest + F.least("place", "at") >= F.col("need"))
    found = found.withColumn("k", F.size(F.array_intersect("held", "words"))).where("k >= need")
    return found.select("doc_id", "mark", "block", "label", (F.col("k") / F.size("words")).alias("containment")).distinct()


def phrase_places(documents: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word and base (labels) of phrases to documents."""
    some = "|".join("(?:" + GAP.join(p.split()) + ")" for p in phrases)
    has = F.coalesce(F.col("text").rlike("(?i)" + some), F.lit(False))
    # Each word stands between spaces of its own, so that places next to each other both count.
    row = F.concat(F.lit(" "), F.array_join(words(lowered("text")), "  "), F.lit(" "))
    out = documents.withColumn("n_words", F.when(F.col("text").isNull(), 0).otherwise(F.size(words("text"))).cast("long"))
    out = out.withColumn("_row", F.when(has, row))
    # The words before a place: each has two spaces.
    before = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases.items():
        spaced = " " + "  ".join(phrase.split()) + " "
        times = (F.length("_row") - F.length(F.replace("_row", F.lit(spaced), F.lit("")))) / len(spaced)
        n = F.coalesce(times.cast("long"), F.lit(0).cast("long"))
        counts.append(n)
        firsts.append(F.when(n > 0, (before(F.substring_index("_row", spaced, 1)) / 2).cast("long")))
        lasts.append(F.when(n > 0, F.col("n_words") - len(phrase.split()) - (before(F.substring_index("_row", spaced, -1)) / 2).cast("long")))
        labels.append(F.when(n > 0, F.lit(label)))
    total = counts[0]
    for n in counts[1:]:
        total = total + n
    least = F.array_min(F.array(*firsts))
    most = F.array_max(F.array(*lasts))
    return out.withColumns({"n_base": total, "first_word": least, "last_word": most, "base": F.array_compact(F.array(*labels))}).drop("_row")


def licenses(documents: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score.

    The score is 1 where a phrase stands, else the highest containment of a template's words
    in a block (0 if below the threshold).  Every row gives a row; null and empty texts have no
    words.  Rows that share doc_id and text share what is found.  Other columns are ignored.
    """
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    met = template_matches(own, templates, percent).groupBy(F.col("doc_id").alias("_d"), F.col("mark").alias("_m"))
    met = met.agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    based = phrase_places(own, phrases).withColumn("mark", F.xxhash64("text")).drop("text")
    out = based.join(met, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m")), "left")
    every = F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"), score.alias("score"),
    )


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses(table(spark, folder, "documents"))


def _oracle() -> str:
    templates = ", ".join(f"({k}, '{label}', string_split('{text}', ' '))" for k, (text, label) in enumerate(TEMPLATES))
    phrases = ", ".join(f"('{label}', string_split('{phrase}', ' '))" for phrase, label in PHRASES.items())
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH templates AS (SELECT k, label, list_distinct(w) AS w FROM (VALUES {templates}) t(k, label, w)),
phrases AS (FROM (VALUES {phrases}) t(label, p)),
lowered AS (SELECT doc_id, translate(text, '{CAPITALS}', '{SMALL}') AS t FROM documents),
docs AS (SELECT doc_id, coalesce(regexp_extract_all(t, '{word}'), []) AS w FROM lowered),
base AS (
  SELECT doc_id, count(*) AS n, min(i) - 1 AS first, max(i) - 1 AS last, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, list(DISTINCT label) AS l
  FROM (SELECT doc_id, w, label, p, unnest(range(1, len(w) + 1)) AS i FROM docs, phrases) WHERE w[i:i + len(p) - 1] = p GROUP BY doc_id),
lines AS (SELECT doc_id, list_distinct(regexp_extract_all(unnest(string_split(t, chr(10))), '{word}')) AS b FROM lowered),
met AS (
  SELECT doc_id, max(k::DOUBLE / n) AS best, list(DISTINCT label) AS l
  FROM (SELECT doc_id, label, len(w) AS n, len(list_intersect(b, w)) AS k FROM lines, templates) WHERE 100 * k >= {PERCENT} * n GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, first::BIGINT AS first_word, last::BIGINT AS last_word,
  coalesce(base.labels, '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.l, []), coalesce(met.l, [])))), ',') AS labels,
  CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM docs d LEFT JOIN base ON d.doc_id = base.doc_id LEFT JOIN met ON d.doc_id = met.doc_id
"""


OP4_SQL = _oracle()
