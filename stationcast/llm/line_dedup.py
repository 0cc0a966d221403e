"""Line deduplication across a corpus, as an exact set-similarity join of lines.

A line's tokens are its distinct word 5-grams (lower case; a line of fewer words is one
token).  A line is removed if an earlier line has Jaccard similarity 0.8 or more with it;
earlier goes by doc_id, then line number.  All steps are DataFrame operations:

1. Equal lines form a class, and only its first line goes on.
2. Lines that share too few of their least tokens with any other can't be similar to one and
   leave; this moves a few 32-bit values per line.  Here, tokens are ordered by the hash of their
   first word, so that only those few are hashed at all.
3. The tokens of the rest are ordered by rarity.  Similar lines share one among their first
   tokens (prefix filter), are of similar size (length filter), and have enough tokens
   after it (positional filter).  Each line is compared with the earliest of the first lines
   of its tokens, then, while that doesn't settle it, with the other first lines, then
   with all earlier ones that share a token.
4. Overlaps are counted, and later lines removed.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.session import written

from .base import free_name, table
from .ngram_join import alike, first_grams, near, ordered_sets, sketch

WORDS = 5
PERCENT = 80
#: Share of the tokens, in hundredths, that step 2 looks at beyond what may differ.
AHEAD = 5
#: 64-bit words of a line's sketch.
SKETCH_WORDS = 2
#: Bits of the largest membership filter (8 MB).
FILTER_BITS = 1 << 26


def members(df: DataFrame, *key: str) -> tuple[DataFrame, int]:
    """A bit for every key of the table, by hash: a filter (part, bits) of pieces of 4 KB, and its number of bits.

    It only spares rows that can't be members a shuffle; an exact join follows wherever it is used.  The filter is
    a written table, so that plans name it and don't hold it.
    """
    n, bits = df.count(), 1 << 15
    while bits < FILTER_BITS and bits < 8 * n:
        bits *= 2
    place = F.pmod(F.xxhash64(*key), F.lit(bits))
    parts = df.select(place.alias("p")).groupBy(F.shiftright("p", 15).alias("part"))
    return written(parts.agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(32767)).alias("bits")), "members"), bits


def with_maybe(df: DataFrame, found: tuple[DataFrame, int], name: str, *key: str) -> DataFrame:
    """The rows with a column ``name``, which is false where the key is no member."""
    filter_, bits = found
    place = F.pmod(F.xxhash64(*key), F.lit(bits))
    byte = F.substr(F.col(f"{name}.bits"), (F.shiftright(place, 3).bitwiseAND(4095) + 1).cast("int"), F.lit(1))
    told = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), place.bitwiseAND(7).cast("int")) == 1
    # The filter is 8 MB at most; without a broadcast, all rows would be shuffled to spare some of them a shuffle.
    joined = df.join(F.broadcast(filter_).select(F.struct("part", "bits").alias(name)), F.shiftright(place, 15) == F.col(f"{name}.part"), "left")
    return joined.withColumn(name, F.coalesce(told, F.lit(False)))


def raw_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, mark, line, s): lines in lower case, with no white space but spaces; ``mark`` is a hash of the document's text."""
    other = "\t\x0b\f\r"
    # Places of characters would be counted one by one; whether they are there is told by bytes.
    has = reduce(or_, [F.col("text").contains(c) for c in other])
    spaced = F.lower(F.when(has, F.translate("text", other, " " * len(other))).otherwise(F.col("text")))
    found = documents.where("text is not null").select("doc_id", F.xxhash64("text").alias("mark"), spaced.alias("spaced"))
    return found.select("doc_id", "mark", F.posexplode(F.split("spaced", "\n")).alias("line", "s"))


def cleaned(lines: DataFrame) -> DataFrame:
    """The lines with single spaces between words, and ``class``, a hash of the line's words."""
    single = F.when(F.col("s").contains("  "), F.regexp_replace("s", " +", " ")).otherwise(F.col("s"))
    return lines.withColumn("s", F.trim(single)).withColumn("class", F.xxhash64("s"))


def plain_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, mark, line, s, class): lines with words, in lower case, with single spaces between words."""
    return cleaned(raw_lines(documents)).where("s <> ''")


def with_tokens(lines: DataFrame) -> DataFrame:
    """Lines with t, the distinct hashes of their word 5-grams, instead of s; the fewer words of a short line are one.

    Words are hashed once; hashes of neighbours are combined to those of two, four and five words.
    """

    def combined(df: DataFrame, name: str, first: str, second: str, step: int) -> DataFrame:
        # The last hashes, which lack a neighbour, are cut off once, at the end.
        later = F.slice(second, F.lit(step + 1), F.size(second))
        return df.withColumn(name, F.zip_with(first, later, lambda x, y: F.xxhash64(x, y)))

    rest = [c for c in lines.columns if c != "s"]
    found = lines.withColumn("w1", F.transform(F.split("s", " "), lambda x: F.xxhash64(x)))
    found = combined(found, "w2", "w1", "w1", 1)
    found = combined(found, "w4", "w2", "w2", 2)
    found = combined(found, "w5", "w4", "w1", WORDS - 1)
    n = F.size("w1") - (WORDS - 1)
    whole = F.slice("w5", F.lit(1), F.greatest(n, F.lit(0)))
    return found.select(*rest, F.when(n < 1, F.array("class")).otherwise(F.array_distinct(whole)).alias("t"))


def with_least(lines: DataFrame, percent: int) -> DataFrame:
    """Lines with least, 32-bit hashes of their first tokens by the hash of the first word, and need, instead of s.

    Similar lines share at least ``need`` of them.  All tokens up to a first word are taken, as many as may differ and
    some more, or else all of the line.  Places count as distinct tokens where more are looked at for it, and distinct
    first words do where fewer are to be shared.  Lines of fewer words equal no line of another class; they have none.
    """
    rest = [c for c in lines.columns if c != "s"]
    n = F.size("w1") - (WORDS - 1)
    ahead = n - F.ceil(n * percent / 100) + F.floor(n * AHEAD / 100) + 1
    token = lambda x, i: F.shiftright(F.xxhash64(x, *[F.get("w1", i + k) for k in range(1, WORDS)]), 32).cast("int")
    some = lambda end: F.transform("heads", lambda x, i: F.when(x <= end, token(x, i)))

    # Columns that are used twice are worked out once; within a function, that would be done for each word, and slowly.
    found = lines.withColumn("w1", F.transform(F.split("s", " "), lambda x: F.xxhash64(x)))
    found = found.select(*rest, "w1", F.least(n, ahead).cast("int").alias("ahead"), F.slice("w1", F.lit(1), F.greatest(n, F.lit(0))).alias("heads"))
    found = found.withColumn("ordered", F.sort_array("heads"))
    need = F.floor(F.ceil(F.size(F.array_distinct("ordered")) * percent / 100) * AHEAD / 100) + 1
    up_to = F.get(F.transform(F.array(F.get("ordered", F.col("ahead") - 1)), some), F.lit(0))
    found = found.withColumn("need", need.cast("int")).withColumn("some", up_to)
    # Nulls and repeated values leave.
    found = found.withColumn("some", F.array_except("some", F.array(F.lit(None).cast("int"))))
    least = F.when(F.size("some") >= F.col("ahead"), F.col("some")).otherwise(F.array_distinct(F.transform("heads", token)))
    return found.select(*rest, "need", least.alias("least"))


def similar(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of lines whose tokens have the Jaccard similarity; a line's tokens are one short row."""
    left = held.select(F.col("sig").alias("a"), F.col("size").alias("m"), F.col("held").alias("ours"))
    right = held.select(F.col("sig").alias("b"), F.col("size").alias("n"), F.col("held").alias("theirs"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    both = both.select("a", "b", "m", "n", F.size(F.array_intersect("ours", "theirs")).alias("k"))
    return both.where(100 * F.col("k") >= percent * (F.col("m") + F.col("n") - F.col("k"))).select("a", "b")


def late_classes(documents: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """Classes (class) whose first line has a similar earlier line."""
    rows = firsts.where("id is not null").select("id", F.explode("least").alias("token")).repartition("token")
    # Both sides of the join have the same columns, so that one shuffle serves them.
    shared = rows.groupBy("token").agg(F.min("id").alias("least_id"), F.max("id").alias("hi")).where("least_id <> hi").select("token")
    some = rows.join(shared.hint("shuffle_hash"), "token").groupBy("id").agg(F.count("*").alias("k"))
    kept = firsts.select("id", "class", "doc_id", "mark", "line", "need").join(some, "id").where("k >= need")
    kept = written(kept.select("class", "doc_id", "mark", "line"), "lines")

    # Other lines are left out before they are cleaned or moved, or their words looked at; none that is kept lacks words.
    place = ["class", "mark", "line"]
    told = with_maybe(raw_lines(documents), members(kept, "mark", "line"), "told", "mark", "line").where("told").drop("told")
    wanted = cleaned(told).join(kept.withColumnRenamed("doc_id", "doc"), place).where(F.col("doc_id").eqNullSafe(F.col("doc")))
    wanted = wanted.dropDuplicates(place)  # of repeated rows
    wanted = written(wanted.select("class", "s"), "wanted")
    # No line is without tokens or size; filters of such lines would tokenise them once more.
    grams = with_tokens(wanted).select(F.col("class").alias("sig"), F.coalesce(F.size("t"), F.lit(0)).cast("long").alias("size"), F.explode_outer("t").alias("gram"))
    held = ordered_sets(grams, percent, "shuffle_hash")

    at = kept.select(F.col("class").alias("sig"), F.struct("doc_id", "line", "mark").alias("first"))
    heads = first_grams(held.withColumn("bits", sketch(SKETCH_WORDS)), percent, "bits")
    heads = written(heads.join(at, "sig"), "heads")
    may = near(percent) & alike(percent, SKETCH_WORDS)
    least = heads.groupBy("gram").agg(F.min(F.struct("first", "sig", "size", "at", "alone", "bits")).alias("y"), F.count("*").alias("n")).where("n > 1")
    stars = heads.alias("x").join(least.select("gram", "y.*").alias("y"), "gram").where("x.sig <> y.sig").where(may)
    stars = stars.groupBy(F.col("x.sig").alias("a"), F.col("y.sig").alias("b")).agg(F.min("y.first").alias("first"))
    stars = written(stars, "stars")
    best = stars.groupBy("a").agg(F.min(F.struct("first", "b")).alias("y")).select("a", "y.b")
    settled = written(similar(best, held, percent).select("a").distinct(), "settled")
    other = stars.join(settled, "a", "left_anti").join(best, ["a", "b"], "left_anti")
    late = settled.union(similar(other, held, percent).select("a").distinct()).withColumnRenamed("a", "sig")
    late = written(late, "late")
    rest = heads.join(late, "sig", "left_anti").alias("x")
    pairs = rest.join(heads.alias("y"), "gram").where("y.first < x.first and x.sig <> y.sig").where(may)
    pairs = pairs.select(F.col("x.sig").alias("a"), F.col("y.sig").alias("b")).distinct().join(stars.select("a", "b"), ["a", "b"], "left_anti")
    more = similar(pairs, held, percent).select(F.col("a").alias("sig"))
    return late.union(more).distinct().withColumnRenamed("sig", "class")


def removed_lines(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, mark, gone): the numbers of a document's lines that are removed."""
    lines = written(with_least(plain_lines(documents), percent).select("doc_id", "mark", "line", "class", "need", "least"), "lines")
    place = F.struct("doc_id", "line", "mark")
    firsts = lines.groupBy("class").agg(F.min(place).alias("f"), F.count("*").alias("n"), F.first("need").alias("need"), F.first("least").alias("least"))
    firsts = written(firsts.select("class", "f.*", "n", "need", "least").withColumn("id", F.monotonically_increasing_id()), "firsts")
    late = written(late_classes(documents, firsts, percent).withColumn("late", F.lit(True)), "late")
    told = firsts.select("class", place.alias("f"), "n").join(late, "class", "left").where("n > 1 or late")
    gone = lines.select("class", "doc_id", "mark", "line").join(told, "class").where(F.col("late").isNotNull() | ~place.eqNullSafe(F.col("f")))
    return written(gone.groupBy("doc_id", "mark").agg(F.collect_set("line").alias("gone")), "gone")


def without_lines(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, their text without removed lines, and n_lines and n_removed.

    Every row gives a row with all its columns.  Null text stays null, with no lines; an empty
    text is one line.  Lines without words are never removed.  Repeated rows count as one
    document; rows that share a doc_id are ordered by line number, then by a hash of their
    text.  A null doc_id comes before all others.  Columns named n_lines or n_removed are
    replaced.
    """
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gone = removed_lines(own, percent)
    touched = gone.select("doc_id", "mark")
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    all_ = documents.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(breaks + 1).cast("long"))
    own, other = free_name([*all_.columns, "n_removed"], "own"), free_name([*all_.columns, "n_removed"], "other")
    named = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("mark"))
    marked = all_.withColumn("n_removed", F.lit(0).cast("long")).withColumn(own, named)
    columns = list(dict.fromkeys([*all_.columns, "n_removed"]))
    told = free_name([*marked.columns, other], "told")
    marked = with_maybe(marked, members(touched, "doc_id", "mark"), told, f"{own}.doc_id", f"{own}.mark")
    lines = gone.select(F.struct("doc_id", "mark", "gone").alias(other))
    same = F.col(f"{own}.doc_id").eqNullSafe(F.col(f"{other}.doc_id")) & (F.col(f"{own}.mark") == F.col(f"{other}.mark"))
    part = marked.where(F.col(told)).join(lines, same, "left")
    # A column of its own: within the function, the text would be split once for each line.
    split = free_name(part.columns, "split")
    part = part.withColumn(split, F.split("text", "\n"))
    removed = F.col(f"{other}.gone")
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), removed)
    text = F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    part = part.withColumn("text", F.when(removed.isNull(), F.col("text")).otherwise(text))
    part = part.withColumn("n_removed", F.when(removed.isNotNull(), F.size(removed)).otherwise(0).cast("long"))
    return part.select(*columns).unionByName(marked.where(~F.col(told)).select(*columns))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = without_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS s, unnest(range(0, len(l))) AS line FROM parts),
words AS (SELECT doc_id, line, s, list_filter(regexp_split_to_array(lower(s), '[ \t\x0B\f\r]+'), lambda x: x <> '') AS w FROM lines),
sets AS (
  SELECT doc_id, line, array_to_string(w, ' ') AS class, list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g FROM words WHERE len(w) > 0),
firsts AS (SELECT class, min((doc_id, line)) AS f, any_value(g) AS g FROM sets GROUP BY class),
grams AS (SELECT class, f, len(g) AS n, unnest(g) AS gram FROM firsts),
late AS (
  SELECT DISTINCT class FROM (
    SELECT a.class, a.f AS f, b.f AS g, a.n AS m, b.n AS n, count(*) AS k FROM grams a JOIN grams b ON a.gram = b.gram
    GROUP BY ALL) WHERE g < f AND 100 * k >= 80 * (m + n - k)),
gone AS (
  SELECT s.doc_id, s.line FROM sets s JOIN firsts f ON s.class = f.class LEFT JOIN late l ON s.class = l.class
  WHERE l.class IS NOT NULL OR f.f <> (s.doc_id, s.line)),
kept AS (
  SELECT l.doc_id, string_agg(l.s, chr(10) ORDER BY l.line) AS t, count(*) AS n
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.line = g.line WHERE g.doc_id IS NULL GROUP BY l.doc_id)
SELECT p.doc_id, coalesce(len(p.l), 0)::BIGINT AS n_lines, (coalesce(len(p.l), 0) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.t, '')) AS kept_sha256
FROM parts p LEFT JOIN kept k ON p.doc_id = k.doc_id
"""
