"""Language identification by nearest centroid.

A text's vector holds the TF-IDF weights of its letter n-grams (hashed, of one to three
characters), of length one.  Each language has several centroids, found by clustering its
training vectors by cosine.  A text takes the language of its nearest centroid; one without
letters, or farther from every centroid than about all training texts were from theirs, is
rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import mixed, row_blocks, table, text_buffer

#: Dimensions that n-grams are hashed to.
DIMENSIONS = 4096
CENTROIDS = 4
#: Training texts of a language whose vectors are clustered: about as many, chosen by hash.
SAMPLE = 1500
#: A text is rejected if its cosine is below this part of the lowest of nearly all training texts.
REJECT = 0.5

UNDETERMINED = "und"


def letter_table() -> np.ndarray:
    """For each code point of the basic plane: its lower-case letter, or 32 if it is no letter."""
    points = np.full(1 << 16, 32, dtype=np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalpha():
            points[i] = ord(c.lower()[0])
    return points


class Counter:
    """Counts of hashed letter n-grams of texts."""

    def __init__(self) -> None:
        self.letters = letter_table()

    def code_points(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
        if len(points) and points.max() >= len(self.letters):
            high = points >= len(self.letters)
            known = self.letters[np.where(high, 32, points)]
            return np.where(high, [ord(c.lower()[0]) if c.isalpha() else 32 for c in text], known).astype(np.uint32)
        return self.letters[points]

    def counts(self, text: str | None) -> tuple[np.ndarray, bool]:
        """Counts by dimension, and whether the text has a letter.  Long texts are counted in parts."""
        total, lettered = np.zeros(DIMENSIONS), False
        for at in range(0, len(text or ""), 1 << 18):
            part = self.code_points(text[max(0, at - 2) : at + (1 << 18)])
            old = min(at, 2)  # characters whose n-grams the part before has counted
            part = part.astype(np.uint64)
            gap = part == 32
            lettered |= not gap.all()
            # Runs of characters that are no letters count as one space.
            keep = np.ones(len(part), dtype=bool)
            keep[1:] = ~(gap[1:] & gap[:-1])
            part, fresh = part[keep], (np.arange(len(part)) >= old)[keep]
            two = part[:-1] << np.uint64(21) | part[1:]
            three = two[:-1] << np.uint64(21) | part[2:]
            for grams, new in ((part, fresh), (two, fresh[1:]), (three, fresh[2:])):
                slots = (mixed(grams[new] + np.uint64(1)) % np.uint64(DIMENSIONS)).astype(np.int64)
                total += np.bincount(slots, minlength=DIMENSIONS)
        return total, lettered


def unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=-1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1)


@dataclass(frozen=True)
class Model:
    """Languages and centroids (row by row), idf per dimension, and the least cosine accepted."""

    languages: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    floor: float


def training_counts(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Number of texts that have each dimension, and of texts; all training rows count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, have, n = Counter(), np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                have += counter.counts(text.as_py())[0] > 0
                n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, DIMENSIONS), pa.int32()), pa.array(np.concatenate([[n], have]))], names=["slot", "n"]
        )

    found = rows.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    have, n = np.zeros(DIMENSIONS), 0
    for r in found:
        if r["slot"] < 0:
            n = r["n"]
        else:
            have[r["slot"]] = r["n"]
    return have, n


def clustered(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of up to k clusters by cosine; each start is the vector farthest from those before."""
    chosen = [unit(vectors.mean(axis=0))]
    while len(chosen) < min(k, len(vectors)):
        nearest = (vectors @ np.array(chosen).T).max(axis=1)
        chosen.append(vectors[int(nearest.argmin())])
    centroids = np.array(chosen)
    for _ in range(rounds):
        of = (vectors @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, of, vectors)
        kept = np.bincount(of, minlength=len(centroids)) > 0
        centroids = unit(sums[kept])
    return centroids


def fit(documents: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE) -> Model:
    """Learn from rows of text, lang and doc_id; null langs and texts without letters are left out.

    Document frequencies come from all rows.  The vectors that are clustered are those of
    ``sample`` rows per language, the least by a hash of doc_id and text, whatever the
    partitions.  One pass draws them for all languages; each language is clustered in a task of
    its own, which holds its sample, and only centroids come to the driver.
    """
    rows = documents.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("doc_id", "text").alias("place"))
    have, n = training_counts(rows)
    idf = np.log((1 + n) / (1 + have)) + 1
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((0, DIMENSIONS)), idf, 0.0)
    # Somewhat more than the sample by a share of the hashes, then the least of them.
    share = {lang: min(1 << 20, sample * 3 * (1 << 19) // size + 64) for lang, size in sizes.items()}
    shares = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
    drawn = rows.where(F.pmod("place", F.lit(1 << 20)) < F.element_at(shares, F.col("lang")))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                found = [counter.counts(t.as_py()) for t in part.column("text")]
                data = [weighted(c, idf).astype(np.float32).tobytes() if lettered else None for c, lettered in found]
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("place"), pa.array(data, pa.binary())], names=["lang", "place", "vector"])

    def cluster(held: pa.Table) -> pa.Table:
        data = np.empty((held.num_rows, DIMENSIONS), dtype=np.float32)
        for at, k in enumerate(np.argsort(held.column("place").to_numpy(), kind="stable")):
            data[at] = np.frombuffer(held.column("vector")[int(k)].as_buffer(), dtype=np.float32)
        centers = clustered(data, centroids)
        lowest = float(np.quantile((data @ centers.T).max(axis=1), 0.001))
        return pa.table({"lang": [held.column("lang")[0].as_py()] * len(centers), "center": [c.tobytes() for c in centers.astype(np.float64)], "lowest": [lowest] * len(centers)})

    # By share, then by the whole hash, as the share looks at its last bits alone.
    order = [F.pmod("place", F.lit(1 << 20)), F.col("place")]
    lettered = drawn.mapInArrow(vectors, "lang string, place long, vector binary").where("vector is not null")
    least = lettered.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("at") <= sample).drop("at")
    rows = least.groupBy("lang").applyInArrow(cluster, "lang string, center binary, lowest double").collect()
    rows = sorted(rows, key=lambda r: r["lang"])  # ties go to the language first in order
    languages, found, lowest = [r["lang"] for r in rows], [np.frombuffer(r["center"])[None] for r in rows], [r["lowest"] for r in rows]
    if not found:
        return Model([], np.zeros((0, DIMENSIONS)), idf, 0.0)
    return Model(languages, np.concatenate(found), idf, REJECT * min(lowest))


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(counts) * idf)


def identify(documents: DataFrame, model: Model, keep: list[str], name: str = "_language") -> DataFrame:
    """The columns to keep of every document, and one of the name: lang_pred, score and rejected.

    The score is the cosine to the nearest centroid (0 to 1).  Null, empty and letterless
    texts are `und`, with score 0, and rejected; so is every text if nothing was learned.
    ``rejected`` also holds for texts below the model's least cosine; their lang_pred is the
    nearest language.  Ties go to the language first in order.
    """
    columns = [*keep, name]
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch in batches:
            _, offsets = text_buffer(batch.column("text"))
            for i, j in row_blocks(offsets):
                part = batch.slice(i, j - i)
                out = []
                for text in part.column("text"):
                    counts, lettered = counter.counts(text.as_py())
                    if lettered and model.languages:
                        cosines = model.centroids @ weighted(counts, model.idf)
                        at = int(cosines.argmax())
                        score = float(min(1.0, max(0.0, cosines[at])))
                        out.append({"lang_pred": model.languages[at], "score": score, "rejected": score < model.floor})
                    else:
                        out.append({"lang_pred": UNDETERMINED, "score": 0.0, "rejected": True})
                arrays = [pa.array(out, kind) if c == name else part.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

    source = documents.select("text", *[c for c in keep if c != "text"])
    schema = source.select(*keep).withColumn(name, F.expr("named_struct('lang_pred', '', 'score', 0D, 'rejected', true)")).schema
    return source.mapInArrow(predict, nullable(schema))


def nullable(schema):
    """The schema with every column nullable."""
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def held_out(column: str = "doc_id") -> F.Column:
    """One row in five by checksum of its id, on which nothing is learned.  A null id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    model = fit(documents.where(~held_out()))
    found = identify(documents, model, ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "_language.lang_pred", "_language.score", "_language.rejected")
