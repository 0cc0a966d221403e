"""Best-fit packing of tokenized documents into sequences of at most a given length.

The configuration linear program over the length histogram (a configuration is a multiset of
lengths that fits a sequence) is solved by multiplicative weights: lengths that are covered
too little gain weight, and a knapsack by dynamic programming finds the configuration of the
greatest weight.  The fractional solution is rounded down and what remains of the histogram
is packed by filling sequences as fully as it allows.  All of this sees only the histogram,
which has no more entries than the sequence length; pieces get their places by their rank
among the pieces of their length, in Spark.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationcast.session import written

from .base import table

CAPACITY = 1024
END_ID = 2
#: Rounds of multiplicative weights.
ROUNDS = 60
#: Characters that are encoded at once, about.
PART = 1 << 18

#: Texts of up to so many characters are held against the library, in each task: of plain ones, those with
#: added tokens, and those encoded in parts, the first few.
PROVED = {"plain": (20_000, 3), "added": (20_000, 1), "parts": (4 * PART, 1)}


def tokenize(documents: DataFrame, tokenizer: str, ranks: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Token ids of each document, cut into pieces.

    Columns: doc_id, piece (from 0), start (ids before it), ids (binary, little-endian
    unsigned 32-bit).  A document's ids are those of its whole text and then ``end_id``; null
    text counts as empty, so every row gives at least one piece.  Documents longer than the
    capacity are cut into pieces of that length, of which the first may be shorter.  Rows are
    taken as they come: repeated rows and null doc_ids give pieces of their own; other columns
    are ignored.

    The ids are those of the tokenizers library.  Its vocabulary is also given as ranks, by
    which tiktoken finds the same ids several times faster; each task holds the first texts
    of each kind against the library.  The tokenizer's added tokens have their ids where their strings
    stand in a text.  Byte-level BPE never merges across the place before a space and a following
    character other than an added token's, so long texts are encoded in parts cut there.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is its share
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks, "rb") as lines:
            vocabulary = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        library = Tokenizer.from_file(tokenizer)
        added = {token.content: k for k, token in library.get_added_tokens_decoder().items()}
        ranked = {token: rank for token, rank in vocabulary.items() if rank not in added.values()}
        fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranked, special_tokens=added)
        before_word = re.compile("(?= " + "".join(f"(?!{re.escape(token)})" for token in added) + r"\S)")
        end, unproved = np.array([end_id], dtype="<u4"), {kind: times for kind, (_, times) in PROVED.items()}

        def ids_of(texts: list[str | None]) -> list[bytes]:
            out = []
            for text in texts:
                parts = [fast.encode_to_numpy(x, allowed_special="all") for x in cut(text)] if text else []
                found = np.concatenate([*parts, end]).astype("<u4")
                kind = "parts" if len(parts) > 1 else "added" if unproved["added"] and text and any(t in text for t in added) else "plain"
                if unproved[kind] and text and len(text) < PROVED[kind][0]:
                    unproved[kind] -= 1
                    if library.encode(text, add_special_tokens=False).ids != found[:-1].tolist():
                        raise ValueError("the ranks and the tokenizer differ")
                out.append(found.tobytes())
            return out

        def cut(text: str) -> list[str]:
            parts, at = [], 0
            while len(text) - at > PART:
                place = before_word.search(text, at + PART)
                if place is None:
                    break
                parts.append(text[at : place.start()])
                at = place.start()
            return [*parts, text[at:]]

        for batch in batches:
            docs, texts = batch.column("doc_id"), batch.column("text")
            at = 0
            while at < len(texts):
                group, size = [], 0
                while at + len(group) < len(texts) and size < 1 << 20:
                    group.append(texts[at + len(group)].as_py())
                    size += len(group[-1] or "")
                rows, pieces, starts, ids = [], [], [], []
                for row, blob in enumerate(ids_of(group), at):
                    n = len(blob) // 4
                    cuts = [0, *range((n - 1) % capacity + 1, n, capacity), n]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        rows.append(row)
                        pieces.append(k)
                        starts.append(a)
                        ids.append(blob[4 * a : 4 * b])
                yield pa.RecordBatch.from_arrays(
                    [docs.take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "ids"],
                )
                at += len(group)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        encode, "doc_id long, piece int, start long, ids binary"
    )


def knapsack(weights: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each size the greatest total weight of pieces that fit in it, and a piece to take first.

    ``weights[l]`` is the weight of one piece of length l; any number of each may be taken.
    A choice of 0 means that the size one less does as well.
    """
    lengths = np.flatnonzero(weights > 0)
    best, chosen = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=int)
    for size in range(1, capacity + 1):
        fits = lengths[: np.searchsorted(lengths, size, side="right")]
        best[size] = best[size - 1]
        if len(fits):
            totals = best[size - fits] + weights[fits]
            k = int(totals.argmax())
            if totals[k] > best[size]:
                best[size], chosen[size] = totals[k], fits[k]
    return best, chosen


def taken(chosen: np.ndarray, first: int, capacity: int) -> dict[int, int]:
    """The configuration of a piece of length ``first`` and the best of what fits beside it."""
    counts, size = {first: 1}, capacity - first
    while size > 0:
        length = int(chosen[size])
        if length:
            counts[length] = counts.get(length, 0) + 1
        size -= length or 1
    return counts


def fractional(histogram: np.ndarray, capacity: int, rounds: int) -> list[tuple[dict[int, int], float]]:
    """Configurations and how often each is used, together covering about every piece.

    Multiplicative weights: a length's weight falls with the share of it that is covered.  A
    round takes, for every length, its best configuration at the round's weights unless it
    weighs little beside the heaviest, and lets no length's share grow by more than a step.
    """
    need = histogram.astype(float)
    lengths = np.flatnonzero(need)
    covered = np.zeros(capacity + 1)
    used: dict[tuple, float] = {}
    if not len(lengths):
        return []
    sharpness, step = 0.5 * np.log(len(lengths) + 1.0), 3.0 / rounds
    for _ in range(rounds):
        share = covered[lengths] / need[lengths]
        if share.min() >= 1:
            break
        weights = np.zeros(capacity + 1)
        # Weights are by length at first, as every full sequence is then as good as any other.
        weights[lengths] = lengths * np.exp(-sharpness * (share - share.min()))
        best, chosen = knapsack(weights, capacity)
        room = step * need
        for first in lengths[np.argsort(share, kind="stable")]:
            first = int(first)
            if weights[first] + best[capacity - first] < 0.5 * best[capacity]:
                continue
            counts = taken(chosen, first, capacity)
            times = min(room[n] / k for n, k in counts.items())
            if times > 0:
                for n, k in counts.items():
                    covered[n] += k * times
                    room[n] -= k * times
                key = tuple(sorted(counts.items(), reverse=True))
                used[key] = used.get(key, 0.0) + times
    return [(dict(key), times) for key, times in used.items()]


def fullest(remaining: np.ndarray, capacity: int) -> dict[int, int]:
    """The longest piece left, and with it pieces that fill its sequence as fully as may be.

    Subset sums as bits of integers; each length counts up to its pieces left.
    """
    lengths = np.flatnonzero(remaining)[::-1]
    first = int(lengths[0])
    gap, reach = capacity - first, [1]
    kept: list[int] = []
    mask = (1 << (gap + 1)) - 1
    for length in map(int, lengths):
        left = int(remaining[length]) - (length == first)
        for _ in range(min(left, gap // length)):
            grown = (reach[-1] | reach[-1] << length) & mask
            if grown == reach[-1]:
                break
            reach.append(grown)
            kept.append(length)
            if grown >> gap & 1:
                break
        if reach[-1] >> gap & 1:
            break
    total = reach[-1].bit_length() - 1
    counts = {first: 1}
    for k in range(len(kept), 0, -1):
        if not reach[k - 1] >> total & 1:
            counts[kept[k - 1]] = counts.get(kept[k - 1], 0) + 1
            total -= kept[k - 1]
    return counts


def rounded(histogram: np.ndarray, capacity: int, solution: list, part: float) -> list[tuple[dict[int, int], int]]:
    """Whole numbers of sequences: a part of the fractional solution, then the fullest sequences."""
    remaining = histogram.astype(np.int64).copy()
    plan = []

    def use(counts: dict[int, int], times: int) -> None:
        if times > 0:
            for n, k in counts.items():
                remaining[n] -= k * times
            plan.append((counts, times))

    for counts, times in sorted(solution, key=lambda x: -x[1]):
        if sum(n * k for n, k in counts.items()) == capacity:
            use(counts, min(int(times * part), *(int(remaining[n]) // k for n, k in counts.items())))
    while remaining.any():
        counts = fullest(remaining, capacity)
        use(counts, min(int(remaining[n]) // k for n, k in counts.items()))
    return plan


def configurations(histogram: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """Configurations and whole numbers of sequences that use each piece of the histogram once.

    The solution is rounded from all and from half of its value; the fewer sequences win.
    """
    shorter = histogram.astype(np.int64).copy()
    full, shorter[capacity] = int(shorter[capacity]), 0
    solution = fractional(shorter, capacity, rounds)
    plans = [rounded(shorter, capacity, solution, part) for part in (1.0, 0.5)]
    plan = min(plans, key=lambda p: sum(times for _, times in p))
    return ([({capacity: 1}, full)] if full else []) + plan


def slots(plan: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """Where the pieces of each length go: from rank ``since``, ``times`` pieces each into the
    sequences from ``sequence`` on, all at ``offset``."""
    rows, base, seen = [], 0, {}
    for counts, times in plan:
        offset = 0
        for n, k in counts.items():
            for _ in range(k):
                rows.append((n, seen.get(n, 0), base, offset))
                seen[n] = seen.get(n, 0) + times
                offset += n
        base += times
    return pd.DataFrame(rows, columns=["length", "since", "sequence", "offset"]).sort_values(["length", "since"])


def pack(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to pieces, a written table with a column ``length`` (1 to capacity).

    Sequences are filled gapless from offset 0.  Ranks are counted per length and bucket of
    rows, so a frequent length is spread over many tasks.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for n, k in counts.items():
        histogram[n] = k
    places = slots(configurations(histogram, capacity, rounds))
    buckets = max(64, int(histogram.sum()) // 20_000)
    keyed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(buckets)))
    sizes = keyed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")
    ranked = keyed.withColumn("_row", F.row_number().over(within)).join(sizes, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_row") - 1)
    keys = places["length"].to_numpy(np.int64) * (1 << 48) + places["since"].to_numpy(np.int64)
    since, sequence, offset = (places[c].to_numpy(np.int64) for c in ("since", "sequence", "offset"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rank = rank.to_numpy(np.int64)
        at = np.searchsorted(keys, length.to_numpy(np.int64) * (1 << 48) + rank, side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + rank - since[at], "offset": offset[at]})

    del spark
    placed = ranked.withColumn("_place", place("length", "_rank"))
    return placed.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with length and checksum in place of their ids."""
    return pieces.select(
        "doc_id", "piece", "start", (F.octet_length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32")
    )


def packed(documents: DataFrame, name: str = "byte_bpe_50k") -> DataFrame:
    """Digest of every piece of the documents and its place, by a tokenizer of public_tokenizers."""
    files = (str(public_tokenizers.path(f"{name}.{kind}")) for kind in ("json", "tiktoken"))
    return pack(written(digest(tokenize(documents, *files)), "pieces"))


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))
