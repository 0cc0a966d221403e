"""Sharding by histogram sort: shards of nearly equal bytes, found by counting.

Rows are ordered by a key.  Exact bytes below candidate boundaries are counted across all
partitions, and the candidates around each splitter are refined until the bytes below one are
within the tolerance; then the rows are exchanged once.  All steps are DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationcast.session import written

from .base import table

SHARDS = 8
#: Part of a shard's bytes by which a splitter may miss its place.
TOLERANCE = 0.0005
#: Candidate boundaries in each interval and round.
PROBES = 1024
#: Rows of a range that are numbered together, about.
RUN_ROWS = 50_000


@dataclass
class Splitter:
    """Looked for in [low, high) of a column's values; ``target`` bytes are to be below it, and ``below`` are below ``low``."""

    target: int
    low: int
    high: int
    below: int = 0
    at: int | None = None


def refine(rows: DataFrame, column: str, splitters: list[Splitter], tolerance: float) -> None:
    """Narrow the splitters' intervals round by round until each is within the tolerance or at one value."""
    while True:
        todo = [s for s in splitters if s.at is None]
        if not todo:
            return
        cells = sorted({(s.low, s.high, s.below) for s in todo})
        value, cell, probe = F.col(column), F.lit(None).cast("int"), F.lit(None).cast("long")
        steps = {}
        for k, (low, high, _) in enumerate(cells):
            steps[k] = max(1, -(-(high - low) // PROBES))
            inside = (value >= low) & (value < high)
            cell = F.when(inside, k).otherwise(cell)
            probe = F.when(inside, F.expr(f"({column} - {low}L) div {steps[k]}L")).otherwise(probe)
        counts = rows.select(cell.alias("cell"), probe.alias("probe"), "_size").where("cell is not null").groupBy("cell", "probe")
        found: dict[int, list] = {}
        for r in counts.agg(F.sum("_size").alias("bytes")).collect():
            found.setdefault(r["cell"], []).append((r["probe"], r["bytes"]))
        for s in todo:
            k = cells.index((s.low, s.high, s.below))
            below, high = s.below, s.high
            s_low, s_high, s_below = s.high, s.high, None
            for probe_, size in sorted(found.get(k, [])):
                start = s.low + probe_ * steps[k]
                if below + size >= s.target:
                    s_low, s_high, s_below = start, min(high, start + steps[k]), below
                    break
                below += size
            else:
                s.at, s.below = high, below
                continue
            after = below + size
            if s.target - below <= tolerance:
                s.at, s.below = s_low, below
            elif after - s.target <= tolerance:
                s.at, s.below = s_high, after
            elif s_high - s_low == 1:
                s.low, s.high, s.below, s.at = s_low, s_high, s_below, None
                s.at = s_low  # one value holds the splitter: rows of that value are split further
            else:
                s.low, s.high, s.below = s_low, s_high, s_below


def shards(df: DataFrame, key: Column, size: Column, number: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows with shard (0 to number - 1) and slot (gapless from 0 in each shard).

    ``key`` is a long from 0 to 2**62 - 1 that orders the rows, such as a hash of a text, so
    that equal texts stand together; ``size`` gives a row's bytes.  Only where one key holds
    more bytes than the tolerance are its rows divided, by a number given to each row.  Shards
    miss equal bytes by the tolerance, plus a row's bytes, at most.  Any rows will do: empty
    tables give no rows, null and repeated ones are rows like others.  Columns named shard and
    slot are replaced.
    """
    # The rows' own columns are one struct, so that their names don't matter.
    own = F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row")
    rows = df.select(own, key.alias("_key"), size.alias("_size")).withColumn("_row", F.monotonically_increasing_id())
    rows = written(rows, "sized")
    total, count, last = rows.agg(F.sum("_size"), F.count("*"), F.max("_row")).first()
    within = tolerance * (total or 0) / number
    splitters = [Splitter(-(-i * (total or 0) // number), 0, 1 << 62) for i in range(1, number)]
    refine(rows, "_key", splitters, within)
    # Those that stop at one value whose rows must be divided, and where among its rows.
    inner = {s.low for s in splitters if s.at == s.low and s.high - s.low == 1 and s.target - s.below > within}
    cuts = [(s.at, 0) for s in splitters]
    for value in inner:
        mine = [i for i, s in enumerate(splitters) if s.at == value and s.high - s.low == 1]
        parts = [Splitter(splitters[i].target, 0, (last or 0) + 1, splitters[i].below) for i in mine]
        refine(rows.where(F.col("_key") == value), "_row", parts, within)
        for i, s in zip(mine, parts, strict=True):
            cuts[i] = (value, s.at)
    shard = F.lit(0)
    for value, row in cuts:
        above = (F.col("_key") > value) | ((F.col("_key") == value) & (F.col("_row") >= row))
        shard = shard + above.cast("int")
    runs = max(1, (count or 0) // RUN_ROWS)
    placed = rows.withColumn("shard", shard).withColumn("_run", F.pmod(F.xxhash64("_row"), F.lit(runs)))
    sizes = placed.groupBy("shard", "_run").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_at", F.row_number().over(Window.partitionBy("shard", "_run").orderBy("_key", "_row")))
    out = numbered.join(sizes, ["shard", "_run"]).withColumn("slot", F.col("_before") + F.col("_at") - 1)
    return out.select(*[F.col(f"row.`{c}`") for c in df.columns if c.lower() not in ("shard", "slot")], "shard", "slot")


def text_key(text: str = "text") -> Column:
    """A key by which equal texts stand together."""
    return F.shiftrightunsigned(F.xxhash64(text), 2)


def write_shards(documents: DataFrame, folder: str, number: int = SHARDS) -> None:
    """Write the documents as one folder per shard, each in files of its runs."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    shards(documents, text_key(), size, number).write.partitionBy("shard").parquet(folder)


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text").cast("string")
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 2).alias("_text"),
    )
    found = shards(documents, F.col("_text"), F.col("size"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
