"""Choosing messages of gridded files by their text inventories.

An inventory is one row per file: ``file`` and ``lines`` (array of text).  Inventories
are a few hundred lines each, so everything that concerns one file is done inside its
row; a selection over any number of files needs no shuffle until the final clean-up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import names


def split_lines(text: Column) -> Column:
    """Lines of an inventory, ignoring white space around the whole text."""
    return F.split(F.btrim(text, F.lit(" \t\r\n\f\u000b")), "\n")


def contains_any(line: Column, phrases: Sequence[str]) -> Column:
    found = F.lit(False)
    for phrase in phrases:
        found = found | line.contains(phrase)
    return found


def contains_all(line: Column, phrases: Sequence[str]) -> Column:
    found = F.lit(True)
    for phrase in phrases:
        found = found & line.contains(phrase)
    return found


def byte_ranges(inventories: DataFrame) -> DataFrame:
    """One row per line with the bytes its message occupies.

    A message ends where the next line of the whole file begins; the last one is open.
    Adds line_no (from 1), line, range_start, range_end and byte_range.
    """
    def start(line: Column) -> Column:
        return names.line_field(line, 1).try_cast("bigint")

    others = [c for c in inventories.columns if c != "lines"]
    following = F.get(F.col("lines"), F.col("_i") + 1)
    return (
        inventories.select(*others, "lines", F.posexplode("lines").alias("_i", "line"))
        .select(
            *others,
            (F.col("_i") + 1).alias("line_no"),
            "line",
            start(F.col("line")).alias("range_start"),
            (start(following) - 1).alias("range_end"),
        )
        .withColumn(
            "byte_range",
            F.concat(
                F.col("range_start").cast("string"),
                F.lit("-"),
                # An end of 0 counts as open, like no end at all.
                F.coalesce(F.nullif(F.col("range_end"), F.lit(0)).cast("string"), F.lit("")),
            ),
        )
    )


def complete_files(
    inventories: DataFrame,
    search: Sequence[str],
    *,
    exclude: Sequence[str] = (),
    require: Sequence[str] = (),
) -> DataFrame:
    """Files in which every search string is found on some eligible line.

    Written as an explode of one or no array: as a plain filter the test would move
    below the splitting of the text and repeat that for each search string.
    """

    def found(text: str) -> Column:
        return F.exists(
            "lines",
            lambda line: line.contains(text) & ~contains_any(line, exclude) & contains_all(line, require),
        )

    complete = F.lit(True)
    for text in search:
        complete = complete & found(text)
    others = [c for c in inventories.columns if c != "lines"]
    return inventories.select(*others, F.explode(F.when(complete, F.array("lines"))).alias("lines"))


def select_messages(
    inventories: DataFrame,
    search: Sequence[str],
    *,
    exclude: Sequence[str] = (),
    require: Sequence[str] = (),
    label: Column | None = None,
    pattern: Column | None = None,
    percentiles: Sequence[int] | None = None,
    all_found: bool = False,
) -> DataFrame:
    """Lines and byte ranges of the wanted messages.

    A line is wanted if it contains any ``search`` string (an empty list takes every
    line) and all ``require`` ones, none of ``exclude``, the ``label`` (anywhere in the line), a match of ``pattern``
    and one of ``percentiles`` in its last field.  ``all_found`` drops files that lack
    one of the search strings.  Lines that share a byte range count once, the last.
    """
    files = complete_files(inventories, search, exclude=exclude, require=require) if all_found else inventories
    line = F.col("line")
    found = contains_any(line, search) if search else F.lit(True)
    wanted = found & ~contains_any(line, exclude) & contains_all(line, require)
    if label is not None:
        wanted = wanted & F.contains(line, label)
    if pattern is not None:
        wanted = wanted & F.regexp_like(line, pattern)
    if percentiles is not None:
        wanted = wanted & names.percentile_of_line(line).isin(list(percentiles))
    return (
        byte_ranges(files)
        .where(wanted)
        .groupBy("file", "byte_range")
        .agg(F.max(F.struct("line_no", "line", "range_start", "range_end")).alias("_last"))
        .select("file", "byte_range", "_last.*")
    )


def select_element(inventories: DataFrame, model: str, element: str, *, required: bool = False) -> DataFrame:
    """Messages of one element of a model, by the rules of that model's inventories.

    Files whose name carries no lead hour are dropped.  ``required`` also applies the
    phrases that all plainly searched lines should carry; archives were made without.
    """
    rules.validate(model, element)
    search = rules.SEARCH[model, element]
    exclude = rules.EXCLUDE.get((model, element), [])
    if model in ("hrrr", "urma"):
        lead = names.forecast_hour(F.col("file"))
    else:
        lead = names.first_group(names.base_name(F.col("file")), r"f(\d{3})").cast("int")
    files = inventories.withColumn("_lead", lead)
    lead = F.col("_lead")

    if model in ("nbmqmd", "nbmqmd_exp"):
        label = {
            "precip24hr": names.day_accumulation_label(lead),
            "precip6hr": names.span_label(lead - 6, lead, "hour acc fcst"),
            "maxt": names.span_label(lead - 18, lead, "hour max fcst"),
            "mint": names.span_label(lead - 18, lead, "hour min fcst"),
        }.get(element, F.concat(lead.cast("string"), F.lit(" hour fcst")))
        return select_messages(files.where("_lead is not null"), search, label=label, percentiles=rules.PERCENTILES)
    if model == "hrrr" and element in ("precip6hr", "snow6hr"):
        label = names.run_total_label(lead)
        return select_messages(files.where("_lead is not null"), search, exclude=exclude, label=label)
    if rules.is_percentile(model, element):
        interval = int(element.removeprefix("snow").removesuffix("hr"))
        pattern = names.annotated_accumulation_pattern(lead, interval)
        return select_messages(
            files.where("_lead is not null"), search, exclude=exclude, pattern=pattern, percentiles=rules.PERCENTILES
        )
    if model not in ("hrrr", "urma"):
        files = files.where("_lead is not null")
    require = rules.REQUIRE.get((model, element), []) if required else []
    return select_messages(files, search, exclude=exclude, require=require, all_found=True)
