"""Listings of object stores and inventories of gridded files."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.manifest import ndfd_files, ndfd_glob
from ..operators.messages import split_lines


def read_inventories(spark: SparkSession, path: str, suffix: str = ".idx") -> DataFrame:
    """Inventories below a path: one row per gridded file, its lines in order."""
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").text(
        path, wholetext=True
    )
    file = F.expr(f"left(_metadata.file_path, length(_metadata.file_path) - {len(suffix)})")
    return text.select(file.alias("file"), split_lines(F.col("value")).alias("lines"))


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Paths and sizes of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def list_ndfd(spark: SparkSession, root: str, element: str, start: datetime, end: datetime) -> DataFrame:
    """Database files of an element for a window: path, component, stamp.

    Only the folders of the days that count are listed.
    """
    found = spark.read.format("binaryFile")
    try:
        listing = found.load(ndfd_glob(root, element, start, end)).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        listing = spark.createDataFrame([], "path string")
    return ndfd_files(listing, element, start, end)
