"""Session settings and shared scratch space."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume.  All can be changed while a session runs.
ENGINE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Archives written by other tools may hold nanosecond timestamps; read them as
    # integers and let the archive reader turn them back into timestamps.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's settings to a running session."""
    for key, value in ENGINE_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", name: str = "stationcast", settings: dict[str, str] | None = None) -> SparkSession:
    """Session for one machine: tests, the benchmark, trying things out."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in (ENGINE_SETTINGS | (settings or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share.

    It lies below ``spark.checkpoint.dir``.  Where that is unset, a session on one machine
    uses its warehouse; on a cluster there is no folder that all are known to share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/stationcast/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a result to shared scratch and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the optimizer
    the table's real size, so that it broadcasts it only when it is small.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
