"""Session settings the library relies on, for programs that start their own session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A task that writes few partitions keeps their files open instead of sorting its rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Building a plan column by column from Python is several times faster without a call site per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def start(app: str = "waybill", master: str | None = None, **extra: str) -> SparkSession:
    """Start (or reuse) a session with UTC timestamps and adaptive execution.

    The number of shuffle partitions is left to the cluster: adaptive execution merges small ones, so a cluster should
    set ``spark.sql.shuffle.partitions`` for its largest shuffle (about 128 MB per partition).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """A new folder for frames on the way: where the cluster names its shared folder, or a temporary one in local mode."""
    local = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
    return f"{shared_folder(spark, tempfile.gettempdir() if local else None)}/waybill-{uuid.uuid4().hex}"


def staging(spark: SparkSession) -> Callable[[str, DataFrame], DataFrame]:
    """Writes a frame under a name into a new folder and reads it back."""
    folder = work_folder(spark)

    def stage(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return stage


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    ``fallback`` is used only where the cluster names none (tests); without either this raises, because a folder of one
    machine would be lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if fallback:
        return fallback.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")
