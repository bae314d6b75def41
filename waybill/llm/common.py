"""Words, staged tables and shared folders of the corpus operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words are runs of anything but these six bytes, which is also what ``bytes.split()`` cuts at.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Lower case for A-Z only; bytes of other letters stay.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

_own: list[str] = []
_noted: ContextVar[list[str] | None] = ContextVar("folders", default=None)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The folders that ``work_folder`` names within, here and not in other threads, for who removes them afterwards."""
    before = _noted.set([])
    try:
        yield _noted.get()
    finally:
        _noted.reset(before)


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def remainder(doc_id: Column, of: int) -> Column:
    """``crc32(doc_id as text) mod of``; null stays null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def work_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``; below a temporary folder only in local mode without the setting."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="waybill-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        named = f"file://{_own[0]}"
    folder = f"{named.rstrip('/')}/corpus-{uuid.uuid4().hex}"
    if _noted.get() is not None:
        _noted.get().append(folder)
    return folder


def free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def long_keys(rows: DataFrame, key: str, folder: str) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` with whole numbers for its keys, in their order, and ``(number, name)`` to tell them by; None where keys
    are whole numbers already."""
    if isinstance(rows.schema[key].dataType, T.IntegralType):
        return rows.withColumn(key, F.col(key).cast("long")), None
    names = (rows.select(F.col(key).alias("name")).where("name IS NOT NULL").distinct().repartitionByRange("name")
             .sortWithinPartitions("name").withColumn("number", F.monotonically_increasing_id()))
    names = stage(names, folder, "names")
    numbered = rows.join(names, F.col(key) == F.col("name"), "left").withColumn(key, F.col("number"))
    return numbered.select(*rows.columns), names


def named(rows: DataFrame, key: str, names: DataFrame | None) -> DataFrame:
    """``rows`` with the keys that ``long_keys`` had numbered, in their first column."""
    if names is None:
        return rows
    others = [c for c in rows.columns if c != key]
    return rows.join(names, F.col(key) == F.col("number"), "left").select(F.col("name").alias(key), *others)


def least_hashes(rows: DataFrame, u: str, size: int) -> float:
    """The largest threshold of ``u``, numbers in (0, 1) without order, that at most ``size`` rows are at or below.

    Told from a histogram whose steps are two in a hundred at any height, so as many counts are collected whatever the
    rows; the threshold falls short of the exact one by a step at most. 1 if all rows are below.
    """
    step = F.floor(-F.log2(F.col(u)) * 32).cast("int")  # u lies in (2 ** (-(step + 1) / 32), 2 ** (-step / 32)]
    seen, most = 0, 0.0
    for k, n in sorted(((r["step"], r["n"]) for r in rows.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True):
        if seen + n > size:
            return most
        seen, most = seen + n, 2.0 ** (-k / 32)
    return 1.0


def least_hashes_by(rows: DataFrame, label: str, u: str, size: int) -> dict:
    """For each label the largest threshold of ``u`` that at most its share of ``size`` rows, equal for all, lie at or
    below; told as in ``least_hashes``, from one count per label and step."""
    step = F.floor(-F.log2(u) * 32).cast("int")
    counts: dict = {}
    for r in rows.groupBy(label, step.alias("step")).agg(F.count("*").alias("n")).collect():
        counts.setdefault(r[0], {})[r["step"]] = r["n"]
    share, most = max(size // max(len(counts), 1), 8), {}
    for name, steps in counts.items():
        seen, most[name] = 0, 0.0
        for k in sorted(steps, reverse=True):
            seen += steps[k]
            if seen > share:
                break
            most[name] = 2.0 ** (-k / 32)
        else:
            most[name] = 1.0
    return most


def bounded(spark: SparkSession) -> None:
    """Let Python tasks see a few megabytes of text at a time, however long the texts are.

    A batch lies in memory three times over: in the executor's buffers, in the worker's, and as Python strings. The
    setting holds for the session, as the plan of a lazy result reads it when it runs.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends, and lost executors lose nothing."""
    path = f"{folder}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, folder: str, name: str = "") -> None:
    """Remove a staged table, or the whole folder, in whatever file system it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}".rstrip("/"))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def count_words(text: Column) -> Column:
    """How many words a text has, without keeping them."""
    t = F.coalesce(text, F.lit(""))
    edge = F.substring(t, 1, 1).rlike(GAP).cast("long") + F.substring(t, -1, 1).rlike(GAP).cast("long")
    return F.when(t == "", F.lit(0).cast("long")).otherwise(F.size(F.split(t, GAP)) - edge)


def unit(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11) + 0.5) / float(1 << 53)
