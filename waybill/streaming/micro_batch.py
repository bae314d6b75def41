"""Feeds as streams over their landing folders.

Structured Streaming keeps track of the landed files; every micro-batch goes through the same load as a scheduled one.
A micro-batch that is delivered again after a failure is recognised by its number and skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from waybill.load import Loader
from waybill.schemas import TABLES
from waybill.sources.feeds import FEEDS, Feed


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed lines with their file and block, as a stream; their row in the block is added per micro-batch."""
    reader = spark.readStream.option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select(
        "value", F.col("_metadata.file_modification_time").alias("_landed"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"))


def _with_origin(batch: DataFrame) -> DataFrame:
    return batch.withColumn("_row", F.monotonically_increasing_id())


def done(loader: Loader, feed: Feed, batch_id: int) -> bool:
    """Whether a micro-batch of a feed has been committed."""
    seen = loader.warehouse.read("sync_state").filter(F.col("domain") == feed.name).agg(
        F.max(F.col("last_sync_key").try_cast("bigint")).alias("key")).first()
    return seen["key"] is not None and seen["key"] >= batch_id


def stream_feed(
    loader: Loader, feed: Feed, landing: str, checkpoint: str, *, available_now: bool = True,
    files_per_batch: int | None = None, clock: Callable[[], datetime] | None = None, once_within: str | None = None,
) -> StreamingQuery:
    """Load a feed as its files land; with ``available_now`` stop once the landed files are loaded.

    A page whose text came before, within ``once_within`` of landing time, is left out. With a loader that lets rows wait, rows of another feed that waited for those of a batch are loaded after it.
    """
    now = clock or (lambda: datetime.now(UTC))
    hanging = [f for f in FEEDS.values() if (TABLES[f.table].parent or ("",))[0] == feed.table]

    def load(batch: DataFrame, batch_id: int) -> None:
        if not done(loader, feed, batch_id):
            loader.load_lines(feed, _with_origin(batch), now(), sync_key=str(batch_id))
        if loader.wait is not None:
            for other in hanging:
                loader.load_waiting(other, now())

    lines = stream_lines(loader.spark, f"{landing.rstrip('/')}/{feed.folder}", files_per_batch)
    if once_within:
        lines = without_repeats(lines.withColumn("_text", F.sha2("value", 256)), ["_text"], "_landed", once_within).drop("_text")
    writer = lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def without_repeats(rows: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """A stream of rows without those whose key came before within ``delay`` of event time."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
