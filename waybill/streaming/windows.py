"""Bounds of incremental loads. Bounds are a handful of values, so plain datetimes; rows are cut by them in Spark."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OVERLAP = timedelta(minutes=5)
DEFAULT_LOOKBACK = timedelta(hours=24)


def _utc(moment: datetime) -> datetime:
    return moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)


def _minute(moment: datetime) -> datetime:
    return moment.replace(second=0, microsecond=0)


def lookback_window(
    now: datetime, last_sync: datetime | None = None, lookback: timedelta | None = None, align: bool = True
) -> tuple[datetime, datetime]:
    """Range of the next load.

    After a successful load it starts five minutes before that load, but no further back than ``lookback``; without
    one it starts ``lookback`` (24 hours) ago. Both ends are cut to the minute unless ``align`` is off.
    """
    end = _minute(_utc(now)) if align else _utc(now)
    if last_sync is not None:
        start = _utc(last_sync) - OVERLAP
        if lookback:
            start = max(start, end - lookback)
    else:
        start = end - (lookback or DEFAULT_LOOKBACK)
    return (_minute(start) if align else start), end


def settlement_window(now: datetime, days: int = 14) -> tuple[datetime, datetime]:
    """From midnight ``days`` before yesterday to the last second of yesterday."""
    yesterday = _utc(now).replace(hour=0, minute=0, second=0, microsecond=0) - timedelta(days=1)
    return yesterday - timedelta(days=days), yesterday + timedelta(hours=23, minutes=59, seconds=59)


def accounting_window(
    now: datetime, start: datetime | None = None, end: datetime | None = None, *, full: bool = False, days: int = 30
) -> tuple[datetime | None, datetime | None]:
    """Range of an accounting load: as given, or the last ``days``; a full load has no range."""
    if full:
        return None, None
    if start is None and end is None:
        today = _utc(now).replace(hour=0, minute=0, second=0, microsecond=0)
        return today - timedelta(days=days), today
    return start, end


def valid_window(start: Column, end: Column) -> Column:
    """Whether a range has both ends, in order."""
    return F.coalesce(start < end, F.lit(False))


def window_seconds(start: Column, end: Column) -> Column:
    """Length of a range in seconds."""
    return (F.unix_micros(end) - F.unix_micros(start)).cast("double") / F.lit(1_000_000.0)


def with_batch_windows(ranges: DataFrame, hours: int = 24, start: str = "start", end: str = "end") -> DataFrame:
    """Each range as consecutive windows of ``hours`` (``batch_start``, ``batch_end``), the last one cut short."""
    step = F.make_dt_interval(hours=F.lit(hours))
    # An empty range is cut off below; greatest() only keeps sequence() from refusing it.
    begun = ranges.withColumn(
        "batch_start", F.explode(F.sequence(F.col(start), F.greatest(F.col(start), F.col(end)), step))
    )
    return begun.filter(F.col("batch_start") < F.col(end)).withColumn(
        "batch_end", F.least(F.col("batch_start") + step, F.col(end))
    )


def batch_windows(spark: SparkSession, start: datetime, end: datetime, hours: int = 24) -> DataFrame:
    """Windows of one range."""
    ranges = spark.range(1).select(F.lit(_utc(start)).alias("start"), F.lit(_utc(end)).alias("end"))
    return with_batch_windows(ranges, hours).select("batch_start", "batch_end")


def window_start(ts: Column, start: Column, hours: int = 24) -> Column:
    """Start of the batch window a time falls in, by arithmetic: rows meet their window without a range join."""
    size = hours * 3_600_000_000
    since = F.unix_micros(ts) - F.unix_micros(start)
    return F.timestamp_micros(F.unix_micros(ts) - F.pmod(since, F.lit(size)))
