"""Health of feeds and jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.streaming.state import healthy


def feed_health(states: DataFrame, as_of: Column, max_age_hours: int = 25) -> DataFrame:
    """Every feed with its last state and whether it is healthy."""
    return states.select(
        "domain", "status", "last_synced_at", "error_count",
        healthy(F.col("status"), F.col("last_synced_at"), as_of, max_age_hours).alias("healthy"),
    )


def overall_health(feeds: DataFrame) -> DataFrame:
    """One row: whether every feed is healthy (true without feeds), and how many are not."""
    return feeds.agg(
        F.coalesce(F.bool_and("healthy"), F.lit(True)).alias("healthy"),
        F.count(F.lit(1)).alias("feeds"),
        F.count(F.when(~F.col("healthy"), 1)).alias("unhealthy"),
    )


def job_health(runs: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Per job with runs in the last hours: the last start, failed runs, and ``healthy`` if none failed."""
    recent = runs.filter(F.col("started_at") >= as_of - F.make_dt_interval(hours=F.lit(hours)))
    grouped = recent.groupBy("job_name").agg(
        F.max("started_at").alias("last_run"),
        F.count(F.when(F.col("status") == "failed", 1)).alias("recent_failures"),
    )
    return grouped.withColumn("status", F.when(F.col("recent_failures") == 0, "healthy").otherwise("unhealthy"))
