"""Sync state: one row per feed with its high-water mark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.operators.merge import OP, merge

SUCCESS, RUNNING, ERROR = "success", "running", "error"


def last_sync(states: DataFrame, domain: str) -> datetime | None:
    """High-water mark of a feed: the time of its last load that succeeded, whatever failed since (see ``put``)."""
    row = states.filter(F.col("domain") == domain).agg(F.max("last_synced_at").alias("at")).first()
    return row["at"] if row else None


def put(states: DataFrame, changes: DataFrame) -> DataFrame:
    """States after changes (``domain``, ``status``, ``last_synced_at``, ``updated_at`` and optional columns).

    Success resets the error count; any other status adds one to it. A load that is not successful leaves the mark
    where it was, so that the next load does not skip what this one missed.
    """
    failed = F.col("status") != SUCCESS
    carried = changes.withColumns({
        "error_count": F.when(failed, 1).otherwise(0),
        "created_at": F.col("updated_at"),
        **{
            c: F.lit(None).cast(states.schema[c].dataType)
            for c in ("last_sync_key", "error_message", "sync_metadata") if c not in changes.columns
        },
    })
    before = states.select(
        "domain", F.col("error_count").alias("_errors"), F.col("last_synced_at").alias("_mark")
    )
    counted = carried.join(before, "domain", "left").withColumns({
        "error_count": F.when(failed, F.coalesce("_errors", F.lit(0)) + 1).otherwise(0),
        "last_synced_at": F.when(failed, F.col("_mark")).otherwise(F.col("last_synced_at")),
    })
    update = [c for c in states.columns if c not in ("domain", "created_at")]
    return merge(states, counted.drop("_errors", "_mark"), ["domain"], update, null_safe=False).drop(OP)


def healthy(status: Column, last_synced_at: Column, as_of: Column, max_age_hours: int = 25) -> Column:
    """Whether the last load succeeded less than ``max_age_hours`` ago."""
    recent = last_synced_at > as_of - F.make_dt_interval(hours=F.lit(max_age_hours))
    return F.coalesce((status == SUCCESS) & recent, F.lit(False))


def is_old_error(as_of: Column, days: int = 7) -> Column:
    cutoff = as_of - F.make_dt_interval(F.lit(days))
    return F.coalesce((F.col("status") == ERROR) & (F.col("updated_at") < cutoff), F.lit(False))


def without_old_errors(states: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """States without those that failed and were last touched more than ``days`` ago."""
    return states.filter(~is_old_error(as_of, days))


def old_error_count(states: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """How many states such a clean-up removes, and how many stay."""
    return states.agg(
        F.count(F.when(is_old_error(as_of, days), 1)).alias("removed"),
        F.count(F.when(~is_old_error(as_of, days), 1)).alias("kept"),
    )
