"""Windows, sync state and feed health."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from entries.registry import Tables, query, stamp
from waybill.operators import links
from waybill.plans import health
from waybill.streaming import state, windows

_NOW = datetime(2024, 1, 30, 12, 0, 42, tzinfo=UTC)


def _events(t: Tables):
    return t.events.withColumn("ts", F.col("ts").cast("timestamp"))


def _as_of():
    return F.lit("2024-01-30 12:00:00").cast("timestamp")


@query("lookback_window", """
SELECT event_type, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-28 09:55:00' AND ts <= TIMESTAMP '2024-01-30 12:00:00' GROUP BY event_type""")
def lookback_window(t: Tables):
    start, end = windows.lookback_window(
        _NOW, datetime(2024, 1, 28, 10, 0, 7, tzinfo=UTC), timedelta(days=3))
    changed = links.between(_events(t), "ts", F.lit(start), F.lit(end))
    return changed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("lookback_capped", """
SELECT event_type, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' AND ts <= TIMESTAMP '2024-01-30 12:00:00' GROUP BY event_type""")
def lookback_capped(t: Tables):
    start, end = windows.lookback_window(_NOW, datetime(2024, 1, 2, tzinfo=UTC), timedelta(hours=12))
    changed = links.between(_events(t), "ts", F.lit(start), F.lit(end))
    return changed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("settlement_window", """
SELECT event_type, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts <= TIMESTAMP '2024-01-29 23:59:59' GROUP BY event_type""")
def settlement_window(t: Tables):
    start, end = windows.settlement_window(_NOW, 14)
    return links.between(_events(t), "ts", F.lit(start), F.lit(end)).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"))


@query("since_filter", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND event_type <> 'error'")
def since_filter(t: Tables):
    """A row whose time cannot be read is dropped."""
    times = F.when(F.col("event_type") != "error", F.col("ts"))
    moment = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return links.since(_events(t).withColumn("ts", times), "ts", moment).select("event_id")


@query("batch_windows", f"""
WITH bounds AS (SELECT min(ts) AS a, max(ts) AS b FROM events),
     w AS (SELECT unnest(generate_series(a, b, INTERVAL 24 HOUR)) AS s, a, b FROM bounds)
SELECT {stamp('s')} AS batch_start, {stamp('least(s + INTERVAL 24 HOUR, b)')} AS batch_end, count(event_id) AS n
FROM w LEFT JOIN events ON ts >= s AND ts < s + INTERVAL 24 HOUR WHERE s < b GROUP BY s, b""")
def batch_windows(t: Tables):
    """Windows over the span of the events, each with its rows; rows find their window by arithmetic."""
    events = _events(t)
    span = events.agg(F.min("ts").alias("start"), F.max("ts").alias("end"))
    cut = windows.with_batch_windows(span)
    first = span.select("start").scalar()
    counts = events.groupBy(windows.window_start(F.col("ts"), first).alias("batch_start")).agg(F.count(F.lit(1)).alias("n"))
    return cut.join(counts, "batch_start", "left").select(
        "batch_start", "batch_end", F.coalesce("n", F.lit(0)).alias("n"))


@query("window_length", """
SELECT user_id, min(ts) < max(ts) AS valid, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS seconds
FROM events GROUP BY user_id""")
def window_length(t: Tables):
    spans = _events(t).groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return spans.select(
        "user_id", windows.valid_window(F.col("a"), F.col("b")).alias("valid"),
        windows.window_seconds(F.col("a"), F.col("b")).alias("seconds"),
    )


def _states(t: Tables, before: bool):
    """One state per user from the events of a half of the month; an ``error`` as last event means a failed load."""
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp")
    half = _events(t).filter(F.col("ts") < cut if before else F.col("ts") >= cut)
    last = half.groupBy("user_id").agg(F.max(F.struct("ts", "event_type")).alias("l"))
    failed = F.col("l.event_type") == "error"
    return last.select(
        F.col("user_id").cast("string").alias("domain"),
        F.col("l.ts").alias("last_synced_at"), F.lit(None).cast("string").alias("last_sync_key"),
        F.when(failed, "error").otherwise("success").alias("status"),
        F.when(failed, 1).otherwise(0).alias("error_count"),
        F.when(failed, "boom").alias("error_message"), F.lit(None).cast("string").alias("sync_metadata"),
        F.col("l.ts").alias("created_at"), F.col("l.ts").alias("updated_at"),
    )


_LAST = """
  SELECT CAST(user_id AS VARCHAR) AS domain, max(ts) AS seen,
         CASE WHEN arg_max(event_type, (ts, event_type)) = 'error' THEN 'error' ELSE 'success' END AS status
  FROM events WHERE ts {op} TIMESTAMP '2024-01-16 00:00:00' GROUP BY user_id"""


@query("sync_state_merge", f"""
SELECT coalesce(s.domain, t.domain) AS domain, coalesce(s.status, t.status) AS status,
       CASE WHEN s.status IS NULL THEN CASE t.status WHEN 'error' THEN 1 ELSE 0 END
            WHEN s.status = 'success' THEN 0
            WHEN t.status = 'error' THEN 2 ELSE 1 END AS error_count,
       strftime(CASE WHEN s.status = 'success' THEN s.seen ELSE t.seen END, '%Y-%m-%d %H:%M:%S.%f') AS last_synced_at,
       strftime(coalesce(t.seen, s.seen), '%Y-%m-%d %H:%M:%S.%f') AS created_at
FROM ({_LAST.format(op='<')}) t FULL JOIN ({_LAST.format(op='>=')}) s ON t.domain = s.domain""")
def sync_state_merge(t: Tables):
    changes = _states(t, False).select(
        "domain", "status", "last_synced_at", "error_message", F.col("updated_at"))
    merged = state.put(_states(t, True), changes)
    return merged.select("domain", "status", "error_count", "last_synced_at", "created_at")


def _all_states(t: Tables):
    """One state per user over all events."""
    last = _events(t).groupBy("user_id").agg(
        F.max(F.struct("ts", "event_type")).alias("l"), F.count(F.when(F.col("event_type") == "error", 1)).alias("n"))
    return last.select(
        F.col("user_id").cast("string").alias("domain"), F.col("l.ts").alias("last_synced_at"),
        F.when(F.col("l.event_type") == "error", "error").otherwise("success").alias("status"),
        F.col("n").alias("error_count"), F.col("l.ts").alias("updated_at"),
    )


_ALL_STATES = """
  SELECT CAST(user_id AS VARCHAR) AS domain, max(ts) AS seen, count(*) FILTER (WHERE event_type = 'error') AS errors,
         CASE WHEN arg_max(event_type, (ts, event_type)) = 'error' THEN 'error' ELSE 'success' END AS status
  FROM events GROUP BY user_id"""


@query("sync_health", f"""
SELECT domain, status, {stamp('seen')} AS last_synced_at, errors AS error_count,
       status = 'success' AND seen > TIMESTAMP '2024-01-29 11:00:00' AS healthy
FROM ({_ALL_STATES})""")
def sync_health(t: Tables):
    return health.feed_health(_all_states(t), _as_of())


@query("overall_health", f"""
SELECT bool_and(h) AS healthy, count(*) AS feeds, count(*) FILTER (WHERE NOT h) AS unhealthy
FROM (SELECT status = 'success' AND seen > TIMESTAMP '2024-01-29 11:00:00' AS h FROM ({_ALL_STATES}))""")
def overall_health(t: Tables):
    return health.overall_health(health.feed_health(_all_states(t), _as_of()))


@query("cleanup_errors", f"""
SELECT domain, status FROM ({_ALL_STATES}) WHERE NOT (status = 'error' AND seen < TIMESTAMP '2024-01-23 12:00:00')""")
def cleanup_errors(t: Tables):
    return state.without_old_errors(_all_states(t), _as_of(), 7).select("domain", "status")


@query("cleanup_count", f"""
SELECT count(*) FILTER (WHERE status = 'error' AND seen < TIMESTAMP '2024-01-29 12:00:00') AS removed,
       count(*) FILTER (WHERE NOT (status = 'error' AND seen < TIMESTAMP '2024-01-29 12:00:00')) AS kept
FROM ({_ALL_STATES})""")
def cleanup_count(t: Tables):
    return state.old_error_count(_all_states(t), _as_of(), 1)


@query("job_health", f"""
SELECT CAST(user_id AS VARCHAR) AS job_name, {stamp('max(ts)')} AS last_run,
       count(*) FILTER (WHERE event_type = 'error') AS recent_failures,
       CASE WHEN count(*) FILTER (WHERE event_type = 'error') = 0 THEN 'healthy' ELSE 'unhealthy' END AS status
FROM events WHERE ts >= TIMESTAMP '2024-01-29 12:00:00' GROUP BY user_id""")
def job_health(t: Tables):
    runs = _events(t).select(
        F.col("user_id").cast("string").alias("job_name"), F.col("ts").alias("started_at"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
    )
    return health.job_health(runs, _as_of())
