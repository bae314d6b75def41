"""Alerts over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from entries.registry import Tables, query
from waybill.plans import alerts, daily, health

_AS_OF = "TIMESTAMP '2001-08-01 12:00:00'"
_FIELDS = ("customer_id", "email")


def _as_of():
    return F.lit("2001-08-01 12:00:00").cast("timestamp")


def _orders(t: Tables):
    state = F.when(F.col("o_orderstatus") == "F", "fulfilled").when(F.col("o_orderstatus") == "O", "pending")
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.lit("x@x")).alias("email"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        state.otherwise("error").alias("fulfillment_status"),
        F.when(F.col("o_orderpriority") != "1-URGENT", "T1").otherwise("").alias("tracking_number"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "refunded").otherwise("paid").alias("status"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("total"),
    )
    shipped = t.lineitem.select(
        F.col("l_orderkey").alias("reference_id"), F.col("l_shipdate").cast("timestamp").alias("shipped_date"))
    return daily.with_fulfilled_at(orders, shipped)


_SHOWN = ["id", "category", "severity", "metric_value", "threshold_value", "affected_count"]

_ORDERS_SQL = f"""
  SELECT o_orderstatus AS st, o_orderpriority AS pr, o_orderdate AS seen, CAST(o_totalprice AS DECIMAL(15,2)) AS total, s
  FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"""
_MEASURES_SQL = f"""
  SELECT count(*) AS all_n,
    count(*) FILTER (WHERE st = 'O' AND seen < {_AS_OF} - INTERVAL 48 HOUR) AS waiting_n,
    CAST(sum(epoch_us({_AS_OF}) - epoch_us(seen)) FILTER (WHERE st = 'O' AND seen < {_AS_OF} - INTERVAL 48 HOUR) AS DOUBLE)
      AS waiting_t,
    count(*) FILTER (WHERE s > seen + INTERVAL 72 HOUR) AS slow_n,
    CAST(sum(epoch_us(s) - epoch_us(seen)) FILTER (WHERE s > seen + INTERVAL 72 HOUR) AS DOUBLE) AS slow_t,
    count(*) FILTER (WHERE seen >= {_AS_OF} - INTERVAL 7 DAY AND seen <= {_AS_OF}) AS now_n,
    count(*) FILTER (WHERE seen >= {_AS_OF} - INTERVAL 7 DAY AND seen <= {_AS_OF} AND st = 'P') AS bad_n,
    count(*) FILTER (WHERE st = 'F' AND pr = '1-URGENT') AS untracked_n,
    CAST(coalesce(sum(total) FILTER (WHERE seen >= {_AS_OF} - INTERVAL 7 DAY AND seen <= {_AS_OF}), 0) AS DOUBLE) AS now_t,
    CAST(sum(total) FILTER (WHERE seen >= {_AS_OF} - INTERVAL 14 DAY AND seen < {_AS_OF} - INTERVAL 7 DAY) AS DOUBLE)
      AS before_t,
    count(*) FILTER (WHERE seen >= {_AS_OF} - INTERVAL 7 DAY AND seen <= {_AS_OF} AND pr = '2-HIGH') AS refund_n,
    (epoch_us({_AS_OF}) - epoch_us(max(seen))) / 3600000000.0 AS age,
    count(*) FILTER (WHERE seen >= date_trunc('day', {_AS_OF}) AND seen <= {_AS_OF}) AS today_n,
    count(*) FILTER (WHERE pr = '5-LOW') AS gap_n
  FROM ({_ORDERS_SQL})"""
_ORDER_ALERTS_SQL = f"""
WITH m AS ({_MEASURES_SQL})
SELECT 'fulfillment_delays' AS id, 'fulfillment' AS category,
       CASE WHEN waiting_n > 20 THEN 'critical' ELSE 'high' END AS severity,
       waiting_t / waiting_n / 3600000000.0 AS metric_value, 48.0::DOUBLE AS threshold_value,
       waiting_n AS affected_count FROM m WHERE waiting_n > 0
UNION ALL SELECT 'slow_completion', 'fulfillment', 'medium', slow_t / slow_n / 3600000000.0, 72, slow_n FROM m
  WHERE slow_n > 0
UNION ALL SELECT 'delivery_exceptions', 'delivery', 'high', bad_n::DOUBLE / now_n, 0.05, bad_n FROM m
  WHERE bad_n::DOUBLE / now_n > 0.05::DOUBLE
UNION ALL SELECT 'missing_tracking', 'delivery', 'medium', untracked_n, 0, untracked_n FROM m WHERE untracked_n > 0
UNION ALL SELECT 'revenue_drop', 'financial', 'high', (before_t - now_t) / before_t, 0.2, now_n FROM m
  WHERE (before_t - now_t) / before_t > 0.2::DOUBLE
UNION ALL SELECT 'refund_rate', 'financial', 'high', refund_n::DOUBLE / now_n, 0.1, refund_n FROM m
  WHERE refund_n::DOUBLE / now_n > 0.1::DOUBLE
UNION ALL SELECT 'stale_data', 'data_quality', 'medium', age, 6, all_n FROM m WHERE age > 6
UNION ALL SELECT 'order_volume', 'system', 'medium', today_n, 50, today_n FROM m WHERE today_n < 50
UNION ALL SELECT 'missing_email', 'data_quality', 'low', gap_n::DOUBLE / all_n, 0.05, gap_n FROM m
  WHERE gap_n::DOUBLE / all_n > 0.05::DOUBLE"""
_STOCK_SQL = """
SELECT 'low_inventory' AS id, 'inventory' AS category, 'medium' AS severity, CAST(min(p_size) AS DOUBLE) AS metric_value,
       10.0::DOUBLE AS threshold_value, count(*) AS affected_count FROM part WHERE p_size <= 10 HAVING count(*) > 0
UNION ALL SELECT 'out_of_stock', 'inventory', 'high', count(*), 0, count(*) FROM part WHERE p_size <= 0
  HAVING count(*) > 0"""
_FEEDS_SQL = """
SELECT 'integration_health' AS id, 'system' AS category, 'high' AS severity, CAST(count(*) AS DOUBLE) AS metric_value,
       0.0::DOUBLE AS threshold_value, count(*) AS affected_count
FROM (SELECT arg_max(event_type, (ts, event_type)) AS last, max(ts) AS seen FROM events GROUP BY user_id)
WHERE last = 'error' OR seen <= TIMESTAMP '2024-01-29 11:00:00' HAVING count(*) > 0"""
_JOBS_SQL = """
SELECT 'job_failures' AS id, 'system' AS category, 'high' AS severity, CAST(count(*) AS DOUBLE) AS metric_value,
       0.0::DOUBLE AS threshold_value, count(*) AS affected_count
FROM events WHERE ts >= TIMESTAMP '2024-01-29 12:00:00' AND event_type = 'error' HAVING count(*) > 0"""
_ALL_SQL = f"""
SELECT * FROM ({_ORDER_ALERTS_SQL}) UNION ALL SELECT * FROM ({_STOCK_SQL}) UNION ALL SELECT * FROM ({_FEEDS_SQL})
UNION ALL SELECT * FROM ({_JOBS_SQL})"""


def _stock(t: Tables):
    return t.part.select(F.col("p_size").alias("quantity_on_hand"))


def _feeds(t: Tables):
    last = t.events.groupBy("user_id").agg(F.max(F.struct("ts", "event_type")).alias("l"))
    states = last.select(
        F.col("user_id").cast("string").alias("domain"), F.col("l.ts").cast("timestamp").alias("last_synced_at"),
        F.when(F.col("l.event_type") == "error", "error").otherwise("success").alias("status"),
        F.lit(0).alias("error_count"))
    return health.feed_health(states, F.lit("2024-01-30 12:00:00").cast("timestamp"))


def _runs(t: Tables):
    """Runs of the event month, moved to the day of the orders' report."""
    shift = F.lit("2001-08-01 12:00:00").cast("timestamp") - F.lit("2024-01-30 12:00:00").cast("timestamp")
    return t.events.select(
        (F.col("ts").cast("timestamp") + shift).alias("started_at"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"))


@query("order_alerts", _ORDER_ALERTS_SQL)
def order_alerts(t: Tables):
    return alerts.order_alerts(_orders(t), _as_of(), critical_fields=_FIELDS).select(*_SHOWN)


@query("stock_alerts", _STOCK_SQL)
def stock_alerts(t: Tables):
    return alerts.stock_alerts(_stock(t)).select(*_SHOWN)


@query("feed_alerts", _FEEDS_SQL)
def feed_alerts(t: Tables):
    return alerts.feed_alerts(_feeds(t)).select(*_SHOWN)


@query("job_alerts", _JOBS_SQL)
def job_alerts(t: Tables):
    return alerts.job_alerts(_runs(t), _as_of()).select(*_SHOWN)


def _all(t: Tables, **only: str):
    orders = _orders(t)
    return alerts.all_alerts(_as_of(), orders=orders, inventory=_stock(t), feeds=_feeds(t), runs=_runs(t), **only)


@query("alerts", f"SELECT a.*, '2001-08-01 12:00:00.000000' AS created_at FROM ({_ALL_SQL}) a")
def all_alerts(t: Tables):
    return _all(t).select(*_SHOWN, "created_at")


@query("alerts_high", f"SELECT id, affected_count FROM ({_ALL_SQL}) WHERE severity = 'high'")
def alerts_high(t: Tables):
    return _all(t, severity="high").select("id", "affected_count")


@query("alert_counts", f"""
SELECT count(*) AS total_count, count(*) FILTER (WHERE severity = 'critical') AS critical,
       count(*) FILTER (WHERE severity = 'high') AS high, count(*) FILTER (WHERE severity = 'medium') AS medium,
       count(*) FILTER (WHERE severity = 'low') AS low
FROM ({_ALL_SQL})""")
def alert_counts(t: Tables):
    return alerts.severity_counts(_all(t))
