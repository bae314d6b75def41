"""Threshold alerts over orders, stock, feeds and jobs.

Each input is read once: one aggregate per input computes the measures of all its rules, and its single row is then
unfolded into one candidate per rule. A candidate whose measure passes its threshold is an alert.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.plans.daily import DELIVERED, EXCEPTIONS, IN_TRANSIT

THRESHOLDS: dict[str, float] = {
    "max_fulfillment_hours": 48,
    "max_completion_hours": 72,
    "delivery_exception_rate": 0.05,
    "low_stock_threshold": 10,
    "revenue_drop_percentage": 0.20,
    "refund_rate": 0.10,
    "max_age_hours": 6,
    "missing_field_rate": 0.05,
    "min_daily_orders": 50,
    "critical_delays": 20,
    "period_days": 7,
}
REFUNDED = ("refunded", "partially_refunded")
CRITICAL_FIELDS = ("customer_id", "total", "fulfillment_status", "email")

_HOUR = 3_600_000_000.0


def _limits(thresholds: Mapping[str, float] | None) -> dict[str, float]:
    return {**THRESHOLDS, **(thresholds or {})}


def _micros(start: Column, end: Column, keep: Column) -> Column:
    """Exact sum of time differences over the kept rows."""
    return F.sum(F.when(keep, (F.unix_micros(end) - F.unix_micros(start)).cast("decimal(20,0)")))


def _mean_hours(micros: Column, n: Column) -> Column:
    return micros.cast("double") / F.nullif(n, F.lit(0)) / F.lit(_HOUR)


def _candidate(
    id_: str, category: str, severity: Column | str, metric: Column, threshold: float, affected: Column,
    fires: Column, title: str, description: str,
) -> Column:
    """One rule as a struct; ``{n}``, ``{metric}`` and ``{threshold}`` in the texts are filled in."""

    def filled(text: str) -> Column:
        parts: Column = F.lit(text.replace("{threshold}", f"{threshold:g}"))
        parts = F.replace(parts, F.lit("{n}"), affected.cast("string"))
        return F.replace(parts, F.lit("{metric}"), F.format_string("%.1f", metric.cast("double")))

    return F.struct(
        F.lit(id_).alias("id"),
        filled(title).alias("title"),
        filled(description).alias("description"),
        F.lit(category).alias("category"),
        (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
        metric.cast("double").alias("metric_value"),
        F.lit(float(threshold)).alias("threshold_value"),
        affected.cast("bigint").alias("affected_count"),
        F.coalesce(fires, F.lit(False)).alias("fires"),
    )


def _unfold(measures: DataFrame, candidates: Sequence[Column]) -> DataFrame:
    return measures.select(F.inline(F.array(*candidates))).filter("fires").drop("fires")


def order_alerts(
    orders: DataFrame, as_of: Column, thresholds: Mapping[str, float] | None = None,
    critical_fields: Sequence[str] = CRITICAL_FIELDS,
) -> DataFrame:
    """Alerts on store orders: delays, exceptions, tracking, revenue, refunds, freshness, gaps, volume.

    Input: ``created_at``, ``updated_at``, ``fulfilled_at``, ``fulfillment_status``, ``tracking_number``, ``status``
    (payment), ``total`` and the critical fields.
    """
    limit = _limits(thresholds)
    fields = [f for f in critical_fields if f in orders.columns]
    state, created, fulfilled = F.col("fulfillment_status"), F.col("created_at"), F.col("fulfilled_at")

    def ago(hours: float) -> Column:
        return as_of - F.make_dt_interval(mins=F.lit(round(hours * 60)))

    period = 24 * limit["period_days"]
    waiting = F.coalesce(state.isin(*IN_TRANSIT), F.lit(True)) & (created < ago(limit["max_fulfillment_hours"]))
    slow_after = F.make_dt_interval(mins=F.lit(round(limit["max_completion_hours"] * 60)))
    slow = fulfilled > created + slow_after
    now = (created >= ago(period)) & (created <= as_of)
    before = (created >= ago(2 * period)) & (created < ago(period))
    done = state == DELIVERED

    def rows(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    m = orders.agg(
        F.count(F.lit(1)).alias("all_n"),
        rows(waiting).alias("waiting_n"),
        _micros(created, as_of, waiting).alias("waiting_t"),
        rows(slow).alias("slow_n"),
        _micros(created, fulfilled, slow).alias("slow_t"),
        rows(now).alias("now_n"),
        rows(now & state.isin(*EXCEPTIONS)).alias("bad_n"),
        rows(done & (F.coalesce("tracking_number", F.lit("")) == "")).alias("untracked_n"),
        F.coalesce(F.sum(F.when(now, F.col("total"))), F.lit(0)).cast("double").alias("now_total"),
        F.sum(F.when(before, F.col("total"))).cast("double").alias("before_total"),
        rows(now & F.col("status").isin(*REFUNDED)).alias("refund_n"),
        F.max("updated_at").alias("newest"),
        rows((created >= F.date_trunc("day", as_of)) & (created <= as_of)).alias("today_n"),
        *[F.count(F.when(F.col(f).isNull(), 1)).alias(f"gap_{f}") for f in fields],
    )

    def share(part: str, whole: str) -> Column:
        return F.col(part).cast("double") / F.nullif(F.col(whole).cast("double"), F.lit(0.0))

    delay = _mean_hours(F.col("waiting_t"), F.col("waiting_n"))
    slow_hours = _mean_hours(F.col("slow_t"), F.col("slow_n"))
    drop = (F.col("before_total") - F.col("now_total")) / F.nullif(F.col("before_total"), F.lit(0.0))
    age = (F.unix_micros(as_of) - F.unix_micros("newest")).cast("double") / F.lit(_HOUR)
    n = F.col
    candidates = [
        _candidate(
            "fulfillment_delays", "fulfillment",
            F.when(n("waiting_n") > limit["critical_delays"], "critical").otherwise("high"),
            delay, limit["max_fulfillment_hours"], n("waiting_n"), n("waiting_n") > 0,
            "{n} orders wait to be shipped",
            "Not shipped after {threshold} hours: {n} orders, which have waited {metric} hours in the mean.",
        ),
        _candidate(
            "slow_completion", "fulfillment", "medium", slow_hours, limit["max_completion_hours"], n("slow_n"),
            n("slow_n") > 0, "{n} orders were shipped late",
            "It took {metric} hours in the mean to ship {n} orders; {threshold} are allowed.",
        ),
        _candidate(
            "delivery_exceptions", "delivery", "high", share("bad_n", "now_n"), limit["delivery_exception_rate"],
            n("bad_n"), share("bad_n", "now_n") > limit["delivery_exception_rate"], "High Delivery Exception Rate",
            "{n} orders ended in an exception, more than a share of {threshold}.",
        ),
        _candidate(
            "missing_tracking", "delivery", "medium", n("untracked_n"), 0, n("untracked_n"), n("untracked_n") > 0,
            "{n} shipped orders cannot be followed", "{n} orders were shipped and have no tracking number.",
        ),
        _candidate(
            "revenue_drop", "financial", "high", drop, limit["revenue_drop_percentage"], n("now_n"),
            drop > limit["revenue_drop_percentage"], "Revenue Drop",
            "Revenue fell by more than a share of {threshold} against the period before.",
        ),
        _candidate(
            "refund_rate", "financial", "high", share("refund_n", "now_n"), limit["refund_rate"], n("refund_n"),
            share("refund_n", "now_n") > limit["refund_rate"], "High Refund Rate",
            "{n} orders were refunded, more than a share of {threshold}.",
        ),
        _candidate(
            "stale_data", "data_quality", "medium", age, limit["max_age_hours"], n("all_n"),
            age > limit["max_age_hours"], "Stale Data", "No order was updated for {metric} hours.",
        ),
        _candidate(
            "order_volume", "system", "medium", n("today_n"), limit["min_daily_orders"], n("today_n"),
            n("today_n") < limit["min_daily_orders"], "Low Order Volume",
            "{n} orders today, fewer than {threshold}.",
        ),
        *[
            _candidate(
                f"missing_{f}", "data_quality", "low", share(f"gap_{f}", "all_n"), limit["missing_field_rate"],
                n(f"gap_{f}"), share(f"gap_{f}", "all_n") > limit["missing_field_rate"], f"Missing {f}",
                f"{{n}} orders lack {f}, more than a share of {{threshold}}.",
            )
            for f in fields
        ],
    ]
    return _unfold(m, candidates)


def stock_alerts(inventory: DataFrame, thresholds: Mapping[str, float] | None = None) -> DataFrame:
    """Alerts on stock: skus at or below the low mark, and skus out of stock. Input: ``quantity_on_hand``."""
    limit = _limits(thresholds)
    low, q = limit["low_stock_threshold"], F.col("quantity_on_hand")
    m = inventory.agg(
        F.count(F.when(q <= low, 1)).alias("low_n"),
        F.min(F.when(q <= low, q)).alias("low_min"),
        F.count(F.when(q <= 0, 1)).alias("out_n"),
    )
    return _unfold(m, [
        _candidate(
            "low_inventory", "inventory", "medium", F.col("low_min"), low, F.col("low_n"), F.col("low_n") > 0,
            "{n} skus run low",
            "The scarcest of {n} skus has {metric} units left; the mark is {threshold}.",
        ),
        _candidate(
            "out_of_stock", "inventory", "high", F.col("out_n"), 0, F.col("out_n"), F.col("out_n") > 0,
            "{n} skus are sold out", "Nothing is left of {n} skus.",
        ),
    ])


def feed_alerts(feeds: DataFrame) -> DataFrame:
    """Alert on unhealthy feeds. Input: the feed health table."""
    m = feeds.agg(F.count(F.when(~F.col("healthy"), 1)).alias("bad"))
    return _unfold(m, [_candidate(
        "integration_health", "system", "high", F.col("bad"), 0, F.col("bad"), F.col("bad") > 0,
        "{n} Feeds without Recent Data", "{n} feeds have no recent successful load.",
    )])


def job_alerts(runs: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Alert on failed runs of the last hours. Input: ``started_at``, ``status``."""
    recent = F.col("started_at") >= as_of - F.make_dt_interval(hours=F.lit(hours))
    m = runs.filter(recent).agg(F.count(F.when(F.col("status") == "failed", 1)).alias("bad"))
    return _unfold(m, [_candidate(
        "job_failures", "system", "high", F.col("bad"), 0, F.col("bad"), F.col("bad") > 0,
        "{n} Failed Jobs", "{n} job runs failed.",
    )])


def all_alerts(
    as_of: Column,
    *,
    orders: DataFrame | None = None,
    inventory: DataFrame | None = None,
    feeds: DataFrame | None = None,
    runs: DataFrame | None = None,
    thresholds: Mapping[str, float] | None = None,
    severity: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """All alerts of the given inputs, optionally of one severity or category."""
    parts = []
    if orders is not None:
        parts.append(order_alerts(orders, as_of, thresholds))
    if inventory is not None:
        parts.append(stock_alerts(inventory, thresholds))
    if feeds is not None:
        parts.append(feed_alerts(feeds))
    if runs is not None:
        parts.append(job_alerts(runs, as_of))
    if not parts:
        raise ValueError("no input to check")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if severity:
        out = out.filter(F.col("severity") == severity)
    if category:
        out = out.filter(F.col("category") == category)
    return out.withColumn("created_at", as_of)


def severity_counts(alerts: DataFrame) -> DataFrame:
    """One row: alerts per severity."""
    return alerts.agg(
        F.count(F.lit(1)).alias("total_count"),
        *[F.count(F.when(F.col("severity") == s, 1)).alias(s) for s in ("critical", "high", "medium", "low")],
    )
