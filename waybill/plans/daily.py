"""Daily trends of store orders, system totals and newest rows.

Order columns: ``created_at``, ``fulfillment_status``, ``total``, and ``fulfilled_at`` (see ``with_fulfilled_at``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions import percent
from waybill.operators.rollups import side_by_side

# Fulfilment states counted as exceptions, and as under way.
EXCEPTIONS = ("error", "cancelled")
IN_TRANSIT = ("pending", "partial")
DELIVERED = "fulfilled"


def _recent(orders: DataFrame, as_of: Column, days: int) -> DataFrame:
    return orders.filter(F.col("created_at") >= as_of - F.make_dt_interval(F.lit(days)))


def _is(status: Sequence[str]) -> Column:
    return F.col("fulfillment_status").isin(*status)


def with_fulfilled_at(
    orders: DataFrame, warehouse_orders: DataFrame, as_of: Column | None = None, days: int = 7, *, older: bool = False
) -> DataFrame:
    """Orders with the first shipping time of the warehouse orders that refer to them.

    With ``as_of``, only orders of the last ``days``, and only their shipments are aggregated; ``older`` keeps older orders
    too, without a shipping time.
    """
    if as_of is not None:
        recent = _recent(orders, as_of, days)
        warehouse_orders = warehouse_orders.join(
            recent.select(F.col("order_id").alias("reference_id")), "reference_id", "left_semi")
        orders = orders if older else recent
    shipped = warehouse_orders.groupBy(F.col("reference_id").alias("order_id")).agg(
        F.min("shipped_date").alias("fulfilled_at")
    )
    return orders.join(shipped, "order_id", "left")


def fulfilment_by_day(orders: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Orders per day: mean hours to fulfilment (0 if none is fulfilled), count, share of exceptions in percent."""
    daily = (
        _recent(orders, as_of, days)
        .groupBy(F.to_date("created_at").alias("date"))
        .agg(
            # Exact microseconds in a decimal: a sum of doubles would depend on the order of rows.
            F.sum((F.unix_micros("fulfilled_at") - F.unix_micros("created_at")).cast("decimal(20,0)")).alias("_micros"),
            F.count("fulfilled_at").alias("_n"),
            F.count(F.lit(1)).alias("orders_count"),
            F.count(F.when(_is(EXCEPTIONS), 1)).alias("_bad"),
        )
    )
    mean_hours = F.col("_micros").cast("double") / F.nullif(F.col("_n"), F.lit(0)) / F.lit(3_600_000_000.0)
    return daily.select(
        "date", F.coalesce(mean_hours, F.lit(0.0)).alias("avg_fulfillment_hours"), "orders_count",
        percent(F.col("_bad"), F.col("orders_count")).alias("exception_rate"),
    ).orderBy("date")


def delivery_by_day(orders: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Orders per day by outcome, and the share of exceptions in percent."""
    daily = (
        _recent(orders, as_of, days)
        .groupBy(F.to_date("created_at").alias("date"))
        .agg(
            F.count(F.when(_is([DELIVERED]), 1)).alias("delivered"),
            F.count(F.when(_is(EXCEPTIONS), 1)).alias("exceptions"),
            F.count(F.when(_is(IN_TRANSIT), 1)).alias("in_transit"),
            F.count(F.lit(1)).alias("_all"),
        )
    )
    return daily.select(
        "date", "delivered", "exceptions", "in_transit",
        percent(F.col("exceptions"), F.col("_all")).alias("exception_rate"),
    ).orderBy("date")


def revenue_by_day(orders: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Revenue, orders and mean order value per day, of orders with a positive total."""
    daily = (
        _recent(orders, as_of, days)
        .filter("total > 0")
        .groupBy(F.to_date("created_at").alias("date"))
        .agg(F.sum("total").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    )
    return daily.select(
        "date", "revenue", "orders", (F.col("revenue").cast("double") / F.col("orders")).alias("avg_order_value")
    ).orderBy("date")


def revenue_change(orders: DataFrame, as_of: Column, days: int = 7, periods: int = 8) -> DataFrame:
    """Revenue of the last ``periods`` periods of ``days``, each against the one before.

    Periods end at ``as_of``; ``period`` 0 is the newest. A period without orders is there with no revenue. ``change`` is
    the share gained or lost, NULL where the period before has no revenue.
    """
    length = F.make_dt_interval(F.lit(days))
    since = F.unix_micros(as_of) - F.unix_micros("created_at") - 1  # a period holds its first moment, and the newest its last
    ago = F.greatest(F.lit(0), F.floor(since / F.lit(days * 86_400_000_000))).cast("int")
    sums = (orders.filter(F.col("created_at") <= as_of).groupBy(ago.alias("period"))
            .agg(F.sum("total").alias("total"), F.count(F.lit(1)).alias("orders")).filter(F.col("period") <= periods))
    calendar = orders.sparkSession.range(periods + 1).select(F.col("id").cast("int").alias("period"))
    filled = calendar.join(sums, "period", "left").select(
        "period", (as_of - F.expr(f"make_dt_interval(period * {days})") - length).alias("period_start"),
        F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce("total", F.lit(0)).cast("double").alias("revenue"))
    before = F.lead("revenue").over(Window.orderBy("period"))  # one row per period
    return (filled.withColumn("before", before).filter(F.col("period") < periods)
            .withColumn("change", (F.col("revenue") - F.col("before")) / F.nullif("before", F.lit(0.0))))


def revenue_drops(orders: DataFrame, as_of: Column, days: int = 7, periods: int = 8, drop_percent: float = 20.0) -> DataFrame:
    """The periods whose revenue fell by more than ``drop_percent`` against the one before."""
    return revenue_change(orders, as_of, days, periods).filter(F.col("change") * -100 > drop_percent)


def system_stats(orders: DataFrame, inventory: DataFrame, customers: DataFrame, as_of: Column) -> DataFrame:
    """One row: all orders, those of the last 24 hours, products, customers, the newest order time, pending orders."""
    order_totals = orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count(F.when(F.col("created_at") >= as_of - F.make_dt_interval(hours=F.lit(24)), 1)).alias("orders_24h"),
        F.max("created_at").alias("last_order_time"),
        F.count(F.when(F.col("fulfillment_status") == "pending", 1)).alias("pending_orders"),
    )
    products = inventory.agg(F.count(F.lit(1)).alias("total_products"))
    people = customers.agg(F.count(F.lit(1)).alias("total_customers"))
    return side_by_side([order_totals, products, people])


def newest(df: DataFrame, by: str, tie: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` newest rows; ``tie`` columns settle equal times."""
    return df.orderBy(F.desc(by), *tie).limit(n)
