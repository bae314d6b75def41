"""Monthly business report: revenue, customers, fulfilment and stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions import percent


def month_report(orders: DataFrame) -> DataFrame:
    """Per month: orders, revenue, customers, the best customer's total, and the share of fulfilled orders.

    Input: ``created_at``, ``customer_id``, ``total``, ``fulfillment_status``. Orders are first summed per month and
    customer; the month is rolled up from those sums, so no customer set is gathered.
    """
    per_customer = orders.groupBy(F.date_trunc("month", "created_at").alias("month"), "customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total").alias("total"),
        F.count(F.when(F.col("fulfillment_status") == "fulfilled", 1)).alias("done"),
    )
    monthly = per_customer.groupBy("month").agg(
        F.sum("n").alias("orders"),
        F.sum("total").alias("revenue"),
        F.count("customer_id").alias("customers"),
        F.max("total").alias("top_customer_total"),
        F.sum("done").alias("_done"),
    )
    return monthly.select(
        "month", "orders", "revenue", "customers", "top_customer_total",
        percent(F.col("_done"), F.col("orders")).alias("fulfilled_rate"),
    ).orderBy("month")


def stock_health(inventory: DataFrame, low: int = 10) -> DataFrame:
    """One row over the stock table: skus, out of stock, low stock, units on hand."""
    on_hand = F.col("quantity_on_hand")
    return inventory.agg(
        F.count(F.lit(1)).alias("skus"),
        F.count(F.when(on_hand <= 0, 1)).alias("out_of_stock"),
        F.count(F.when((on_hand > 0) & (on_hand <= low), 1)).alias("low_stock"),
        F.sum(on_hand).alias("units"),
    )
