"""Invoices, bills and bank movements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import day_difference

# Names of the aging buckets and the last day of each.
AGING = (("0-30 days", 30), ("31-60 days", 60), ("61-90 days", 90))
OLDEST = "90+ days"


def average(total: Column, n: Column) -> Column:
    """``sum / count`` as double: the mean of exact decimals, the same on every engine."""
    return total.cast("double") / n.cast("double")


def revenue_by_month(invoices: DataFrame, since: Column, status: str = "Paid") -> DataFrame:
    """Invoices of a status per month since a day: count, total and mean value."""
    monthly = (
        invoices.filter((F.col("status") == status) & (F.col("dated_on") >= since))
        .groupBy(F.date_trunc("month", "dated_on").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("invoice_count"),
            F.sum("total_value").alias("total_revenue"),
            F.count("total_value").alias("_n"),
        )
    )
    return monthly.select(
        "month", "invoice_count", "total_revenue", average(F.col("total_revenue"), F.col("_n")).alias("avg_invoice_value")
    ).orderBy("month")


def aging_bucket(due_on: Column, as_of: Column) -> Column:
    """Bucket of an open invoice by days overdue; not yet due counts as the first, an unknown due date as the last."""
    days = day_difference(due_on, as_of)
    bucket = F.when(days <= AGING[0][1], AGING[0][0])
    for name, last in AGING[1:]:
        bucket = bucket.when(days <= last, name)
    return bucket.otherwise(OLDEST)


def receivables_aging(invoices: DataFrame, as_of: Column) -> DataFrame:
    """Open invoices per aging bucket: count and amount outstanding."""
    return (
        invoices.filter("due_value > 0")
        .groupBy(aging_bucket(F.col("due_on"), as_of).alias("aging_bucket"))
        .agg(F.count(F.lit(1)).alias("invoice_count"), F.sum("due_value").alias("total_outstanding"))
    )


def cash_flow(transactions: DataFrame, accounts: DataFrame, since: Column) -> DataFrame:
    """Money in, money out (positive) and net per account name and month.

    Movements are summed per account id and month before they meet the accounts, so the join and its shuffle carry
    sums; accounts that share a name are added up after it.
    """
    amount = F.col("amount")
    moved = (
        transactions.filter(F.col("dated_on") >= since)
        .groupBy("bank_account_id", F.date_trunc("month", "dated_on").alias("month"))
        .agg(
            F.sum(F.when(amount > 0, amount).otherwise(F.lit(0))).alias("inflows"),
            F.sum(F.when(amount < 0, F.abs(amount)).otherwise(F.lit(0))).alias("outflows"),
            F.sum(amount).alias("net_flow"),
        )
    )
    named = moved.join(accounts.select("bank_account_id", F.col("name").alias("bank_account")), "bank_account_id")
    return (
        named.groupBy("bank_account", "month")
        .agg(*[F.sum(c).alias(c) for c in ("inflows", "outflows", "net_flow")])
        .orderBy("month", "bank_account")
    )


def expenses_by_category(
    bills: DataFrame, explanations: DataFrame, categories: DataFrame, since: Column, status: str = "Paid"
) -> DataFrame:
    """Bills of a status per category: count, total and mean. A bill with several explanations counts for each.

    Explanations are counted per bill and category first; a bill explained many times then joins as one row with a
    weight instead of many rows.
    """
    weights = (
        explanations.filter(F.col("bill_id").isNotNull() & F.col("category_id").isNotNull())
        .groupBy("bill_id", "category_id")
        .agg(F.count(F.lit(1)).alias("_w"))
    )
    paid = bills.filter((F.col("dated_on") >= since) & (F.col("status") == status)).select("bill_id", "total_value")
    value = F.col("total_value")
    per_category = (
        paid.join(weights, "bill_id")
        .groupBy("category_id")
        .agg(
            F.sum("_w").alias("bill_count"),
            F.sum(value * F.col("_w").cast("decimal(18,0)")).alias("total_expenses"),
            F.sum(F.when(value.isNotNull(), F.col("_w"))).alias("_n"),
        )
    )
    named = per_category.join(
        categories.select("category_id", F.col("description").alias("category"), "nominal_code"), "category_id"
    )
    return named.select(
        "category_id", "category", "nominal_code", "bill_count", "total_expenses",
        average(F.col("total_expenses"), F.col("_n")).alias("avg_bill_value"),
    ).orderBy(F.desc("total_expenses"), "category_id")
