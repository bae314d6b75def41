"""Parent / child keys and links between feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.operators.picks import latest_per_key


def drop_orphans(children: DataFrame, parents: DataFrame, on: str) -> DataFrame:
    """Children whose parent is there. A parent with very many children is split by adaptive skew handling."""
    return children.join(parents.select(on), on, "left_semi")


def orphan_keys(children: DataFrame, parents: DataFrame, on: str) -> DataFrame:
    """Distinct parent keys that children name and no parent has. Keys are reduced before they are joined."""
    return children.select(on).distinct().join(parents.select(on), on, "left_anti")


def keep_keys(df: DataFrame, column: str, wanted: DataFrame | Sequence[str]) -> DataFrame:
    """Rows with a wanted key: a literal list becomes a pushed-down predicate, a frame a semi join."""
    if isinstance(wanted, DataFrame):
        return df.join(wanted.select(F.col(wanted.columns[0]).alias(column)), column, "left_semi")
    return df.filter(F.col(column).isin(*wanted))


def since(df: DataFrame, column: str, moment: Column) -> DataFrame:
    """Rows at or after a moment; a row without a time is dropped."""
    return df.filter(F.col(column) >= moment)


def between(df: DataFrame, column: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Rows of a range, both ends included; an open end does not filter."""
    if start is not None:
        df = df.filter(F.col(column) >= start)
    if end is not None:
        df = df.filter(F.col(column) <= end)
    return df


def order_links(orders: DataFrame, warehouse_orders: DataFrame) -> DataFrame:
    """Every store order with the newest warehouse order that refers to it (NULLs when none does)."""
    newest = latest_per_key(
        warehouse_orders.select(
            F.col("reference_id").alias("order_id"), "shipbob_order_id", F.col("status").alias("warehouse_status"),
            "tracking_number", "carrier", "shipped_date", "delivered_date", "last_updated_date",
        ).filter(F.col("order_id").isNotNull()),
        ["order_id"],
        ["last_updated_date"],
    )
    return orders.select("order_id", "purchase_date").join(newest, "order_id", "left")


def with_stock(products: DataFrame, inventory: DataFrame) -> DataFrame:
    """Every product with its stock row, matched by sku (NULLs without stock)."""
    return products.join(inventory, "sku", "left")
