"""Reshaping between generic and per-source tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Former column of the inventory feed to its table column.
LEGACY_INVENTORY = {
    "fc": "fulfillment_center",
    "on_hand": "quantity_on_hand",
    "reserved": "quantity_reserved",
    "inbound": "quantity_incoming",
    "updated_at": "last_updated",
}


def current_inventory_columns(df: DataFrame, source: str = "amazon") -> DataFrame:
    """Former inventory columns under their table names; a table column that is already there wins."""
    out = df
    for former, current in LEGACY_INVENTORY.items():
        if former in out.columns:
            value = F.coalesce(F.col(current), F.col(former)) if current in out.columns else F.col(former)
            out = out.withColumn(current, value).drop(former)
    if "source" not in out.columns:
        return out.withColumn("source", F.lit(source))
    return out.withColumn("source", F.coalesce("source", F.lit(source)))


def flat_tracking(df: DataFrame) -> DataFrame:
    """A ``tracking`` struct as three columns (NULL without one), stamped with the time of the update."""
    return df.select(
        *[c for c in df.columns if c != "tracking"],
        F.col("tracking.tracking_number"), F.col("tracking.carrier"), F.col("tracking.tracking_url"),
        F.col("updated_at").alias("tracking_updated_at"),
    )


def of_source(df: DataFrame, source: str) -> DataFrame:
    """The rows of one source, without the source column."""
    return df.filter(F.col("source") == source).drop("source")


def items_of_source(items: DataFrame, orders: DataFrame, source: str, on: str = "order_id") -> DataFrame:
    """Items whose order comes from a source."""
    return items.join(of_source(orders.select(on, "source"), source), on, "left_semi")


def unified(parts: Mapping[str, DataFrame]) -> DataFrame:
    """One frame over per-source frames, with their source as a literal column; missing columns are NULL."""
    labelled = [df.withColumn("source", F.lit(name)) for name, df in parts.items()]
    out = labelled[0]
    for frame in labelled[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def fill_default(df: DataFrame, **values: str) -> DataFrame:
    """Constant in place of NULL, per column."""
    return df.fillna(values)
