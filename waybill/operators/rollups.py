"""Roll-ups of loaded records. All are aggregates with a map-side step, so one large key costs no single task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def inventory_by_sku(df: DataFrame, quantities: Sequence[str], first: Sequence[str], center: str, seq: str) -> DataFrame:
    """One row per sku over all centers: quantities summed, the last named center, other columns of the first row."""
    return df.groupBy("sku").agg(
        *[F.sum(q).alias(q) for q in quantities],
        F.max_by(F.col(center), F.when(F.col(center) != "", F.col(seq))).alias(center),
        *[F.min_by(c, seq).alias(c) for c in first],
    )


def settlement_headers(lines: DataFrame, seq: str, by: Sequence[str] = ("settlement_id",)) -> DataFrame:
    """One header per settlement: period and currency of its first line, and the sums of its lines.

    ``gross`` and ``net`` are the sum of all lines. ``fees`` sums the lines that are neither principal nor refund,
    ``refunds`` the refund lines.
    """
    zero = F.lit(0).cast("decimal(12,2)")
    refund = F.col("type") == "Refund"
    fee = F.coalesce(F.col("fee_type") != "Principal", F.lit(False)) & ~F.coalesce(refund, F.lit(False))

    def total(amount: Column) -> Column:
        return F.coalesce(F.sum(amount), zero).cast("decimal(12,2)")

    first = F.min_by(F.struct("period_start", "period_end", "currency"), seq)
    summed = lines.groupBy(*by).agg(
        first.alias("_first"),
        total(F.col("amount")).alias("gross"),
        total(F.when(fee, F.col("amount"))).alias("fees"),
        total(F.when(refund, F.col("amount"))).alias("refunds"),
        F.count(F.lit(1)).alias("line_count"),
    )
    return summed.select(
        *by, "_first.period_start", "_first.period_end", "gross", "fees", "refunds", F.col("gross").alias("net"),
        "_first.currency", "line_count",
    )


def amount_total(items: Column, field: str = "amount") -> Column:
    """Sum of a money field over an array of structs, 0 for an empty or missing array."""
    total = F.aggregate(
        items,
        F.lit(0).cast("decimal(18,6)"),
        lambda sum_, item: (
            sum_ + F.coalesce(item[field].try_cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))
        ).cast("decimal(18,6)"),
    )
    return F.coalesce(total, F.lit(0).cast("decimal(18,6)")).cast("decimal(12,2)")


def batch_stats(df: DataFrame, **measures: Column) -> DataFrame:
    """One row of named aggregates over a batch."""
    return df.agg(*[m.alias(name) for name, m in measures.items()])


def side_by_side(frames: Sequence[DataFrame]) -> DataFrame:
    """One row out of several one-row frames with different columns, without a cross join."""
    names = [c for f in frames for c in f.columns]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in names])


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
