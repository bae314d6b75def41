"""Marketplace payloads to rows: orders, items, stock summaries, settlement lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import blank_to_null, clamp_zero, coerce_int, money, parse_date, text_or_blank
from waybill.operators.picks import first_element
from waybill.operators.quality import Rule
from waybill.sources.landing import SEQ

SOURCE = "amazon"
# The order states a load asks for.
ORDER_STATES = ("Pending", "Unshipped", "PartiallyShipped", "Shipped", "Canceled", "Unfulfillable")
#: Quantities of a stock summary.
QUANTITIES = ("on_hand", "reserved", "inbound")


def _seq(df: DataFrame) -> list[str]:
    """What records carry of where they come from."""
    return [c for c in (SEQ, "_pull", "_whole") if c in df.columns]


def wanted_orders(df: DataFrame, since: Column | None = None) -> DataFrame:
    """Order records in a wanted state, changed strictly after ``since``."""
    df = df.filter(F.col("OrderStatus").isin(*ORDER_STATES))
    return df if since is None else df.filter(parse_date(F.col("LastUpdateDate")) > since)


def _amount(of: str) -> Column:
    """Amount of a money struct: NULL without the struct, 0 in a struct without an amount."""
    return F.when(
        F.col(of).isNotNull(),
        F.when(F.col(f"{of}.Amount").isNull(), F.lit(0).cast("decimal(12,2)")).otherwise(money(F.col(f"{of}.Amount"))),
    )


def orders(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("AmazonOrderId").alias("order_id"),
        F.lit(SOURCE).alias("source"),
        parse_date(F.col("PurchaseDate")).alias("purchase_date"),
        F.col("OrderStatus").alias("status"),
        text_or_blank(F.col("BuyerEmail")).alias("customer_id"),
        _amount("OrderTotal").alias("total"),
        F.col("OrderTotal.CurrencyCode").alias("currency"),
        F.col("MarketplaceId").alias("marketplace_id"),
        parse_date(F.col("LastUpdateDate")).alias("last_update_date"),
        *_seq(df),
    )


def order_items(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("AmazonOrderId").alias("order_id"),
        text_or_blank(F.col("SellerSKU")).alias("sku"),
        text_or_blank(F.col("ASIN")).alias("asin"),
        F.when(F.col("QuantityOrdered").isNull(), F.lit(1)).otherwise(coerce_int(F.col("QuantityOrdered")))
        .try_cast("int").alias("qty"),
        _amount("ItemPrice").alias("price"),
        _amount("ItemTax").alias("tax"),
        F.lit(None).cast("decimal(12,2)").alias("fee_estimate"),
        *_seq(df),
    )


def inventory(df: DataFrame, as_of: Column) -> DataFrame:
    """Stock summaries per sku and center; a summary without a sku or with an unreadable quantity is dropped."""
    rows = _stock(df, as_of)
    return rows.dropna(subset=["sku", *QUANTITIES])


def unreadable_stock(df: DataFrame) -> DataFrame:
    """``(reason, value)`` of summaries that name a sku and a quantity that is no number; ``inventory`` leaves them out."""
    rows = _stock(df, F.lit(None).cast("timestamp"), F.to_json(F.struct(*[c for c in df.columns if c not in _seq(df)])))
    lost = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in QUANTITIES]))
    return rows.filter((F.size(lost) > 0) & F.col("sku").isNotNull()).select(
        F.concat(F.lit("invalid "), F.array_join(lost, ", ")).alias("reason"), "value")


def _stock(df: DataFrame, as_of: Column, value: Column | None = None) -> DataFrame:
    """Stock summaries per sku and center; a quantity that cannot be read is NULL."""
    reserved_raw = F.col("inventoryDetails.reservedQuantity")
    reserved = F.when(
        F.ltrim(reserved_raw).startswith("{"), F.get_json_object(reserved_raw, "$.totalReservedQuantity")
    ).otherwise(reserved_raw)
    detailed = F.col("inventoryDetails").isNotNull()
    texts = F.array(
        F.when(detailed, F.col("inventoryDetails.fulfillableQuantity")).otherwise(F.col("totalQuantity")),
        F.when(detailed, reserved), F.when(detailed, F.col("inventoryDetails.inboundWorkingQuantity")))
    numbers = F.transform(texts, lambda raw: F.when(raw.isNull(), F.lit(0)).otherwise(coerce_int(raw)))
    # A filter on the quantities would repeat all their parsing; on an exploded column it reads what was parsed once.
    once = df.select(
        blank_to_null(F.col("sellerSku")).alias("sku"),
        blank_to_null(F.col("asin")).alias("asin"),
        blank_to_null(F.col("fnSku")).alias("fnsku"),
        F.nullif(first_element(F.col("fulfillmentCenterDetails"))["fulfillmentCenterCode"], F.lit("")).alias("fc"),
        *([] if value is None else [value.alias("value")]),
        *_seq(df),
        F.explode_outer(F.array(numbers)).alias("_numbers"),
    )
    quantities = [clamp_zero(F.col("_numbers")[k]).try_cast("int").alias(name) for k, name in enumerate(QUANTITIES)]
    return once.select(
        "sku", "asin", "fnsku", "fc", *quantities, as_of.alias("updated_at"),
        *([] if value is None else ["value"]), *_seq(df))


#: A report speaks of one settlement, that of its first line.
OF_ITS_REPORT = Rule("settlement of another report", "report_settlement_id IS NOT NULL AND settlement_id <> report_settlement_id")


def report_headers(lines: DataFrame) -> DataFrame:
    """``(report, settlement_id)`` of the first line of every report that names a settlement."""
    return lines.filter("settlement_id IS NOT NULL").groupBy("report").agg(F.min_by("settlement_id", SEQ).alias("settlement_id"))


def settlement_lines(df: DataFrame) -> DataFrame:
    """Report lines, trimmed; each keeps its own settlement id, period and currency for the header."""

    def cell(name: str) -> Column:
        return F.trim(F.col(f"`{name}`"))

    amount = F.when(
        F.coalesce(cell("amount"), F.lit("")) == "", F.lit(0).cast("decimal(12,2)")
    ).otherwise(money(cell("amount")))
    return df.select(
        F.nullif(cell("settlement-id"), F.lit("")).alias("settlement_id"),
        F.nullif(cell("order-id"), F.lit("")).alias("order_id"),
        F.coalesce(cell("transaction-type"), F.lit("")).alias("type"),
        amount.alias("amount"),
        F.coalesce(cell("amount-type"), F.lit("")).alias("fee_type"),
        parse_date(cell("posted-date")).alias("posted_date"),
        parse_date(cell("settlement-start-date")).alias("period_start"),
        parse_date(cell("settlement-end-date")).alias("period_end"),
        cell("currency").alias("currency"),
        *[c for c in ("report", SEQ) if c in df.columns],
    )
