"""Payloads of the fulfilment warehouse to rows: stock, orders, returns, receiving, products, variants, centers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import (
    bool_text, coerce_int, coerce_int_or_zero, money, order_status, parse_date, text_or_blank,
)
from waybill.operators.picks import first_present, last_element
from waybill.operators.rollups import amount_total
from waybill.sources.landing import SEQ

SOURCE = "shipbob"
# Payload quantity to table column.
# The source's names of the stock columns, over all centers and at one center.
STOCK = {
    "quantity_on_hand": "total_on_hand_quantity",
    "quantity_available": "total_sellable_quantity",
    "quantity_reserved": "total_committed_quantity",
    "quantity_incoming": "total_awaiting_quantity",
    "fulfillable_quantity": "total_fulfillable_quantity",
    "backordered_quantity": "total_backordered_quantity",
    "exception_quantity": "total_exception_quantity",
    "internal_transfer_quantity": "total_internal_transfer_quantity",
}
CENTER_STOCK = {
    "quantity_on_hand": "quantity_on_hand",
    "quantity_available": "quantity_available",
    "quantity_reserved": "quantity_committed",
    "quantity_incoming": "quantity_incoming",
    "fulfillable_quantity": "quantity_fulfillable",
    "backordered_quantity": "quantity_backordered",
    "exception_quantity": "quantity_exception",
    "internal_transfer_quantity": "quantity_internal_transfer",
}


def _seq(df: DataFrame) -> list[str]:
    return [SEQ] if SEQ in df.columns else []


def _quantity(raw: Column) -> Column:
    """Whole quantity; unreadable counts as 0, missing stays NULL."""
    return coerce_int_or_zero(raw).try_cast("int")


def inventory(df: DataFrame, as_of: Column) -> DataFrame:
    """Stock per sku over all centers; records without a sku are dropped."""
    rows = df.select(
        text_or_blank(F.col("sku")).alias("sku"),
        *[_quantity(F.col(raw)).alias(name) for name, raw in STOCK.items()],
        as_of.alias("last_updated"),
        *_seq(df),
    )
    return rows.filter("trim(sku) <> ''")


def inventory_by_center(df: DataFrame) -> DataFrame:
    """Stock per sku and center; a record without centers gives one row with the totals."""
    rows = df.select(
        "inventory", *STOCK.values(), F.explode_outer("fulfillment_center_locations").alias("at"), *_seq(df)
    )
    here = F.col("at").isNotNull()

    def stock(name: str) -> Column:
        at_center, total = F.col(f"at.{CENTER_STOCK[name]}"), F.col(STOCK[name])
        return F.coalesce(_quantity(F.when(here, at_center).otherwise(total)), F.lit(0)).alias(name)

    return rows.select(
        text_or_blank(F.col("inventory.name")).alias("sku"),
        text_or_blank(F.col("inventory.id")).alias("inventory_id"),
        F.when(here, text_or_blank(F.col("at.fulfillment_center.id"))).alias("fulfillment_center_id"),
        F.when(here, text_or_blank(F.col("at.fulfillment_center.name"))).alias("fulfillment_center_name"),
        *[stock(name) for name in STOCK],
        *_seq(df),
    )


def order_statuses(df: DataFrame, since: Column) -> DataFrame:
    """Status changes since a moment, of orders that carry a store reference, with the last shipment's tracking."""
    shipment = last_element(F.col("shipments"))
    rows = df.withColumns({
        "_shipment": shipment,
        "_updated": parse_date(F.coalesce(F.nullif("last_updated_date", F.lit("")), F.col("created_date"))),
    })
    rows = rows.filter((F.col("_updated") >= since) & (F.coalesce("reference_id", F.lit("")) != ""))
    tracked = F.coalesce(F.col("_shipment.tracking.tracking_number"), F.lit("")) != ""
    return rows.select(
        F.col("reference_id").alias("order_id"),
        order_status(F.col("status"), F.col("_shipment.status")).alias("status"),
        F.when(tracked, F.struct(
            F.col("_shipment.tracking.tracking_number").alias("tracking_number"),
            F.col("_shipment.tracking.carrier").alias("carrier"),
            F.col("_shipment.tracking.tracking_url").alias("tracking_url"),
        )).alias("tracking"),
        F.col("_updated").alias("updated_at"),
        text_or_blank(F.col("id")).alias("shipbob_order_id"),
        text_or_blank(F.col("status")).alias("shipbob_status"),
        F.col("_shipment.status").alias("shipment_status"),
        *_seq(df),
    )


def orders(df: DataFrame) -> DataFrame:
    """Full orders; shipping fields come from the first shipment. Records without an id are dropped."""
    rows = df.withColumn("_first", first_present(F.col("shipments")))
    return rows.select(
        text_or_blank(F.col("id")).alias("shipbob_order_id"),
        text_or_blank(F.col("reference_id")).alias("reference_id"),
        text_or_blank(F.col("status")).alias("status"),
        parse_date(F.col("created_date")).alias("created_date"),
        parse_date(F.col("last_updated_date")).alias("last_updated_date"),
        parse_date(F.col("_first.shipped_date")).alias("shipped_date"),
        parse_date(F.col("_first.delivery_date")).alias("delivered_date"),
        text_or_blank(F.col("_first.tracking.tracking_number")).alias("tracking_number"),
        text_or_blank(F.col("_first.tracking.carrier_name")).alias("carrier"),
        text_or_blank(F.col("recipient.name")).alias("recipient_name"),
        text_or_blank(F.col("recipient.email")).alias("recipient_email"),
        text_or_blank(F.col("_first.location.id")).alias("fulfillment_center_id"),
        F.lit(0).cast("decimal(10,3)").alias("total_weight"),
        F.coalesce(money(F.col("financials.total_price")), F.lit(0).cast("decimal(12,2)")).alias("total_cost"),
        F.lit("USD").alias("currency"),
        text_or_blank(F.col("shipping_method")).alias("shipping_method"),
        *_seq(df),
    ).filter("shipbob_order_id <> ''")


def returns(df: DataFrame) -> DataFrame:
    items = F.transform("inventory", lambda i: F.struct(
        F.coalesce(i["id"], F.lit("")).alias("inventory_id"),
        F.coalesce(i["name"], F.lit("")).alias("name"),
        F.coalesce(coerce_int(i["quantity"]), F.lit(0)).cast("int").alias("quantity"),
        F.coalesce(i["action_requested"]["action"], F.lit("")).alias("action_requested"),
        F.coalesce(i["action_requested"]["instructions"], F.lit("")).alias("action_instructions"),
    ))
    amounts = F.from_json("transactions", "array<struct<amount: string>>")
    return df.select(
        text_or_blank(F.col("id")).alias("return_id"),
        F.lit(SOURCE).alias("source"),
        text_or_blank(F.col("original_shipment_id")).alias("original_shipment_id"),
        *[text_or_blank(F.col(c)).alias(c) for c in (
            "reference_id", "store_order_id", "status", "return_type", "customer_name", "tracking_number")],
        amount_total(amounts).alias("total_cost"),
        text_or_blank(F.col("fulfillment_center.id")).alias("fulfillment_center_id"),
        text_or_blank(F.col("fulfillment_center.name")).alias("fulfillment_center_name"),
        F.coalesce(items, F.array()).alias("items"),
        F.coalesce("transactions", F.lit("[]")).alias("transactions"),
        parse_date(F.col("insert_date")).alias("insert_date"),
        parse_date(F.col("completed_date")).alias("completed_date"),
        *_seq(df),
    )


def receiving_orders(df: DataFrame) -> DataFrame:
    def number(value: Column, name: str) -> Column:
        return F.coalesce(coerce_int(value), F.lit(0)).cast("int").alias(name)

    quantities = F.transform("inventory_quantities", lambda i: F.struct(
        F.coalesce(i["inventory_id"], F.lit("")).alias("inventory_id"),
        F.coalesce(i["sku"], F.lit("")).alias("sku"),
        number(i["expected_quantity"], "expected_quantity"),
        number(i["received_quantity"], "received_quantity"),
        number(i["stowed_quantity"], "stowed_quantity"),
    ))
    return df.select(
        text_or_blank(F.col("id")).alias("wro_id"),
        F.lit(SOURCE).alias("source"),
        *[text_or_blank(F.col(c)).alias(c) for c in (
            "purchase_order_number", "status", "package_type", "box_packaging_type")],
        text_or_blank(F.col("fulfillment_center.id")).alias("fulfillment_center_id"),
        text_or_blank(F.col("fulfillment_center.name")).alias("fulfillment_center_name"),
        F.coalesce(quantities, F.array()).alias("inventory_quantities"),
        F.coalesce("status_history", F.lit("[]")).alias("status_history"),
        *[parse_date(F.col(c)).alias(c) for c in ("expected_arrival_date", "insert_date", "last_updated_date")],
        *_seq(df),
    )


def _flag(flag: Column, default: bool) -> Column:
    return bool_text(F.coalesce(flag, F.lit(str(default).lower())))


def products(df: DataFrame) -> DataFrame:
    return df.select(
        text_or_blank(F.col("id")).alias("product_id"),
        F.lit(SOURCE).alias("source"),
        *[text_or_blank(F.col(c)).alias(c) for c in ("name", "sku", "barcode", "description", "category")],
        _flag(F.col("is_case"), False).alias("is_case"),
        _flag(F.col("is_lot"), False).alias("is_lot"),
        _flag(F.col("variant.is_active"), True).alias("is_active"),
        _flag(F.col("variant.is_bundle"), False).alias("is_bundle"),
        _flag(F.col("variant.is_digital"), False).alias("is_digital"),
        _flag(F.col("variant.hazmat.is_hazmat"), False).alias("is_hazmat"),
        *[F.coalesce(c, F.lit("{}")).alias(c) for c in ("dimensions", "weight", "value")],
        *_seq(df),
    )


def variants(df: DataFrame) -> DataFrame:
    return df.select(
        text_or_blank(F.col("id")).alias("variant_id"),
        text_or_blank(F.col("product_id")).alias("product_id"),
        F.lit(SOURCE).alias("source"),
        *[text_or_blank(F.col(c)).alias(c) for c in ("name", "sku", "barcode")],
        _flag(F.col("is_active"), True).alias("is_active"),
        *[F.coalesce(c, F.lit("{}")).alias(c) for c in ("dimensions", "weight", "value")],
        *_seq(df),
    )


def centers(df: DataFrame) -> DataFrame:
    return df.select(
        text_or_blank(F.col("id")).alias("center_id"),
        F.lit(SOURCE).alias("source"),
        *[text_or_blank(F.col(c)).alias(c) for c in (
            "name", "address1", "address2", "city", "state", "zip_code", "country", "phone_number", "email",
            "timezone")],
        *_seq(df),
    )
