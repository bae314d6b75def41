"""Store payloads to rows: orders, line items, customers, products, variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import (
    blank_to_null, coerce_int, money, parse_date, split_tags, tags_to_json, text_or_blank,
)
from waybill.operators.picks import last_match
from waybill.sources.landing import SEQ


def _seq(df: DataFrame) -> list[str]:
    return [SEQ] if SEQ in df.columns else []


def _first_text(*candidates: Column) -> Column:
    """First candidate that is neither missing nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def order_key() -> Column:
    """Orders go by their readable name; the internal id stands in where there is none."""
    return _first_text(F.col("name"), F.col("id"))


def orders(df: DataFrame) -> DataFrame:
    shipped = last_match(F.col("fulfillments"), lambda f: f["tracking_number"] != "")
    internal = F.col("id")
    tags = F.when(
        F.ltrim("tags").startswith("["), F.array_join(F.from_json("tags", "array<string>"), ", ")
    ).otherwise(text_or_blank(F.col("tags")))
    rows = df.withColumn("_shipped", shipped)
    return rows.select(
        order_key().alias("order_id"),
        F.when(internal != order_key(), internal).alias("shopify_internal_id"),
        parse_date(F.col("created_at")).alias("purchase_date"),
        F.col("financial_status").alias("status"),
        "fulfillment_status",
        text_or_blank(F.col("customer.id")).alias("customer_id"),
        money(F.col("total_price")).alias("total"),
        text_or_blank(F.col("currency")).alias("currency"),
        *[money(F.col(c)).alias(c) for c in ("subtotal_price", "total_tax", "total_discounts")],
        F.nullif(coerce_int(F.col("total_weight")), F.lit(0)).try_cast("int").alias("total_weight"),
        _first_text(F.col("email"), F.col("contact_email")).alias("email"),
        "phone",
        tags.alias("tags"),
        "note", "confirmation_number",
        F.nullif(coerce_int(F.col("order_number")), F.lit(0)).try_cast("int").alias("order_number"),
        "referring_site", "landing_site", "source_name",
        *[parse_date(F.col(c)).alias(c) for c in ("processed_at", "closed_at", "cancelled_at")],
        parse_date(F.col("updated_at")).alias("updated_at_shopify"),
        F.col("_shipped.tracking_number").alias("tracking_number"),
        F.col("_shipped.tracking_company").alias("carrier"),
        F.col("_shipped.tracking_url").alias("tracking_url"),
        parse_date(F.col("_shipped.updated_at")).alias("tracking_updated_at"),
        "billing_address", "shipping_address",
        *_seq(df),
    )


def order_items(df: DataFrame) -> DataFrame:
    """One row per line item of the order records; ``line`` is its place in the order."""
    lines = df.select(
        order_key().alias("order_id"), parse_date(F.col("updated_at")).alias("updated_at_shopify"),
        F.posexplode("line_items").alias("line", "_item"), *_seq(df),
    )
    return lines.select(
        "order_id",
        F.coalesce(_first_text(F.col("_item.sku"), F.col("_item.id")), F.lit("")).alias("sku"),
        F.when(F.col("_item.quantity").isNull(), F.lit(1)).otherwise(coerce_int(F.col("_item.quantity")))
        .try_cast("int").alias("qty"),
        F.when(F.col("_item.price").isNull(), F.lit(0).cast("decimal(12,2)")).otherwise(money(F.col("_item.price")))
        .alias("price"),
        "updated_at_shopify", "line",
        *_seq(df),
    )


def customers(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("id").alias("customer_id"),
        *[text_or_blank(F.col(c)).alias(c) for c in ("email", "first_name", "last_name")],
        parse_date(F.col("created_at")).alias("created_at"),
        parse_date(F.col("updated_at")).alias("updated_at"),
        F.coalesce(money(F.col("total_spent")), F.lit(0).cast("decimal(12,2)")).alias("total_spent"),
        F.coalesce(coerce_int(F.col("orders_count")), F.lit(0)).try_cast("int").alias("orders_count"),
        text_or_blank(F.col("state")).alias("state"),
        tags_column(F.col("tags")).alias("tags"),
        blank_to_null(F.col("last_order_id")).alias("last_order_id"),
        *_seq(df),
    )


def tags_column(tags: Column) -> Column:
    """Tags as stored: a JSON array stays one (NULL when empty), comma-separated text becomes one."""
    return F.when(
        F.ltrim(tags).startswith("["), tags_to_json(F.from_json(tags, "array<string>"))
    ).otherwise(tags_to_json(split_tags(tags)))


def tags_as_given(tags: Column) -> Column:
    """Tags kept in the form they came in: JSON array text, or plain text; NULL when empty."""
    is_list = F.ltrim(tags).startswith("[")
    return F.when(is_list, tags_to_json(F.from_json(tags, "array<string>"))).otherwise(F.nullif(tags, F.lit("")))


def products(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("id").alias("product_id"),
        *[text_or_blank(F.col(c)).alias(c) for c in ("title", "vendor", "product_type")],
        parse_date(F.col("created_at")).alias("created_at"),
        parse_date(F.col("updated_at")).alias("updated_at"),
        *_seq(df),
    )


def variants(df: DataFrame) -> DataFrame:
    """One row per variant of the product records."""
    rows = df.select(F.col("id").alias("_product"), F.explode("variants").alias("v"), *_seq(df))
    return rows.select(
        F.col("v.id").alias("variant_id"),
        F.col("_product").alias("product_id"),
        text_or_blank(F.col("v.sku")).alias("sku"),
        F.when(F.col("v.price").isNull(), F.lit(0).cast("decimal(12,2)")).otherwise(money(F.col("v.price")))
        .alias("price"),
        money(F.col("v.weight"), 8, 3).alias("weight"),
        text_or_blank(F.col("v.inventory_item_id")).alias("inventory_item_id"),
        parse_date(F.col("v.created_at")).alias("created_at"),
        parse_date(F.col("v.updated_at")).alias("updated_at"),
        *_seq(df),
    )
