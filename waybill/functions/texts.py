"""Text, flags, tags, JSON text and status names."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shipment status to order status.
SHIPMENT_STATUS = {
    "Shipped": "shipped",
    "Delivered": "delivered",
    "Processing": "processing",
    "Exception": "exception",
    "Cancelled": "cancelled",
}
# Warehouse order status to order status.
ORDER_STATUS = {
    "Processing": "processing",
    "Shipped": "shipped",
    "Complete": "delivered",
    "Cancelled": "cancelled",
    "Exception": "exception",
}


def blank_to_null(text: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def text_or_blank(text: Column) -> Column:
    """Text of a scalar, ``""`` when missing."""
    return F.coalesce(text.cast("string"), F.lit(""))


def bool_text(flag: Column, style: str = "title") -> Column:
    """A boolean (or its text) as ``True`` / ``False``, or ``true`` / ``false`` with ``style="lower"``."""
    lower = F.lower(flag.cast("string"))
    if style == "lower":
        return lower
    if style == "title":
        return F.initcap(lower)
    raise ValueError(f"style must be title or lower, not {style!r}")


def json_text(raw: Column) -> Column:
    """Raw JSON text of a nested field, NULL when missing or an empty object or array."""
    bare = F.regexp_replace(raw, r"\s", "")
    return F.when(~bare.isin("{}", "[]", "null", ""), raw)


def split_tags(text: Column) -> Column:
    """Comma-separated tags as an array of trimmed, non-empty texts; empty array for none."""
    kept = F.filter(F.transform(F.split(text, ","), lambda tag: F.trim(tag)), lambda tag: tag != "")
    return F.coalesce(kept, F.array().cast("array<string>"))


def tags_to_json(tags: Column) -> Column:
    """Tag array as JSON text, NULL when empty."""
    return F.when(F.size(tags) > 0, F.to_json(tags))


def _lookup(names: dict[str, str], key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
    return F.element_at(table, key)


def order_status(order: Column, shipment: Column) -> Column:
    """Status of an order: the shipment's status if known, else the order's own, else ``unknown``."""
    return F.coalesce(_lookup(SHIPMENT_STATUS, shipment), _lookup(ORDER_STATUS, order), F.lit("unknown"))
