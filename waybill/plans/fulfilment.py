"""Returns, centers and receiving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions import percent, whole_days
from waybill.schemas.tables import RECEIVED_ITEMS


def return_rate(returns: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Returned items per product category: ``returns`` and ``return_rate`` (returns * 100 / distinct orders).

    Only returns of known store orders count. A return is tied to a product through its items (by product id): without
    that link every category would be paired with every return.
    """
    items = (
        returns.select("reference_id", F.explode("items").alias("item"))
        .select("reference_id", F.col("item.inventory_id").alias("product_id"))
    )
    known = items.join(orders.select(F.col("order_id").alias("reference_id")), "reference_id", "left_semi")
    return rate_by_category(known, products)


def rate_by_category(returned: DataFrame, products: DataFrame) -> DataFrame:
    """Rate over one row per returned item (``reference_id``, ``product_id``).

    Orders are counted by a second grouping of the per-order counts, so that no set of order ids is ever gathered.
    """
    named = returned.join(products.select("product_id", "category"), "product_id")
    per_order = named.groupBy("category", "reference_id").agg(F.count(F.lit(1)).alias("n"))
    out = per_order.groupBy("category").agg(
        F.sum("n").alias("returns"), F.count("reference_id").alias("orders")
    )
    return out.select("category", "returns", percent(F.col("returns"), F.col("orders")).alias("return_rate"))


def center_days(centers: DataFrame, returns: DataFrame) -> DataFrame:
    """Average whole days from arrival to completion of returns, per center; open returns do not count."""
    days = (
        returns.filter(F.col("completed_date").isNotNull())
        .groupBy(F.col("fulfillment_center_id").alias("center_id"))
        .agg(
            F.sum(whole_days(F.col("insert_date"), F.col("completed_date"))).alias("_days"),
            F.count("insert_date").alias("_n"),
        )
    )
    joined = centers.select("center_id", "name", "state").join(days, "center_id")
    return joined.select(
        "center_id", "name", "state",
        (F.col("_days").cast("double") / F.nullif(F.col("_n").cast("double"), F.lit(0.0))).alias("avg_processing_days"),
    )


def receiving_accuracy(receiving: DataFrame, status: str = "Completed") -> DataFrame:
    """Expected and received units per receiving order of a status, and their ratio in percent (NULL for 0 expected).

    ``inventory_quantities`` may be the typed array or its JSON text.
    """
    quantities = F.col("inventory_quantities")
    if receiving.schema["inventory_quantities"].dataType.simpleString() == "string":
        quantities = F.from_json(quantities, RECEIVED_ITEMS)
    items = receiving.filter(F.col("status") == status).select(
        "wro_id", "purchase_order_number", F.explode(quantities).alias("q")
    )
    sums = items.groupBy("wro_id", "purchase_order_number").agg(
        F.sum("q.expected_quantity").alias("expected_total"), F.sum("q.received_quantity").alias("received_total")
    )
    return sums.withColumn("accuracy_rate", percent(F.col("received_total"), F.col("expected_total")))
