"""The feeds: where a feed lands, how its pages look, how records become rows, and which table takes them.

A feed is data. A new one is a new ``Feed``, not new code.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions import parse_date
from waybill.operators.links import between
from waybill.operators.picks import latest_batch
from waybill.operators.reshape import current_inventory_columns
from waybill.operators.rollups import inventory_by_sku
from waybill.schemas import TABLES
from waybill.schemas import payloads as p
from waybill.sources import accounting, fulfilment, marketplace, store
from waybill.sources.landing import SEQ, object_records, pages, read_lines, records_of
from waybill.sources.pulls import PULL, whole_pulls, with_pulls

Normalizer = Callable[[DataFrame, Column], DataFrame]


@dataclass(frozen=True)
class Feed:
    """One feed.

    ``at`` is the path of the record array in an object page; ``"[]"`` means bare arrays only, ``"*"`` bare arrays or an
    ``items`` envelope. ``changed`` is the row column the range of a load applies to, and the newest-wins order.
    ``children`` are feeds over the same records. ``fold`` combines rows of one key where the newest does not replace
    the others. ``more`` are the paths, one of which holds a token in a page that others of the same pull follow. ``lost`` gives ``(reason, value)`` of records that ``rows`` leaves out as unreadable.
    """

    name: str
    folder: str
    record: str
    at: str
    table: str
    rows: Normalizer
    changed: str | None = None
    after: bool = False
    lookback_hours: int = 24
    carry: str | None = None
    children: tuple[Feed, ...] = ()
    fold: Callable[[DataFrame], DataFrame] | None = None
    more: tuple[str, ...] = ()
    lost: Callable[[DataFrame], DataFrame] | None = None

    def pages(self, lines: DataFrame) -> DataFrame:
        """Everything landed lines hold, records and what is none, from one parse (see ``landing.pages``)."""
        if self.more:
            token = F.coalesce(*[F.get_json_object("value", f"$.{path}") for path in self.more])
            lines = lines.withColumn("_more", F.coalesce(token, F.lit("")) != "")
        return pages(lines, self.record, self.at, self.carry)

    def records_of(self, found: DataFrame) -> DataFrame:
        """Records of parsed pages; those of a feed pulled page by page with the number of their pull."""
        return records_of(with_pulls(found) if self.more else found)

    def records(self, lines: DataFrame) -> DataFrame:
        """Records of landed lines."""
        return self.records_of(self.pages(lines))

    def in_range(
        self, rows: DataFrame, start: Column | None, end: Column | None, *, undated: bool = False
    ) -> DataFrame:
        """Rows changed from ``start`` (after it, where the source asks strictly) to ``end``; ``undated`` keeps rows
        whose change time is missing or cannot be read, for the rules to judge."""
        if self.changed is None:
            return rows
        if undated:
            at = F.col(self.changed)
            since = F.lit(True) if start is None else (at > start if self.after else at >= start)
            until = F.lit(True) if end is None else at <= end
            return rows.filter(at.isNull() | (since & until))
        if self.after and start is not None:
            rows, start = rows.filter(F.col(self.changed) > start), None
        return between(rows, self.changed, start, end)


def _plain(rows: Callable[[DataFrame], DataFrame]) -> Normalizer:
    return lambda df, as_of: rows(df)


def _market_inventory(df: DataFrame, as_of: Column) -> DataFrame:
    """Stock of all centers per sku, under the table's column names.

    Of several pulls of the stock, the newest complete one that names a sku counts, over all of its pages (see ``pulls``).
    """
    per_center = marketplace.inventory(df, as_of)
    if SEQ not in per_center.columns:
        raise ValueError("stock summaries need their order of arrival")
    total = inventory_by_sku(
        latest_batch(whole_pulls(per_center), ["sku"], [F.col(PULL)]), ["on_hand", "reserved", "inbound"],
        ["asin", "fnsku", "updated_at"], "fc", SEQ)
    ints = [F.col(c).cast("int").alias(c) for c in ("on_hand", "reserved", "inbound")]
    return current_inventory_columns(total.select("sku", "asin", "fnsku", "fc", "updated_at", *ints))


def _fold_items(rows: DataFrame) -> DataFrame:
    """Lines of one order with one sku: the newest copy of the order counts, its quantities add up, last price wins."""
    newest = rows.groupBy("order_id", "sku", "updated_at_shopify", SEQ).agg(
        F.sum("qty").cast("int").alias("qty"), F.max_by("price", "line").alias("price")
    )
    return newest.groupBy("order_id", "sku").agg(
        F.max(F.struct("updated_at_shopify", SEQ, "qty", "price")).alias("_last")
    ).select("order_id", "sku", "_last.qty", "_last.price")


def _market_orders(df: DataFrame, as_of: Column) -> DataFrame:
    return marketplace.orders(marketplace.wanted_orders(df))


def _accounting(kind: str, folder: str, record: str, at: str, changed: str | None, days: int = 30) -> Feed:
    return Feed(
        f"accounting_{kind}", folder, record, at, accounting.RECORDS[kind].table,
        _plain(partial(accounting.rows, kind)), changed, lookback_hours=24 * days,
    )


_ALL = [
    Feed(
        "store_orders", "store/orders", p.STORE_ORDER, "orders", "shopify_orders", _plain(store.orders),
        "updated_at_shopify",
        children=(Feed(
            "store_order_items", "store/orders", p.STORE_ORDER, "orders", "shopify_order_items",
            _plain(store.order_items), "updated_at_shopify", fold=_fold_items,
        ),),
    ),
    Feed(
        "store_customers", "store/customers", p.STORE_CUSTOMER, "customers", "shopify_customers",
        _plain(store.customers), "updated_at",
    ),
    Feed(
        "store_products", "store/products", p.STORE_PRODUCT, "products", "shopify_products", _plain(store.products),
        children=(Feed(
            "store_variants", "store/products", p.STORE_PRODUCT, "products", "shopify_variants",
            _plain(store.variants),
        ),),
    ),
    Feed(
        "marketplace_orders", "marketplace/orders", p.MARKET_ORDER, "payload.Orders", "orders", _market_orders,
        "last_update_date", after=True,
    ),
    Feed(
        "marketplace_order_items", "marketplace/order_items", p.MARKET_ITEM, "payload.OrderItems", "order_items",
        _plain(marketplace.order_items), carry="AmazonOrderId",
    ),
    Feed(
        "marketplace_inventory", "marketplace/inventory", p.MARKET_INVENTORY, "payload.inventorySummaries",
        "inventory", _market_inventory, lost=marketplace.unreadable_stock,
        more=("payload.nextToken", "pagination.nextToken", "payload.pagination.nextToken"),
    ),
    Feed(
        "warehouse_inventory", "warehouse/inventory", p.WAREHOUSE_INVENTORY, "*", "shipbob_inventory",
        fulfilment.inventory,
    ),
    Feed(
        "warehouse_orders", "warehouse/orders", p.WAREHOUSE_ORDER, "*", "shipbob_orders", _plain(fulfilment.orders),
        "last_updated_date",
    ),
    Feed(
        "warehouse_returns", "warehouse/returns", p.WAREHOUSE_RETURN, "*", "shipbob_returns",
        _plain(fulfilment.returns), "insert_date", lookback_hours=24 * 30,
    ),
    Feed(
        "warehouse_receiving", "warehouse/receiving", p.WAREHOUSE_RECEIVING, "*", "shipbob_receiving_orders",
        _plain(fulfilment.receiving_orders), "insert_date", lookback_hours=24 * 14,
    ),
    Feed(
        "warehouse_products", "warehouse/products", p.WAREHOUSE_PRODUCT, "*", "shipbob_products",
        _plain(fulfilment.products),
    ),
    Feed(
        "warehouse_variants", "warehouse/variants", p.WAREHOUSE_VARIANT, "*", "shipbob_variants",
        _plain(fulfilment.variants),
    ),
    Feed(
        "warehouse_centers", "warehouse/centers", p.WAREHOUSE_CENTER, "[]", "shipbob_fulfillment_centers",
        _plain(fulfilment.centers),
    ),
    _accounting("contacts", "accounting/contacts", p.CONTACT, "contacts", "updated_at_api"),
    _accounting("invoices", "accounting/invoices", p.INVOICE, "invoices", "dated_on", 60),
    _accounting("bills", "accounting/bills", p.BILL, "bills", "dated_on"),
    _accounting("categories", "accounting/categories", p.CATEGORY, "categories", None),
    _accounting("bank_accounts", "accounting/bank_accounts", p.BANK_ACCOUNT, "bank_accounts", None),
    _accounting(
        "bank_transactions", "accounting/bank_transactions", p.BANK_TRANSACTION, "bank_transactions", "dated_on"
    ),
    _accounting(
        "bank_transaction_explanations", "accounting/bank_transaction_explanations", p.EXPLANATION,
        "bank_transaction_explanations", "dated_on",
    ),
    _accounting("transactions", "accounting/transactions", p.LEDGER_TRANSACTION, "transactions", "dated_on"),
    _accounting("users", "accounting/users", p.USER, "users", None),
]

FEEDS: dict[str, Feed] = {f.name: f for f in _ALL}


def read_feed(
    spark: SparkSession,
    feed: Feed,
    landing: str,
    as_of: Column,
    start: Column | None = None,
    end: Column | None = None,
    *,
    only: Mapping[str, str] | None = None,
    limit: int | None = None,
    page_per_file: bool = False,
    enabled: bool = True,
) -> DataFrame:
    """Rows of a feed from its landing folder, in an optional range of its ``changed`` column.

    ``only`` keeps rows with the given column values (one bank account, one nominal code). ``limit`` gives the first
    rows by key.
    """
    lines = read_lines(spark, f"{landing.rstrip('/')}/{feed.folder}", page_per_file=page_per_file, enabled=enabled)
    rows = feed.in_range(feed.rows(feed.records(lines), as_of), start, end)
    for column, value in (only or {}).items():
        rows = rows.filter(F.col(column) == value)
    return rows if limit is None else first_rows(feed, rows, limit)


def first_rows(feed: Feed, rows: DataFrame, limit: int) -> DataFrame:
    """The first rows of a feed by key, then by arrival; every input partition sends so many at most."""
    arrival = [c for c in (SEQ,) if c in rows.columns]
    return rows.orderBy(*TABLES[feed.table].key, *arrival).limit(limit)


def read_changes(
    spark: SparkSession, landing: str, start: Column | None = None, end: Column | None = None, *, enabled: bool = True
) -> DataFrame:
    """The accounting change feed of a range. Nothing is loaded from it; it tells what changed."""
    return changes_of(read_lines(spark, f"{landing.rstrip('/')}/accounting/changes", enabled=enabled), start, end)


def changes_of(lines: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Records of the accounting change feed in a range of their change time."""
    records = object_records(lines, p.CHANGE, "changes")
    stamped = records.withColumns({
        "dated_on": parse_date(F.col("dated_on")),
        "created_at": parse_date(F.col("created_at")),
        "updated_at": parse_date(F.col("updated_at")),
    })
    return between(stamped, "updated_at", start, end)
