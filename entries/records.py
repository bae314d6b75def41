"""Feeds: Spark writes payload pages from table rows, the feed parses and normalizes them, SQL states the outcome.

Every payload leaves out, misspells or nests some fields on some rows, by a column of the row, so that the defaults and
fallbacks of the normalizers show in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entries.registry import Tables, query, stamp
from waybill.operators.picks import number_repeats
from waybill.operators.rollups import inventory_by_sku, settlement_headers
from waybill.schemas import payloads as p
from waybill.sources import FEEDS, accounting, fulfilment, marketplace, store
from waybill.sources.landing import (
    array_records, broken, envelope_records, object_records, split_report_lines, unreadable,
)

_LOADED = "2024-06-01 00:00:00"


def _as_of() -> Column:
    return F.lit(_LOADED).cast("timestamp")


def _iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _fields(**fields: Column) -> Column:
    return F.struct(*[c.alias(name) for name, c in fields.items()])


def _page(df: DataFrame, payload: Column) -> DataFrame:
    """One page of JSON text per row."""
    return df.select(F.to_json(payload).alias("value"))


def _list_page(df: DataFrame, key: str, **fields: Column) -> DataFrame:
    """Pages ``{"key": [record]}``."""
    return _page(df, _listed(key, **fields))


def _either(df: DataFrame, condition: Column, first: Column, second: Column) -> DataFrame:
    """Pages of two shapes, by a condition on the row."""
    return df.select(F.when(condition, F.to_json(first)).otherwise(F.to_json(second)).alias("value"))


def _listed(key: str, **fields: Column) -> Column:
    """``{"key": [record]}``, the key possibly nested one level."""
    head, _, tail = key.partition(".")
    records = F.array(_fields(**fields))
    return _fields(**{head: _fields(**{tail: records}) if tail else records})


# --- envelopes -----------------------------------------------------------------------------------------------------
@query("json_scan", "SELECT CAST(props->>'k' AS VARCHAR) AS k, count(*) AS n FROM events GROUP BY 1")
def json_scan(t: Tables):
    lines = t.wide("events").select(F.concat(F.lit('{"rows":['), "props", F.lit("]}")).alias("value"))
    return object_records(lines, p.struct("k"), "rows").groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("envelope_union", """
SELECT CAST(props->>'k' AS VARCHAR) AS k, count(*) + count(*) FILTER (WHERE event_type = 'click') AS n
FROM events GROUP BY 1""")
def envelope_union(t: Tables):
    bare = F.concat(F.lit(" ["), "props", F.lit("]"))
    twice = F.concat(F.lit("["), "props", F.lit(","), "props", F.lit("]"))
    wrapped = F.concat(F.lit('{"items":['), "props", F.lit('],"next":"c"}'))
    page = F.when(F.col("event_type") == "view", bare).when(F.col("event_type") == "click", twice).otherwise(wrapped)
    records = envelope_records(t.wide("events").select(page.alias("value")), p.struct("k"))
    return records.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("array_pages", "SELECT CAST(props->>'k' AS VARCHAR) AS k, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1")
def array_pages(t: Tables):
    bare = F.concat(F.lit("["), "props", F.lit("]"))
    page = F.when(F.col("event_type") == "view", bare).otherwise(F.concat(F.lit('{"items":'), bare, F.lit("}")))
    return array_records(t.wide("events").select(page.alias("value")), p.struct("k")).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"))


@query("unreadable_pages", "SELECT count(*) AS n FROM events WHERE event_type = 'error'")
def unreadable_pages(t: Tables):
    page = F.when(F.col("event_type") == "error", F.concat(F.lit('{"k": '), "props")).otherwise(F.col("props"))
    lines = t.wide("events").select(page.alias("value"), F.lit("page").alias("_file"))
    return unreadable(lines).agg(F.count(F.lit(1)).alias("n"))


# --- store ---------------------------------------------------------------------------------------------------------
def _store_order_pages(t: Tables) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    common = {
        "id": F.col("o_orderkey"),
        "name": F.when(priority != "5-LOW", F.concat(F.lit("#"), "o_orderkey")),
        "created_at": F.when(priority == "1-URGENT", F.lit("soon")).otherwise(_iso("o_orderdate")),
        "updated_at": _iso("o_orderdate"),
        "total_price": F.when(priority == "4-NOT SPECIFIED", F.lit("n/a")).otherwise(_text("o_totalprice")),
        "currency": F.when(priority != "2-HIGH", F.lit("EUR")),
        "financial_status": F.when(status == "F", F.lit("paid")).otherwise(F.lit("pending")),
        "fulfillment_status": F.when(status != "O", F.lit("fulfilled")),
        "customer": F.when(status != "P", _fields(id=F.col("o_custkey"))),
        "email": F.when(status == "P", F.lit("")).when(status == "F", F.concat("o_custkey", F.lit("@x.org"))),
        "contact_email": F.lit("contact@x.org"),
        "total_weight": F.when(status == "F", F.lit(0)).otherwise(F.col("o_custkey")),
        "order_number": F.col("o_orderkey"),
        "fulfillments": F.when(status != "P", F.array(
            _fields(tracking_number=F.lit("old"), tracking_company=F.lit("A"), updated_at=_iso("o_orderdate")),
            _fields(tracking_number=_text("o_custkey"), tracking_company=F.lit("B"), updated_at=_iso("o_orderdate")),
            _fields(tracking_number=F.lit(""), tracking_company=F.lit("C"), updated_at=_iso("o_orderdate")),
        )),
        "line_items": F.array(
            _fields(id=F.col("o_orderkey"), sku=F.when(status == "F", F.lit("")).otherwise(F.col("o_orderpriority")),
                    quantity=F.lit(2), price=_text("o_totalprice")),
            _fields(id=F.col("o_custkey"), sku=F.lit(None).cast("string"), quantity=F.lit(None).cast("int"),
                    price=F.lit("x")),
        ),
    }
    text = _listed("orders", **common, tags=F.lit("a, b"))
    listed = _listed("orders", **common, tags=F.array(F.lit("a"), F.col("o_orderpriority")))
    return _either(t.wide("orders"), status == "F", listed, text)


_STORE_ID = "CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_orderkey AS VARCHAR) ELSE '#' || o_orderkey END"


@query("store_orders", f"""
SELECT {_STORE_ID} AS order_id,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderkey AS VARCHAR) END AS shopify_internal_id,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN {stamp('o_orderdate')} END AS purchase_date,
       CASE WHEN o_orderstatus = 'F' THEN 'paid' ELSE 'pending' END AS status,
       CASE WHEN o_orderstatus <> 'O' THEN 'fulfilled' END AS fulfillment_status,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS customer_id,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END
         AS total,
       CASE WHEN o_orderpriority <> '2-HIGH' THEN 'EUR' ELSE '' END AS currency,
       CASE WHEN o_orderstatus = 'F' THEN 'a, ' || o_orderpriority ELSE 'a, b' END AS tags,
       CASE WHEN o_orderstatus = 'F' THEN o_custkey || '@x.org' ELSE 'contact@x.org' END AS email,
       CASE WHEN o_orderstatus <> 'F' THEN nullif(CAST(o_custkey AS INTEGER), 0) END AS total_weight,
       nullif(CAST(o_orderkey AS INTEGER), 0) AS order_number,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS tracking_number,
       CASE WHEN o_orderstatus <> 'P' THEN 'B' END AS carrier,
       CASE WHEN o_orderstatus <> 'P' THEN {stamp('o_orderdate')} END AS tracking_updated_at,
       {stamp('o_orderdate')} AS updated_at_shopify
FROM orders""")
def store_orders(t: Tables):
    records = object_records(_store_order_pages(t), p.STORE_ORDER, "orders")
    return store.orders(records).select(
        "order_id", "shopify_internal_id", "purchase_date", "status", "fulfillment_status", "customer_id", "total",
        "currency", "tags", "email", "total_weight", "order_number", "tracking_number", "carrier",
        "tracking_updated_at", "updated_at_shopify",
    )


@query("child_explode", f"""
SELECT {_STORE_ID} AS order_id,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderpriority END AS sku, 2 AS qty,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price, 0 AS line FROM orders
UNION ALL
SELECT {_STORE_ID}, CAST(o_custkey AS VARCHAR), 1, NULL, 1 FROM orders""")
def child_explode(t: Tables):
    records = object_records(_store_order_pages(t), p.STORE_ORDER, "orders")
    return store.order_items(records).select("order_id", "sku", "qty", "price", "line")


@query("store_customers", f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CASE WHEN c_acctbal < 0 THEN '' ELSE c_name END AS email,
       {stamp("TIMESTAMP '2020-01-02 03:04:05'")} AS created_at,
       CAST(CASE WHEN c_acctbal < 0 THEN 0 ELSE CAST(c_acctbal AS DECIMAL(12,2)) END AS DOUBLE) AS total_spent,
       c_nationkey AS orders_count,
       CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN '["vip"]'
            ELSE '["' || c_mktsegment || '","b"]' END AS tags
FROM customer""")
def store_customers(t: Tables):
    poor, segment = F.col("c_acctbal") < 0, F.col("c_mktsegment")
    common = {
        "id": F.col("c_custkey"), "email": F.when(~poor, F.col("c_name")),
        "created_at": F.lit("2020-01-02T03:04:05Z"), "updated_at": F.lit("2020-01-02"),
        "total_spent": F.when(poor, F.lit("-")).otherwise(_text("c_acctbal")),
        "orders_count": F.col("c_nationkey"),
    }
    listed = _listed("customers", **common, tags=F.array(F.lit("vip")))
    text = _listed("customers", **common, tags=F.when(
        segment != "BUILDING", F.concat("c_mktsegment", F.lit(", b,"))).otherwise(F.lit("")))
    pages = _either(t.customer, segment == "MACHINERY", listed, text)
    records = object_records(pages, p.STORE_CUSTOMER, "customers")
    return store.customers(records).select(
        "customer_id", "email", "created_at", "total_spent", "orders_count", "tags")


@query("tags_as_given", """
SELECT p_partkey, CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN '["' || p_brand || '"]' WHEN p_size = 3 THEN NULL
                       ELSE p_brand || ',x' END AS tags
FROM part""")
def tags_as_given(t: Tables):
    size = F.col("p_size")
    tags = (
        F.when(size == 1, F.lit("[]")).when(size == 2, F.concat(F.lit('["'), "p_brand", F.lit('"]')))
        .when(size == 3, F.lit("")).otherwise(F.concat("p_brand", F.lit(",x")))
    )
    return t.part.select("p_partkey", store.tags_as_given(tags).alias("tags"))


def _variant(**given: Column) -> Column:
    names = ("id", "sku", "price", "weight", "created_at", "inventory_item_id")
    return _fields(**{n: given.get(n, F.lit(None)).cast("string") for n in names})


def _product_pages(t: Tables) -> DataFrame:
    return _list_page(
        t.part, "products", id=F.col("p_partkey"), title=F.col("p_name"), vendor=F.col("p_brand"),
        created_at=F.lit("2021-05-06T07:08:09Z"), updated_at=F.when(F.col("p_size") > 25, F.lit("2022-01-01")),
        variants=F.array(
            _variant(id=F.col("p_partkey") * 10, sku=F.col("p_type"), price=_text("p_retailprice"),
                     weight=F.col("p_size") + F.lit(0.5), created_at=F.lit("2021-05-06")),
            _variant(id=F.col("p_partkey") * 10 + 1, inventory_item_id=F.col("p_size")),
        ),
    )


@query("store_products", f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS title, p_brand AS vendor, '' AS product_type,
       {stamp("TIMESTAMP '2021-05-06 07:08:09'")} AS created_at,
       CASE WHEN p_size > 25 THEN {stamp("TIMESTAMP '2022-01-01 00:00:00'")} END AS updated_at
FROM part""")
def store_products(t: Tables):
    return store.products(object_records(_product_pages(t), p.STORE_PRODUCT, "products")).drop("_seq")


@query("store_variants", f"""
SELECT CAST(p_partkey * 10 AS VARCHAR) AS variant_id, CAST(p_partkey AS VARCHAR) AS product_id, p_type AS sku,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS price, p_size + 0.5::DOUBLE AS weight,
       '' AS inventory_item_id, {stamp("TIMESTAMP '2021-05-06 00:00:00'")} AS created_at FROM part
UNION ALL
SELECT CAST(p_partkey * 10 + 1 AS VARCHAR), CAST(p_partkey AS VARCHAR), '', 0, NULL, CAST(p_size AS VARCHAR), NULL
FROM part""")
def store_variants(t: Tables):
    rows = store.variants(object_records(_product_pages(t), p.STORE_PRODUCT, "products"))
    return rows.drop("_seq", "updated_at")


# --- marketplace ---------------------------------------------------------------------------------------------------
@query("marketplace_orders", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'amazon' AS source, {stamp('o_orderdate')} AS purchase_date,
       CASE o_orderstatus WHEN 'F' THEN 'Shipped' ELSE 'Pending' END AS status,
       CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'c' || o_custkey END AS customer_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 0
            ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS total,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN 'EUR' END AS currency
FROM orders WHERE o_orderstatus <> 'P' AND o_orderdate > TIMESTAMP '1996-01-01 00:00:00'""")
def marketplace_orders(t: Tables):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    pages = _list_page(
        t.wide("orders"), "payload.Orders",
        AmazonOrderId=_text("o_orderkey"), PurchaseDate=_iso("o_orderdate"), LastUpdateDate=_iso("o_orderdate"),
        OrderStatus=F.when(status == "F", "Shipped").when(status == "O", "Pending").otherwise("Draft"),
        BuyerEmail=F.when(priority != "5-LOW", F.concat(F.lit("c"), "o_custkey")),
        OrderTotal=F.when(priority != "1-URGENT", _fields(
            Amount=F.when(priority != "2-HIGH", _text("o_totalprice")), CurrencyCode=F.lit("EUR"))),
    )
    records = object_records(pages, p.MARKET_ORDER, "payload.Orders")
    wanted = marketplace.wanted_orders(records, F.lit("1996-01-01 00:00:00").cast("timestamp"))
    return marketplace.orders(wanted).select(
        "order_id", "source", "purchase_date", "status", "customer_id", "total", "currency")


@query("marketplace_order_items", """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_partkey AS VARCHAR) END
         AS sku, CAST(l_suppkey AS VARCHAR) AS asin,
       CASE WHEN l_returnflag = 'N' THEN 1 ELSE CAST(l_quantity AS INTEGER) END AS qty,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
       CASE WHEN l_linestatus = 'F' THEN NULL ELSE CAST(CAST(l_tax AS DECIMAL(12,2)) AS DOUBLE) END AS tax
FROM lineitem""")
def marketplace_order_items(t: Tables):
    item = _fields(
        ASIN=_text("l_suppkey"), SellerSKU=F.when(F.col("l_linenumber") != 1, _text("l_partkey")),
        QuantityOrdered=F.when(F.col("l_returnflag") != "N", F.col("l_quantity").cast("int")),
        ItemPrice=_fields(Amount=_text("l_extendedprice")),
        ItemTax=F.when(F.col("l_linestatus") != "F", _fields(Amount=_text("l_tax"))),
    )
    pages = _page(t.wide("lineitem"), _fields(payload=_fields(AmazonOrderId=_text("l_orderkey"), OrderItems=F.array(item))))
    records = object_records(pages, p.MARKET_ITEM, "payload.OrderItems", carry="AmazonOrderId")
    return marketplace.order_items(records).select("order_id", "sku", "asin", "qty", "price", "tax")


def _summaries(t: Tables) -> DataFrame:
    """Stock summaries: the reserved quantity comes as object for one line state, as number for the other."""
    flag = F.col("l_returnflag")
    common = {
        "sellerSku": F.when(F.col("l_linenumber") == 7, F.lit("  ")).otherwise(
            F.concat(F.lit(" "), "l_partkey", F.lit(" "))),
        "asin": F.when(flag != "N", _text("l_suppkey")),
        "totalQuantity": F.col("l_linenumber"),
        "fulfillmentCenterDetails": F.when(flag != "R", F.array(_fields(fulfillmentCenterCode=_text("l_suppkey")))),
    }

    def page(reserved: Column) -> Column:
        details = F.when(flag != "A", _fields(
            fulfillableQuantity=F.col("l_quantity").cast("int") - 10, reservedQuantity=reserved,
            inboundWorkingQuantity=F.col("l_linenumber"),
        ))
        return _listed("payload.inventorySummaries", **common, inventoryDetails=details)

    finished = F.col("l_linestatus") == "F"
    return _either(t.wide("lineitem"), finished, page(_fields(totalReservedQuantity=F.lit(3))), page(F.lit(4)))


_STOCK_SQL = """
  SELECT CAST(l_partkey AS VARCHAR) AS sku, CASE WHEN l_returnflag <> 'N' THEN CAST(l_suppkey AS VARCHAR) END AS asin,
         CASE WHEN l_returnflag <> 'R' THEN CAST(l_suppkey AS VARCHAR) END AS fc,
         CASE WHEN l_returnflag = 'A' THEN l_linenumber ELSE greatest(0, CAST(l_quantity AS INTEGER) - 10) END AS on_hand,
         CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_linestatus = 'F' THEN 3 ELSE 4 END AS reserved,
         CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_linenumber END AS inbound
  FROM lineitem WHERE l_linenumber <> 7"""


@query("marketplace_inventory", _STOCK_SQL)
def marketplace_inventory(t: Tables):
    records = object_records(_summaries(t), p.MARKET_INVENTORY, "payload.inventorySummaries")
    return marketplace.inventory(records, _as_of()).select("sku", "asin", "fc", "on_hand", "reserved", "inbound")


@query("marketplace_inventory_by_sku", f"""
SELECT sku, CAST(sum(on_hand) AS BIGINT) AS on_hand, CAST(sum(reserved) AS BIGINT) AS reserved,
       CAST(sum(inbound) AS BIGINT) AS inbound, max(fc) AS fc
FROM ({_STOCK_SQL}) GROUP BY sku""")
def marketplace_inventory_by_sku(t: Tables):
    records = object_records(_summaries(t), p.MARKET_INVENTORY, "payload.inventorySummaries")
    rows = marketplace.inventory(records, _as_of()).withColumn("seq", F.col("fc"))
    return inventory_by_sku(rows, ["on_hand", "reserved", "inbound"], [], "fc", "seq")


def _report_text(t: Tables) -> DataFrame:
    """Report lines as text: one settlement per part, the currency blank and the amount blank on some."""
    cells = [
        F.concat(F.lit(" "), _text("l_partkey")), _iso("l_shipdate"), F.date_format("l_shipdate", "yyyy-MM-dd"),
        F.lit("EUR"), F.when(F.col("l_returnflag") == "R", "Refund").otherwise("Order"),
        F.when(F.col("l_linenumber") == 1, " ").otherwise(_text("l_orderkey")),
        F.when(F.col("l_linestatus") == "F", "Principal").otherwise("Commission"),
        F.when(F.col("l_linenumber") == 2, "").otherwise(_text("l_extendedprice")), _iso("l_shipdate"),
    ]
    return t.wide("lineitem").select(
        F.concat_ws("\t", *cells).alias("value"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice").alias("_seq"),
    )


_LINES_SQL = f"""
  SELECT CAST(l_partkey AS VARCHAR) AS settlement_id,
         CASE WHEN l_linenumber <> 1 THEN CAST(l_orderkey AS VARCHAR) END AS order_id,
         CASE WHEN l_returnflag = 'R' THEN 'Refund' ELSE 'Order' END AS type,
         CASE WHEN l_linenumber = 2 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS amount,
         CASE WHEN l_linestatus = 'F' THEN 'Principal' ELSE 'Commission' END AS fee_type,
         l_shipdate AS posted, date_trunc('day', l_shipdate) AS period_end
  FROM lineitem"""


@query("tsv_lines", f"""
SELECT settlement_id, order_id, type, CAST(amount AS DOUBLE) AS amount, fee_type, {stamp('posted')} AS posted_date,
       {stamp('CAST(period_end AS TIMESTAMP)')} AS period_end FROM ({_LINES_SQL})""")
def tsv_lines(t: Tables):
    lines = marketplace.settlement_lines(split_report_lines(_report_text(t)))
    return lines.select("settlement_id", "order_id", "type", "amount", "fee_type", "posted_date", "period_end")


@query("settlement_header", f"""
SELECT settlement_id, {stamp('min(posted)')} AS period_start, CAST(sum(amount) AS DOUBLE) AS gross,
       CAST(coalesce(sum(amount) FILTER (WHERE type <> 'Refund' AND fee_type <> 'Principal'), 0) AS DOUBLE) AS fees,
       CAST(coalesce(sum(amount) FILTER (WHERE type = 'Refund'), 0) AS DOUBLE) AS refunds,
       CAST(sum(amount) AS DOUBLE) AS net, 'EUR' AS currency, count(*) AS line_count
FROM ({_LINES_SQL}) GROUP BY settlement_id""")
def settlement_header(t: Tables):
    lines = marketplace.settlement_lines(split_report_lines(_report_text(t)))
    return settlement_headers(lines, "_seq").drop("period_end")


@query("settlement_line_numbers", f"""
SELECT settlement_id, type, fee_type, CAST(amount AS DOUBLE) AS amount,
       row_number() OVER (PARTITION BY settlement_id, type, fee_type ORDER BY amount) AS line_number
FROM ({_LINES_SQL})""")
def settlement_line_numbers(t: Tables):
    lines = marketplace.settlement_lines(split_report_lines(_report_text(t)))
    return number_repeats(
        lines.select("settlement_id", "type", "fee_type", "amount", "_seq"), ["settlement_id", "type", "fee_type"],
        spread_by="_seq")


# --- fulfilment warehouse ------------------------------------------------------------------------------------------
def _wrapped(records: Column, is_bare: Column) -> Column:
    """A record as a page of a bare array, or of an ``items`` envelope."""
    listed = F.to_json(F.array(records))
    return F.when(is_bare, listed).otherwise(F.concat(F.lit('{"items":'), listed, F.lit(',"next":null}')))


@query("warehouse_inventory", """
SELECT CAST(l_partkey AS VARCHAR) AS sku, CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_returnflag = 'A' THEN 0
         ELSE CAST(l_quantity AS INTEGER) END AS quantity_on_hand, l_linenumber AS quantity_available,
       CAST(l_suppkey AS INTEGER) AS quantity_reserved
FROM lineitem WHERE l_linenumber <> 1""")
def warehouse_inventory(t: Tables):
    record = _fields(
        sku=F.when(F.col("l_linenumber") != 1, _text("l_partkey")),
        total_on_hand_quantity=F.when(F.col("l_returnflag") == "A", "many").when(
            F.col("l_returnflag") == "N", _text("l_quantity")),
        total_sellable_quantity=F.col("l_linenumber"), total_committed_quantity=F.col("l_suppkey"),
    )
    pages = t.wide("lineitem").select(_wrapped(record, F.col("l_linestatus") == "F").alias("value"))
    rows = fulfilment.inventory(envelope_records(pages, p.WAREHOUSE_INVENTORY), _as_of())
    return rows.select("sku", "quantity_on_hand", "quantity_available", "quantity_reserved")


@query("warehouse_inventory_by_center", """
SELECT CAST(l_partkey AS VARCHAR) AS sku, CAST(l_suppkey AS VARCHAR) AS fulfillment_center_id,
       CAST(l_quantity AS INTEGER) AS quantity_on_hand, 0 AS quantity_available FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL
SELECT CAST(l_partkey AS VARCHAR), 'second', l_linenumber, l_linenumber FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL
SELECT CAST(l_partkey AS VARCHAR), NULL, 99, 0 FROM lineitem WHERE l_returnflag = 'R'""")
def warehouse_inventory_by_center(t: Tables):
    places = F.array(
        _fields(fulfillment_center=_fields(id=_text("l_suppkey")), quantity_on_hand=F.col("l_quantity").cast("int"),
                quantity_available=F.lit(None).cast("int")),
        _fields(fulfillment_center=_fields(id=F.lit("second")), quantity_on_hand=F.col("l_linenumber"),
                quantity_available=F.col("l_linenumber")),
    )
    record = _fields(
        inventory=_fields(name=_text("l_partkey")), total_on_hand_quantity=F.lit(99),
        fulfillment_center_locations=F.when(F.col("l_returnflag") != "R", places),
    )
    pages = t.wide("lineitem").select(_wrapped(record, F.col("l_linestatus") == "F").alias("value"))
    rows = fulfilment.inventory_by_center(envelope_records(pages, p.WAREHOUSE_INVENTORY))
    return rows.select("sku", "fulfillment_center_id", "quantity_on_hand", "quantity_available")


def _warehouse_orders(t: Tables) -> DataFrame:
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")

    def shipment(status: Column, number: Column) -> Column:
        return _fields(
            status=status, tracking=_fields(
                tracking_number=number, carrier=F.lit("USPS"), carrier_name=F.lit("Postal")),
            location=_fields(id=F.col("l_suppkey")), shipped_date=_iso("l_shipdate"),
        )

    record = _fields(
        id=F.when(line != 7, F.col("l_orderkey")),
        reference_id=F.when(line != 1, F.concat(F.lit("ref"), "l_orderkey")),
        status=F.when(F.col("l_linestatus") == "F", "Complete").otherwise("Processing"),
        created_date=_iso("l_shipdate"), last_updated_date=F.when(flag == "R", _iso("l_shipdate")),
        shipments=F.when(flag != "N", F.array(
            shipment(F.lit("Shipped"), _text("l_partkey")),
            shipment(F.when(flag == "A", "Lost").otherwise("Exception"),
                     F.when(flag == "R", _text("l_suppkey")).otherwise(F.lit(""))),
        )),
        financials=_fields(total_price=F.col("l_extendedprice")),
        recipient=_fields(name=F.lit("N")),
    )
    return envelope_records(
        t.wide("lineitem").select(_wrapped(record, F.col("l_quantity") > 25).alias("value")), p.WAREHOUSE_ORDER)


@query("warehouse_order_status", f"""
SELECT 'ref' || l_orderkey AS order_id,
       CASE WHEN l_returnflag = 'R' THEN 'exception' WHEN l_linestatus = 'F' THEN 'delivered' ELSE 'processing' END
         AS status,
       CASE WHEN l_returnflag = 'R' THEN CAST(l_suppkey AS VARCHAR) END AS tracking_number,
       CASE WHEN l_returnflag = 'R' THEN 'USPS' END AS carrier, {stamp('l_shipdate')} AS updated_at,
       CASE l_returnflag WHEN 'R' THEN 'Exception' WHEN 'A' THEN 'Lost' END AS shipment_status
FROM lineitem WHERE l_linenumber <> 1 AND l_shipdate >= TIMESTAMP '1997-06-01 00:00:00'""")
def warehouse_order_status(t: Tables):
    since = F.lit("1997-06-01 00:00:00").cast("timestamp")
    return fulfilment.order_statuses(_warehouse_orders(t), since).select(
        "order_id", "status", "tracking.tracking_number", "tracking.carrier", "updated_at", "shipment_status")


@query("warehouse_orders", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS shipbob_order_id,
       CASE WHEN l_linenumber = 1 THEN '' ELSE 'ref' || l_orderkey END AS reference_id,
       CASE WHEN l_returnflag <> 'N' THEN {stamp('l_shipdate')} END AS shipped_date,
       CASE WHEN l_returnflag <> 'N' THEN CAST(l_partkey AS VARCHAR) ELSE '' END AS tracking_number,
       CASE WHEN l_returnflag <> 'N' THEN 'Postal' ELSE '' END AS carrier,
       CASE WHEN l_returnflag <> 'N' THEN CAST(l_suppkey AS VARCHAR) ELSE '' END AS fulfillment_center_id,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS total_cost, 'USD' AS currency, 'N' AS recipient_name
FROM lineitem WHERE l_linenumber <> 7""")
def warehouse_orders(t: Tables):
    return fulfilment.orders(_warehouse_orders(t)).select(
        "shipbob_order_id", "reference_id", "shipped_date", "tracking_number", "carrier", "fulfillment_center_id",
        "total_cost", "currency", "recipient_name")


@query("warehouse_returns", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS return_id, CAST(l_suppkey AS VARCHAR) AS fulfillment_center_id,
       CAST(CASE WHEN l_returnflag = 'N' THEN 0
            ELSE CAST(l_extendedprice AS DECIMAL(12,2)) + CAST(2.5 AS DECIMAL(12,2)) END AS DOUBLE) AS total_cost,
       {stamp('l_shipdate')} AS insert_date, CAST(l_partkey AS VARCHAR) AS inventory_id,
       CAST(l_quantity AS INTEGER) AS quantity, CASE WHEN l_linestatus = 'F' THEN 'Restock' ELSE '' END AS action
FROM lineitem""")
def warehouse_returns(t: Tables):
    record = _fields(
        id=F.col("l_orderkey"), insert_date=_iso("l_shipdate"),
        fulfillment_center=_fields(id=F.col("l_suppkey")),
        inventory=F.array(_fields(
            id=F.col("l_partkey"), quantity=F.col("l_quantity"),
            action_requested=F.when(F.col("l_linestatus") == "F", _fields(action=F.lit("Restock"))))),
        transactions=F.when(F.col("l_returnflag") != "N", F.array(
            _fields(amount=F.col("l_extendedprice")), _fields(amount=F.lit(2.5)))),
    )
    pages = t.wide("lineitem").select(_wrapped(record, F.col("l_quantity") > 25).alias("value"))
    rows = fulfilment.returns(envelope_records(pages, p.WAREHOUSE_RETURN))
    return rows.select(
        "return_id", "fulfillment_center_id", "total_cost", "insert_date", F.explode("items").alias("i")
    ).select(
        "return_id", "fulfillment_center_id", "total_cost", "insert_date", "i.inventory_id", "i.quantity",
        F.col("i.action_requested").alias("action"))


@query("warehouse_receiving", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS wro_id, CASE WHEN l_returnflag = 'N' THEN '' ELSE 'PO' || l_partkey END
         AS purchase_order_number, {stamp('l_shipdate')} AS expected_arrival_date,
       CAST(l_quantity AS INTEGER) AS expected_quantity,
       CASE WHEN l_linestatus = 'F' THEN l_linenumber ELSE 0 END AS received_quantity
FROM lineitem""")
def warehouse_receiving(t: Tables):
    record = _fields(
        id=F.col("l_orderkey"), purchase_order_number=F.when(
            F.col("l_returnflag") != "N", F.concat(F.lit("PO"), "l_partkey")),
        expected_arrival_date=_iso("l_shipdate"),
        inventory_quantities=F.array(_fields(
            expected_quantity=F.col("l_quantity"),
            received_quantity=F.when(F.col("l_linestatus") == "F", F.col("l_linenumber")))),
    )
    pages = t.wide("lineitem").select(_wrapped(record, F.col("l_quantity") > 25).alias("value"))
    rows = fulfilment.receiving_orders(envelope_records(pages, p.WAREHOUSE_RECEIVING))
    return rows.select(
        "wro_id", "purchase_order_number", "expected_arrival_date", F.explode("inventory_quantities").alias("q")
    ).select("wro_id", "purchase_order_number", "expected_arrival_date", "q.expected_quantity", "q.received_quantity")


@query("warehouse_products", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category,
       CASE WHEN p_size > 25 THEN 'True' ELSE 'False' END AS is_case, 'False' AS is_lot,
       CASE WHEN p_size > 10 THEN 'False' ELSE 'True' END AS is_active,
       CASE WHEN p_size > 10 AND p_size > 40 THEN 'True' ELSE 'False' END AS is_hazmat,
       CASE WHEN p_size > 25 THEN '{"length":' || p_size || '}' ELSE '{}' END AS dimensions
FROM part""")
def warehouse_products(t: Tables):
    size = F.col("p_size")
    record = _fields(
        id=F.col("p_partkey"), name=F.col("p_name"), category=F.col("p_type"),
        is_case=F.when(size > 25, F.lit(True)),
        variant=F.when(size > 10, _fields(is_active=F.lit(False), hazmat=_fields(is_hazmat=size > 40))),
        dimensions=F.when(size > 25, _fields(length=size)),
    )
    pages = t.part.select(_wrapped(record, size > 30).alias("value"))
    rows = fulfilment.products(envelope_records(pages, p.WAREHOUSE_PRODUCT))
    return rows.select(
        "product_id", "name", "category", "is_case", "is_lot", "is_active", "is_hazmat", "dimensions")


@query("warehouse_variants", """
SELECT CAST(p_partkey * 10 AS VARCHAR) AS variant_id, CAST(p_partkey AS VARCHAR) AS product_id, p_brand AS sku,
       CASE WHEN p_size > 25 THEN 'False' ELSE 'True' END AS is_active, '{"amount":' || p_size || '}' AS value
FROM part""")
def warehouse_variants(t: Tables):
    record = _fields(
        id=F.col("p_partkey") * 10, product_id=F.col("p_partkey"), sku=F.col("p_brand"),
        is_active=F.when(F.col("p_size") > 25, F.lit(False)), value=_fields(amount=F.col("p_size")),
    )
    pages = t.part.select(_wrapped(record, F.col("p_size") > 30).alias("value"))
    rows = fulfilment.variants(envelope_records(pages, p.WAREHOUSE_VARIANT))
    return rows.select("variant_id", "product_id", "sku", "is_active", "value")


@query("warehouse_centers", """
SELECT CAST(s_suppkey AS VARCHAR) AS center_id, 'shipbob' AS source, s_name AS name,
       CAST(s_nationkey AS VARCHAR) AS country, '' AS city
FROM supplier""")
def warehouse_centers(t: Tables):
    record = _fields(id=F.col("s_suppkey"), name=F.col("s_name"), country=F.col("s_nationkey"))
    pages = t.supplier.select(F.to_json(F.array(record)).alias("value"))
    return fulfilment.centers(array_records(pages, p.WAREHOUSE_CENTER)).select(
        "center_id", "source", "name", "country", "city")


# --- accounting ----------------------------------------------------------------------------------------------------
def _url(kind: str, key: str) -> Column:
    return F.concat(F.lit(f"https://api.example.com/v2/{kind}/"), key)


def _accounting(kind: str, record: str, pages: DataFrame) -> DataFrame:
    return accounting.rows(kind, object_records(pages, record, kind))


@query("accounting_contacts", f"""
SELECT CAST(c_custkey AS VARCHAR) AS contact_id, c_name AS organisation_name, c_nationkey AS
         default_payment_terms_in_days, CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS DOUBLE) AS account_balance,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 'True' ELSE 'False' END AS
         uses_contact_invoice_sequence,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE {stamp("TIMESTAMP '2024-01-15 10:30:00'")} END AS
         updated_at_api
FROM customer WHERE c_mktsegment <> 'FURNITURE'""")
def accounting_contacts(t: Tables):
    segment = F.col("c_mktsegment")
    pages = _list_page(
        t.customer, "contacts",
        url=F.when(segment != "FURNITURE", _url("contacts", "c_custkey")).otherwise(F.lit("https://api.example.com")),
        organisation_name=F.col("c_name"), default_payment_terms_in_days=F.col("c_nationkey"),
        account_balance=_text("c_acctbal"),
        uses_contact_invoice_sequence=F.when(F.col("c_acctbal") >= 0, segment == "BUILDING"),
        updated_at=F.when(segment == "MACHINERY", "2024-13-99T99:99:99Z").otherwise("2024-01-15T10:30:00Z"),
    )
    return _accounting("contacts", p.CONTACT, pages).select(
        "contact_id", "organisation_name", "default_payment_terms_in_days", "account_balance",
        "uses_contact_invoice_sequence", "updated_at_api")


def _invoice_pages(t: Tables) -> DataFrame:
    low = F.col("o_orderpriority") == "5-LOW"
    return _list_page(
        t.wide("orders"), "invoices",
        url=_url("invoices", "o_orderkey"), contact=_url("contacts", "o_custkey"),
        project=F.when(low, _url("projects", "o_custkey")),
        dated_on=F.date_format("o_orderdate", "yyyy-MM-dd"),
        due_on=F.date_format(F.date_add("o_orderdate", 30), "yyyy-MM-dd"),
        total_value=_text("o_totalprice"), due_value=F.when(low, F.lit("")).otherwise(_text("o_totalprice")),
        exchange_rate=F.lit("1.25"), initial_sales_tax_rate=F.lit("20.0"),
        status=F.when(F.col("o_orderstatus") == "F", "Paid").otherwise("Sent"),
        outside_of_sales_tax_scope=F.when(~low, F.lit(False)),
    )


@query("accounting_invoices", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS invoice_id, CAST(o_custkey AS VARCHAR) AS contact_id,
       CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_custkey AS VARCHAR) END AS project_id,
       {stamp('o_orderdate')} AS dated_on, {stamp('o_orderdate + INTERVAL 30 DAY')} AS due_on,
       CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) AS total_value,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) END AS due_value,
       1.25::DOUBLE AS exchange_rate, 20::DOUBLE AS initial_sales_tax_rate,
       CASE WHEN o_orderpriority <> '5-LOW' THEN 'False' END AS outside_of_sales_tax_scope
FROM orders""")
def accounting_invoices(t: Tables):
    return _accounting("invoices", p.INVOICE, _invoice_pages(t)).select(
        "invoice_id", "contact_id", "project_id", "dated_on", "due_on", "total_value", "due_value", "exchange_rate",
        "initial_sales_tax_rate", "outside_of_sales_tax_scope")


@query("accounting_bills", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS bill_id, CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_custkey AS VARCHAR)
         END AS contact_id, {stamp('o_orderdate')} AS dated_on, o_orderpriority AS status,
       CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) AS net_value
FROM orders""")
def accounting_bills(t: Tables):
    pages = _list_page(
        t.wide("orders"), "bills", url=_url("bills", "o_orderkey"),
        contact=F.when(F.col("o_orderstatus") != "P", _url("contacts", "o_custkey")),
        dated_on=_iso("o_orderdate"), status=F.col("o_orderpriority"), net_value=F.col("o_totalprice"),
    )
    return _accounting("bills", p.BILL, pages).select("bill_id", "contact_id", "dated_on", "status", "net_value")


@query("accounting_categories", """
SELECT CAST(p_partkey AS VARCHAR) AS category_id, p_brand AS description, p_type AS nominal_code,
       CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) END AS parent_category_id,
       CASE WHEN p_size > 10 THEN CASE WHEN p_size > 40 THEN 'True' ELSE 'False' END END AS is_visible,
       CAST(p_size AS DOUBLE) AS auto_sales_tax_rate
FROM part""")
def accounting_categories(t: Tables):
    size = F.col("p_size")
    pages = _list_page(
        t.part, "categories", url=_url("categories", "p_partkey"), description=F.col("p_brand"),
        nominal_code=F.col("p_type"), parent_category=F.when(size > 25, _url("categories", "p_size")),
        is_visible=F.when(size > 10, size > 40), auto_sales_tax_rate=_text("p_size"),
    )
    return _accounting("categories", p.CATEGORY, pages).select(
        "category_id", "description", "nominal_code", "parent_category_id", "is_visible", "auto_sales_tax_rate")


@query("accounting_bank_accounts", f"""
SELECT CAST(s_suppkey AS VARCHAR) AS bank_account_id, s_name AS name,
       CAST(CAST(s_acctbal AS DECIMAL(15,2)) AS DOUBLE) AS current_balance,
       CASE WHEN s_nationkey = 0 THEN NULL WHEN s_nationkey < 10 THEN 'True' ELSE 'False' END AS is_primary,
       {stamp("TIMESTAMP '2019-04-01 00:00:00'")} AS opening_balance_date
FROM supplier""")
def accounting_bank_accounts(t: Tables):
    nation = F.col("s_nationkey")
    pages = _list_page(
        t.supplier, "bank_accounts", url=_url("bank_accounts", "s_suppkey"), name=F.col("s_name"),
        current_balance=_text("s_acctbal"), is_primary=F.when(nation != 0, nation < 10),
        opening_balance_date=F.lit("2019-04-01"),
    )
    return _accounting("bank_accounts", p.BANK_ACCOUNT, pages).select(
        "bank_account_id", "name", "current_balance", "is_primary", "opening_balance_date")


@query("accounting_bank_transactions", f"""
SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS bank_account_id,
       {stamp("CAST(date_trunc('day', ts) AS TIMESTAMP)")} AS dated_on,
       CAST(CASE WHEN event_type = 'error' THEN NULL ELSE CAST(value AS DECIMAL(15,2)) END AS DOUBLE) AS amount,
       CASE WHEN event_type = 'view' THEN 'True' END AS is_manual
FROM events""")
def accounting_bank_transactions(t: Tables):
    kind = F.col("event_type")
    pages = _list_page(
        t.wide("events"), "bank_transactions", url=_url("bank_transactions", "event_id"),
        bank_account=_url("bank_accounts", "user_id"), dated_on=F.date_format("ts", "yyyy-MM-dd"),
        amount=F.when(kind == "error", F.lit("?")).otherwise(_text("value")),
        is_manual=F.when(kind == "view", F.lit(True)),
    )
    return _accounting("bank_transactions", p.BANK_TRANSACTION, pages).select(
        "transaction_id", "bank_account_id", "dated_on", "amount", "is_manual")


@query("accounting_explanations", f"""
SELECT CAST(event_id AS VARCHAR) AS explanation_id, CAST(user_id AS VARCHAR) AS bank_transaction_id,
       CASE WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR) END AS category_id,
       CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) END AS invoice_id,
       CASE WHEN event_type = 'error' THEN CAST(user_id AS VARCHAR) END AS bill_id,
       CAST(CAST(value AS DECIMAL(15,2)) AS DOUBLE) AS gross_value, {stamp('ts')} AS created_at_api
FROM events""")
def accounting_explanations(t: Tables):
    kind = F.col("event_type")
    pages = _list_page(
        t.wide("events"), "bank_transaction_explanations", url=_url("bank_transaction_explanations", "event_id"),
        bank_transaction=_url("bank_transactions", "user_id"),
        category=F.when(kind == "view", _url("categories", "user_id")),
        invoice=F.when(kind == "click", _url("invoices", "user_id")),
        bill=F.when(kind == "error", _url("bills", "user_id")),
        gross_value=_text("value"), created_at=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS+00:00"),
    )
    return _accounting("bank_transaction_explanations", p.EXPLANATION, pages).select(
        "explanation_id", "bank_transaction_id", "category_id", "invoice_id", "bill_id", "gross_value",
        "created_at_api")


@query("accounting_transactions", """
SELECT CAST(event_id AS VARCHAR) AS transaction_id, event_type AS nominal_code,
       CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'error' THEN '{"k":' || CAST(props->>'k' AS VARCHAR)
            || '}' ELSE NULL END AS foreign_currency_data,
       CAST(CAST(value AS DECIMAL(15,2)) AS DOUBLE) AS debit_value
FROM events""")
def accounting_transactions(t: Tables):
    kind = F.col("event_type")
    inner = F.from_json("props", "k int")
    pages = _list_page(
        t.wide("events"), "transactions", url=_url("transactions", "event_id"), nominal_code=kind, debit_value=_text("value"),
        foreign_currency_data=F.when(kind == "error", inner).when(kind == "view", F.from_json(F.lit("{}"), "k int")),
    )
    return _accounting("transactions", p.LEDGER_TRANSACTION, pages).select(
        "transaction_id", "nominal_code", "foreign_currency_data", "debit_value")


@query("accounting_users", """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS email, c_nationkey AS permission_level,
       CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS DOUBLE) AS opening_mileage
FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal >= 0""")
def accounting_users(t: Tables):
    pages = _list_page(
        t.customer, "users", url=_url("users", "c_custkey"), email=F.col("c_name"),
        permission_level=F.col("c_nationkey"), opening_mileage=F.col("c_acctbal"),
        role=F.when(F.col("c_mktsegment") == "BUILDING", "Director").otherwise("Accountant"),
        hidden=F.col("c_acctbal") < 0,
    )
    staff = accounting.users_in_view(object_records(pages, p.USER, "users"), "active_staff")
    return accounting.rows("users", staff).select("user_id", "email", "permission_level", "opening_mileage")


# --- pages with broken records ------------------------------------------------------------------------------------
def _broken_pages(t: Tables) -> DataFrame:
    """Pages of two records; a text among them on every third row, and every seventh page cut short."""
    key, nation = _text("c_custkey"), _text("c_nationkey")
    odd = F.when(F.col("c_custkey") % 3 == 0, F.lit(',"x"')).otherwise(F.lit(""))
    page = F.concat(F.lit('{"rows":[{"k":"'), key, F.lit('"}'), odd, F.lit(',{"k":"n'), nation, F.lit('"}]}'))
    return t.customer.select(F.when(F.col("c_custkey") % 7 == 0, F.substring(page, 1, 20)).otherwise(page).alias("value"),
                             F.lit("landed").alias("_file"))


@query("page_with_bad_element", """
SELECT k, count(*) AS n FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS k FROM customer WHERE c_custkey % 7 <> 0
  UNION ALL SELECT 'n' || c_nationkey FROM customer WHERE c_custkey % 7 <> 0) GROUP BY k""")
def page_with_bad_element(t: Tables):
    return object_records(_broken_pages(t), p.struct("k"), "rows").groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("unreadable_to_quarantine", """
SELECT CASE WHEN c_custkey % 7 = 0 THEN 'unreadable page' ELSE 'record is no object' END AS reason, count(*) AS n
FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 3 = 0 GROUP BY 1""")
def unreadable_to_quarantine(t: Tables):
    return broken(_broken_pages(t), "rows").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("range_keeps_undated", """
SELECT count(*) AS kept, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS undated FROM orders
WHERE o_orderkey % 5 = 0 OR (o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1997-06-30')""")
def range_keeps_undated(t: Tables):
    rows = t.orders.select(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate").cast("timestamp")).alias("updated_at"))
    kept = FEEDS["store_customers"].in_range(
        rows, F.lit("1996-01-01").cast("timestamp"), F.lit("1997-06-30").cast("timestamp"), undated=True)
    return kept.agg(F.count(F.lit(1)).alias("kept"), F.count(F.when(F.col("updated_at").isNull(), 1)).alias("undated"))
