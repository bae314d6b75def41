from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests import payloads as p
from waybill.sources import FEEDS, read_feed
from waybill.sources.feeds import read_changes
from waybill.sources.landing import read_lines, read_report, unreadable
from waybill.sources import accounting, fulfilment, marketplace, store
from waybill.schemas import TABLES, payloads


def rows(spark, feed, root, **how):
    df = read_feed(spark, FEEDS[feed], root, F.lit("2024-03-31 12:00:00").cast("timestamp"), **how)
    return [r.asDict(recursive=True) for r in df.collect()]


def child_rows(spark, feed, root):
    f = FEEDS[feed]
    child = f.children[0]
    df = child.rows(f.records(read_lines(spark, f"{root}/{f.folder}")), F.lit(None).cast("timestamp"))
    return [r.asDict(recursive=True) for r in df.collect()]


def by(rows_, key):
    return {r[key]: r for r in rows_}


def test_store_orders(spark, landing):
    root = landing("store/orders", p.STORE_ORDERS)
    orders = by(rows(spark, "store_orders", root), "order_id")
    assert set(orders) == {"#A-17", "#A-18"}
    first, second = orders["#A-17"], orders["#A-18"]
    assert first["shopify_internal_id"] == "880010017" and first["total"] == Decimal("64.20")
    assert first["customer_id"] == "70071" and first["tags"] == "new, gift"
    assert (first["tracking_number"], first["carrier"]) == ("T1", "UPS")
    assert first["billing_address"] == '{"city":"Leeds","zip":"LS1"}'
    assert second["fulfillment_status"] is None and second["customer_id"] == "" and second["tags"] == "a, b"
    items = child_rows(spark, "store_orders", root)
    assert sorted((i["order_id"], i["sku"], i["qty"], str(i["price"])) for i in items) == [
        ("#A-17", "MUG-BLUE", 2, "32.10"), ("#A-18", "77", 1, "18.75")]


def test_range_and_history(spark, landing):
    root = landing("store/orders", p.STORE_ORDERS, p.STORE_ORDERS)
    assert len(rows(spark, "store_orders", root)) == 4
    late = rows(spark, "store_orders", root, start=F.lit("2024-02-02 00:00:00").cast("timestamp"))
    assert {r["order_id"] for r in late} == {"#A-18"}


def test_store_customers(spark, landing):
    root = landing("store/customers", p.STORE_CUSTOMERS)
    found = by(rows(spark, "store_customers", root), "customer_id")
    assert found["1"]["tags"] == '["wholesale","net30"]' and found["2"]["tags"] is None
    assert found["2"]["total_spent"] == Decimal("0.00") and found["2"]["email"] == ""


def test_store_products(spark, landing):
    root = landing("store/products", p.STORE_PRODUCTS)
    assert len(rows(spark, "store_products", root)) == 2
    variants = by(child_rows(spark, "store_products", root), "variant_id")
    assert set(variants) == {"101", "102", "201"} and variants["101"]["weight"] == Decimal("0.250")


def test_marketplace(spark, landing):
    root = landing("marketplace/orders", p.MARKET_ORDERS)
    landing("marketplace/order_items", p.MARKET_ITEMS)
    orders = by(rows(spark, "marketplace_orders", root), "order_id")
    assert set(orders) == {"M-501", "M-502"}
    assert orders["M-502"]["customer_id"] == "" and orders["M-502"]["total"] is None
    strict = rows(spark, "marketplace_orders", root, start=F.lit("2024-02-02 00:00:00").cast("timestamp"))
    assert {r["order_id"] for r in strict} == {"M-502"}  # strictly after
    (item,) = rows(spark, "marketplace_order_items", root)
    assert (item["order_id"], item["sku"], item["qty"], str(item["price"]), str(item["tax"])) == (
        "M-501", "SKU-1", 2, "60.20", "9.63") and item["fee_estimate"] is None


def test_marketplace_inventory(spark, landing):
    root = landing(
        "marketplace/inventory",
        p.stock_page(p.stock("LAMP-S", 31, 4, 6, "HUB1"), p.stock("  ", 1, 1, 1, "X"),
                     p.stock("LAMP-L", -6, {"totalReservedQuantity": 9}, 13, "HUB1")),
        p.stock_page(p.stock("LAMP-S", 11, "2", 1, "HUB2"), p.stock("BAD", "many", 0, 0, "X")))
    found = by(rows(spark, "marketplace_inventory", root), "sku")
    assert set(found) == {"LAMP-S", "LAMP-L"}
    one = found["LAMP-S"]
    assert (one["quantity_on_hand"], one["quantity_reserved"], one["quantity_incoming"]) == (42, 6, 7)
    assert one["fulfillment_center"] == "HUB2" and one["source"] == "amazon"
    assert (found["LAMP-L"]["quantity_on_hand"], found["LAMP-L"]["quantity_reserved"]) == (0, 9)


def test_stock_quantities_are_parsed_once(spark):
    detail = "inventoryDetails struct<fulfillableQuantity: string, reservedQuantity: string, inboundWorkingQuantity: string>"
    df = spark.createDataFrame(
        [("a", "5", None), ("b", "x", None), ("c", "5", ("-3", '{"totalReservedQuantity": 7}', None)), ("d", "5", ("1", "many", "2")),
         ("e", None, ("99999999999", "1", "1")), (" ", "1", None)],
        f"sellerSku string, totalQuantity string, {detail}")
    none = {"asin": "string", "fnSku": "string", "fulfillmentCenterDetails": "array<struct<fulfillmentCenterCode: string>>"}
    df = df.withColumns({c: F.lit(None).cast(kind) for c, kind in none.items()})
    stock = marketplace.inventory(df, F.lit(None).cast("timestamp"))
    assert sorted((r["sku"], r["on_hand"], r["reserved"], r["inbound"]) for r in stock.collect()) == [("a", 5, 0, 0), ("c", 0, 7, 0)]
    assert sorted(r["reason"] for r in marketplace.unreadable_stock(df).collect()) == [
        "invalid on_hand", "invalid on_hand", "invalid reserved"]
    plan = stock._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object(") == 1


def test_settlement_report(spark, landing):
    root = landing("marketplace/settlements", name="r1.tsv", text=p.report(p.SETTLEMENT_ROWS))
    lines = marketplace.settlement_lines(read_report(spark, f"{root}/marketplace/settlements")).collect()
    assert len(lines) == 5 and {x["order_id"] for x in lines if x["fee_type"] == "Storage"} == {None}
    assert sum(x["amount"] for x in lines) == Decimal("59.99")


def test_report_headers_must_agree(spark, landing):
    root = landing("marketplace/settlements", name="a.tsv", text=p.report(p.SETTLEMENT_ROWS))
    other = p.report(p.SETTLEMENT_ROWS).replace("settlement-id\tsettlement-start-date", "settlement-start-date\tsettlement-id")
    landing("marketplace/settlements", name="b.tsv", text=other)
    with pytest.raises(Exception, match="(?i)header"):
        read_report(spark, f"{root}/marketplace/settlements").collect()


@pytest.mark.parametrize("wrap", [lambda x: x, lambda x: {"items": x, "next": "c"}])
def test_warehouse_inventory(spark, landing, wrap):
    root = landing("warehouse/inventory", wrap(p.WAREHOUSE_INVENTORY))
    found = by(rows(spark, "warehouse_inventory", root), "sku")
    assert set(found) == {"TENT-2P", "TENT-4P"}
    first, second = found["TENT-2P"], found["TENT-4P"]
    assert (first["quantity_on_hand"], first["quantity_available"], first["quantity_reserved"]) == (61, 70, None)
    assert [second[c] for c in fulfilment.STOCK] == [36, 33, 3, 0, 31, 7, 4, 0]


def test_page_per_file(spark, landing):
    import json
    root = landing("warehouse/inventory", text=json.dumps(p.WAREHOUSE_INVENTORY, indent=2))
    assert len(rows(spark, "warehouse_inventory", root, page_per_file=True)) == 2


def test_inventory_by_center(spark, landing):
    page = [{"inventory": {"id": 5, "name": "S1"}, "fulfillment_center_locations": [
        {"fulfillment_center": {"id": 1, "name": "IL"}, "quantity_on_hand": 3},
        {"fulfillment_center": {"id": 2, "name": "NV"}, "quantity_on_hand": 4, "quantity_committed": 1}]},
        {"inventory": {"id": 6, "name": "S2"}, "total_on_hand_quantity": 9}]
    root = landing("warehouse/inventory", page)
    feed = FEEDS["warehouse_inventory"]
    df = fulfilment.inventory_by_center(feed.records(read_lines(spark, f"{root}/warehouse/inventory")))
    got = sorted((r["sku"], r["fulfillment_center_id"], r["quantity_on_hand"], r["quantity_reserved"])
                 for r in df.collect())
    assert got == [("S1", "1", 3, 0), ("S1", "2", 4, 1), ("S2", None, 9, 0)]


def test_order_statuses(spark, landing):
    root = landing("warehouse/orders", p.WAREHOUSE_ORDERS)
    feed = FEEDS["warehouse_orders"]
    records = feed.records(read_lines(spark, f"{root}/warehouse/orders"))
    found = by([r.asDict(recursive=True) for r in fulfilment.order_statuses(
        records, F.lit("2023-01-02 00:00:00").cast("timestamp")).collect()], "order_id")
    assert set(found) == {"#A-17", "web-552"}
    assert found["#A-17"]["status"] == "shipped"
    assert found["#A-17"]["tracking"]["tracking_number"] == "RX77-40"
    assert found["#A-17"]["tracking"]["carrier"] == "DHL"
    assert found["web-552"]["status"] == "processing" and found["web-552"]["tracking"] is None
    full = by(rows(spark, "warehouse_orders", root), "shipbob_order_id")
    assert full["7101"]["carrier"] == "DHL Parcel" and full["7101"]["total_cost"] == Decimal("17.25")
    assert full["7101"]["shipped_date"] == datetime(2023, 1, 2) and full["7102"]["tracking_number"] == ""
    assert len(rows(spark, "warehouse_orders", root, limit=2)) == 2


def test_returns_and_receiving(spark, landing):
    root = landing("warehouse/returns", p.RETURNS)
    landing("warehouse/receiving", p.RECEIVING)
    (ret,) = rows(spark, "warehouse_returns", root)
    assert ret["total_cost"] == Decimal("3.40") and ret["fulfillment_center_id"] == "1"
    assert ret["items"] == [{"inventory_id": "5001", "name": "Two-person tent", "quantity": 2,
                             "action_requested": "Quarantine", "action_instructions": "Check the poles"}]
    assert ret["completed_date"] == datetime(2023, 3, 9, 16, 45)
    (wro,) = rows(spark, "warehouse_receiving", root)
    assert wro["inventory_quantities"][0]["received_quantity"] == 30
    assert not rows(spark, "warehouse_returns", root, start=F.lit("2024-01-01 00:00:00").cast("timestamp"))


def test_products_variants_centers(spark, landing):
    root = landing("warehouse/products", p.PRODUCTS)
    landing("warehouse/variants", p.VARIANTS)
    landing("warehouse/centers", p.CENTERS)
    (product,) = rows(spark, "warehouse_products", root)
    assert (product["is_lot"], product["is_case"], product["is_active"], product["is_hazmat"]) == (
        "True", "False", "True", "False")
    assert product["value"] == "{}" and product["weight"] == "{}"
    assert len(rows(spark, "warehouse_variants", root)) == 2 and len(rows(spark, "warehouse_centers", root)) == 2


def test_accounting(spark, landing):
    root = landing("accounting/contacts", p.CONTACTS)
    for folder, page in (
        ("invoices", p.INVOICES), ("categories", p.CATEGORIES), ("bank_accounts", p.BANK_ACCOUNTS),
        ("bank_transactions", p.BANK_TRANSACTIONS), ("bills", p.BILLS),
        ("bank_transaction_explanations", p.EXPLANATIONS), ("transactions", p.TRANSACTIONS), ("users", p.USERS),
    ):
        landing(f"accounting/{folder}", page)
    (contact,) = rows(spark, "accounting_contacts", root)
    assert contact["contact_id"] == "310" and contact["uses_contact_invoice_sequence"] == "True"
    assert contact["account_balance"] == Decimal("-72.30") and contact["created_at_api"] is None
    invoices = by(rows(spark, "accounting_invoices", root), "invoice_id")
    assert invoices["611"]["project_id"] is None and invoices["612"]["project_id"] == "9"
    assert invoices["611"]["outside_of_sales_tax_scope"] == "False"
    assert invoices["611"]["initial_sales_tax_rate"] == Decimal("17.50")
    categories = by(rows(spark, "accounting_categories", root), "category_id")
    assert categories["420"]["parent_category_id"] == "400" and categories["430"]["parent_category_id"] is None
    assert categories["430"]["allowable_for_tax"] is None
    only = rows(spark, "accounting_bank_transactions", root, only={"bank_account_id": "2"})
    assert [r["transaction_id"] for r in only] == ["3"]
    ledger = by(rows(spark, "accounting_transactions", root), "transaction_id")
    assert ledger["1"]["foreign_currency_data"] == '{"currency":"USD","rate":1.1}'
    assert ledger["2"]["foreign_currency_data"] is None
    assert len(rows(spark, "accounting_users", root)) == 2
    users = FEEDS["accounting_users"].records(read_lines(spark, f"{root}/accounting/users"))
    assert accounting.users_in_view(users, "staff").count() == 1
    assert accounting.users_in_view(users, "active_advisors").count() == 0
    with pytest.raises(ValueError):
        accounting.users_in_view(users, "nobody")


def test_every_accounting_record_fits_its_table(spark):
    for kind, record in accounting.RECORDS.items():
        ddl = {"contacts": payloads.CONTACT, "invoices": payloads.INVOICE, "bills": payloads.BILL,
               "categories": payloads.CATEGORY, "bank_accounts": payloads.BANK_ACCOUNT,
               "bank_transactions": payloads.BANK_TRANSACTION, "bank_transaction_explanations": payloads.EXPLANATION,
               "transactions": payloads.LEDGER_TRANSACTION, "users": payloads.USER}[kind]
        out = accounting.rows(kind, spark.createDataFrame([], f"r {ddl}").select("r.*"))
        table = TABLES[record.table]
        assert [f"{f.name}:{f.dataType.simpleString()}" for f in out.schema] == [
            f"{n}:{t}" for n, t in table.columns.items() if n != "created_at"]


def test_absent_or_disabled_feed_is_empty(spark, landing):
    root = landing("store/orders", p.STORE_ORDERS)
    assert rows(spark, "warehouse_orders", root) == []
    assert rows(spark, "store_orders", root, enabled=False) == []
    assert read_report(spark, f"{root}/nowhere").count() == 0
    assert read_changes(spark, root).count() == 0


def test_unreadable_page_is_set_aside(spark, landing):
    root = landing("store/orders", text='{"orders": [{"id": 1,\n{"orders": [{"id": 2, "name": "#2"}]}\n')
    assert [r["order_id"] for r in rows(spark, "store_orders", root)] == ["#2"]
    assert unreadable(read_lines(spark, f"{root}/store/orders")).count() == 1


def test_tags_as_given(spark):
    df = spark.createDataFrame([('["a"]',), ("[]",), ("a,b",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(store.tags_as_given(F.col("t"))).collect()] == ['["a"]', None, "a,b", None, None]
