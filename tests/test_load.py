from datetime import UTC, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests import payloads as p
from waybill.load import Loader, check_unique
from waybill.operators.quality import InvalidBatch
from waybill.plans import finance
from waybill.sources import FEEDS
from waybill.streaming.micro_batch import stream_feed, without_repeats
from waybill.warehouse import Conflict, Warehouse

SINCE = datetime(2023, 1, 1, tzinfo=UTC)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"), buckets=3)


@pytest.fixture
def loader(warehouse):
    return Loader(warehouse)


def rows(warehouse, table, key):
    return {r[key]: r for r in warehouse.read(table).collect()}


def counts(outcome):
    return {s.table: (s.processed, s.inserted, s.updated) for s in outcome.tables}


def test_orders_and_items_load_together(loader, warehouse, landing, as_of):
    root = landing("store/orders", p.STORE_ORDERS)
    first = loader.load(FEEDS["store_orders"], root, as_of)
    assert counts(first) == {"shopify_orders": (2, 2, 0), "shopify_order_items": (2, 2, 0)}
    orders = rows(warehouse, "shopify_orders", "order_id")
    assert orders["#A-17"]["total"] == Decimal("64.20") and orders["#A-17"]["storefront"] == "shopify"
    assert orders["#A-17"]["created_at"] == as_of.replace(tzinfo=None)
    again = loader.load(FEEDS["store_orders"], root, as_of + timedelta(days=1))
    assert counts(again) == {"shopify_orders": (2, 0, 2), "shopify_order_items": (2, 0, 2)}
    kept = rows(warehouse, "shopify_orders", "order_id")
    assert kept["#A-17"]["created_at"] == as_of.replace(tzinfo=None)  # a merge keeps the time of the insert
    log = warehouse.read("job_executions").orderBy("started_at").collect()
    assert [(r["status"], r["records_inserted"], r["records_updated"]) for r in log] == [
        ("success", 4, 0), ("success", 0, 4)]
    state = rows(warehouse, "sync_state", "domain")["store_orders"]
    assert (state["status"], state["error_count"]) == ("success", 0)


def test_only_touched_buckets_are_rewritten(loader, warehouse, landing, as_of):
    contacts = {"contacts": [{"url": f"https://h/contacts/{i}", "organisation_name": "x"} for i in range(30)]}
    root = landing("accounting/contacts", contacts)
    loader.load(FEEDS["accounting_contacts"], root, as_of)
    before = warehouse.state()["tables"]["freeagent_contacts"]["runs"]
    one = {"contacts": [{"url": "https://h/contacts/7", "organisation_name": "y"}]}
    landing("accounting/contacts", one)
    loader.load(FEEDS["accounting_contacts"], root, as_of)
    after = warehouse.state()["tables"]["freeagent_contacts"]["runs"]
    assert set(after) == {"0", "1", "2"} and sum(before[b] != after[b] for b in after) == 1
    names = rows(warehouse, "freeagent_contacts", "contact_id")
    assert len(names) == 30 and names["7"]["organisation_name"] == "y"
    assert warehouse.obsolete()  # notes of the first load are superseded


def test_failed_load_leaves_tables_alone_and_is_noted(loader, warehouse, landing, as_of, monkeypatch):
    root = landing("store/orders", p.STORE_ORDERS)
    loader.load(FEEDS["store_orders"], root, as_of)
    merge = warehouse.merge

    def broken(run, name, *args, **how):
        if name == "shopify_order_items":
            raise RuntimeError("lost")
        return merge(run, name, *args, **how)

    monkeypatch.setattr(warehouse, "merge", broken)
    changed = {"orders": [{**p.STORE_ORDERS["orders"][0], "total_price": "1.00", "line_items": []}]}
    landing("store/orders", changed)
    with pytest.raises(RuntimeError):
        loader.load(FEEDS["store_orders"], root, as_of + timedelta(days=1))
    assert rows(warehouse, "shopify_orders", "order_id")["#A-17"]["total"] == Decimal("64.20")
    state = rows(warehouse, "sync_state", "domain")["store_orders"]
    assert (state["status"], state["error_count"], state["error_message"]) == ("error", 1, "lost")
    assert state["last_synced_at"] == as_of.replace(tzinfo=None)
    assert warehouse.read("job_executions").filter("status = 'failed'").count() == 1


def test_second_writer_of_a_commit_fails(warehouse):
    stale = warehouse.state()
    warehouse.commit("one", [])
    warehouse.state = lambda: stale
    with pytest.raises(Conflict, match="exists"):
        warehouse.commit("two", [])


def test_no_update_is_lost_between_writers(spark, warehouse, as_of):
    def merged(run, key):
        contacts = spark.createDataFrame([(key, run)], "contact_id string, organisation_name string")
        return warehouse.merge(run, "freeagent_contacts", warehouse.stage(run, "contacts", contacts).frame)

    one = Warehouse(spark, warehouse.root, buckets=1)
    warehouse.buckets = 1
    first, second = merged("one", "1"), merged("two", "2")
    one.commit("one", [first])
    with pytest.raises(Conflict, match="freeagent_contacts"):
        one.commit("two", [second])
    one.commit("two", [merged("again", "2")])
    assert set(rows(warehouse, "freeagent_contacts", "contact_id")) == {"1", "2"}


def test_load_merges_again_after_a_conflict(spark, loader, warehouse, landing, as_of, monkeypatch):
    page = lambda i: {"contacts": [{"url": f"https://h/contacts/{i}", "organisation_name": "x"}]}
    warehouse.buckets = 1
    here = landing("accounting/contacts", page(1))
    commit, others = warehouse.commit, []

    def late(run, changes, job=None):
        if not others:  # another load of the same table comes first
            others.append(1)
            contacts = spark.createDataFrame([("2", "y")], "contact_id string, organisation_name string")
            other = Warehouse(spark, warehouse.root, buckets=1)
            other.commit("other", [other.merge("other", "freeagent_contacts", other.stage("other", "c", contacts).frame)])
        return commit(run, changes, job)

    monkeypatch.setattr(warehouse, "commit", late)
    loader.load(FEEDS["accounting_contacts"], here, as_of)
    assert set(rows(warehouse, "freeagent_contacts", "contact_id")) == {"1", "2"}


def test_marks_of_two_feeds_survive_each_other(loader, warehouse, landing, as_of, monkeypatch):
    root = landing("accounting/contacts", p.CONTACTS)
    landing("accounting/bills", p.BILLS)
    replace, nested = warehouse.replace, []

    def late(run, name, frame, now):
        if not nested:
            nested.append(1)
            loader.load(FEEDS["accounting_bills"], root, as_of)
        return replace(run, name, frame, now)

    monkeypatch.setattr(warehouse, "replace", late)
    loader.load(FEEDS["accounting_contacts"], root, as_of)
    assert set(rows(warehouse, "sync_state", "domain")) == {"accounting_contacts", "accounting_bills"}


def test_a_long_gap_and_a_failure_lose_nothing(loader, warehouse, landing, monkeypatch):
    person = lambda i, at: {"customers": [{"id": i, "created_at": at, "updated_at": at, "orders_count": 1}]}
    root = landing("store/customers", person(1, "2023-06-01T00:00:00Z"), name="1.json")
    feed, day = FEEDS["store_customers"], datetime(2024, 1, 1, 12, 0, tzinfo=UTC)
    loader.load_new(feed, root, day)
    assert set(rows(warehouse, "shopify_customers", "customer_id")) == {"1"}  # a first load takes all that landed
    landing("store/customers", person(2, "2024-01-01T18:00:00Z"), name="2.json")
    merge = warehouse.merge
    monkeypatch.setattr(warehouse, "merge", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        loader.load_new(feed, root, day + timedelta(days=1))
    monkeypatch.setattr(warehouse, "merge", merge)
    loader.load_new(feed, root, day + timedelta(days=9))
    assert set(rows(warehouse, "shopify_customers", "customer_id")) == {"1", "2"}
    landing("store/customers", person(3, "2024-01-12T00:00:00Z"), name="3.json")
    loader.load_new(feed, root, day + timedelta(days=30), timedelta(days=2))  # only where asked for
    assert set(rows(warehouse, "shopify_customers", "customer_id")) == {"1", "2"}


def test_a_broken_record_costs_itself(loader, warehouse, landing, as_of, spark):
    one, two = p.STORE_ORDERS["orders"]
    root = landing("store/orders", {"orders": [one, "x", two, None]}, name="a.json")
    landing("store/orders", text='{"orders": [{"id": 1, "name":\n', name="b.json")
    landing("warehouse/inventory", [p.WAREHOUSE_INVENTORY[0], 7], {"items": ["y", p.WAREHOUSE_INVENTORY[1]]})
    outcome = loader.load(FEEDS["store_orders"], root, as_of)
    assert set(rows(warehouse, "shopify_orders", "order_id")) == {"#A-17", "#A-18"}
    assert outcome.tables[0].quarantined == 3
    assert loader.load(FEEDS["warehouse_inventory"], root, as_of).tables[0].quarantined == 2
    assert warehouse.read("shipbob_inventory").count() == 2
    reasons = spark.read.json(f"{warehouse.root}/_quarantine").groupBy(F.col("errors")[0]).count().collect()
    assert {r[0]: r[1] for r in reasons} == {"record is no object": 4, "unreadable page": 1}
    with pytest.raises(InvalidBatch, match="3 unreadable"):
        Loader(warehouse, "refuse").load(FEEDS["store_orders"], root, as_of)


def test_undated_row_of_a_range_is_judged(loader, warehouse, landing, as_of):
    good = {"id": 1, "created_at": "2024-01-02", "updated_at": "2024-01-02", "orders_count": 1}
    root = landing("store/customers", {"customers": [good, {**good, "id": 2, "updated_at": "no time"}]})
    start = datetime(2024, 1, 1, tzinfo=UTC)
    (stats,) = loader.load(FEEDS["store_customers"], root, as_of, start, as_of).tables
    assert stats.processed + stats.quarantined == 2


def test_pulls_and_reports_count_once(loader, warehouse, landing, as_of):
    root = landing("marketplace/inventory", p.stock_page(p.stock("S", 10, 0, 0, "A"), p.stock("S", 5, 0, 0, "B"),
                                                         p.stock("GONE", 3, 0, 0, "A")), name="day1.json")
    loader.load(FEEDS["marketplace_inventory"], root, as_of)
    landing("marketplace/inventory", p.stock_page(p.stock("S", 12, 0, 0, "A")), name="day2.json")
    loader.load(FEEDS["marketplace_inventory"], root, as_of)
    found = rows(warehouse, "inventory", "sku")
    assert {k: r["quantity_on_hand"] for k, r in found.items()} == {"S": 12, "GONE": 3}
    landing("marketplace/settlements", name="r1.tsv", text=p.report(p.SETTLEMENT_ROWS[:2]))
    landing("marketplace/settlements", name="r2.tsv", text=p.report(p.SETTLEMENT_ROWS))
    loader.load_settlements(root, as_of)
    (header,) = warehouse.read("settlements").collect()
    assert header["gross"] == Decimal("59.99") and warehouse.read("settlement_lines").count() == 5


def test_bad_rows_go_to_quarantine(loader, warehouse, landing, as_of, spark):
    root = landing("store/customers", p.STORE_CUSTOMERS)
    outcome = loader.load(FEEDS["store_customers"], root, as_of)
    (stats,) = outcome.tables
    assert (stats.processed, stats.quarantined) == (2, 1)
    bad = spark.read.json(f"{warehouse.root}/_quarantine").collect()
    assert len(bad) == 1 and bad[0]["errors"] == ["invalid orders_count"] and '"customer_id":"3"' in bad[0]["record"]
    with pytest.raises(InvalidBatch, match="invalid orders_count"):
        Loader(warehouse, "refuse").load(FEEDS["store_customers"], root, as_of)


def test_orphans_are_dropped(loader, warehouse, landing, as_of):
    root = landing("warehouse/products", p.PRODUCTS)
    landing("warehouse/variants", p.VARIANTS)
    landing("marketplace/orders", p.MARKET_ORDERS)
    landing("marketplace/order_items", p.MARKET_ITEMS, p.MARKET_ITEMS_ORPHAN)
    for feed in ("warehouse_products", "marketplace_orders"):
        loader.load(FEEDS[feed], root, as_of)
    (variants,) = loader.load(FEEDS["warehouse_variants"], root, as_of).tables
    assert (variants.inserted, variants.orphans) == (1, 1)
    (items,) = loader.load(FEEDS["marketplace_order_items"], root, as_of).tables
    assert (items.inserted, items.orphans) == (1, 1)


def test_settlements_reload(loader, warehouse, landing, as_of):
    root = landing("marketplace/settlements", name="r1.tsv", text=p.report(p.SETTLEMENT_ROWS))
    first = loader.load_settlements(root, as_of)
    assert counts(first) == {"settlements": (1, 1, 0), "settlement_lines": (5, 5, 0)}
    (header,) = warehouse.read("settlements").collect()
    assert header["gross"] == header["net"] == Decimal("59.99") and header["currency"] == "EUR"
    assert header["refunds"] == Decimal("-42.00") and header["fees"] == Decimal("-18.41")
    assert header["period_end"] == datetime(2024, 2, 20, 23, 59, 59)
    assert counts(loader.load_settlements(root, as_of))["settlement_lines"] == (5, 0, 5)


def test_settlement_lines_of_equal_content_are_all_kept(loader, warehouse, landing, as_of):
    twice = [*p.SETTLEMENT_ROWS, p.SETTLEMENT_ROWS[3], p.SETTLEMENT_ROWS[3]]
    root = landing("marketplace/settlements", name="r1.tsv", text=p.report(twice))
    loader.load_settlements(root, as_of)
    assert counts(loader.load_settlements(root, as_of))["settlement_lines"] == (7, 0, 7)
    assert warehouse.read("settlement_lines").count() == 7


def test_settlements_of_a_range(loader, warehouse, landing, as_of):
    import os

    other = [["ST-2024-07", *row[1:]] for row in p.SETTLEMENT_ROWS[:2]]
    root = landing("marketplace/settlements", name="r1.tsv", text=p.report(p.SETTLEMENT_ROWS))
    landing("marketplace/settlements", name="r2.tsv", text=p.report(other))
    day = datetime(2024, 3, 30, tzinfo=UTC).timestamp()  # yesterday of as_of; the range starts 14 days before its midnight
    first = day - 14 * 86_400
    for r1, r2, want in ((first - 1, day + 86_400, []), (first, day + 86_400, ["ST-2024-06"]),
                         (first - 0.5, day + 86_399.5, ["ST-2024-06", "ST-2024-07"])):
        for name, at in (("r1.tsv", r1), ("r2.tsv", r2)):
            os.utime(f"{root}/marketplace/settlements/{name}", (at, at))
        loader.load_recent_settlements(root, as_of)
        assert sorted(rows(warehouse, "settlements", "settlement_id")) == want
    assert rows(warehouse, "sync_state", "domain")["marketplace_settlements"]["status"] == "success"


def test_accounting_default_ranges(loader, warehouse, landing, as_of):
    dates = ["2024-01-20", "2024-01-31", "2024-03-31", "2024-04-01"]  # 60 days before the midnight of as_of: 2024-01-31
    page = {"invoices": [{**p.INVOICES["invoices"][0], "url": f"x/invoices/{i}", "dated_on": d} for i, d in enumerate(dates)]}
    root = landing("accounting/invoices", page)
    landing("accounting/users", p.USERS)
    loader.load_accounting("invoices", root, as_of)
    assert set(rows(warehouse, "freeagent_invoices", "invoice_id")) == {"1", "2"}
    loader.load_accounting("invoices", root, as_of, datetime(2024, 4, 1, tzinfo=UTC))
    assert set(rows(warehouse, "freeagent_invoices", "invoice_id")) == {"1", "2", "3"}
    loader.load_accounting("invoices", root, as_of, full=True)
    assert len(rows(warehouse, "freeagent_invoices", "invoice_id")) == 4
    loader.load_accounting("users", root, as_of, view="staff")
    assert set(rows(warehouse, "freeagent_users", "user_id")) == {"1"}
    loader.load_accounting("users", root, as_of)
    assert set(rows(warehouse, "freeagent_users", "user_id")) == {"1", "2"}
    for kind, how in (("invoices", {"view": "staff"}), ("users", {"start": as_of}), ("users", {"view": "nobody"})):
        with pytest.raises(ValueError):
            loader.load_accounting(kind, root, as_of, **how)


def test_late_shipping_reads_shipments_of_some_days(spark):
    from waybill.plans.daily import with_fulfilled_at

    orders = spark.sql("SELECT 'a' order_id, timestamp'2024-03-30 00:00:00' created_at UNION ALL"
                       " SELECT 'b', timestamp'2024-01-01 00:00:00' UNION ALL SELECT 'c', timestamp'2024-03-29 00:00:00'")
    shipped = spark.sql("SELECT 'a' reference_id, timestamp'2024-03-31 00:00:00' shipped_date UNION ALL"
                        " SELECT 'b', timestamp'2024-02-01 00:00:00'")
    at = F.lit("2024-03-31 12:00:00").cast("timestamp")
    found = {r["order_id"]: r["fulfilled_at"] for r in with_fulfilled_at(orders, shipped, at, 7, older=True).collect()}
    assert found == {"a": datetime(2024, 3, 31), "b": None, "c": None}
    assert {r["order_id"] for r in with_fulfilled_at(orders, shipped, at, 7).collect()} == {"a", "c"}


def test_order_status_updates_only(loader, warehouse, landing, as_of):
    root = landing("store/orders", p.STORE_ORDERS)
    landing("warehouse/orders", p.WAREHOUSE_ORDERS)
    loader.load(FEEDS["store_orders"], root, as_of)
    (stats,) = loader.load_order_status(root, as_of, SINCE).tables
    assert (stats.processed, stats.inserted, stats.updated) == (2, 0, 1)
    orders = rows(warehouse, "shopify_orders", "order_id")
    assert set(orders) == {"#A-17", "#A-18"}
    assert (orders["#A-17"]["status"], orders["#A-17"]["tracking_number"]) == ("shipped", "RX77-40")
    assert orders["#A-17"]["tracking_updated_at"] == datetime(2023, 1, 3) and orders["#A-18"]["status"] == "pending"


def test_full_refresh_may_drop_vanished_keys(loader, warehouse, landing, as_of):
    root = landing("warehouse/centers", p.CENTERS)
    loader.load(FEEDS["warehouse_centers"], root, as_of)
    landing("warehouse/centers", p.CENTERS[:1])
    loader.load(FEEDS["warehouse_centers"], root, as_of)
    assert set(rows(warehouse, "shipbob_fulfillment_centers", "center_id")) == {"1", "2"}
    loader.load(FEEDS["warehouse_centers"], root, as_of, delete_missing=True)
    assert set(rows(warehouse, "shipbob_fulfillment_centers", "center_id")) == {"1"}


def test_newer_copy_of_a_record_wins(loader, warehouse, landing, as_of):
    old = {"orders": [{**p.STORE_ORDERS["orders"][0], "updated_at": "2023-11-01T00:00:00Z", "total_price": "1.00"}]}
    root = landing("store/orders", p.STORE_ORDERS, old)
    loader.load(FEEDS["store_orders"], root, as_of)
    assert rows(warehouse, "shopify_orders", "order_id")["#A-17"]["total"] == Decimal("64.20")
    landing("store/orders", old)
    loader.load(FEEDS["store_orders"], root, as_of, newer_by=None)
    assert rows(warehouse, "shopify_orders", "order_id")["#A-17"]["total"] == Decimal("1.00")


def test_large_batch_is_shuffled_into_buckets(spark, warehouse, as_of, monkeypatch):
    contacts = spark.range(200).selectExpr("cast(id as string) contact_id", "'x' organisation_name")
    monkeypatch.setattr("waybill.operators.merge.SMALL_BATCH_ROWS", 10)
    batch = warehouse.stage("r1", "contacts", contacts)
    assert batch.rows == 200
    change = warehouse.merge("r1", "freeagent_contacts", batch.frame, rows=batch.rows)
    warehouse.commit("r1", [change])
    assert (change.inserted, change.updated) == (200, 0) and set(change.runs) == {0, 1, 2}
    half = warehouse.stage("r2", "contacts", contacts.filter("contact_id < 100").withColumn("organisation_name", F.lit("y")))
    change = warehouse.merge("r2", "freeagent_contacts", half.frame, rows=half.rows)
    warehouse.commit("r2", [change])
    assert (change.inserted, change.updated) == (0, 100)
    assert warehouse.read("freeagent_contacts").filter("organisation_name = 'y'").count() == 100
    files = warehouse.read("freeagent_contacts").inputFiles()
    assert len(files) == 3  # one file per bucket


def test_empty_feed_loads_nothing(loader, warehouse, landing, as_of):
    root = landing("store/orders", p.STORE_ORDERS)
    outcome = loader.load(FEEDS["accounting_bills"], root, as_of)
    assert counts(outcome) == {"freeagent_bills": (0, 0, 0)}
    assert warehouse.read("freeagent_bills").count() == 0


def test_incremental_load_starts_at_the_mark(loader, warehouse, landing):
    root = landing("store/orders", p.STORE_ORDERS)
    feed = FEEDS["store_orders"]
    now = datetime(2024, 2, 1, 12, 0, tzinfo=UTC)
    assert loader.load_new(feed, root, now).total("processed") == 2  # #A-17 and its item
    later = loader.load_new(feed, root, now + timedelta(days=1), timedelta(days=30))
    assert later.total("processed") == 2 and later.total("inserted") == 2  # only #A-18: the mark is past #A-17
    state = rows(warehouse, "sync_state", "domain")["store_orders"]
    assert state["last_synced_at"] == datetime(2024, 2, 2, 12, 0)


def test_views_answer_sql(spark, loader, warehouse, landing, as_of):
    root = landing("warehouse/receiving", p.RECEIVING)
    loader.load(FEEDS["warehouse_receiving"], root, as_of)
    warehouse.views()
    row = spark.sql("""
        SELECT purchase_order_number, sum(q.received_quantity) * 100 / nullif(sum(q.expected_quantity), 0) AS rate
        FROM shipbob_receiving_orders LATERAL VIEW explode(inventory_quantities) AS q
        WHERE status = 'Completed' GROUP BY wro_id, purchase_order_number""").first()
    assert tuple(row) == ("PO-88", 75.0)
    warehouse.views(json_text=True)
    text = spark.table("shipbob_receiving_orders").first()["inventory_quantities"]
    assert '"received_quantity":30' in text


def test_check_unique(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    with pytest.raises(InvalidBatch):
        check_unique(df, ["k"])
    assert check_unique(df.distinct(), ["k"]).count() == 2


def test_stream_matches_batch(loader, warehouse, landing, as_of, tmp_path):
    root = landing("store/orders", p.STORE_ORDERS)
    check = str(tmp_path / "checkpoint")
    feed = FEEDS["store_orders"]
    stream_feed(loader, feed, root, check, clock=lambda: as_of).awaitTermination()
    assert warehouse.read("shopify_orders").count() == 2
    more = {"orders": [{**p.STORE_ORDERS["orders"][0], "name": "#A-19", "id": 5}]}
    landing("store/orders", more, name="later.json")
    stream_feed(loader, feed, root, check, clock=lambda: as_of).awaitTermination()
    assert set(rows(warehouse, "shopify_orders", "order_id")) == {"#A-17", "#A-18", "#A-19"}
    assert rows(warehouse, "sync_state", "domain")["store_orders"]["last_sync_key"] == "1"
    assert warehouse.read("job_executions").count() == 2


def test_stream_without_repeats(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.sql("SELECT 'a' k, timestamp'2024-01-01 00:00:00' at UNION ALL SELECT 'a', timestamp'2024-01-01 00:00:01'"
              " UNION ALL SELECT 'b', timestamp'2024-01-01 00:00:02'").write.parquet(source)
    rows_ = spark.readStream.schema("k string, at timestamp").parquet(source)
    query = without_repeats(rows_, ["k"], "at", "10 minutes").writeStream.format("memory").queryName("once").trigger(
        availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["k"] for r in spark.table("once").collect()) == ["a", "b"]


def test_landed_files_to_business_questions(loader, warehouse, landing, as_of):
    root = landing("accounting/invoices", p.INVOICES)
    landing("accounting/bank_accounts", p.BANK_ACCOUNTS)
    landing("accounting/bank_transactions", p.BANK_TRANSACTIONS)
    for kind in ("invoices", "bank_accounts", "bank_transactions"):
        loader.load(FEEDS[f"accounting_{kind}"], root, as_of)
    aging = finance.receivables_aging(warehouse.read("freeagent_invoices"), F.lit(as_of))
    assert {(r["aging_bucket"], r["invoice_count"], str(r["total_outstanding"])) for r in aging.collect()} == {
        ("31-60 days", 1, "840.00"), ("90+ days", 1, "65.00")}
    flow = finance.cash_flow(
        warehouse.read("freeagent_bank_transactions"), warehouse.read("freeagent_bank_accounts"),
        F.lit("2024-01-01").cast("timestamp"))
    assert [(r["bank_account"], str(r["inflows"]), str(r["outflows"]), str(r["net_flow"])) for r in flow.collect()] == [
        ("Current", "250.00", "80.25", "169.75")]


def test_only_some_rows_of_a_feed(loader, warehouse, landing, as_of):
    root = landing("accounting/bank_transactions", p.BANK_TRANSACTIONS)
    landing("store/orders", p.STORE_ORDERS)
    loader.load(FEEDS["accounting_bank_transactions"], root, as_of, only={"bank_account_id": ["2"]})
    assert set(rows(warehouse, "freeagent_bank_transactions", "transaction_id")) == {"3"}
    outcome = loader.load(FEEDS["store_orders"], root, as_of, only={"order_id": ["#A-17", "#A-99"]})
    assert counts(outcome) == {"shopify_orders": (1, 1, 0), "shopify_order_items": (1, 1, 0)}


def test_command_line(spark, landing, tmp_path, capsys):
    from waybill.__main__ import main, questions

    root, store = landing("accounting/invoices", p.INVOICES), str(tmp_path / "cli")
    main(["load", "accounting_invoices", "--landing", root, "--warehouse", store, "--full"])
    main(["ask", "receivables_aging", "--warehouse", store, "--as-of", "2024-03-31"])
    shown = capsys.readouterr().out
    assert "inserted=3" in shown and "31-60 days" in shown
    moment = F.lit("2024-03-31 00:00:00").cast("timestamp")
    known = questions(Warehouse(spark, store).snapshot(), moment, moment, 7)
    for name, ask in known.items():
        assert ask().columns, name  # every question fits the warehouse's tables
    assert known["alerts"]().count() >= 1
    assert known["table_counts"]().filter("table_name = 'freeagent_invoices'").first()["rows"] == 3
