"""Landed pages: every shape tells itself apart, pulls of several files make one whole, files are opened once."""

import os
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests import payloads as p
from waybill.load import Loader
from waybill.operators.quality import InvalidBatch
from waybill.sources import FEEDS
from waybill.sources.landing import pages, read_lines, records_of, rejected
from waybill.sources.pulls import PULL, WHOLE, file_pulls
from waybill.streaming.micro_batch import stream_feed
from waybill.warehouse import Warehouse

RECORD = "struct<`a`: string, `l`: array<struct<`b`: string>>>"
DAY = datetime(2024, 5, 1, tzinfo=UTC)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"), buckets=2)


def found(spark, at, *texts, carry=None):
    lines = spark.createDataFrame([(t, "f") for t in texts], "value string, _file string")
    return pages(lines, RECORD, at, carry)


def reasons(df):
    return sorted((r["reason"], r["value"]) for r in rejected(df).collect())


def test_shapes_of_object_pages(spark):
    texts = ['{"c": [{"a": 1}, "x", null, {"a": 2, "l": [{"b": 3}]}, [4]]}', '{"c": {"a": 1}}', '{"c": "none"}', '{"errors": ["no"]}',
             '{"c": []}', '{"c": [{"a": 5}]}', '{"c": [{"a": 1}', "", "  ", "7", '{"c": null}', '{"c": [null]}', '{"c": ["s", 2]}']
    df = found(spark, "c", *texts)
    assert sorted(r["a"] for r in records_of(df).collect()) == ["1", "2", "5"]
    assert reasons(df) == sorted([
        ("record is no object", "x"), ("record is no object", "null"), ("record is no object", "null"), ("record is no object", "[4]"),
        ("record is no object", "s"), ("record is no object", "2"), ("unreadable page", '{"c": [{"a": 1}'),
        *[("page without records", t) for t in ('{"c": {"a": 1}}', '{"c": "none"}', '{"errors": ["no"]}', "7", '{"c": null}')]])


def test_shapes_of_bare_and_enveloped_pages(spark):
    texts = ['[{"a": 1}, 2]', '{"items": [{"a": 3}], "next": "n"}', '{"items": {"a": 4}}', '{"message": "too many requests"}', "[]"]
    both = found(spark, "*", *texts)
    assert sorted(r["a"] for r in records_of(both).collect()) == ["1", "3"]
    assert [r for r, _ in reasons(both)] == ["page without records"] * 2 + ["record is no object"]
    bare = found(spark, "[]", *texts)
    assert [r["a"] for r in records_of(bare).collect()] == ["1"]
    assert [r for r, _ in reasons(bare)] == ["page without records"] * 3 + ["record is no object"]


def test_what_a_page_carries(spark):
    df = found(spark, "p.rows", '{"p": {"id": "o1", "rows": [{"a": 1}, {"a": 2}]}}', '{"p": {"id": "o2", "rows": [{"a": 3}, 0]}}', carry="id")
    assert sorted((r["id"], r["a"]) for r in records_of(df).collect()) == [("o1", "1"), ("o1", "2"), ("o2", "3")]


def test_a_page_is_parsed_once(spark):
    plan = found(spark, "c", '{"c": []}')._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") - plan.count("array<string>") <= 4 and "Join" not in plan


def test_pages_of_the_wrong_shape_are_counted(spark, warehouse, landing, as_of):
    root = landing("accounting/contacts", p.CONTACTS, {"contacts": p.CONTACTS["contacts"][0]}, {"errors": ["limit"]}, {"contacts": "none"},
                   {"contacts": [1, "two"]}, {"contacts": []})
    loader = Loader(warehouse)
    (stats,) = loader.load(FEEDS["accounting_contacts"], root, as_of).tables
    assert (stats.processed, stats.quarantined) == (1, 5)  # of two contacts one has no id
    kinds = spark.read.json(f"{warehouse.root}/_quarantine").groupBy(F.col("errors")[0]).count().collect()
    assert {k: n for k, n in kinds} == {"page without records": 3, "record is no object": 2}
    landing("warehouse/orders", {"message": "gone"}, p.WAREHOUSE_ORDERS)
    assert loader.load_order_status(root, as_of, DAY).tables[0].quarantined == 1
    with pytest.raises(InvalidBatch, match="5 unreadable"):
        Loader(warehouse, "refuse").load(FEEDS["accounting_contacts"], root, as_of)


def test_a_load_reads_its_files_once(warehouse, landing, as_of):
    root = landing("store/orders", p.STORE_ORDERS, {"orders": "none"})
    seen = []
    stage = warehouse.stage

    def counted(run, name, df):
        seen.append((name, [f for f in df.inputFiles() if "/landing/" in f]))
        return stage(run, name, df)

    warehouse.stage = counted
    Loader(warehouse).load(FEEDS["store_orders"], root, as_of)
    assert [name for name, files in seen if files] == ["store_orders_pages"]


# --- pulls -----------------------------------------------------------------------------------------------------------
def stamped(root, folder, name, at):
    os.utime(f"{root}/{folder}/{name}", (at.timestamp(), at.timestamp()))


def pull_page(token, *stock):
    page = p.stock_page(*stock)
    return page if token is None else {"payload": {**page["payload"], "nextToken": token}}


def quantities(warehouse):
    return {r["sku"]: r["quantity_on_hand"] for r in warehouse.read("inventory").collect()}


def test_a_pull_of_several_files_adds_up(warehouse, landing, as_of):
    put = lambda name, at, token, *stock: (
        landing("marketplace/inventory", pull_page(token, *stock), name=name), stamped(landing.root, "marketplace/inventory", name, at))
    feed, loader = FEEDS["marketplace_inventory"], Loader(warehouse)
    put("b.json", DAY, "t1", p.stock("S", 10, 0, 0, "C1"), p.stock("ONCE", 4, 0, 0, "C1"))
    put("a.json", DAY + timedelta(seconds=2), "", p.stock("S", 5, 0, 0, "C2"))
    loader.load(feed, landing.root, as_of)
    assert quantities(warehouse) == {"S": 15, "ONCE": 4}
    put("c.json", DAY + timedelta(hours=3), "t2", p.stock("S", 7, 0, 0, "C1"))
    put("d.json", DAY + timedelta(hours=3, seconds=5), "t3")  # a page without stock goes on with its pull
    loader.load(feed, landing.root, as_of)
    assert quantities(warehouse) == {"S": 15, "ONCE": 4}  # not whole yet
    put("e.json", DAY + timedelta(hours=3, seconds=9), None, p.stock("S", 1, 0, 0, "C2"))
    loader.load(feed, landing.root, as_of)
    assert quantities(warehouse) == {"S": 8, "ONCE": 4}


def test_an_unfinished_pull_waits_for_its_last_page(warehouse, landing, as_of):
    put = lambda name, at, token, *stock: (
        landing("marketplace/inventory", pull_page(token, *stock), name=name), stamped(landing.root, "marketplace/inventory", name, at))
    feed, loader = FEEDS["marketplace_inventory"], Loader(warehouse)
    put("1.json", DAY, "t", p.stock("S", 10, 0, 0, "C1"))
    loader.load_landed(feed, landing.root, as_of)
    assert quantities(warehouse) == {} and warehouse.read("landed_files").count() == 0
    put("2.json", DAY + timedelta(minutes=1), None, p.stock("S", 5, 0, 0, "C2"))
    loader.load_landed(feed, landing.root, as_of)
    assert quantities(warehouse) == {"S": 15} and warehouse.read("landed_files").count() == 2
    put("3.json", DAY + timedelta(days=1), "t", p.stock("S", 99, 0, 0, "C1"))  # given up: its next page never lands
    put("4.json", DAY + timedelta(days=2), None, p.stock("S", 6, 0, 0, "C1"))
    loader.load_landed(feed, landing.root, as_of)
    assert quantities(warehouse) == {"S": 6} and warehouse.read("landed_files").count() == 4


def test_unreadable_quantities_are_counted(spark, warehouse, landing, as_of):
    page = pull_page(None, p.stock("S", 3, 0, 0, "C1"), p.stock("BAD", "many", 0, 0, "X"), p.stock("", "many", 0, 0, "X"))
    landing("marketplace/inventory", page)
    assert Loader(warehouse).load(FEEDS["marketplace_inventory"], landing.root, as_of).tables[0].quarantined == 1
    (bad,) = spark.read.json(f"{warehouse.root}/_quarantine").collect()
    assert bad["errors"] == ["invalid on_hand"] and '"sellerSku":"BAD"' in bad["record"] and quantities(warehouse) == {"S": 3}
    with pytest.raises(InvalidBatch, match="1 records with unreadable values"):
        Loader(warehouse, "refuse").load(FEEDS["marketplace_inventory"], landing.root, as_of)


def test_numbers_of_pulls_against_a_loop(spark):
    import random
    rnd = random.Random(4)
    files, at = [], DAY
    for i in range(400):
        at += timedelta(seconds=rnd.choice([1, 5, 900, 4000, 40_000]))
        files.append((at, f"f{rnd.randrange(10**6):06}", rnd.random() < 0.6))
    want, number, members = {}, 0, {}
    for i, (at, name, more) in enumerate(files):
        want[name] = number
        members.setdefault(number, []).append(more)
        gone = i + 1 < len(files) and files[i + 1][0] - at > timedelta(hours=1)
        number += (not more) or gone
    df = spark.createDataFrame(files, "_landed timestamp, _file string, _more boolean").repartition(5)
    got = {r["_file"]: (r[PULL], r[WHOLE]) for r in file_pulls(df).collect()}
    assert got == {name: (n, not members[n][-1]) for name, n in want.items()}


# --- only what is new ------------------------------------------------------------------------------------------------
def contact(i, name="x"):
    return {"contacts": [{"url": f"https://h/contacts/{i}", "organisation_name": name, "updated_at": "2020-01-01T00:00:00Z"}]}


def test_only_new_files_are_opened(spark, warehouse, landing, as_of):
    feed, loader = FEEDS["accounting_contacts"], Loader(warehouse)
    for i in range(5):
        landing("accounting/contacts", contact(i), name=f"{i}.json")
        stamped(landing.root, "accounting/contacts", f"{i}.json", DAY + timedelta(days=i))
    assert loader.load_landed(feed, landing.root, as_of).tables[0].inserted == 5
    for i in (5, 6):
        landing("accounting/contacts", contact(i), name=f"{i}.json")
        stamped(landing.root, "accounting/contacts", f"{i}.json", DAY + timedelta(days=i))
    opened = read_lines(spark, f"{landing.root}/accounting/contacts", after=DAY + timedelta(days=4) - timedelta(hours=1)).inputFiles()
    assert sorted(f.rsplit("/", 1)[1] for f in opened) == ["4.json", "5.json", "6.json"]
    (stats,) = loader.load_landed(feed, landing.root, as_of).tables
    assert (stats.processed, stats.inserted) == (2, 2)  # 4.json is opened again, and left out by name
    assert loader.load_landed(feed, landing.root, as_of).tables[0].processed == 0
    landing("accounting/contacts", contact(7), name="old.json")  # arrives with an old time
    stamped(landing.root, "accounting/contacts", "old.json", DAY - timedelta(days=9))
    assert loader.load_landed(feed, landing.root, as_of).tables[0].processed == 0
    assert loader.load_landed(feed, landing.root, as_of, sweep=True).tables[0].inserted == 1
    landing("accounting/contacts", contact(0, "y"), name="0.json")  # the same name again, later
    stamped(landing.root, "accounting/contacts", "0.json", DAY + timedelta(days=8))
    assert loader.load_landed(feed, landing.root, as_of).tables[0].updated == 1
    assert warehouse.read("landed_files").count() == 9


def test_a_failed_load_lists_no_files(warehouse, landing, as_of, monkeypatch):
    landing("accounting/contacts", contact(1))
    loader, merge = Loader(warehouse), warehouse.merge
    monkeypatch.setattr(warehouse, "merge", lambda run, name, *a, **b: 1 / 0 if name == "freeagent_contacts" else merge(run, name, *a, **b))
    with pytest.raises(ZeroDivisionError):
        loader.load_landed(FEEDS["accounting_contacts"], landing.root, as_of)
    monkeypatch.setattr(warehouse, "merge", merge)
    assert warehouse.read("landed_files").count() == 0
    assert loader.load_landed(FEEDS["accounting_contacts"], landing.root, as_of).tables[0].inserted == 1


# --- children before their parents -----------------------------------------------------------------------------------
def test_rows_wait_for_what_they_hang_on(spark, warehouse, landing, as_of):
    loader = Loader(warehouse, wait=timedelta(days=3))
    items, orders = FEEDS["marketplace_order_items"], FEEDS["marketplace_orders"]
    landing("marketplace/order_items", p.MARKET_ITEMS, p.MARKET_ITEMS_ORPHAN)
    (stats,) = loader.load(items, landing.root, as_of).tables
    assert (stats.inserted, stats.orphans, stats.waiting) == (0, 0, 2)
    assert warehouse.read("order_items").count() == 0 and warehouse.read("waiting_order_items").count() == 2
    landing("marketplace/orders", p.MARKET_ORDERS)
    loader.load(orders, landing.root, as_of + timedelta(hours=1))
    (stats,) = loader.load_waiting(items, as_of + timedelta(hours=1)).tables
    assert (stats.inserted, stats.waiting) == (1, 1)
    (loaded,) = warehouse.read("order_items").collect()
    assert loaded["order_id"] == "M-501" and loaded["created_at"] == (as_of + timedelta(hours=1)).replace(tzinfo=None)
    (stats,) = loader.load_waiting(items, as_of + timedelta(days=2)).tables
    assert (stats.orphans, stats.waiting) == (0, 1)
    landing("marketplace/order_items", p.MARKET_ITEMS_ORPHAN)  # landing again does not start the wait anew
    loader.load(items, landing.root, as_of + timedelta(days=2))
    (stats,) = loader.load_waiting(items, as_of + timedelta(days=4)).tables
    assert (stats.orphans, stats.waiting) == (1, 0) and warehouse.read("waiting_order_items").count() == 0
    bad = [r for r in spark.read.json(f"{warehouse.root}/_quarantine").collect() if r["errors"][0].startswith("no order_id in orders")]
    assert len(bad) == 1


def test_a_stream_loads_items_that_came_before_their_order(warehouse, landing, as_of, tmp_path):
    loader = Loader(warehouse, wait=timedelta(days=3))
    run = lambda name: stream_feed(
        loader, FEEDS[name], landing.root, str(tmp_path / name), clock=lambda: as_of).awaitTermination()
    landing("marketplace/order_items", p.MARKET_ITEMS)
    run("marketplace_order_items")
    assert warehouse.read("order_items").count() == 0
    landing("marketplace/orders", p.MARKET_ORDERS)
    run("marketplace_orders")
    assert warehouse.read("order_items").count() == 1 and warehouse.read("waiting_order_items").count() == 0


def test_without_waiting_orphans_are_dropped(warehouse, landing, as_of):
    landing("marketplace/order_items", p.MARKET_ITEMS)
    (stats,) = Loader(warehouse).load(FEEDS["marketplace_order_items"], landing.root, as_of).tables
    assert (stats.inserted, stats.orphans, stats.waiting) == (0, 1, 0)
