"""Loads into tables kept as changes: the tests of loads that hold for any warehouse, and what is its own."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests import payloads as p
from tests.test_landing import test_rows_wait_for_what_they_hang_on  # noqa: F401
from tests.test_load import (  # noqa: F401  collected here with this module's warehouse
    counts, loader, rows, test_a_long_gap_and_a_failure_lose_nothing, test_bad_rows_go_to_quarantine,
    test_full_refresh_may_drop_vanished_keys, test_newer_copy_of_a_record_wins, test_order_status_updates_only,
    test_settlements_reload,
)
from waybill.__main__ import main
from waybill.change_warehouse import ChangeWarehouse
from waybill.sources import FEEDS
from waybill.streaming import state


@pytest.fixture
def warehouse(spark, tmp_path):
    return ChangeWarehouse(spark, str(tmp_path / "warehouse"))


def test_a_load_appends_and_rewrites_nothing(loader, warehouse, landing, as_of):  # noqa: F811
    root = landing("store/orders", p.STORE_ORDERS)
    loader.load(FEEDS["store_orders"], root, as_of)
    before = {f: f.stat().st_mtime_ns for f in Path(warehouse.root).rglob("*.parquet")}
    again = loader.load(FEEDS["store_orders"], root, as_of)
    assert counts(again) == {"shopify_orders": (2, 0, 2), "shopify_order_items": (2, 0, 2)}
    assert all(f.stat().st_mtime_ns == at for f, at in before.items())
    assert warehouse.read("shopify_orders").count() == 2 and warehouse.read("job_executions").count() == 2


def test_two_writers_of_one_table_both_survive(spark, warehouse):
    def batch(*keys):
        return spark.createDataFrame([(k, datetime(2024, 1, 1)) for k in keys], "order_id string, purchase_date timestamp")

    one = warehouse.merge("one", "shopify_orders", batch("a", "b"))
    two = warehouse.merge("two", "shopify_orders", batch("b", "c"))
    assert warehouse.read("shopify_orders").count() == 0
    warehouse.commit("two", [two])
    assert {r["order_id"] for r in warehouse.read("shopify_orders").collect()} == {"b", "c"}
    warehouse.commit("one", [one])
    assert {r["order_id"] for r in warehouse.read("shopify_orders").collect()} == {"a", "b", "c"}


def test_marks_written_side_by_side_both_stay(spark, warehouse):
    def mark(feed):
        return spark.createDataFrame(
            [(feed, datetime(2024, 1, 1), "success", datetime(2024, 1, 2))],
            "domain string, last_synced_at timestamp, status string, updated_at timestamp")

    now = warehouse.state()
    changes = [(f, warehouse.replace(f, "sync_state", state.put(warehouse.read("sync_state", now), mark(f)), now)) for f in "ab"]
    for feed, change in changes:
        warehouse.commit(feed, [change])
    assert {r["domain"] for r in warehouse.read("sync_state").collect()} == {"a", "b"}


def test_a_snapshot_does_not_see_later_loads(loader, warehouse, landing, as_of):  # noqa: F811
    root = landing("store/orders", p.STORE_ORDERS)
    loader.load(FEEDS["store_orders"], root, as_of)
    read = warehouse.snapshot()
    warehouse.commit("gone", [warehouse.merge(
        "gone", "shopify_orders", warehouse.read("shopify_orders").limit(1), delete_missing=True)])
    assert read("shopify_orders").count() == 2 and warehouse.read("shopify_orders").count() == 1


def test_compaction_leaves_the_same_rows(spark, loader, warehouse, landing, as_of):  # noqa: F811
    root = landing("store/orders", p.STORE_ORDERS)
    for _ in range(2):
        loader.load(FEEDS["store_orders"], root, as_of)
    before = rows(warehouse, "shopify_orders", "order_id")
    stored = spark.read.parquet(f"{warehouse.root}/shopify_orders")
    parts = [r[0] for r in stored.select(F.col("_part").cast("string")).distinct().collect()]
    assert parts and all(len(part) == 7 for part in parts)  # months
    warehouse.compact("shopify_orders", parts)
    assert rows(warehouse, "shopify_orders", "order_id") == before
    assert all("/shopify_orders/" in folder for folder in warehouse.obsolete()) and warehouse.obsolete()


def test_what_a_batch_lacks_can_be_set_to_its_default(spark, warehouse):
    first = spark.createDataFrame([("a", datetime(2024, 1, 1), "note")], "order_id string, purchase_date timestamp, note string")
    warehouse.commit("one", [warehouse.merge("one", "shopify_orders", first)])
    warehouse.commit("two", [warehouse.merge("two", "shopify_orders", first.drop("note"))])
    assert rows(warehouse, "shopify_orders", "order_id")["a"]["note"] == "note"
    warehouse.commit("three", [warehouse.merge("three", "shopify_orders", first.drop("note"), missing="default")])
    assert rows(warehouse, "shopify_orders", "order_id")["a"]["note"] is None
    with pytest.raises(ValueError):
        warehouse.merge("four", "shopify_orders", first, missing="drop")


def test_an_undated_copy_is_not_newer(spark, warehouse):
    ddl = "order_id string, purchase_date timestamp, updated_at_shopify timestamp, note string"
    day = datetime(2024, 1, 1)
    for run, at, note in (("one", day, "first"), ("two", None, "undated"), ("three", day, "as new")):
        batch = spark.createDataFrame([("a", day, at, note)], ddl)
        warehouse.commit(run, [warehouse.merge(run, "shopify_orders", batch, newer_by="updated_at_shopify")])
        expected = "as new" if run == "three" else "first"
        assert rows(warehouse, "shopify_orders", "order_id")["a"]["note"] == expected


def test_shell(landing, tmp_path, capsys):
    root, kept = landing("store/orders", p.STORE_ORDERS), str(tmp_path / "kept")
    main(["load", "store_orders", "--landing", root, "--warehouse", kept, "--as-changes"])
    assert "shopify_orders" in capsys.readouterr().out
    main(["ask", "recent_jobs", "--warehouse", kept, "--as-changes"])
    assert "store_orders" in capsys.readouterr().out
