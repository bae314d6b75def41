"""Tables kept as changes, identity over chains of values, settlement lines of other reports, repeated pages in a stream."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests import payloads as p
from waybill.changes import ChangeTable, new_run
from waybill.load import Loader
from waybill.operators import identity, picks
from waybill.schemas import TABLES, Table
from waybill.session import staging
from waybill.sources import FEEDS
from waybill.streaming.micro_batch import stream_feed
from waybill.warehouse import Warehouse

MONTH = "date_format(purchase_date, 'yyyy-MM')"
NOW = datetime(2024, 6, 1, tzinfo=UTC)


def orders(spark, *rows):
    return spark.createDataFrame([(k, s, datetime(2024, m, 5)) for k, s, m in rows], "order_id string, status string, purchase_date timestamp")


def state(table):
    return {r["order_id"]: r["status"] for r in table.read().collect()}


@pytest.fixture
def table(spark, tmp_path):
    return ChangeTable(spark, str(tmp_path / "changes"), TABLES["shopify_orders"], MONTH)


def test_upsert_update_and_delete(spark, table):
    one = new_run()
    assert table.read().count() == 0
    done = table.upsert(one, orders(spark, ("a", "new", 1), ("b", "new", 2)).withColumn("created_at", F.lit("2024-01-01").cast("timestamp")))
    assert (done.inserted, done.updated) == (2, 0) and table.read().count() == 0  # not published yet
    table.publish(one, NOW)
    assert state(table) == {"a": "new", "b": "new"}
    two = new_run()
    done = table.upsert(two, orders(spark, ("a", "paid", 3), ("c", "new", 3)).withColumn("created_at", F.lit("2024-06-01").cast("timestamp")))
    assert (done.inserted, done.updated) == (1, 1)
    table.publish(two, NOW + timedelta(hours=1))
    rows = {r["order_id"]: r for r in table.read().collect()}
    assert rows["a"]["status"] == "paid" and rows["a"]["created_at"] == datetime(2024, 1, 1)  # frozen on insert
    assert rows["a"]["storefront"] == "shopify"  # a default
    three = new_run()
    patch = spark.createDataFrame([("a", "T1"), ("zz", "T2")], "order_id string, tracking_number string")
    done = table.update(three, patch)
    assert (done.inserted, done.updated) == (0, 1)
    assert table.delete(three, spark.createDataFrame([("b",), ("none",)], "order_id string")).updated == 1
    table.publish(three, NOW + timedelta(hours=2))
    rows = {r["order_id"]: r for r in table.read().collect()}
    assert set(rows) == {"a", "c"} and (rows["a"]["tracking_number"], rows["a"]["status"]) == ("T1", "paid")
    four = new_run()
    assert table.upsert(four, orders(spark, ("b", "again", 2))).inserted == 1
    table.publish(four, NOW + timedelta(hours=3))
    assert state(table) == {"a": "paid", "b": "again", "c": "new"}


def test_keys_of_one_month_touch_one_part(spark, table):
    months = spark.range(1200).select(F.concat(F.lit("o"), "id").alias("order_id"), F.lit("new").alias("status"), F.expr(
        "make_timestamp(2024, cast(id % 4 + 1 as int), 5, 0, 0, 0)").alias("purchase_date"))
    table.upsert("base", months)
    table.publish("base", NOW)
    batch = months.filter("id % 4 = 2").withColumn("status", F.lit("paid")).withColumn("purchase_date", F.lit("2024-09-09").cast("timestamp"))
    done = table.upsert("change", batch)
    table.publish("change", NOW + timedelta(hours=1))
    assert (done.inserted, done.updated) == (0, 300)
    files = spark.read.parquet(table.path).filter("_run = 'change'")
    assert [r[0] for r in files.select("_part").distinct().collect()] == ["2024-03"]  # keys stay where they were first written
    assert len({f for f in files.select("_metadata.file_path").distinct().toPandas().iloc[:, 0]}) == 1
    part = table.read_parts(["2024-03"])
    assert part.count() == 300 and part.filter("status = 'paid'").count() == 300 and table.read().count() == 1200


def test_two_writers_both_survive(spark, table):
    other = ChangeTable(spark, table.path.rsplit("/", 1)[0], TABLES["shopify_orders"], MONTH)
    table.upsert("first", orders(spark, ("a", "new", 1), ("b", "first", 1)))
    other.upsert("second", orders(spark, ("b", "second", 1), ("c", "new", 1)))
    other.publish("second", NOW)
    table.publish("first", NOW + timedelta(seconds=1))
    assert state(table) == {"a": "new", "b": "first", "c": "new"}  # the one published last wins
    table.publish("second", NOW + timedelta(days=1))  # published again: the first time counts
    assert state(table)["b"] == "first"


def test_tables_of_a_run_appear_together(spark, tmp_path):
    root = str(tmp_path / "both")
    parent, child = ChangeTable(spark, root, TABLES["shopify_orders"], MONTH), ChangeTable(spark, root, TABLES["shopify_order_items"])
    parent.upsert("r", orders(spark, ("a", "new", 1)))
    child.upsert("r", spark.createDataFrame([("a", None, 1), ("a", "s", 2)], "order_id string, sku string, qty int"))
    assert parent.read().count() == child.read().count() == 0
    parent.publish("r", NOW)
    assert parent.read().count() == 1 and child.read().count() == 2
    assert child.upsert("s", spark.createDataFrame([("a", None, 9)], "order_id string, sku string, qty int")).updated == 1  # NULL keys match


def test_compaction_keeps_rows_and_later_changes(spark, table):
    for k in range(3):
        table.upsert(f"r{k}", orders(spark, ("a", f"s{k}", 1), (f"x{k}", "new", 2)))
        table.publish(f"r{k}", NOW + timedelta(hours=k))
    before = state(table)
    table.upsert("late", orders(spark, ("a", "late", 1)))  # written before the compaction, published after it
    run = table.compact(["2024-01"], NOW + timedelta(hours=9))
    assert state(table) == before == {"a": "s2", "x0": "new", "x1": "new", "x2": "new"}
    gone = table.obsolete()
    assert len(gone) == 3 and all("_part=2024-01/_run=r" in path for path in gone)
    table.publish("late", NOW + timedelta(hours=10))
    assert state(table) == before | {"a": "late"} and run.startswith("compact")


def test_changes_against_a_dict(spark, tmp_path):
    rnd = random.Random(7)
    plain = Table("plain", {"k": "string", "a": "int", "b": "int", "first": "int"}, ("k",), frozen=("first",))
    table, want = ChangeTable(spark, str(tmp_path / "dict"), plain, "concat('p', cast(a % 3 as string))"), {}
    for turn in range(6):
        keys = rnd.sample("abcdefgh", 4)
        kind = rnd.choice(["upsert", "upsert", "update", "delete"])
        rows = [(k, rnd.randrange(100)) for k in keys]
        if kind == "upsert":
            table.upsert(f"t{turn}", spark.createDataFrame([(k, v, turn) for k, v in rows], "k string, a int, first int"))
            for k, v in rows:
                old = want.get(k, {"b": None, "first": turn})
                want[k] = {**old, "a": v}
        elif kind == "update":
            table.update(f"t{turn}", spark.createDataFrame(rows, "k string, b int"))
            for k, v in rows:
                if k in want:
                    want[k]["b"] = v
        else:
            table.delete(f"t{turn}", spark.createDataFrame(rows, "k string, b int"))
            for k in keys:
                want.pop(k, None)
        table.publish(f"t{turn}", NOW + timedelta(minutes=turn))
    assert {r["k"]: {c: r[c] for c in ("a", "b", "first")} for r in table.read().collect()} == want


def test_a_chain_of_partial_links_is_one_group(spark):
    rows = [("o1", "t1", None, "c1"), ("o2", "t1", "r1", None), ("o3", None, "r1", " "), ("o4", "t9", "", None), ("o5", None, None, "c1"),
            ("o6", "c1", None, None), ("o7", None, None, None)]  # o6's tracking number only looks like a customer
    df = spark.createDataFrame(rows, "id string, tracking string, reference string, customer string")
    got = dict(map(tuple, identity.identity_groups(df, "id", ["tracking", "reference", "customer"], staging(spark)).collect()))
    assert got == {"o1": "o1", "o2": "o1", "o3": "o1", "o5": "o1", "o4": "o4", "o6": "o6", "o7": "o7"}


def test_a_hot_key_is_numbered_in_ranges(spark):
    rnd = random.Random(2)
    rows = [("hot", rnd.choice([None, *range(300)]), i) for i in range(4000)] + [("cold", i, i) for i in range(9)]
    df = spark.createDataFrame(rows, "k string, amount int, place int")
    got = picks.number_repeats(df, ["k"], "place", many=50).collect()
    for key in ("hot", "cold"):
        own = sorted((r["line_number"], (r["amount"] is not None, r["amount"] or 0)) for r in got if r["k"] == key)
        assert [n for n, _ in own] == list(range(1, len(own) + 1)) and [v for _, v in own] == sorted(v for _, v in own)
    ranges = picks._range_of(df, ["k"], "amount", 50).filter("k = 'hot'").groupBy("_range").count().collect()
    assert len(ranges) > 40 and max(r["count"] for r in ranges) < 400


def test_settlement_lines_of_another_settlement_are_set_aside(spark, tmp_path, landing, as_of):
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)
    other = p.report(p.SETTLEMENT_ROWS).splitlines()
    mixed = "\n".join([*other, other[-1].replace("ST-2024-06", "ST-OTHER")]) + "\n"
    landing("marketplace/settlements", name="r.tsv", text=mixed)
    outcome = Loader(warehouse).load_settlements(landing.root, as_of)
    assert {s.table: (s.processed, s.quarantined) for s in outcome.tables} == {"settlements": (1, 0), "settlement_lines": (5, 1)}
    (bad,) = spark.read.json(f"{warehouse.root}/_quarantine").collect()
    assert bad["errors"] == ["settlement of another report"] and "ST-OTHER" in bad["record"]


def test_repeated_pages_are_parsed_once(spark, tmp_path, landing, as_of):
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)
    bad = {"customers": "none"}
    for name in ("1.json", "2.json"):
        landing("store/customers", p.STORE_CUSTOMERS, bad, name=name)
    loader = Loader(warehouse)
    assert loader.load(FEEDS["store_customers"], landing.root, as_of).tables[0].quarantined == 4
    assert loader.load(FEEDS["store_customers"], landing.root, as_of, once=True).tables[0].quarantined == 2
    stream_feed(loader, FEEDS["store_customers"], landing.root, str(tmp_path / "c"), clock=lambda: as_of, once_within="1 day").awaitTermination()
    streamed = warehouse.read("job_executions").orderBy("started_at").collect()[2:]
    assert [r["metadata"].count('"quarantined": 2') for r in streamed][0] == 1
