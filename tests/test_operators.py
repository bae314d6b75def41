from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from waybill.operators import links, merge, picks, quality, reshape, rollups
from waybill.schemas import TABLES


def table(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [("a", 1, 10, "2020"), ("b", 2, 20, "2021"), (None, 3, 30, "2022")], "k string, v int, w int, created string")


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([("b", 22, "new"), ("c", 33, "new"), (None, 44, "new")], "k string, v int, created string")


@pytest.mark.parametrize("small", [False, True])
def test_merge(target, batch, small):
    out = merge.merge(target, batch, ["k"], ["v", "w"], defaults={"w": "0"}, small_batch=small)
    assert {r["k"]: (r["v"], r["w"], r["created"], r["_op"]) for r in out.collect()} == {
        "a": (1, 10, "2020", "keep"), "b": (22, 20, "2021", "update"), "c": (33, 0, "new", "insert"),
        None: (44, 30, "2022", "update")}


def test_merge_missing_default_and_plain_keys(target, batch):
    out = merge.merge(target, batch, ["k"], ["v", "w"], defaults={"w": "0"}, missing="default", null_safe=False)
    got = sorted(((r["k"] or "", r["w"], r["_op"]) for r in out.collect()))
    assert got == [("", 0, "insert"), ("", 30, "keep"), ("a", 10, "keep"), ("b", 0, "update"), ("c", 0, "insert")]
    with pytest.raises(ValueError):
        merge.merge(target, batch, ["k"], missing="drop")


def test_merge_twice_changes_nothing(target, batch):
    once = merge.merge(target, batch, ["k"], ["v"]).drop("_op")
    twice = merge.merge(once, batch, ["k"], ["v"])
    assert sorted(map(str, twice.drop("_op").collect())) == sorted(map(str, once.collect()))
    counts = {r["op"]: r["n"] for r in merge.op_counts(twice).collect()}
    assert counts == {"update": 3, "keep": 1}


def test_op_counts_add_up_to_the_batch(target, batch):
    counts = {r["op"]: r["n"] for r in merge.op_counts(merge.merge(target, batch, ["k"], ["v"])).collect()}
    assert counts["insert"] + counts["update"] == batch.count()


def test_merge_newer_only(spark):
    old = spark.createDataFrame([("a", 5, "t"), ("b", None, "t")], "k string, at int, v string")
    new = spark.createDataFrame([("a", 4, "s"), ("b", 1, "s"), ("c", 0, "s")], "k string, at int, v string")
    out = merge.merge(old, new, ["k"], newer_by="at")
    assert table(out.select("k", "v", "_op")) == [("a", "t", "keep"), ("b", "s", "update"), ("c", "s", "insert")]


def test_small_batch_is_broadcast_and_table_not_shuffled(spark):
    old = spark.range(100).selectExpr("cast(id as string) k", "id v")
    new = spark.range(5).selectExpr("cast(id as string) k", "-id v")
    plan = merge.merge(old, new, ["k"], ["v"], small_batch=True)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin FullOuter" not in plan and "BroadcastHashJoin" in plan


def test_null_safe_merge_is_an_equi_join(target, batch):
    plan = merge.merge(target, batch, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan


def test_update_only_and_vanished(target, batch):
    out = merge.update_only(target, batch, ["k"], ["v"])
    assert {r["k"]: (r["v"], r["_op"]) for r in out.collect()} == {
        "a": (1, "keep"), "b": (22, "update"), None: (3, "keep")}
    assert {r["k"] for r in merge.unmatched(batch, target, ["k"]).collect()} == {"c", None}
    assert {r["k"] for r in merge.still_present(target, batch, ["k"]).collect()} == {"b"}


def test_picks(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", None, "m")], "k string, at int, v string")
    assert table(picks.latest_per_key(df, ["k"], ["at"])) == [("a", 2, "z"), ("b", None, "n")]
    lines = spark.createDataFrame([("o", "s", 2, 5, 0), ("o", "s", 3, 6, 1)], "o string, s string, qty int, price int, seq int")
    assert table(picks.fold_lines(lines, ["o", "s"], ["qty"], ["price"], "seq")) == [("o", "s", 5, 6)]
    rows = spark.createDataFrame([("a", 1, i) for i in range(5)] + [("a", 2, 9), ("b", 1, 1)], "k string, v int, seq int")
    got = table(picks.number_repeats(rows, ["k"], "seq", spread=3))
    assert got == [("a", 1, 1), ("a", 1, 2), ("a", 1, 3), ("a", 1, 4), ("a", 1, 5), ("a", 2, 6), ("b", 1, 1)]


def test_repeats_are_numbered_alike_with_and_without_ranges(spark):
    data = [(k, v, i) for i, (k, v) in enumerate([("hot", i % 90) for i in range(400)] + [("one", 7)] * 300 + [(None, None)] * 200
            + [("few", 3), ("few", None), ("few", 3), (None, 1)])]
    df = spark.createDataFrame(data, "k string, v int, place int")
    want = []
    for key in {k for k, _, _ in data}:
        own = sorted((v for k, v, _ in data if k == key), key=lambda v: (v is not None, v or 0))
        want += [(key, v, n) for n, v in enumerate(own, 1)]
    for many in (1, 50, 250, 100_000):
        got = picks.number_repeats(df, ["k"], "place", many=many)
        assert got.schema["line_number"].dataType.simpleString() == "bigint"
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want)), many


def test_keys_of_few_rows_are_numbered_after_one_shuffle(spark):
    df = spark.range(2000).selectExpr("id % 100 k", "cast(id % 7 as int) v", "id place")
    out = picks.number_repeats(df, ["k"], "place")
    assert len(out.collect()) == 2000
    final = out._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 1 and final.count("Window ") == 1


def test_picks_shrink_partitions_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x")], "k string, at int, v string")
    plan = picks.latest_per_key(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial") and "WindowGroupLimit" in plan


def test_quality(spark):
    df = spark.createDataFrame([("a", 1), ("", 1), ("b", -1), (None, None)], "id string, qty int")
    rules = [quality.required("id"), quality.not_negative("qty"), quality.Rule("one", "qty = 1", "warning")]
    good, bad = quality.valid(df, rules), quality.quarantined(df, rules)
    assert table(good) == [("a", 1)]
    assert sorted(len(r["errors"]) for r in bad.collect()) == [1, 1, 2]
    assert good.count() + bad.count() == df.count()
    assert table(quality.rule_counts(df, rules)) == [
        ("invalid qty", "error", 2), ("missing id", "error", 2), ("one", "warning", 2)]
    with pytest.raises(quality.InvalidBatch, match="missing id: 2"):
        quality.refuse_broken(df, rules)
    assert quality.refuse_broken(good, rules) is good


def test_table_rules():
    names = {r.name for r in quality.table_rules(TABLES["order_items"])}
    assert {"missing order_id", "missing sku", "missing qty", "invalid qty"} <= names


def test_links(spark):
    children = spark.createDataFrame([("2001", "1001"), ("2002", "9999"), ("2003", "9999")], "id string, product_id string")
    parents = spark.createDataFrame([("1001",)], "product_id string")
    assert table(links.drop_orphans(children, parents, "product_id").select("id")) == [("2001",)]
    assert table(links.orphan_keys(children, parents, "product_id")) == [("9999",)]
    assert links.keep_keys(children, "id", ["2001"]).count() == 1
    assert links.keep_keys(children, "id", parents.selectExpr("'2002' AS x")).count() == 1


def test_skewed_children(spark):
    """One parent owns most children; none may be lost and the totals must hold."""
    children = spark.range(20_000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS parent", "id")
    parents = spark.range(0, 20_000, 2).withColumnRenamed("id", "parent")
    expected = sum(1 for i in range(20_000) if (0 if i % 3 == 0 else i) % 2 == 0)
    assert links.drop_orphans(children, parents, "parent").count() == expected
    assert picks.latest_per_key(children, ["parent"], ["id"]).filter("parent = 0").first()["id"] == 19_998


def test_inventory_by_sku(spark):
    df = spark.createDataFrame(
        [("S", 25, "LTN1", "first", 1), ("S", 20, "MAN2", "second", 2), ("S", 0, "", "third", 3), ("T", 1, None, "x", 4)],
        "sku string, on_hand int, fc string, asin string, seq int")
    assert table(rollups.inventory_by_sku(df, ["on_hand"], ["asin"], "fc", "seq")) == [
        ("S", 45, "MAN2", "first"), ("T", 1, None, "x")]


def test_amount_total(spark):
    df = spark.createDataFrame([(["2.5", "x", None, "1.005"],), ([],), (None,)], "a array<string>")
    items = F.transform("a", lambda x: F.struct(x.alias("amount")))
    assert [r[0] for r in df.select(rollups.amount_total(items)).collect()] == [
        Decimal("3.51"), Decimal("0.00"), Decimal("0.00")]


def test_side_by_side_has_no_cross_join(spark):
    a = spark.range(3).agg(F.count(F.lit(1)).alias("x"))
    b = spark.range(4).agg(F.max("id").alias("y"))
    out = rollups.side_by_side([a, b])
    assert tuple(out.first()) == (3, 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_reshape(spark):
    orders = spark.createDataFrame([("1", "shopify", "x"), ("2", "amazon", None)], "order_id string, source string, v string")
    items = spark.createDataFrame([("1", "a"), ("2", "b")], "order_id string, sku string")
    assert table(reshape.items_of_source(items, orders, "shopify")) == [("1", "a")]
    parts = {s: reshape.of_source(orders, s) for s in ("shopify", "amazon")}
    assert sorted(map(str, reshape.unified(parts).select(*orders.columns).collect())) == sorted(map(str, orders.collect()))
    assert table(reshape.fill_default(orders, v="d").select("v")) == [("d",), ("x",)]
    old = spark.createDataFrame([("s", "FC", 1, 2)], "sku string, fc string, on_hand int, quantity_on_hand int")
    row = reshape.current_inventory_columns(old).first()
    assert (row["fulfillment_center"], row["quantity_on_hand"], row["source"]) == ("FC", 2, "amazon")
