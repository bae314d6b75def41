"""Landed pages: wrong shapes, pulls over several files, repeated pages, the change feed, limits and default ranges."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from entries.registry import Tables, query, stamp
from waybill.operators import links, quality
from waybill.schemas import TABLES
from waybill.schemas import payloads as p
from waybill.sources import FEEDS, fulfilment
from waybill.sources.feeds import changes_of, first_rows
from waybill.sources.landing import object_records, pages, records_of, rejected, without_repeated_pages
from waybill.sources.pulls import PULL, WHOLE, with_pulls
from waybill.streaming import windows


def _shapes(t: Tables):
    """A page per customer: a list, one record, a text, an error, a list with texts, no JSON, by the remainder of the key."""
    key = F.col("c_custkey")
    record = F.concat(F.lit('{"k":"'), "c_custkey", F.lit('"}'))
    page = (
        F.when(key % 6 == 0, F.concat(F.lit('{"rows":'), record, F.lit("}")))
        .when(key % 6 == 1, F.concat(F.lit('{"rows":"'), "c_custkey", F.lit('"}')))
        .when(key % 6 == 2, F.lit('{"errors":["limit"]}'))
        .when(key % 6 == 3, F.concat(F.lit('{"rows":["x",'), record, F.lit(",null,7]}")))
        .when(key % 6 == 4, F.concat(F.lit('{"rows":['), record))
        .otherwise(F.concat(F.lit('{"rows":['), record, F.lit(","), record, F.lit("]}"))))
    return t.customer.select(page.alias("value"), F.col("c_nationkey").cast("string").alias("_file"))


@query("page_without_array", """
SELECT CAST(c_nationkey AS VARCHAR) AS file, reason, count(*) AS n FROM (
  SELECT c_nationkey, CASE WHEN c_custkey % 6 <= 2 THEN 'page without records' WHEN c_custkey % 6 = 4 THEN 'unreadable page' END AS reason
  FROM customer WHERE c_custkey % 6 IN (0, 1, 2, 4)
  UNION ALL SELECT c_nationkey, 'record is no object' FROM customer, range(3) WHERE c_custkey % 6 = 3) GROUP BY ALL""")
def page_without_array(t: Tables):
    found = rejected(pages(_shapes(t), p.struct("k"), "rows"))
    return found.groupBy(F.col("_file").alias("file"), "reason").agg(F.count(F.lit(1)).alias("n"))


@query("records_beside_bad_pages", """
SELECT CAST(c_custkey AS VARCHAR) AS k, CASE WHEN c_custkey % 6 = 3 THEN 1 ELSE 2 END AS n
FROM customer WHERE c_custkey % 6 IN (3, 5)""")
def records_beside_bad_pages(t: Tables):
    found = records_of(pages(_shapes(t), p.struct("k"), "rows"))
    return found.groupBy("k").agg(F.count(F.lit(1)).cast("int").alias("n"))


_LANDED = "TIMESTAMP '2024-01-01' + to_seconds(CAST(o_orderkey * 7 + (o_orderkey // 500) * 7200 AS BIGINT))"
_PULLS = f"""
WITH f AS (SELECT o_orderkey, o_custkey % 40 AS sku, o_orderkey % 13 AS q, {_LANDED} AS landed, o_orderstatus <> 'F' AS more FROM orders),
e AS (SELECT *, NOT more OR coalesce(lead(landed) OVER (ORDER BY landed, o_orderkey) > landed + INTERVAL 1 HOUR, false) AS ended FROM f),
n AS (SELECT *, coalesce(sum(CAST(ended AS BIGINT)) OVER (ORDER BY landed, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS pull FROM e),
w AS (SELECT *, arg_max(more, (landed, o_orderkey)) OVER (PARTITION BY pull) AS open FROM n)"""


def _pull_pages(t: Tables):
    """A page of stock per order, each in a file of its own; those of orders not finished hold a token."""
    key = F.col("o_orderkey")
    landed = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + key * 7 + F.floor(key / 500) * 7200)
    page = F.concat(
        F.lit('{"payload":{"inventorySummaries":[{"sellerSku":"s'), (F.col("o_custkey") % 40).cast("string"),
        F.lit('","totalQuantity":'), (key % 13).cast("string"), F.lit("}]"),
        F.when(F.col("o_orderstatus") != "F", F.lit(',"nextToken":"t"')).otherwise(F.lit("")), F.lit("}}"))
    return t.wide("orders").select(
        page.alias("value"), landed.alias("_landed"), F.lpad(key.cast("string"), 12, "0").alias("_file"),
        F.lit(0).cast("bigint").alias("_block"), F.lit(0).cast("bigint").alias("_row"))


@query("pull_of_pages", f"""
{_PULLS}
SELECT 's' || sku AS sku, CAST(sum(q) AS INTEGER) AS on_hand FROM (
  SELECT *, max(pull) OVER (PARTITION BY sku) AS newest FROM w WHERE NOT open) WHERE pull = newest GROUP BY sku""")
def pull_of_pages(t: Tables):
    feed = FEEDS["marketplace_inventory"]
    rows = feed.rows(feed.records(_pull_pages(t)), F.lit("2024-06-01 00:00:00").cast("timestamp"))
    return rows.select("sku", F.col("quantity_on_hand").alias("on_hand"))


@query("pull_numbers", f"""
{_PULLS}
SELECT pull, NOT open AS whole, count(*) AS files FROM w GROUP BY ALL""")
def pull_numbers(t: Tables):
    found = with_pulls(FEEDS["marketplace_inventory"].pages(_pull_pages(t)))
    return found.groupBy(F.col(PULL).alias("pull"), F.col(WHOLE).alias("whole")).agg(F.countDistinct("_seq._file").alias("files"))


@query("store_history", """
SELECT 'o' || o_orderkey AS order_id, 'paid' AS status FROM orders""")
def store_history(t: Tables):
    """Every page of the history landed under two names; it is parsed once."""
    page = F.concat(F.lit('{"orders":[{"name":"o'), F.col("o_orderkey").cast("string"),
                    F.lit('","created_at":"2024-01-01","financial_status":"paid"}]}'))
    once = t.wide("orders").select(page.alias("value"), F.col("o_orderkey").alias("_row"), F.lit("a").alias("_file"))
    twice = once.unionByName(once.withColumn("_file", F.lit("b")))
    feed = FEEDS["store_orders"]
    return feed.rows(feed.records(without_repeated_pages(twice)), F.lit(None).cast("timestamp")).select("order_id", "status")


@query("accounting_changes", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS record, {stamp('o_orderdate')} AS updated_at FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1996-12-31' AND o_orderkey % 5 <> 0""")
def accounting_changes(t: Tables):
    at = F.when(F.col("o_orderkey") % 5 == 0, F.lit("never")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    record = F.struct(F.col("o_orderkey").cast("string").alias("url"), at.alias("updated_at"))
    lines = t.wide("orders").select(F.to_json(F.struct(F.array(record).alias("changes"))).alias("value"))
    moment = lambda s: F.lit(s).cast("timestamp")
    found = changes_of(lines, moment("1996-01-01"), moment("1996-12-31"))
    return found.select(F.col("url").alias("record"), "updated_at")


@query("scan_limit", "SELECT CAST(c_custkey AS VARCHAR) AS customer_id FROM customer ORDER BY 1 LIMIT 25")
def scan_limit(t: Tables):
    rows = t.customer.select(F.col("c_custkey").cast("string").alias("customer_id"))
    return first_rows(FEEDS["store_customers"], rows, 25)


@query("accounting_window", """
SELECT event_type, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND ts <= TIMESTAMP '2024-01-30 00:00:00' GROUP BY event_type""")
def accounting_window(t: Tables):
    start, end = windows.accounting_window(datetime(2024, 1, 30, 12, 0, tzinfo=UTC), days=10)
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return links.between(events, "ts", F.lit(start), F.lit(end)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("center_rules", """
SELECT 'missing center_id' AS rule, 'error' AS severity, count(*) FILTER (WHERE n_nationkey % 3 = 0) AS broken FROM nation""")
def center_rules(t: Tables):
    record = F.struct(F.when(F.col("n_nationkey") % 3 != 0, F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("name"))
    lines = t.nation.select(F.to_json(F.array(record)).alias("value"))
    rows = fulfilment.centers(FEEDS["warehouse_centers"].records(lines))
    return quality.rule_counts(rows, quality.table_rules(TABLES["shipbob_fulfillment_centers"]))


@query("rules_beside", """
SELECT count(*) FILTER (WHERE l_suppkey % 10 <> s) AS broken FROM lineitem
JOIN (SELECT l_orderkey AS o, arg_min(l_suppkey % 10, (l_linenumber, l_suppkey % 10)) AS s FROM lineitem GROUP BY 1) ON o = l_orderkey""")
def rules_beside(t: Tables):
    """A line against the first line of its order."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 10).alias("group"))
    heads = lines.groupBy("l_orderkey").agg(F.min_by("group", F.struct("l_linenumber", "group")).alias("first"))
    both = quality.beside(lines, quality.Reference(heads, ("l_orderkey",), {"head": "first"}))
    return quality.rule_counts(both, [quality.Rule("other group", "group <> head")]).select("broken")


@query("empty_pages_count", "SELECT count(*) AS files FROM orders WHERE o_orderkey % 3 = 0")
def empty_pages_count(t: Tables):
    """A page with an empty list holds no record, yet counts as landed."""
    lines = t.orders.filter("o_orderkey % 3 = 0").select(
        F.lit('{"rows":[]}').alias("value"), F.col("o_orderkey").cast("string").alias("_file"))
    found = pages(lines, p.struct("k"), "rows")
    return found.filter("_record IS NULL AND _reason IS NULL").agg(F.countDistinct("_seq._file").alias("files")).filter(
        F.lit(object_records(lines, p.struct("k"), "rows").limit(1).isEmpty()))
