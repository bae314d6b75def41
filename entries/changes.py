"""Tables kept as changes, records joined by identity, revenue against the period before."""

from __future__ import annotations

from pyspark.sql import functions as F

from entries.registry import Tables, query
from waybill.operators import identity, picks
from waybill.operators.changes import GONE, PATCH, ROW, resolved
from waybill.plans import daily
from waybill.session import staging

_EVENTS = """
WITH e AS (SELECT user_id % 50 AS k, (event_id // 7) % 40 AS k2, event_id AS seq, CASE event_id % 11 WHEN 0 THEN 'gone' WHEN 1 THEN 'patch' WHEN 2 THEN 'patch'
           ELSE 'row' END AS kind, value, event_type FROM events),
g AS (SELECT *, max(CASE WHEN kind = 'gone' THEN seq END) OVER (PARTITION BY k, k2) AS ended FROM e),
l AS (SELECT * FROM g WHERE kind <> 'gone' AND (ended IS NULL OR seq > ended))"""


@query("change_resolve", f"""
{_EVENTS}
SELECT k, k2, arg_max(value, seq) AS amount, arg_max(event_type, seq) FILTER (WHERE kind = 'row') AS label,
       arg_min(seq, seq) FILTER (WHERE kind = 'row') AS first_at, 'none' AS note
FROM l GROUP BY k, k2 HAVING count(*) FILTER (WHERE kind = 'row') > 0""")
def change_resolve(t: Tables):
    """Whole rows, patches of one column, and ends of rows, resolved per key."""
    at = F.col("event_id")
    kind = F.when(at % 11 == 0, GONE).when((at % 11).isin(1, 2), PATCH).otherwise(ROW)
    changes = t.events.select(
        (F.col("user_id") % 50).alias("k"), (F.floor(at / 7) % 40).alias("k2"), at.alias("_at"), F.lit("r").alias("_run"), kind.alias("_kind"),
        F.when(kind == PATCH, F.array(F.lit("amount"))).otherwise(F.array(*map(F.lit, ("amount", "label", "first_at")))).alias("_set"),
        F.col("value").alias("amount"), F.col("event_type").alias("label"), at.alias("first_at"), F.lit(None).cast("string").alias("note"))
    columns = {"k": "bigint", "k2": "bigint", "amount": "double", "label": "string", "first_at": "bigint", "note": "string"}
    return resolved(changes, ["k", "k2"], columns, ["first_at"], defaults={"note": "'none'"})


@query("identity_groups", """
WITH RECURSIVE r AS (SELECT o_orderkey AS record, CASE WHEN o_orderkey % 10 <> 9 THEN o_orderkey // 2 END AS tracking,
                            CASE WHEN o_orderkey % 10 <> 0 THEN (o_orderkey + 1) // 2 END AS reference FROM orders),
v AS (SELECT record, 't' || tracking AS value FROM r WHERE tracking IS NOT NULL
      UNION SELECT record, 'r' || reference FROM r WHERE reference IS NOT NULL),
near AS (SELECT DISTINCT a.record AS a, b.record AS b FROM v a JOIN v b ON a.value = b.value),
reach AS (SELECT record AS a, record AS b FROM r UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a)
SELECT a AS record, min(b) AS "group" FROM reach GROUP BY a""")
def identity_groups(t: Tables):
    """Orders in chains: each shares a tracking number with one neighbour and a reference with the other."""
    key = F.col("o_orderkey")
    records = t.orders.select(key.alias("record"), F.when(key % 10 != 9, F.floor(key / 2)).alias("tracking"),
                              F.when(key % 10 != 0, F.floor((key + 1) / 2)).alias("reference"))
    return identity.identity_groups(records, "record", ["tracking", "reference"], staging(t.orders.sparkSession))


_AS_OF = "TIMESTAMP '1998-08-01 12:00:00'"
_CHANGE = f"""
WITH s AS (SELECT greatest(0, CAST(floor((epoch_us({_AS_OF}) - epoch_us(o_orderdate) - 1) / (3 * 86400000000.0)) AS INTEGER)) AS period,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS revenue, count(*) AS orders
           FROM orders WHERE o_orderdate <= {_AS_OF} AND o_custkey % 97 = 0 GROUP BY 1),
c AS (SELECT CAST(range AS INTEGER) AS period, coalesce(orders, 0) AS orders, coalesce(revenue, 0) AS revenue
      FROM range(41) LEFT JOIN s ON s.period = range),
d AS (SELECT *, lead(revenue) OVER (ORDER BY period) AS before FROM c)"""


def _few_orders(t: Tables):
    """Orders so few that some periods have none."""
    orders = t.orders.filter("o_custkey % 97 = 0").select(
        F.col("o_orderdate").cast("timestamp").alias("created_at"), F.col("o_totalprice").cast("decimal(15,2)").alias("total"))
    return orders, F.lit("1998-08-01 12:00:00").cast("timestamp")


@query("revenue_change", f"""
{_CHANGE}
SELECT period, orders, revenue, before, CASE WHEN before > 0 THEN (revenue - before) / before END AS change FROM d WHERE period < 40""")
def revenue_change(t: Tables):
    orders, as_of = _few_orders(t)
    return daily.revenue_change(orders, as_of, 3, 40).select("period", "orders", "revenue", "before", "change")


@query("revenue_drops", f"""
{_CHANGE}
SELECT period, revenue, before FROM d WHERE period < 40 AND before > 0 AND (before - revenue) / before * 100 > 20""")
def revenue_drops(t: Tables):
    orders, as_of = _few_orders(t)
    return daily.revenue_drops(orders, as_of, 3, 40).select("period", "revenue", "before")


@query("number_hot_key", """
SELECT l_returnflag, l_extendedprice, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS line_number
FROM (SELECT l_returnflag, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice FROM lineitem)""")
def number_hot_key(t: Tables):
    """Three keys own all lines: their values are numbered in ranges."""
    lines = t.lineitem.select("l_returnflag", F.col("l_extendedprice").cast("double").alias("l_extendedprice"),
                              (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("place"))
    return picks.number_repeats(lines, ["l_returnflag"], "place", many=1000)
