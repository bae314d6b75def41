"""Row rules, quarantine and batch statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from entries.registry import Tables, query
from waybill.operators import quality, rollups
from waybill.operators.merge import op_counts, update_only

_RULES = [
    quality.required("c_mktsegment"),
    quality.Rule("invalid balance", "c_acctbal < 0"),
    quality.Rule("unknown nation", "c_nationkey = 0", "warning"),
    quality.not_negative("orders_count"),
]


def _customers(t: Tables):
    """Customers with some fields blanked by their own values."""
    return t.customer.select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"), "c_acctbal", "c_nationkey",
        F.when(F.col("c_nationkey") > 20, F.lit(None)).otherwise(F.col("c_nationkey") - 1).alias("orders_count"),
    )


_BROKEN_SQL = """
  SELECT c_custkey, c_mktsegment = 'BUILDING' AS no_segment, c_acctbal < 0 AS negative, c_nationkey = 0 AS nation,
         c_nationkey > 20 OR c_nationkey - 1 < 0 AS bad_count FROM customer"""


@query("validate_rules", f"""
SELECT c_custkey,
       array_to_string(list_filter([CASE WHEN no_segment THEN 'missing c_mktsegment' END,
         CASE WHEN negative THEN 'invalid balance' END, CASE WHEN bad_count THEN 'invalid orders_count' END],
         lambda x: x IS NOT NULL), ';') AS errors,
       CASE WHEN nation THEN 'unknown nation' ELSE '' END AS warnings
FROM ({_BROKEN_SQL})""")
def validate_rules(t: Tables):
    return quality.checked(_customers(t), _RULES).select(
        "c_custkey", F.array_join("errors", ";").alias("errors"), F.array_join("warnings", ";").alias("warnings"))


@query("valid_rows", f"SELECT c_custkey FROM ({_BROKEN_SQL}) WHERE NOT (no_segment OR negative OR bad_count)")
def valid_rows(t: Tables):
    return quality.valid(_customers(t), _RULES).select("c_custkey")


@query("quarantine", f"""
SELECT c_custkey, CAST(no_segment AS INTEGER) + CAST(negative AS INTEGER) + CAST(bad_count AS INTEGER) AS reasons
FROM ({_BROKEN_SQL}) WHERE no_segment OR negative OR bad_count""")
def quarantine(t: Tables):
    return quality.quarantined(_customers(t), _RULES).select("c_custkey", F.size("errors").alias("reasons"))


@query("rule_counts", f"""
SELECT 'missing c_mktsegment' AS rule, 'error' AS severity, count(*) FILTER (WHERE no_segment) AS broken
FROM ({_BROKEN_SQL}) UNION ALL
SELECT 'invalid balance', 'error', count(*) FILTER (WHERE negative) FROM ({_BROKEN_SQL}) UNION ALL
SELECT 'unknown nation', 'warning', count(*) FILTER (WHERE nation) FROM ({_BROKEN_SQL}) UNION ALL
SELECT 'invalid orders_count', 'error', count(*) FILTER (WHERE bad_count) FROM ({_BROKEN_SQL})""")
def rule_counts(t: Tables):
    return quality.rule_counts(_customers(t), _RULES)


@query("settlement_rules", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25) AND l_returnflag <> 'N'""")
def settlement_rules(t: Tables):
    """A line is good if its amount is there and its id is that of a header."""
    headers = t.part.filter("p_size > 25").select(F.col("p_partkey").alias("header_id"))
    lines = t.lineitem.withColumn("amount", F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice")))
    checked = lines.join(headers, F.col("l_partkey") == F.col("header_id"), "left")
    rules = [
        quality.required("amount", "decimal(12,2)"),
        quality.Rule("mismatched settlement", "header_id IS NULL"),
    ]
    return quality.valid(checked, rules).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("stats_row", """
SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS total_cost,
       count(DISTINCT nullif(l_partkey, 0)) AS purchase_orders, count(*) FILTER (WHERE l_linestatus = 'F') AS tracked,
       count(*) AS processed
FROM lineitem""")
def stats_row(t: Tables):
    cost = F.col("l_extendedprice").cast("decimal(15,2)")
    return rollups.batch_stats(
        t.lineitem,
        total_cost=F.sum(F.when(F.col("l_returnflag") == "R", cost)),
        purchase_orders=F.countDistinct(F.nullif("l_partkey", F.lit(0))),
        tracked=F.count(F.when(F.col("l_linestatus") == "F", 1)),
        processed=F.count(F.lit(1)),
    )


@query("update_stats", """
SELECT CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 'update' ELSE 'keep' END
  AS op, count(*) AS n FROM orders GROUP BY 1""")
def update_stats(t: Tables):
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    batch = returned.withColumn("o_orderstatus", F.lit("R"))
    return op_counts(update_only(t.orders, batch, ["o_orderkey"], ["o_orderstatus"]))
