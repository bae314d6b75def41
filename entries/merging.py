"""Merges, picks, links and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from entries.registry import Tables, query
from waybill.operators import links, merge, picks, reshape, rollups

# An incremental load: the table holds finished and open orders; the batch brings everything placed since 1998 and all
# pending orders, with a corrected total and a new priority (which the merge is told to leave alone).
_TARGET = "o_orderstatus <> 'P'"
_BATCH = "o_orderstatus = 'P' OR o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'"
_BATCH_SQL = f"""
  SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15,2)) + 1 AS total, 'new' AS o_orderpriority
  FROM orders WHERE {_BATCH}"""
_TARGET_SQL = f"""
  SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15,2)) AS total, o_orderpriority
  FROM orders WHERE {_TARGET}"""
_MERGED_SQL = f"""
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CAST(CASE WHEN s.o_orderkey IS NULL THEN t.total ELSE s.total END AS DOUBLE) AS total,
       CASE WHEN t.o_orderkey IS NULL THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
       CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'keep' ELSE 'update' END AS op
FROM ({_TARGET_SQL}) t FULL JOIN ({_BATCH_SQL}) s ON t.o_orderkey = s.o_orderkey"""


def _orders(t: Tables):
    return t.orders.select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(15,2)").alias("total"), "o_orderpriority",
        "o_orderdate",
    )


def _target(t: Tables):
    return _orders(t).filter(_TARGET).drop("o_orderdate")


def _batch(t: Tables):
    changed = _orders(t).filter(_BATCH).drop("o_orderdate")
    return changed.withColumns({
        "total": (F.col("total") + 1).cast("decimal(15,2)"), "o_orderpriority": F.lit("new"),
    })


def _merged(t: Tables, **how):
    return merge.merge(_target(t), _batch(t), ["o_orderkey"], ["total"], **how)


@query("merge_orders", _MERGED_SQL)
def merge_orders(t: Tables):
    return _merged(t, null_safe=False).withColumnRenamed("_op", "op")


@query("merge_counts", f"SELECT op, count(*) AS n FROM ({_MERGED_SQL}) GROUP BY op")
def merge_counts(t: Tables):
    return merge.op_counts(_merged(t, null_safe=False))


@query("merge_default_columns", f"""
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN 0 ELSE t.backordered END AS backordered,
       CASE WHEN t.o_orderkey IS NULL THEN 0 ELSE t.kept END AS kept
FROM (SELECT o_orderkey, 7 AS backordered, 5 AS kept FROM orders WHERE {_TARGET}) t
FULL JOIN (SELECT o_orderkey FROM orders WHERE {_BATCH}) s ON t.o_orderkey = s.o_orderkey""")
def merge_default_columns(t: Tables):
    target = _target(t).select("o_orderkey", F.lit(7).alias("backordered"), F.lit(5).alias("kept"))
    return merge.merge(
        target, _batch(t).select("o_orderkey"), ["o_orderkey"], ["backordered"],
        defaults={"backordered": "0", "kept": "0"}, missing="default", null_safe=False,
    ).drop("_op")


@query("merge_newer_only", """
WITH t AS (SELECT l_orderkey AS k, max(l_shipdate) AS at, 'table' AS origin FROM lineitem
           WHERE l_linestatus = 'F' GROUP BY l_orderkey),
     s AS (SELECT l_orderkey AS k, max(l_shipdate) AS at, 'batch' AS origin FROM lineitem
           WHERE l_linestatus = 'O' GROUP BY l_orderkey)
SELECT coalesce(t.k, s.k) AS l_orderkey,
       strftime(CASE WHEN t.k IS NULL OR s.at >= t.at THEN s.at ELSE t.at END, '%Y-%m-%d %H:%M:%S.%f') AS at,
       CASE WHEN t.k IS NULL OR s.at >= t.at THEN s.origin ELSE t.origin END AS origin
FROM t FULL JOIN s ON t.k = s.k""")
def merge_newer_only(t: Tables):
    def side(status: str, origin: str):
        return t.lineitem.filter(F.col("l_linestatus") == status).groupBy("l_orderkey").agg(
            F.max("l_shipdate").alias("at"), F.lit(origin).alias("origin")
        )

    return merge.merge(
        side("F", "table"), side("O", "batch"), ["l_orderkey"], newer_by="at", null_safe=False
    ).drop("_op")


_HALVES = """
  SELECT user_id, nullif(event_type, 'error') AS kind, count(*) AS n,
         CAST(sum(CAST(value AS DECIMAL(15,2))) AS DOUBLE) AS total
  FROM events WHERE ts {op} TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1, 2"""


@query("merge_null_safe", f"""
SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.kind, s.kind) AS kind,
       CASE WHEN s.n IS NULL THEN t.n ELSE s.n END AS n,
       CASE WHEN s.n IS NULL THEN t.total ELSE s.total END AS total,
       CASE WHEN t.n IS NULL THEN 'insert' WHEN s.n IS NULL THEN 'keep' ELSE 'update' END AS op
FROM ({_HALVES.format(op='<')}) t FULL JOIN ({_HALVES.format(op='>=')}) s
  ON t.user_id = s.user_id AND t.kind IS NOT DISTINCT FROM s.kind""")
def merge_null_safe(t: Tables):
    events = t.events.withColumn("kind", F.nullif("event_type", F.lit("error")))
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")

    def grouped(df):
        return df.groupBy("user_id", "kind").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(15,2)")).alias("total")
        )

    before, after = grouped(events.filter(F.col("ts") < cut)), grouped(events.filter(F.col("ts") >= cut))
    return merge.merge(before, after, ["user_id", "kind"]).withColumnRenamed("_op", "op")


@query("repeated_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def repeated_keys(t: Tables):
    return merge.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("update_only", f"""
SELECT t.o_orderkey, t.o_orderstatus, CAST(coalesce(s.total, t.total) AS DOUBLE) AS total,
       CASE WHEN s.o_orderkey IS NULL THEN 'keep' ELSE 'update' END AS op
FROM ({_TARGET_SQL}) t LEFT JOIN ({_BATCH_SQL}) s ON t.o_orderkey = s.o_orderkey""")
def update_only(t: Tables):
    out = merge.update_only(_target(t).drop("o_orderpriority"), _batch(t), ["o_orderkey"], ["total"])
    return out.withColumnRenamed("_op", "op")


@query("update_only_unmatched", f"""
SELECT count(*) AS dropped FROM orders
WHERE ({_BATCH}) AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE {_TARGET})""")
def update_only_unmatched(t: Tables):
    return merge.unmatched(_batch(t), _target(t), ["o_orderkey"]).agg(F.count(F.lit(1)).alias("dropped"))


@query("delete_missing", f"""
SELECT o_orderkey, CAST(total AS DOUBLE) AS total FROM ({_TARGET_SQL})
WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE {_BATCH})""")
def delete_missing(t: Tables):
    return merge.still_present(_target(t), _batch(t), ["o_orderkey"]).select("o_orderkey", "total")


_LINE_RANK = """l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
  l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"""


@query("latest_per_key", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_RANK}) = 1""")
def latest_per_key(t: Tables):
    return picks.latest_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag",
        "l_linestatus", "l_shipdate",
    )


@query("fold_lines", """
SELECT l_orderkey, l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
       arg_max(l_extendedprice, (l_shipdate, l_linenumber, l_extendedprice)) AS price
FROM lineitem GROUP BY l_orderkey, l_partkey""")
def fold_lines(t: Tables):
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_extendedprice").alias("price"),
        F.struct("l_shipdate", "l_linenumber", "l_extendedprice").alias("seq"),
    )
    return picks.fold_lines(lines, ["l_orderkey", "l_partkey"], ["qty"], ["price"], "seq")


@query("number_repeats", """
SELECT l_suppkey, l_returnflag, l_quantity,
       row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_quantity) AS line_number
FROM lineitem""")
def number_repeats(t: Tables):
    lines = t.lineitem.select("l_suppkey", "l_returnflag", "l_quantity", "l_orderkey")
    return picks.number_repeats(lines, ["l_suppkey", "l_returnflag"], spread_by="l_orderkey")


@query("orphan_drop", """
SELECT count(*) AS lines, count(DISTINCT l_orderkey) AS orders,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS total
FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00')""")
def orphan_drop(t: Tables):
    early = t.orders.filter("o_orderdate < TIMESTAMP_NTZ '1998-01-01 00:00:00'").select(
        F.col("o_orderkey").alias("l_orderkey"))
    kept = links.drop_orphans(t.lineitem, early, "l_orderkey")
    return kept.agg(
        F.count(F.lit(1)).alias("lines"), F.countDistinct("l_orderkey").alias("orders"),
        F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("total"),
    )


@query("orphan_keys", """
SELECT DISTINCT l_orderkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00')""")
def orphan_keys(t: Tables):
    early = t.orders.filter("o_orderdate < TIMESTAMP_NTZ '1998-01-01 00:00:00'").select(
        F.col("o_orderkey").alias("l_orderkey"))
    return links.orphan_keys(t.lineitem, early, "l_orderkey")


@query("sku_filter", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#2' OR p_size > 40)""")
def sku_filter(t: Tables):
    wanted = t.part.filter("p_brand = 'Brand#2' OR p_size > 40").select("p_partkey")
    return links.keep_keys(t.lineitem, "l_partkey", wanted).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("status_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def status_in(t: Tables):
    return links.keep_keys(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"]).select("o_orderkey", "o_orderpriority")


@query("date_filter", """
SELECT l_returnflag, count(*) AS n FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-03-01 00:00:00' AND l_shipdate <= TIMESTAMP '1998-09-02 00:00:00'
GROUP BY l_returnflag""")
def date_filter(t: Tables):
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("1996-03-01 00:00:00", "1998-09-02 00:00:00"))
    return links.between(t.lineitem, "l_shipdate", start, end).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"))


@query("order_links", """
WITH w AS (
  SELECT l_orderkey, l_suppkey, l_linestatus, l_shipdate,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, CAST(l_suppkey AS VARCHAR) DESC,
                            l_linestatus DESC, l_returnflag DESC) AS rn
  FROM lineitem)
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(w.l_suppkey AS VARCHAR) AS shipbob_order_id,
       w.l_linestatus AS warehouse_status, strftime(w.l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS shipped_date
FROM orders LEFT JOIN w ON w.l_orderkey = o_orderkey AND w.rn = 1""")
def order_links(t: Tables):
    orders = t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderdate").alias("purchase_date"))
    shipped = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("reference_id"),
        F.col("l_suppkey").cast("string").alias("shipbob_order_id"),
        F.col("l_linestatus").alias("status"), F.col("l_returnflag").alias("tracking_number"),
        F.lit("carrier").alias("carrier"), F.col("l_shipdate").alias("shipped_date"),
        F.lit(None).cast("timestamp").alias("delivered_date"), F.col("l_shipdate").alias("last_updated_date"),
    )
    return links.order_links(orders, shipped).select("order_id", "shipbob_order_id", "warehouse_status", "shipped_date")


@query("backfill_split", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def backfill_split(t: Tables):
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("source"))
    return reshape.items_of_source(t.lineitem, orders, "F", on="l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("unified_view", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       o_orderstatus AS source
FROM orders""")
def unified_view(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderpriority", F.col("o_orderstatus").alias("source"))
    parts = {s: reshape.of_source(orders, s) for s in ("F", "O", "P")}
    parts["O"] = parts["O"].drop("o_orderpriority")
    return reshape.unified(parts)


@query("fill_default", """
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'shopify') AS storefront FROM orders""")
def fill_default(t: Tables):
    orders = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("storefront"))
    return reshape.fill_default(orders, storefront="shopify")


@query("legacy_columns", """
SELECT CAST(l_partkey AS VARCHAR) AS sku, nullif(l_returnflag, 'N') AS fulfillment_center,
       CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS INTEGER) ELSE l_linenumber END AS quantity_on_hand,
       coalesce(nullif(l_linestatus, 'O'), 'amazon') AS source
FROM lineitem""")
def legacy_columns(t: Tables):
    old = t.lineitem.select(
        F.col("l_partkey").cast("string").alias("sku"), F.nullif("l_returnflag", F.lit("N")).alias("fc"),
        F.col("l_linenumber").alias("on_hand"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("int")).alias("quantity_on_hand"),
        F.nullif("l_linestatus", F.lit("O")).alias("source"),
    )
    return reshape.current_inventory_columns(old).select("sku", "fulfillment_center", "quantity_on_hand", "source")


@query("flat_tracking", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 'T' || o_orderkey END AS tracking_number,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS carrier,
       CASE WHEN o_orderstatus <> 'P' THEN 'http://t/' || o_custkey END AS tracking_url,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS tracking_updated_at
FROM orders""")
def flat_tracking(t: Tables):
    tracking = F.struct(
        F.concat(F.lit("T"), "o_orderkey").alias("tracking_number"), F.col("o_orderpriority").alias("carrier"),
        F.concat(F.lit("http://t/"), "o_custkey").alias("tracking_url"),
    )
    updates = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", tracking).alias("tracking"),
        F.col("o_orderdate").alias("updated_at"),
    )
    return reshape.flat_tracking(updates).drop("updated_at")


@query("inventory_sum", """
SELECT l_partkey AS sku, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS on_hand,
       CAST(sum(l_linenumber) AS BIGINT) AS reserved,
       arg_max(center, seq) FILTER (WHERE center <> '') AS fc,
       arg_min(l_returnflag, seq) AS first_flag
FROM (SELECT *, CASE WHEN l_linestatus = 'F' THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS center,
             (l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_returnflag) AS seq
      FROM lineitem)
GROUP BY l_partkey""")
def inventory_sum(t: Tables):
    lines = t.lineitem.select(
        F.col("l_partkey").alias("sku"), F.col("l_quantity").cast("bigint").alias("on_hand"),
        F.col("l_linenumber").alias("reserved"),
        F.when(F.col("l_linestatus") == "F", "").otherwise(F.col("l_suppkey").cast("string")).alias("fc"),
        F.col("l_returnflag").alias("first_flag"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_returnflag").alias("seq"),
    )
    return rollups.inventory_by_sku(lines, ["on_hand", "reserved"], ["first_flag"], "fc", "seq")


@query("inventory_newest_pull", """
SELECT l_partkey AS sku, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS on_hand, count(*) AS centers
FROM (SELECT *, max(l_shipdate) OVER (PARTITION BY l_partkey) AS newest FROM lineitem)
WHERE l_shipdate = newest GROUP BY l_partkey""")
def inventory_newest_pull(t: Tables):
    pulls = picks.latest_batch(
        t.lineitem.select("l_partkey", "l_quantity", "l_shipdate"), ["l_partkey"], [F.col("l_shipdate")])
    return pulls.groupBy(F.col("l_partkey").alias("sku")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("on_hand"), F.count(F.lit(1)).alias("centers"))


@query("settlement_relanded", """
SELECT l_orderkey AS settlement_id, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS gross,
       count(*) AS line_count
FROM (SELECT *, max(l_returnflag) OVER (PARTITION BY l_orderkey) AS newest FROM lineitem)
WHERE l_returnflag = newest GROUP BY l_orderkey""")
def settlement_relanded(t: Tables):
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("settlement_id"), F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
        F.col("l_returnflag").alias("report"), F.lit("Order").alias("type"), F.lit("Principal").alias("fee_type"),
        F.col("l_shipdate").cast("timestamp").alias("period_start"), F.col("l_shipdate").cast("timestamp").alias("period_end"),
        F.lit("EUR").alias("currency"), F.col("l_linenumber").alias("seq"))
    newest = picks.latest_batch(lines, ["settlement_id"], [F.col("report")])
    return rollups.settlement_headers(newest, "seq").select("settlement_id", "gross", "line_count")
