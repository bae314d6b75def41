"""Business questions, with the given tables in the role of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from entries.registry import Tables, query, stamp
from waybill.operators import links, rollups
from waybill.plans import daily, finance, fulfilment, month

_MONEY = "decimal(15,2)"


def _invoices(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("invoice_id"),
        F.col("o_orderdate").cast("timestamp").alias("dated_on"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_add("o_orderdate", 30)).cast("timestamp").alias("due_on"),
        F.when(F.col("o_orderstatus") == "F", "Paid").otherwise("Sent").alias("status"),
        F.col("o_totalprice").cast(_MONEY).alias("total_value"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice").cast(_MONEY)).otherwise(0).alias("due_value"),
    )


def _store_orders(t: Tables):
    """Orders, fulfilled by the first shipping date of their lines."""
    state = F.when(F.col("o_orderstatus") == "F", "fulfilled").when(F.col("o_orderstatus") == "O", "pending")
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        state.otherwise("error").alias("fulfillment_status"), F.col("o_totalprice").cast(_MONEY).alias("total"),
    )
    return orders


def _shipments(t: Tables):
    return t.lineitem.select(
        F.col("l_orderkey").alias("reference_id"), F.col("l_shipdate").cast("timestamp").alias("shipped_date"))


def _as_of():
    return F.lit("2001-08-02 00:00:00").cast("timestamp")


@query("return_rate", """
SELECT p_brand AS category, count(*) AS returns, count(*) * 100.0 / count(DISTINCT l_orderkey) AS return_rate
FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE l_returnflag = 'R' AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
GROUP BY p_brand""")
def return_rate(t: Tables):
    returns = t.lineitem.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("reference_id"),
        F.array(F.struct(F.col("l_partkey").alias("inventory_id"))).alias("items"),
    )
    products = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("category"))
    orders = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("order_id"))
    return fulfilment.return_rate(returns, products, orders)


@query("center_days", """
SELECT s_suppkey AS center_id, s_name AS name, s_nationkey AS state,
       sum((epoch_us(l_shipdate) - epoch_us(TIMESTAMP '1995-01-01 00:00:00')) // 86400000000) * 1.0::DOUBLE / count(*)
         AS avg_processing_days
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_linestatus = 'F' GROUP BY ALL""")
def center_days(t: Tables):
    returns = t.lineitem.select(
        F.col("l_suppkey").alias("fulfillment_center_id"),
        F.lit("1995-01-01 00:00:00").cast("timestamp").alias("insert_date"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate").cast("timestamp")).alias("completed_date"),
    )
    centers = t.supplier.select(
        F.col("s_suppkey").alias("center_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("state"))
    return fulfilment.center_days(centers, returns)


_RECEIVED_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS wro_id, 'PO' || l_orderkey AS purchase_order_number,
       CAST(sum(e) AS BIGINT) AS expected_total, CAST(sum(r) AS BIGINT) AS received_total,
       sum(r) * 100.0 / nullif(sum(e), 0) AS accuracy_rate
FROM (SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS e,
             l_linenumber AS r FROM lineitem WHERE l_linestatus = 'F'
      UNION ALL SELECT l_orderkey, 0, 1 FROM lineitem WHERE l_linestatus = 'F')
GROUP BY l_orderkey"""


def _receiving(t: Tables):
    def quantity(expected, received):
        return F.struct(expected.alias("expected_quantity"), received.alias("received_quantity"))

    expected = F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_quantity").cast("int"))
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("wro_id"),
        F.concat(F.lit("PO"), "l_orderkey").alias("purchase_order_number"),
        F.when(F.col("l_linestatus") == "F", "Completed").otherwise("Processing").alias("status"),
        F.array(quantity(expected, F.col("l_linenumber")), quantity(F.lit(0), F.lit(1))).alias("inventory_quantities"),
    )


@query("receiving_accuracy", _RECEIVED_SQL)
def receiving_accuracy(t: Tables):
    return fulfilment.receiving_accuracy(_receiving(t))


@query("receiving_accuracy_json", _RECEIVED_SQL)
def receiving_accuracy_json(t: Tables):
    """The same, from the JSON text of the quantities."""
    text = _receiving(t).withColumn("inventory_quantities", F.to_json("inventory_quantities"))
    return fulfilment.receiving_accuracy(text)


@query("revenue_month", f"""
SELECT {stamp("CAST(date_trunc('month', o_orderdate) AS TIMESTAMP)")} AS month, count(*) AS invoice_count,
       CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS total_revenue,
       CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) / count(*) AS avg_invoice_value
FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' GROUP BY 1""")
def revenue_month(t: Tables):
    return finance.revenue_by_month(_invoices(t), F.lit("1996-01-01 00:00:00").cast("timestamp"))


@query("aging", """
SELECT CASE WHEN d <= 30 THEN '0-30 days' WHEN d <= 60 THEN '31-60 days' WHEN d <= 90 THEN '61-90 days'
            ELSE '90+ days' END AS aging_bucket, count(*) AS invoice_count,
       CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS total_outstanding
FROM (SELECT *, CASE WHEN o_orderpriority <> '5-LOW'
                     THEN DATE '2001-08-02' - (CAST(o_orderdate AS DATE) + 30) END AS d FROM orders)
WHERE o_orderstatus <> 'F' AND o_totalprice > 0 GROUP BY 1""")
def aging(t: Tables):
    return finance.receivables_aging(_invoices(t), _as_of())


@query("cash_flow", f"""
SELECT n_name AS bank_account, {stamp("CAST(date_trunc('month', l_shipdate) AS TIMESTAMP)")} AS month,
       CAST(sum(CASE WHEN a > 0 THEN a ELSE 0 END) AS DOUBLE) AS inflows,
       CAST(sum(CASE WHEN a < 0 THEN -a ELSE 0 END) AS DOUBLE) AS outflows, CAST(sum(a) AS DOUBLE) AS net_flow
FROM (SELECT l_suppkey, l_shipdate, CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(15,2))
                                         ELSE CAST(l_extendedprice AS DECIMAL(15,2)) END AS a FROM lineitem)
JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
WHERE l_shipdate >= TIMESTAMP '1996-01-01 00:00:00' GROUP BY 1, 2""")
def cash_flow(t: Tables):
    price = F.col("l_extendedprice").cast(_MONEY)
    moved = t.lineitem.select(
        F.col("l_suppkey").alias("bank_account_id"), F.col("l_shipdate").cast("timestamp").alias("dated_on"),
        F.when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("amount"),
    )
    accounts = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).select(
        F.col("s_suppkey").alias("bank_account_id"), F.col("n_name").alias("name"))
    return finance.cash_flow(moved, accounts, F.lit("1996-01-01 00:00:00").cast("timestamp"))


@query("expense_category", """
SELECT p_partkey AS category_id, p_brand AS category, p_type AS nominal_code, count(*) AS bill_count,
       CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS total_expenses,
       CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) / count(*) AS avg_bill_value
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderstatus = 'F' GROUP BY 1, 2, 3""")
def expense_category(t: Tables):
    """A bill per order, explained by its lines; the part is the category."""
    bills = _invoices(t).select(F.col("invoice_id").cast("bigint").alias("bill_id"), "dated_on", "status", "total_value")
    explained = t.lineitem.select(F.col("l_orderkey").alias("bill_id"), F.col("l_partkey").alias("category_id"))
    categories = t.part.select(
        F.col("p_partkey").alias("category_id"), F.col("p_brand").alias("description"),
        F.col("p_type").alias("nominal_code"))
    return finance.expenses_by_category(
        bills, explained, categories, F.lit("1996-01-01 00:00:00").cast("timestamp"))


_RECENT = "o_orderdate >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 2500 DAY"


@query("fulfillment_day", f"""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS date,
       coalesce(CAST(sum(epoch_us(shipped) - epoch_us(o_orderdate)) AS DOUBLE) / count(shipped) / 3600000000.0, 0)
         AS avg_fulfillment_hours, count(*) AS orders_count,
       count(*) FILTER (WHERE o_orderstatus = 'P') * 100.0 / count(*) AS exception_rate
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS shipped FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
WHERE {_RECENT} GROUP BY 1""")
def fulfillment_day(t: Tables):
    orders = daily.with_fulfilled_at(_store_orders(t), _shipments(t), _as_of(), 2500)
    return daily.fulfilment_by_day(orders, _as_of(), 2500)


@query("delivery_day", f"""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, count(*) FILTER (WHERE o_orderstatus = 'F') AS delivered,
       count(*) FILTER (WHERE o_orderstatus = 'P') AS exceptions,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS in_transit,
       count(*) FILTER (WHERE o_orderstatus = 'P') * 100.0 / count(*) AS exception_rate
FROM orders WHERE {_RECENT} GROUP BY 1""")
def delivery_day(t: Tables):
    return daily.delivery_by_day(_store_orders(t), _as_of(), 2500)


@query("revenue_day", f"""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS revenue,
       count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) / count(*) AS avg_order_value
FROM orders WHERE {_RECENT} AND o_totalprice > 0 GROUP BY 1""")
def revenue_day(t: Tables):
    return daily.revenue_by_day(_store_orders(t), _as_of(), 2500)


@query("system_stats", f"""
SELECT (SELECT count(*) FROM orders) AS total_orders,
       (SELECT count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-01 00:00:00') AS orders_24h,
       (SELECT count(*) FROM part) AS total_products, (SELECT count(*) FROM customer) AS total_customers,
       (SELECT {stamp('max(o_orderdate)')} FROM orders) AS last_order_time,
       (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS pending_orders""")
def system_stats(t: Tables):
    return daily.system_stats(_store_orders(t), t.part, t.customer, _as_of())


_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
            "pages", "benchmark", "labels", "conversations")


@query("table_counts", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows FROM {name}" for name in _COUNTED))
def table_counts(t: Tables):
    return rollups.table_counts({name: getattr(t, name) for name in _COUNTED})


@query("newest_rows", f"""
SELECT o_orderkey, {stamp('o_orderdate')} AS o_orderdate, o_totalprice FROM orders
ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 10""")
def newest_rows(t: Tables):
    return daily.newest(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), "o_orderdate", ["o_orderkey"])


@query("month_report", f"""
SELECT {stamp("CAST(m AS TIMESTAMP)")} AS month, CAST(sum(n) AS BIGINT) AS orders, CAST(sum(v) AS DOUBLE) AS revenue,
       count(*) AS customers, CAST(max(v) AS DOUBLE) AS top_customer_total, sum(f) * 100.0 / sum(n) AS fulfilled_rate
FROM (SELECT date_trunc('month', o_orderdate) AS m, o_custkey, count(*) AS n,
             sum(CAST(o_totalprice AS DECIMAL(15,2))) AS v, count(*) FILTER (WHERE o_orderstatus = 'F') AS f
      FROM orders GROUP BY 1, 2)
GROUP BY m""")
def month_report(t: Tables):
    return month.month_report(_store_orders(t))


@query("stock_health", """
SELECT count(*) AS skus, count(*) FILTER (WHERE q <= 0) AS out_of_stock,
       count(*) FILTER (WHERE q > 0 AND q <= 10) AS low_stock, CAST(sum(q) AS BIGINT) AS units
FROM (SELECT p_size - 5 AS q FROM part)""")
def stock_health(t: Tables):
    return month.stock_health(t.part.select((F.col("p_size") - 5).alias("quantity_on_hand")))


@query("sku_links", """
SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name AS name, CAST(q AS BIGINT) AS quantity_on_hand
FROM part LEFT JOIN (SELECT l_partkey, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY 1)
  ON l_partkey = p_partkey""")
def sku_links(t: Tables):
    products = t.part.select(F.col("p_partkey").cast("string").alias("sku"), F.col("p_name").alias("name"))
    stock = t.lineitem.groupBy(F.col("l_partkey").cast("string").alias("sku")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity_on_hand"))
    return links.with_stock(products, stock).select("sku", "name", "quantity_on_hand")
