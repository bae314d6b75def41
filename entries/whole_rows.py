"""All columns of the widest records, two records a page: one that holds every field and one that holds its key alone.

A record is given by SQL: for every column of the row the payload's field, its value in Spark, and the outcome in SQL.
A column without a field of its own is told by the field of another.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entries.alerting import _AS_OF, _ORDERS_SQL, _as_of, _orders
from entries.records import _LINES_SQL, _report_text
from entries.registry import Tables, query, stamp
from waybill import functions as fn
from waybill.operators.rollups import settlement_headers
from waybill.plans import alerts
from waybill.schemas import payloads as p
from waybill.sources import accounting, marketplace, store
from waybill.sources.landing import object_records, split_report_lines

Spec = dict[str, tuple[str, str, str]]


def _same(names: str, key: str) -> Spec:
    """Text columns that hold their name and the key."""
    return {n: (n, f"'{n} ' || {key}", f"'{n} ' || {key}") for n in names.split()}


def _money(names: str, source: str, kind: str = "DECIMAL(15,2)") -> Spec:
    return {n: (n, f"CAST({source} AS STRING)", f"CAST(CAST({source} AS {kind}) AS DOUBLE)") for n in names.split()}


def _day(column: str, field: str, source: str) -> Spec:
    return {column: (field, f"date_format({source}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")", stamp(source))}


def _fixed(column: str, field: str, text: str, outcome: str) -> Spec:
    """A time spelled the same on all records."""
    return {column: (field, f"'{text}'", stamp(f"TIMESTAMP '{outcome}'"))}


def _link(column: str, field: str, key: str) -> Spec:
    return {column: (field, f"'https://api.example.com/v2/{field}s/' || {key}", f"CAST({key} AS VARCHAR)")}


def _pairs(df: DataFrame, listed: str, spec: Spec, bare: dict[str, str]) -> DataFrame:
    """Pages ``{listed: [whole record, bare record]}``."""
    fields = {field: F.expr(value) for field, value, _ in spec.values() if field}
    whole = F.struct(*[c.alias(f) for f, c in fields.items()])
    other = F.struct(*[(F.expr(bare[f]) if f in bare else F.when(F.lit(False), c)).alias(f) for f, c in fields.items()])
    return df.select(F.to_json(F.struct(F.array(whole, other).alias(listed))).alias("value"))


def _whole(name: str, table: str, listed: str, record: str, spec: Spec, bare: dict[str, str], outcome: dict[str, str],
           rows: Callable[[DataFrame], DataFrame]) -> None:
    """Register a query of all columns; ``outcome`` has what the bare record gives besides NULL."""
    whole = ", ".join(f"{sql} AS {column}" for column, (_, _, sql) in spec.items())
    other = ", ".join(f"{outcome.get(column, 'NULL')} AS {column}" for column in spec)

    @query(name, f"SELECT {whole} FROM {table} UNION ALL SELECT {other} FROM {table}")
    def build(t: Tables) -> DataFrame:
        found = rows(object_records(_pairs(t.wide(table), listed, spec, bare), record, listed))
        if set(found.columns) - {"_seq", "source"} != set(spec):
            raise AssertionError(f"{name} leaves out {set(found.columns) ^ set(spec)}")
        return found.select(*spec)


def _accounting(name: str, kind: str, table: str, key: str, record: str, spec: Spec, outcome: dict[str, str]) -> None:
    own = accounting.RECORDS[kind].ids
    column = next(iter(own))
    _whole(name, table, kind, record, _link(column, "url", key) | spec, {"url": f"'/v2/{kind}/' || {key} || 'b'"},
           {column: f"{key} || 'b'", **outcome}, lambda records: accounting.rows(kind, records))


_TIMES = _fixed("created_at_api", "created_at", "2020-01-02", "2020-01-02 00:00:00") | _fixed(
    "updated_at_api", "updated_at", "2024-01-15T10:30:00+02:00", "2024-01-15 08:30:00")

_accounting(
    "accounting_contacts_whole", "contacts", "customer", "c_custkey", p.CONTACT,
    _same("organisation_name first_name last_name contact_name_on_invoices email phone_number mobile fax address1 address2"
          " address3 town region postcode country contact_type charge_sales_tax sales_tax_registration_number status",
          "c_custkey")
    | {"default_payment_terms_in_days": ("default_payment_terms_in_days", "CAST(c_nationkey AS STRING)", "c_nationkey"),
       "active_projects_count": ("active_projects_count", "c_nationkey || '.9'", "c_nationkey"),
       "uses_contact_invoice_sequence": ("uses_contact_invoice_sequence", "c_acctbal < 0",
                                         "CASE WHEN c_acctbal < 0 THEN 'True' ELSE 'False' END")}
    | _money("account_balance", "c_acctbal") | _TIMES, {})

_accounting(
    "accounting_bills_whole", "bills", "orders", "o_orderkey", p.BILL,
    _same("reference contact_name status sales_tax_status comments", "o_orderkey")
    | _link("contact_id", "contact", "o_custkey") | _link("project_id", "project", "o_custkey")
    | _money("net_value sales_tax_value total_value paid_value due_value", "o_totalprice")
    | _day("dated_on", "dated_on", "o_orderdate") | _day("due_on", "due_on", "o_orderdate") | _TIMES,
    {"contact_id": "''"})

_accounting(
    "accounting_invoices_whole", "invoices", "orders", "o_orderkey", p.INVOICE,
    _same("reference contact_name currency status sales_tax_status comments", "o_orderkey")
    | _link("contact_id", "contact", "o_custkey") | _link("project_id", "project", "o_custkey")
    | _money("net_value sales_tax_value total_value paid_value due_value net_value_in_base_currency", "o_totalprice")
    | {"exchange_rate": ("exchange_rate", "'1.234567'", "1.234567::DOUBLE"),
       "initial_sales_tax_rate": ("initial_sales_tax_rate", "'20.0'", "20.0::DOUBLE"),
       "payment_terms_in_days": ("payment_terms_in_days", "' 30 '", "30"),
       "outside_of_sales_tax_scope": ("outside_of_sales_tax_scope", "o_orderstatus = 'F'",
                                      "CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END")}
    | _day("dated_on", "dated_on", "o_orderdate") | _day("due_on", "due_on", "o_orderdate") | _TIMES,
    {"contact_id": "''"})

_accounting(
    "accounting_users_whole", "users", "customer", "c_custkey", p.USER,
    _same("email first_name last_name ni_number unique_tax_reference role", "c_custkey")
    | {"permission_level": ("permission_level", "CAST(c_nationkey AS STRING)", "c_nationkey"),
       "current_payroll_profile": ("current_payroll_profile", "named_struct('total', c_nationkey)",
                                   "'{\"total\":' || c_nationkey || '}'")}
    | _money("opening_mileage", "c_acctbal", "DECIMAL(10,2)") | _TIMES, {})

_SENT = "named_struct('tracking_number', {0}, 'tracking_company', {1}, 'tracking_url', {2}, 'updated_at', {3})"
_AT = "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
_whole(
    "store_orders_whole", "orders", "orders", p.STORE_ORDER,
    {"order_id": ("name", "'#' || o_orderkey", "'#' || o_orderkey"),
     "shopify_internal_id": ("id", "CAST(o_orderkey AS STRING)", "CAST(o_orderkey AS VARCHAR)"),
     "status": ("financial_status", "o_orderpriority", "o_orderpriority"),
     "customer_id": ("customer", "named_struct('id', o_custkey)", "CAST(o_custkey AS VARCHAR)"),
     "total_weight": ("total_weight", "o_custkey || '.7'", "nullif(o_custkey, 0)"),
     "order_number": ("order_number", "CAST(o_orderkey AS STRING)", "nullif(o_orderkey, 0)"),
     "billing_address": ("billing_address", "named_struct('city', o_orderstatus, 'zip', o_custkey)",
                         "'{\"city\":\"' || o_orderstatus || '\",\"zip\":' || o_custkey || '}'"),
     "shipping_address": ("shipping_address", "named_struct('zip', o_custkey)", "'{\"zip\":' || o_custkey || '}'"),
     "tracking_number": ("fulfillments", f"array({_SENT.format(chr(39) + 'old' + chr(39), 'NULL', 'NULL', _AT)}, "
                         + _SENT.format("'T' || o_custkey", "o_orderpriority", "'https://t/' || o_custkey", _AT) + ")",
                         "'T' || o_custkey")}
    | _same("fulfillment_status currency email phone tags note confirmation_number referring_site landing_site source_name",
            "o_orderkey")
    | _money("subtotal_price total_tax total_discounts", "o_totalprice", "DECIMAL(12,2)")
    | {"total": ("total_price", "CAST(o_totalprice AS STRING)", "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE)"),
       "carrier": ("", "", "o_orderpriority"), "tracking_url": ("", "", "'https://t/' || o_custkey"),
       "tracking_updated_at": ("", "", stamp("o_orderdate"))}
    | _day("purchase_date", "created_at", "o_orderdate") | _day("updated_at_shopify", "updated_at", "o_orderdate")
    | _day("processed_at", "processed_at", "o_orderdate") | _day("closed_at", "closed_at", "o_orderdate")
    | _day("cancelled_at", "cancelled_at", "o_orderdate"),
    {"id": "o_orderkey || 'b'"},
    {"order_id": "o_orderkey || 'b'", "customer_id": "''", "currency": "''", "tags": "''"}, store.orders)


@query("settlement_periods", f"""
SELECT settlement_id, {stamp('min(posted)')} AS period_start, {stamp('CAST(min(period_end) AS TIMESTAMP)')} AS period_end
FROM ({_LINES_SQL}) GROUP BY settlement_id""")
def settlement_periods(t: Tables):
    lines = marketplace.settlement_lines(split_report_lines(_report_text(t)))
    return settlement_headers(lines, "_seq").select("settlement_id", "period_start", "period_end")


_SPELLED = """CASE page_id % 5 WHEN 0 THEN regexp_replace(url, '^([a-z]+://[^/]*).*$', '{group}') WHEN 1 THEN url || '/a.b.c'
  WHEN 2 THEN url || '?of=/x/1#y' WHEN 3 THEN url || '/' ELSE url END"""


@query("url_link_any", rf"""
SELECT page_id, regexp_replace([x FOR x IN string_split(path, '/') IF regexp_full_match(x, '[A-Za-z0-9_-]+(\.(json|xml|html))?')][-1],
                               '\..*$', '') AS link
FROM (SELECT page_id, regexp_replace(regexp_replace(spelled, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', '') AS path
      FROM (SELECT page_id, {_SPELLED.format(group=chr(92) + '1')} AS spelled FROM pages))""")
def url_link_any(t: Tables):
    """Links of every page, some of the host alone, some that end in a segment that is no id."""
    spelled = F.expr(_SPELLED.format(group="$1"))
    return t.pages.select("page_id", fn.optional_id_from_url(spelled).alias("link"))


@query("stock_alerts_sold_out", """
SELECT 'low_inventory' AS id, CAST(min(p_size - 12) AS DOUBLE) AS metric_value, count(*) AS affected_count FROM part
WHERE p_size <= 22 HAVING count(*) > 0
UNION ALL SELECT 'out_of_stock', count(*), count(*) FROM part WHERE p_size <= 12 HAVING count(*) > 0""")
def stock_alerts_sold_out(t: Tables):
    stock = t.part.select((F.col("p_size") - 12).alias("quantity_on_hand"))
    return alerts.stock_alerts(stock).select("id", "metric_value", "affected_count")


_RECENT = f"seen >= {_AS_OF} - INTERVAL 7 DAY AND seen <= {_AS_OF}"


@query("order_alerts_drop", f"""
SELECT 'revenue_drop' AS id, (before_t - now_t) / before_t AS metric_value, now_n AS affected_count FROM (
  SELECT CAST(coalesce(sum(CASE WHEN pr = '2-HIGH' THEN total ELSE 0 END) FILTER (WHERE {_RECENT}), 0) AS DOUBLE) AS now_t,
         CAST(sum(total) FILTER (WHERE seen >= {_AS_OF} - INTERVAL 14 DAY AND seen < {_AS_OF} - INTERVAL 7 DAY) AS DOUBLE)
           AS before_t, count(*) FILTER (WHERE {_RECENT}) AS now_n FROM ({_ORDERS_SQL}))
WHERE (before_t - now_t) / before_t > 0.2::DOUBLE""")
def order_alerts_drop(t: Tables):
    """Of the last week only refunded orders have a value."""
    recent = F.col("created_at") >= _as_of() - F.make_dt_interval(F.lit(7))
    worth = F.when(recent & (F.col("status") != "refunded"), F.lit(0)).otherwise(F.col("total")).cast("decimal(15,2)")
    found = alerts.order_alerts(_orders(t).withColumn("total", worth), _as_of())
    return found.filter("id = 'revenue_drop'").select("id", "metric_value", "affected_count")
