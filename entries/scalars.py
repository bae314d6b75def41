"""Scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from entries.registry import Tables, query, stamp
from waybill import functions as fn
from waybill.operators import picks, rollups


def _ts(column: str):
    """The given tables carry times without a zone; the library's are UTC."""
    return F.col(column).cast("timestamp")


@query("url_id", r"""
SELECT page_id, coalesce(list_filter(list_transform(
    string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*', ''), '/'),
    lambda s: regexp_replace(s, '\.(json|xml|html)$', '')),
    lambda s: regexp_full_match(s, '[A-Za-z0-9_-]+'))[-1], '') AS id
FROM pages""")
def url_id(t: Tables):
    return t.pages.select("page_id", fn.id_from_url(F.col("url")).alias("id"))


@query("url_link", r"""
SELECT page_id, nullif(regexp_extract(url, '://[^/]*/([A-Za-z0-9_-]+)/([0-9]+)', 2), '') AS link FROM pages
WHERE regexp_matches(url, '^[a-z]+://[^/]*/[A-Za-z0-9_-]+/[0-9]+(\.html|/)?([?#].*)?$')""")
def url_link(t: Tables):
    shaped = t.pages.filter(F.col("url").rlike(r"^[a-z]+://[^/]*/[A-Za-z0-9_-]+/[0-9]+(\.html|/)?([?#].*)?$"))
    return shaped.select("page_id", fn.optional_id_from_url(F.col("url")).alias("link"))


@query("date_parse", f"""
SELECT o_orderkey, {stamp('''CASE o_orderpriority WHEN '5-LOW' THEN NULL
  WHEN '4-NOT SPECIFIED' THEN o_orderdate - INTERVAL 330 MINUTE ELSE o_orderdate END''')} AS parsed
FROM orders""")
def date_parse(t: Tables):
    spelled = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm'+0530'"))
        .otherwise(F.date_format("o_orderdate", "yyyy"))
    )
    return t.orders.select("o_orderkey", fn.parse_date(spelled).alias("parsed"))


@query("iso_text", """
SELECT event_id, CASE WHEN date_trunc('second', ts) = ts THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS iso,
       strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS iso_hour
FROM events""")
def iso_text(t: Tables):
    return t.events.select(
        "event_id", fn.iso_text(_ts("ts")).alias("iso"), fn.iso_text(fn.align(_ts("ts"), "hour")).alias("iso_hour"))


@query("iso_round_trip", f"SELECT event_id, {stamp('ts')} AS ts FROM events")
def iso_round_trip(t: Tables):
    return t.events.select("event_id", fn.parse_date(fn.iso_text(_ts("ts"))).alias("ts"))


@query("align_time", f"""
SELECT event_id, {stamp("date_trunc('minute', ts)")} AS at_minute, {stamp("date_trunc('hour', ts)")} AS at_hour,
       {stamp("CAST(date_trunc('day', ts) AS TIMESTAMP)")} AS at_day
FROM events""")
def align_time(t: Tables):
    return t.events.select(
        "event_id", *[fn.align(_ts("ts"), unit).alias(f"at_{unit}") for unit in ("minute", "hour", "day")])


@query("duration_text", """
SELECT event_id, CASE
  WHEN s < 60 THEN s || 's'
  WHEN s < 3600 THEN (s // 60) || 'm' || (s % 60) || 's'
  WHEN s < 86400 THEN (s // 3600) || 'h' || (s % 3600) // 60 || 'm'
  ELSE (s // 86400) || 'd' || (s % 86400) // 3600 || 'h' END AS duration
FROM (SELECT event_id, CAST(CASE WHEN event_type = 'error' THEN -value WHEN event_type = 'view' THEN value * 10000
                            ELSE value * 100 END AS BIGINT) AS s FROM (
      SELECT event_id, event_type, trunc(value) AS value FROM events))""")
def duration_text(t: Tables):
    whole = F.col("value").cast("bigint")
    seconds = F.when(F.col("event_type") == "error", -whole).when(F.col("event_type") == "view", whole * 10000)
    return t.events.select("event_id", fn.duration_text(seconds.otherwise(whole * 100)).alias("duration"))


@query("time_differences", """
SELECT event_id, (epoch_us(TIMESTAMP '2024-01-15 12:00:00') - epoch_us(ts)) / 3600000000.0 AS hours,
       CAST(trunc((epoch_us(TIMESTAMP '2024-01-15 12:00:00') - epoch_us(ts)) / 86400000000.0) AS BIGINT) AS days,
       CAST(DATE '2024-01-15' - CAST(ts AS DATE) AS BIGINT) AS calendar_days
FROM events""")
def time_differences(t: Tables):
    moment = F.lit("2024-01-15 12:00:00").cast("timestamp")
    return t.events.select(
        "event_id", fn.hours_between(_ts("ts"), moment).alias("hours"), fn.whole_days(_ts("ts"), moment).alias("days"),
        fn.day_difference(_ts("ts"), moment).cast("bigint").alias("calendar_days"),
    )


@query("coerce_int", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT)
            ELSE CAST(trunc(l_extendedprice) AS BIGINT) END AS n,
       CASE WHEN l_returnflag = 'N' THEN 0 WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT)
            ELSE CAST(trunc(l_extendedprice) AS BIGINT) END AS n_or_zero
FROM lineitem""")
def coerce_int(t: Tables):
    text = (
        F.when(F.col("l_returnflag") == "N", F.concat(F.lit("x"), F.col("l_quantity")))
        .when(F.col("l_returnflag") == "A", F.col("l_quantity").cast("bigint").cast("string"))
        .otherwise(F.col("l_extendedprice").cast("string"))
    )
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", fn.coerce_int(text).alias("n"),
        fn.coerce_int_or_zero(text).alias("n_or_zero"),
    )


@query("decimal_parse", """
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '5-LOW' THEN NULL
                        ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS DOUBLE) AS total
FROM orders""")
def decimal_parse(t: Tables):
    text = (
        F.when(F.col("o_orderstatus") == "P", "  ")
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("EUR "), F.col("o_totalprice")))
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    return t.orders.select("o_orderkey", fn.money(text).alias("total"))


@query("clamp_zero", "SELECT c_custkey, greatest(c_acctbal, 0) AS balance FROM customer")
def clamp_zero(t: Tables):
    return t.customer.select("c_custkey", fn.clamp_zero(F.col("c_acctbal")).alias("balance"))


@query("safe_ratio", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_tax * 100.0 / nullif(l_discount, 0) AS pct,
       l_tax / nullif(l_discount, 0) AS share
FROM lineitem""")
def safe_ratio(t: Tables):
    tax, discount = F.col("l_tax"), F.col("l_discount")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", fn.percent(tax, discount).alias("pct"),
        fn.ratio(tax, discount).alias("share"))


@query("json_out", """
SELECT event_id, CASE WHEN event_type IN ('error', 'view', 'click') THEN NULL ELSE props END AS props FROM events""")
def json_out(t: Tables):
    raw = (
        F.when(F.col("event_type") == "error", "{ }").when(F.col("event_type") == "view", "[]")
        .when(F.col("event_type") == "click", "null").otherwise(F.col("props"))
    )
    return t.events.select("event_id", fn.json_text(raw).alias("props"))


@query("tags_split", """
SELECT p_partkey, array_to_string(tags, '|') AS tags, CASE WHEN len(tags) > 0 THEN CAST(to_json(tags) AS VARCHAR) END
  AS tags_json
FROM (SELECT p_partkey, list_filter(list_transform(string_split(
  CASE WHEN p_size = 1 THEN ' , ' ELSE p_type || ' , ' || p_name || ',, ' || p_brand END, ','), lambda s: trim(s)),
  lambda s: s <> '') AS tags FROM part)""")
def tags_split(t: Tables):
    text = F.when(F.col("p_size") == 1, " , ").otherwise(
        F.concat("p_type", F.lit(" , "), "p_name", F.lit(",, "), "p_brand"))
    tags = fn.split_tags(text)
    return t.part.select("p_partkey", F.array_join(tags, "|").alias("tags"), fn.tags_to_json(tags).alias("tags_json"))


@query("bool_text", """
SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_quantity > 25 THEN 'True' ELSE 'False' END AS title,
       CASE WHEN l_quantity > 25 THEN 'true' ELSE 'false' END AS lower
FROM lineitem""")
def bool_text(t: Tables):
    big = F.col("l_quantity") > 25
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", fn.bool_text(big).alias("title"),
        fn.bool_text(big, "lower").alias("lower"))


@query("status_map", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       CASE l_returnflag WHEN 'R' THEN 'exception' WHEN 'A' THEN 'shipped'
            ELSE CASE l_linestatus WHEN 'F' THEN 'delivered' ELSE 'unknown' END END AS status
FROM lineitem""")
def status_map(t: Tables):
    shipment = F.when(F.col("l_returnflag") == "R", "Exception").when(F.col("l_returnflag") == "A", "Shipped")
    order = F.when(F.col("l_linestatus") == "F", "Complete").otherwise("Odd")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", fn.order_status(order, shipment).alias("status"))


@query("blank_to_null", """
SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE event_type END AS kind,
       CASE WHEN event_type = 'click' THEN '' WHEN event_type = 'view' THEN '  ' ELSE '  ' || event_type || ' ' END
         AS kind_text
FROM events""")
def blank_to_null(t: Tables):
    kind = (
        F.when(F.col("event_type") == "view", "  ")
        .when(F.col("event_type") != "click", F.concat(F.lit("  "), "event_type", F.lit(" ")))
    )
    return t.events.select(
        "event_id", fn.blank_to_null(kind).alias("kind"), fn.text_or_blank(kind).alias("kind_text"))


def _shipments(t: Tables):
    """Three shipments per line; each may lack tracking."""

    def shipment(tracking: str, no_tracking, weight):
        found = F.struct(F.when(~no_tracking, F.lit(tracking)).otherwise("").alias("tracking"), weight.alias("weight"))
        return F.when(F.col("l_quantity") > 0, found)

    return t.lineitem.withColumn("shipments", F.array(
        shipment("first", F.col("l_returnflag") == "R", F.col("l_quantity")),
        shipment("second", F.col("l_linestatus") == "F", F.col("l_tax")),
        shipment("third", F.col("l_quantity") < 40, F.col("l_discount")),
    ))


@query("last_match", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       CASE WHEN l_quantity >= 40 THEN 'third' WHEN l_linestatus <> 'F' THEN 'second'
            WHEN l_returnflag <> 'R' THEN 'first' END AS tracking
FROM lineitem""")
def last_match(t: Tables):
    found = picks.last_match(F.col("shipments"), lambda s: s["tracking"] != "")
    return _shipments(t).select("l_orderkey", "l_linenumber", "l_extendedprice", found["tracking"].alias("tracking"))


@query("first_match", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity AS first_weight, l_discount AS last_weight
FROM lineitem""")
def first_match(t: Tables):
    shipments = F.col("shipments")
    return _shipments(t).select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        picks.first_element(shipments)["weight"].alias("first_weight"),
        picks.last_element(shipments)["weight"].alias("last_weight"),
    )


@query("array_sum", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       CAST(CASE WHEN l_returnflag = 'N' THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(15,2))
            + CASE WHEN l_linestatus = 'F' THEN 0 ELSE CAST(l_quantity AS DECIMAL(15,2)) END END AS DOUBLE) AS total
FROM lineitem""")
def array_sum(t: Tables):
    def amount(value):
        return F.struct(value.cast("string").alias("amount"))

    amounts = F.when(F.col("l_returnflag") != "N", F.array(
        amount(F.col("l_extendedprice")),
        amount(F.when(F.col("l_linestatus") == "F", F.lit("none")).otherwise(F.col("l_quantity").cast("string"))),
    ))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", rollups.amount_total(amounts).alias("total"))
