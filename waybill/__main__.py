"""Command line: load feeds, ask business questions.

    python -m waybill load store_orders --landing /data/landing --warehouse /data/warehouse
    python -m waybill ask receivables_aging --warehouse /data/warehouse
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.change_warehouse import ChangeWarehouse
from waybill.load import Loader
from waybill.operators.links import order_links, with_stock
from waybill.operators.rollups import table_counts
from waybill.plans import alerts, daily, finance, fulfilment, health, month
from waybill.schemas import TABLES
from waybill.session import start
from waybill.sources import FEEDS
from waybill.warehouse import Warehouse

SPECIAL = ("marketplace_settlements", "warehouse_order_status")


Read = Callable[[str], DataFrame]


def store_orders(read: Read, as_of: Column | None = None, days: int = 7, older: bool = False) -> DataFrame:
    """Store orders under the names the daily questions use, with the time they were shipped; all, or of some days.
    ``older`` adds the orders before those days, without that time."""
    orders = read("shopify_orders").withColumns({
        "created_at": F.col("purchase_date"), "updated_at": F.col("updated_at_shopify")})
    return daily.with_fulfilled_at(orders, read("shipbob_orders"), as_of, days, older=older)


def all_alerts(read: Read, as_of: Column, late_days: int = 14) -> DataFrame:
    """All alerts; late shipping is judged on the orders of the last ``late_days``, so only their shipments are joined."""
    return alerts.all_alerts(
        as_of, orders=store_orders(read, as_of, late_days, older=True), inventory=read("shipbob_inventory"),
        feeds=health.feed_health(read("sync_state"), as_of), runs=read("job_executions"))


def questions(read: Read, as_of: Column, since: Column, days: int) -> dict[str, Callable[[], DataFrame]]:
    """All business questions over the tables of one warehouse snapshot."""
    return {
        "return_rate": lambda: fulfilment.return_rate(
            read("shipbob_returns"), read("shipbob_products"), read("shopify_orders")),
        "center_days": lambda: fulfilment.center_days(read("shipbob_fulfillment_centers"), read("shipbob_returns")),
        "receiving_accuracy": lambda: fulfilment.receiving_accuracy(read("shipbob_receiving_orders")),
        "revenue_by_month": lambda: finance.revenue_by_month(read("freeagent_invoices"), since),
        "receivables_aging": lambda: finance.receivables_aging(read("freeagent_invoices"), as_of),
        "cash_flow": lambda: finance.cash_flow(
            read("freeagent_bank_transactions"), read("freeagent_bank_accounts"), since),
        "expenses_by_category": lambda: finance.expenses_by_category(
            read("freeagent_bills"), read("freeagent_bank_transaction_explanations"),
            read("freeagent_categories"), since),
        "fulfilment_by_day": lambda: daily.fulfilment_by_day(store_orders(read, as_of, days), as_of, days),
        "delivery_by_day": lambda: daily.delivery_by_day(store_orders(read), as_of, days),
        "revenue_by_day": lambda: daily.revenue_by_day(store_orders(read), as_of, days),
        "system_stats": lambda: daily.system_stats(
            store_orders(read), read("shipbob_inventory"), read("shopify_customers"), as_of),
        "month_report": lambda: month.month_report(store_orders(read)),
        "stock_health": lambda: month.stock_health(read("shipbob_inventory")),
        "products_with_stock": lambda: with_stock(read("shipbob_products"), read("shipbob_inventory")),
        "order_links": lambda: order_links(read("shopify_orders"), read("shipbob_orders")),
        "feed_health": lambda: health.feed_health(read("sync_state"), as_of),
        "job_health": lambda: health.job_health(read("job_executions"), as_of),
        "recent_jobs": lambda: daily.newest(read("job_executions"), "started_at", ["run_id"], 20),
        "table_counts": lambda: table_counts({name: read(name) for name in TABLES}),
        "alerts": lambda: all_alerts(read, as_of),
        "alert_counts": lambda: alerts.severity_counts(all_alerts(read, as_of)),
    }


def _time(text: str) -> datetime:
    at = datetime.fromisoformat(text)
    return at if at.tzinfo else at.replace(tzinfo=UTC)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="waybill")
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="load the files of a feed that landed since its last load")
    load.add_argument("feed", choices=[*FEEDS, *SPECIAL])
    load.add_argument("--landing", required=True)
    load.add_argument("--full", action="store_true", help="the whole landing folder, not only new files")
    load.add_argument("--changed", action="store_true", help="of all files, the rows changed since the last load")
    load.add_argument("--recent", action="store_true",
                      help="of accounting feeds and settlements, the last days only, as the feed has them")
    load.add_argument("--view", default=None, help="of accounting_users: staff, advisors, active_staff, active_advisors")
    load.add_argument("--wait-hours", type=float, default=None,
                      help="let rows wait so long for the rows of other feeds they hang on, instead of dropping them")
    load.add_argument("--only", action="append", default=[], metavar="COLUMN=VALUE",
                      help="keep rows with this value in a column; several values of one column may be given")
    load.add_argument("--refuse", action="store_true", help="fail on a bad row instead of setting it aside")
    ask = commands.add_parser("ask", help="answer a business question")
    ask.add_argument("question")
    ask.add_argument("--since", type=_time, default=datetime(2024, 1, 1, tzinfo=UTC))
    ask.add_argument("--days", type=int, default=7)
    ask.add_argument("--rows", type=int, default=100)
    for command in (load, ask):
        command.add_argument("--warehouse", required=True)
        command.add_argument("--as-changes", action="store_true", help="the warehouse keeps its tables as their changes")
        command.add_argument("--as-of", type=_time, default=None)
    args = parser.parse_args(argv)

    warehouse = (ChangeWarehouse if args.as_changes else Warehouse)(start(), args.warehouse)
    now = args.as_of or datetime.now(UTC)
    if args.command == "ask":
        known = questions(warehouse.snapshot(), F.lit(now), F.lit(args.since), args.days)
        if args.question not in known:
            parser.error(f"unknown question; one of {', '.join(known)}")
        answer = known[args.question]()
        answer.show(args.rows, truncate=False)
        if answer.limit(args.rows + 1).count() > args.rows:
            print(f"only the first {args.rows} rows; --rows shows more")
        return
    wait = None if args.wait_hours is None else timedelta(hours=args.wait_hours)
    loader = Loader(warehouse, "refuse" if args.refuse else "quarantine", wait)
    group, _, kind = args.feed.partition("_")
    if args.recent and group != "accounting" and args.feed != "marketplace_settlements":
        parser.error("--recent is for accounting feeds and marketplace_settlements")
    if args.view and args.feed != "accounting_users":
        parser.error("--view is for accounting_users")
    if args.feed == "marketplace_settlements":
        outcome = (loader.load_recent_settlements if args.recent else loader.load_settlements)(args.landing, now)
    elif args.feed == "warehouse_order_status":
        outcome = loader.load_status_since_last(args.landing, now)
    else:
        only: dict[str, list[str]] = {}
        for column, _, value in (part.partition("=") for part in args.only):
            only.setdefault(column, []).append(value)
        if args.recent or args.view:
            outcome = loader.load_accounting(kind, args.landing, now, full=not args.recent, view=args.view, only=only)
            for table in outcome.tables:
                print(table)
            return
        load_feed = loader.load if args.full else loader.load_new if args.changed else loader.load_landed
        outcome = load_feed(FEEDS[args.feed], args.landing, now, only=only)
    for table in outcome.tables:
        print(table)


if __name__ == "__main__":
    main()
