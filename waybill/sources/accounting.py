"""Accounting payloads to rows.

The nine record kinds differ only in which columns are ids taken from URLs, flags kept as text, or raw JSON; the rest
follows from the column types of the target table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import (
    bool_text, coerce_int, id_from_url, json_text, money, optional_id_from_url, parse_date,
)
from waybill.schemas import TABLES
from waybill.sources.landing import SEQ

SOURCE = "freeagent"


@dataclass(frozen=True)
class Record:
    """How a record kind fills its table: ``ids`` are "" without a link, ``links`` NULL; both map column to field."""

    table: str
    ids: dict[str, str]
    links: dict[str, str] = field(default_factory=dict)
    flags: tuple[str, ...] = ()
    raw: tuple[str, ...] = ()


RECORDS = {
    "contacts": Record("freeagent_contacts", {"contact_id": "url"}, flags=("uses_contact_invoice_sequence",)),
    "invoices": Record(
        "freeagent_invoices", {"invoice_id": "url", "contact_id": "contact"}, {"project_id": "project"},
        flags=("outside_of_sales_tax_scope",),
    ),
    "bills": Record("freeagent_bills", {"bill_id": "url", "contact_id": "contact"}, {"project_id": "project"}),
    "categories": Record(
        "freeagent_categories", {"category_id": "url"}, {"parent_category_id": "parent_category"},
        flags=("allowable_for_tax", "is_visible"),
    ),
    "bank_accounts": Record(
        "freeagent_bank_accounts", {"bank_account_id": "url"}, {"default_bill_category_id": "default_bill_category"},
        flags=("is_primary", "is_personal", "email_new_transactions"),
    ),
    "bank_transactions": Record(
        "freeagent_bank_transactions", {"transaction_id": "url", "bank_account_id": "bank_account"},
        flags=("is_manual",),
    ),
    "bank_transaction_explanations": Record(
        "freeagent_bank_transaction_explanations",
        {"explanation_id": "url", "bank_transaction_id": "bank_transaction", "bank_account_id": "bank_account"},
        {"category_id": "category", "invoice_id": "invoice", "bill_id": "bill"},
    ),
    "transactions": Record(
        "freeagent_transactions", {"transaction_id": "url"}, {"category_id": "category"},
        raw=("foreign_currency_data",),
    ),
    "users": Record("freeagent_users", {"user_id": "url"}, raw=("current_payroll_profile",)),
}


def rows(kind: str, df: DataFrame) -> DataFrame:
    """Records of one kind as rows of its table, without those whose id cannot be read."""
    record = RECORDS[kind]
    table = TABLES[record.table]

    def value(name: str, type_: str) -> Column:
        if name in record.ids:
            return id_from_url(F.col(record.ids[name]))
        if name in record.links:
            return optional_id_from_url(F.col(record.links[name]))
        if name in record.flags:
            return bool_text(F.col(name))
        if name in record.raw:
            return json_text(F.col(name))
        if name == "source":
            return F.lit(SOURCE)
        if name.endswith("_at_api"):
            return parse_date(F.col(name.removesuffix("_api")))
        if type_ == "timestamp":
            return parse_date(F.col(name))
        if type_ == "int":
            return coerce_int(F.col(name)).try_cast("int")
        if decimal := re.fullmatch(r"decimal\((\d+),(\d+)\)", type_):
            return money(F.col(name), int(decimal[1]), int(decimal[2]))
        return F.col(name)

    columns = [value(n, t).alias(n) for n, t in table.columns.items() if n != "created_at"]
    key = table.key[0]
    return df.select(*columns, *[c for c in (SEQ,) if c in df.columns]).filter(F.col(key) != "")

# Roles counted as staff, and the advisor role.
STAFF_ROLES = ("Owner", "Director", "Partner", "Company Secretary", "Employee", "Shareholder")
ADVISOR_ROLE = "Accountant"


def users_in_view(df: DataFrame, view: str = "all") -> DataFrame:
    """User records of a view: ``all``, ``staff`` or ``advisors``; with ``active_`` only those not hidden."""
    active, _, kind = view.rpartition("_")
    if kind not in ("all", "staff", "advisors") or active not in ("", "active") or view == "active_all":
        raise ValueError(f"unknown view {view!r}")
    if kind == "staff":
        df = df.filter(F.col("role").isin(*STAFF_ROLES))
    elif kind == "advisors":
        df = df.filter(F.col("role") == ADVISOR_ROLE)
    return df.filter(F.coalesce(F.lower("hidden"), F.lit("false")) != "true") if active else df
