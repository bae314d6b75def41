"""Warehouse tables: columns, business key and the columns a merge may overwrite."""

from __future__ import annotations

from dataclasses import dataclass, field

MONEY = "decimal(12,2)"
LEDGER = "decimal(15,2)"
RATE = "decimal(5,2)"
RETURN_ITEMS = (
    "array<struct<inventory_id:string,name:string,quantity:int,action_requested:string,action_instructions:string>>"
)
RECEIVED_ITEMS = (
    "array<struct<inventory_id:string,sku:string,expected_quantity:int,received_quantity:int,stowed_quantity:int>>"
)


@dataclass(frozen=True)
class Table:
    """A keyed table.

    ``frozen`` columns are written on insert and kept on a later match; ``required`` columns may not be NULL, ``wanted`` ones may but are reported;
    ``defaults`` are SQL values of columns a record lacks; ``parent`` names the table and column a child hangs on.
    """

    name: str
    columns: dict[str, str]
    key: tuple[str, ...]
    frozen: tuple[str, ...] = ("source", "created_at_api", "created_at")
    required: tuple[str, ...] = ()
    wanted: tuple[str, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)
    parent: tuple[str, str] | None = None

    @property
    def update(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if c not in self.key and c not in self.frozen)

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.columns.items())


def _columns(spec: str, **types: str) -> dict[str, str]:
    """Column types in order: ``name`` is text, ``name:type`` typed; ``types`` overrides."""
    pairs = (word.partition(":")[::2] for word in spec.split())
    return {name: types.get(name, kind or "string") for name, kind in pairs}


_STAMP = " created_at:timestamp"
_API_STAMPS = " created_at_api:timestamp updated_at_api:timestamp" + _STAMP
_QUANTITIES = (
    " quantity_on_hand:int quantity_available:int quantity_reserved:int quantity_incoming:int"
    " fulfillable_quantity:int backordered_quantity:int exception_quantity:int internal_transfer_quantity:int"
)
_ZERO_QUANTITIES = {w.split(":")[0]: "0" for w in _QUANTITIES.split()}

_ALL = [
    Table(
        "orders",
        _columns(
            "order_id source purchase_date:timestamp status customer_id total currency marketplace_id"
            " shopify_internal_id tracking_number carrier tracking_url tracking_updated_at:timestamp" + _STAMP,
            total=MONEY,
        ),
        ("order_id",),
        frozen=("tracking_number", "carrier", "tracking_url", "tracking_updated_at", "created_at"),
        required=("order_id", "source", "purchase_date"),
    ),
    Table(
        "order_items",
        _columns("order_id sku asin qty:int price tax fee_estimate" + _STAMP,
                 price=MONEY, tax=MONEY, fee_estimate=MONEY),
        ("order_id", "sku"),
        required=("order_id", "sku", "qty"),
        parent=("orders", "order_id"),
    ),
    Table(
        "inventory",
        _columns("sku source" + _QUANTITIES + " asin fnsku fulfillment_center inventory_id inventory_name"
                 " last_updated:timestamp" + _STAMP),
        ("sku", "source"),
        frozen=("created_at",),
        required=("sku", "source", "last_updated"),
        defaults=_ZERO_QUANTITIES,
    ),
    Table(
        "settlements",
        _columns("settlement_id period_start:timestamp period_end:timestamp gross fees refunds net currency" + _STAMP,
                 gross=MONEY, fees=MONEY, refunds=MONEY, net=MONEY),
        ("settlement_id",),
        required=("settlement_id", "currency"),
    ),
    Table(
        "settlement_lines",
        _columns("settlement_id order_id type amount fee_type posted_date:timestamp line_number:bigint" + _STAMP,
                 amount=MONEY),
        ("settlement_id", "order_id", "type", "fee_type", "posted_date", "line_number"),
        required=("settlement_id", "amount"),
        parent=("settlements", "settlement_id"),
    ),
    Table(
        "invoices",
        _columns("invoice_id source amount currency fa_status" + _STAMP, amount=MONEY),
        ("invoice_id",),
        frozen=("created_at",),
        required=("invoice_id",),
    ),
    Table(
        "shopify_orders",
        _columns(
            "order_id shopify_internal_id purchase_date:timestamp status fulfillment_status customer_id total currency"
            " subtotal_price total_tax total_discounts total_weight:int email phone tags note confirmation_number"
            " order_number:int referring_site landing_site source_name processed_at:timestamp closed_at:timestamp"
            " cancelled_at:timestamp updated_at_shopify:timestamp tracking_number carrier tracking_url"
            " tracking_updated_at:timestamp billing_address shipping_address storefront" + _STAMP,
            total=MONEY, subtotal_price=MONEY, total_tax=MONEY, total_discounts=MONEY,
        ),
        ("order_id",),
        frozen=("storefront", "created_at"),
        required=("order_id", "purchase_date"),
        defaults={"storefront": "'shopify'"},
    ),
    Table(
        "shopify_order_items",
        _columns("order_id sku qty:int price" + _STAMP, price=MONEY),
        ("order_id", "sku"),
        required=("order_id", "qty"),
        wanted=("sku",),
        parent=("shopify_orders", "order_id"),
    ),
    Table(
        "shopify_customers",
        _columns(
            "customer_id email first_name last_name created_at:timestamp updated_at:timestamp total_spent"
            " orders_count:int state tags last_order_id last_order_date:timestamp",
            total_spent=MONEY,
        ),
        ("customer_id",),
        frozen=(),
        required=("customer_id", "created_at", "updated_at"),
    ),
    Table(
        "shopify_products",
        _columns("product_id title vendor product_type created_at:timestamp updated_at:timestamp"),
        ("product_id",),
        frozen=(),
        required=("product_id", "created_at", "updated_at"),
    ),
    Table(
        "shopify_variants",
        _columns("variant_id product_id sku price weight inventory_item_id created_at:timestamp updated_at:timestamp",
                 price=MONEY, weight="decimal(8,3)"),
        ("variant_id",),
        frozen=(),
        required=("variant_id", "product_id", "created_at", "updated_at"),
        parent=("shopify_products", "product_id"),
    ),
    Table(
        "shipbob_inventory",
        _columns("sku" + _QUANTITIES + " last_updated:timestamp" + _STAMP),
        ("sku",),
        required=("sku",),
        defaults=_ZERO_QUANTITIES,
    ),
    Table(
        "shipbob_returns",
        _columns(
            "return_id source original_shipment_id reference_id store_order_id status return_type customer_name"
            " tracking_number total_cost fulfillment_center_id fulfillment_center_name items transactions"
            " insert_date:timestamp completed_date:timestamp" + _STAMP,
            total_cost=MONEY, items=RETURN_ITEMS,
        ),
        ("return_id",),
        required=("return_id",),
    ),
    Table(
        "shipbob_receiving_orders",
        _columns(
            "wro_id source purchase_order_number status package_type box_packaging_type fulfillment_center_id"
            " fulfillment_center_name inventory_quantities status_history expected_arrival_date:timestamp"
            " insert_date:timestamp last_updated_date:timestamp" + _STAMP,
            inventory_quantities=RECEIVED_ITEMS,
        ),
        ("wro_id",),
        required=("wro_id",),
    ),
    Table(
        "shipbob_products",
        _columns("product_id source name sku barcode description category is_case is_lot is_active is_bundle"
                 " is_digital is_hazmat dimensions weight value" + _STAMP),
        ("product_id",),
        required=("product_id",),
    ),
    Table(
        "shipbob_variants",
        _columns("variant_id product_id source name sku barcode is_active dimensions weight value" + _STAMP),
        ("variant_id",),
        required=("variant_id", "product_id"),
        parent=("shipbob_products", "product_id"),
    ),
    Table(
        "shipbob_fulfillment_centers",
        _columns("center_id source name address1 address2 city state zip_code country phone_number email timezone"
                 + _STAMP),
        ("center_id",),
        required=("center_id",),
    ),
    Table(
        "shipbob_orders",
        _columns(
            "shipbob_order_id reference_id status created_date:timestamp last_updated_date:timestamp"
            " shipped_date:timestamp delivered_date:timestamp tracking_number carrier recipient_name recipient_email"
            " fulfillment_center_id total_weight total_cost currency shipping_method" + _STAMP,
            total_weight="decimal(10,3)", total_cost=MONEY,
        ),
        ("shipbob_order_id",),
        frozen=("created_date", "created_at"),
        required=("shipbob_order_id",),
        defaults={"currency": "'USD'"},
    ),
    Table(
        "freeagent_contacts",
        _columns(
            "contact_id source organisation_name first_name last_name contact_name_on_invoices email phone_number"
            " mobile fax address1 address2 address3 town region postcode country contact_type"
            " default_payment_terms_in_days:int charge_sales_tax sales_tax_registration_number"
            " active_projects_count:int account_balance uses_contact_invoice_sequence status" + _API_STAMPS,
            account_balance=LEDGER,
        ),
        ("contact_id",),
        required=("contact_id",),
    ),
    Table(
        "freeagent_invoices",
        _columns(
            "invoice_id source reference dated_on:timestamp due_on:timestamp contact_id contact_name net_value"
            " sales_tax_value total_value paid_value due_value currency exchange_rate net_value_in_base_currency"
            " status payment_terms_in_days:int sales_tax_status outside_of_sales_tax_scope initial_sales_tax_rate"
            " comments project_id" + _API_STAMPS,
            net_value=LEDGER, sales_tax_value=LEDGER, total_value=LEDGER, paid_value=LEDGER, due_value=LEDGER,
            exchange_rate="decimal(15,6)", net_value_in_base_currency=LEDGER, initial_sales_tax_rate=RATE,
        ),
        ("invoice_id",),
        required=("invoice_id",),
    ),
    Table(
        "freeagent_bills",
        _columns(
            "bill_id source reference dated_on:timestamp due_on:timestamp contact_id contact_name net_value"
            " sales_tax_value total_value paid_value due_value status sales_tax_status comments project_id"
            + _API_STAMPS,
            net_value=LEDGER, sales_tax_value=LEDGER, total_value=LEDGER, paid_value=LEDGER, due_value=LEDGER,
        ),
        ("bill_id",),
        required=("bill_id",),
    ),
    Table(
        "freeagent_categories",
        _columns("category_id source description nominal_code category_type parent_category_id auto_sales_tax_rate"
                 " allowable_for_tax is_visible group_description" + _STAMP, auto_sales_tax_rate=RATE),
        ("category_id",),
        required=("category_id",),
    ),
    Table(
        "freeagent_bank_accounts",
        _columns("bank_account_id source name bank_name type account_number sort_code iban bic current_balance"
                 " currency is_primary is_personal email_new_transactions default_bill_category_id"
                 " opening_balance_date:timestamp" + _STAMP, current_balance=LEDGER),
        ("bank_account_id",),
        required=("bank_account_id",),
    ),
    Table(
        "freeagent_bank_transactions",
        _columns("transaction_id source bank_account_id dated_on:timestamp amount description bank_reference"
                 " transaction_type running_balance is_manual" + _API_STAMPS, amount=LEDGER, running_balance=LEDGER),
        ("transaction_id",),
        required=("transaction_id",),
    ),
    Table(
        "freeagent_bank_transaction_explanations",
        _columns(
            "explanation_id source bank_transaction_id bank_account_id dated_on:timestamp amount description"
            " category_id category_name foreign_currency_amount foreign_currency_type gross_value sales_tax_rate"
            " sales_tax_value invoice_id bill_id" + _API_STAMPS,
            amount=LEDGER, foreign_currency_amount=LEDGER, gross_value=LEDGER, sales_tax_rate=RATE,
            sales_tax_value=LEDGER,
        ),
        ("explanation_id",),
        required=("explanation_id",),
    ),
    Table(
        "freeagent_transactions",
        _columns("transaction_id source dated_on:timestamp description category_id category_name nominal_code"
                 " debit_value credit_value source_item_url foreign_currency_data" + _API_STAMPS,
                 debit_value=LEDGER, credit_value=LEDGER),
        ("transaction_id",),
        required=("transaction_id",),
    ),
    Table(
        "freeagent_users",
        _columns("user_id source email first_name last_name ni_number unique_tax_reference role permission_level:int"
                 " opening_mileage current_payroll_profile" + _API_STAMPS, opening_mileage="decimal(10,2)"),
        ("user_id",),
        required=("user_id",),
    ),
    Table(
        "amazon_settlements",
        _columns("settlement_id settlement_start_date:timestamp settlement_end_date:timestamp deposit_date:timestamp"
                 " total_amount currency marketplace_id" + _STAMP, total_amount=MONEY),
        ("settlement_id",),
        required=("settlement_id",),
    ),
    Table(
        "amazon_settlement_lines",
        _columns("settlement_id posted_date:timestamp order_id sku description quantity:int amount type fee_type"
                 " line_number:bigint" + _STAMP, amount=MONEY),
        ("settlement_id", "order_id", "type", "fee_type", "posted_date", "line_number"),
        required=("settlement_id",),
        parent=("amazon_settlements", "settlement_id"),
    ),
    Table(
        "sync_state",
        _columns("domain last_synced_at:timestamp last_sync_key status error_count:int error_message sync_metadata"
                 " created_at:timestamp updated_at:timestamp"),
        ("domain",),
        frozen=("created_at",),
        required=("domain",),
    ),
    Table(
        "landed_files",
        _columns("feed file landed_at:timestamp run_id"),
        ("feed", "file", "landed_at"),
        frozen=(),
    ),
    Table(
        "job_executions",
        _columns("run_id job_name status started_at:timestamp completed_at:timestamp duration_seconds"
                 " records_processed:bigint records_inserted:bigint records_updated:bigint error_message metadata"
                 + _STAMP, duration_seconds="decimal(10,2)"),
        ("run_id",),
        required=("run_id", "job_name", "status", "started_at"),
    ),
]

TABLES: dict[str, Table] = {t.name: t for t in _ALL}

#: Where rows wait for the row of another feed they hang on, by the table they are bound for.
WAITING: dict[str, Table] = {
    t.name: Table(f"waiting_{t.name}", {**t.columns, "waiting_since": "timestamp"}, t.key, frozen=())
    for t in _ALL if t.parent
}


def table(name: str) -> Table:
    """A table of the warehouse by its name, or the one where its rows wait."""
    return TABLES[name] if name in TABLES else WAITING[name.removeprefix("waiting_")]
