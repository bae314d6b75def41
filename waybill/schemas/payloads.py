"""Payload record schemas as DDL.

Only the nesting is typed. Every scalar is read as text, because feeds send the same field as number, text or boolean
("95.0", 95, true) and a typed read would turn a whole record into NULLs; the normalizers cast. Fields whose inner
shape is open (addresses, dimensions, currency data) are read as raw JSON text, so no unknown key is lost.
"""

from __future__ import annotations


def struct(*fields: str) -> str:
    """DDL of a struct; a bare name is a text field, ``name=ddl`` a nested one."""
    return f"struct<{_fields(fields)}>"


def array(ddl: str) -> str:
    return f"array<{ddl}>"


def _fields(fields: tuple[str, ...]) -> str:
    words = [w for f in fields for w in (f.split() if "=" not in f else [f])]
    return ", ".join(f"`{w.split('=', 1)[0]}`: {w.split('=', 1)[1]}" if "=" in w else f"`{w}`: string" for w in words)


# --- store ---------------------------------------------------------------------------------------------------------
STORE_LINE_ITEM = struct("id sku quantity price")
STORE_ORDER = struct(
    "id name created_at updated_at total_price currency financial_status fulfillment_status",
    "subtotal_price total_tax total_discounts total_weight order_number phone email contact_email note",
    "confirmation_number referring_site landing_site source_name processed_at closed_at cancelled_at tags",
    "billing_address shipping_address",
    "customer=" + struct("id email"),
    "fulfillments=" + array(struct("tracking_number tracking_company tracking_url updated_at")),
    "line_items=" + array(STORE_LINE_ITEM),
)
STORE_CUSTOMER = struct(
    "id email first_name last_name created_at updated_at total_spent orders_count state tags",
    "last_order_id last_order_name",
)
STORE_VARIANT = struct("id product_id sku price weight inventory_item_id created_at updated_at")
STORE_PRODUCT = struct(
    "id title vendor product_type created_at updated_at", "variants=" + array(STORE_VARIANT)
)

# --- marketplace ---------------------------------------------------------------------------------------------------
_AMOUNT = struct("Amount CurrencyCode")
MARKET_ORDER = struct(
    "AmazonOrderId PurchaseDate LastUpdateDate OrderStatus BuyerEmail MarketplaceId", "OrderTotal=" + _AMOUNT
)
MARKET_ITEM = struct(
    "ASIN SellerSKU QuantityOrdered", "ItemPrice=" + _AMOUNT, "ItemTax=" + _AMOUNT
)
MARKET_INVENTORY = struct(
    "asin sellerSku fnSku totalQuantity",
    "fulfillmentCenterDetails=" + array(struct("fulfillmentCenterCode")),
    "inventoryDetails=" + struct("fulfillableQuantity reservedQuantity inboundWorkingQuantity"),
)

# --- fulfilment (third-party warehouse) ----------------------------------------------------------------------------
_CENTER_REF = struct("id name")
WAREHOUSE_INVENTORY = struct(
    "inventory_id sku name total_on_hand_quantity total_sellable_quantity total_fulfillable_quantity",
    "total_committed_quantity total_awaiting_quantity total_backordered_quantity total_exception_quantity",
    "total_internal_transfer_quantity",
    "inventory=" + struct("id name"),
    "fulfillment_center_locations=" + array(struct(
        "fulfillment_center=" + _CENTER_REF,
        "quantity_on_hand quantity_available quantity_committed quantity_incoming quantity_fulfillable",
        "quantity_backordered quantity_exception quantity_internal_transfer",
    )),
)
WAREHOUSE_ORDER = struct(
    "id reference_id status created_date last_updated_date shipping_method",
    "shipments=" + array(struct(
        "id status shipped_date delivery_date",
        "tracking=" + struct("carrier carrier_name tracking_number tracking_url"),
        "location=" + struct("id"),
    )),
    "recipient=" + struct("name email"),
    "financials=" + struct("total_price"),
)
WAREHOUSE_RETURN = struct(
    "id reference_id store_order_id status return_type customer_name tracking_number original_shipment_id",
    "insert_date completed_date transactions",
    "fulfillment_center=" + _CENTER_REF,
    "inventory=" + array(struct("id name quantity", "action_requested=" + struct("action instructions"))),
)
WAREHOUSE_RECEIVING = struct(
    "id purchase_order_number status package_type box_packaging_type expected_arrival_date insert_date",
    "last_updated_date status_history",
    "fulfillment_center=" + _CENTER_REF,
    "inventory_quantities=" + array(struct("inventory_id sku expected_quantity received_quantity stowed_quantity")),
)
WAREHOUSE_PRODUCT = struct(
    "id name sku barcode description category is_case is_lot dimensions weight value",
    "variant=" + struct("is_active is_bundle is_digital", "hazmat=" + struct("is_hazmat")),
)
WAREHOUSE_VARIANT = struct("id product_id name sku barcode is_active dimensions weight value")
WAREHOUSE_CENTER = struct(
    "id name address1 address2 city state zip_code country phone_number email timezone"
)

# --- accounting ----------------------------------------------------------------------------------------------------
CONTACT = struct(
    "url organisation_name first_name last_name contact_name_on_invoices email phone_number mobile fax address1",
    "address2 address3 town region postcode country contact_type default_payment_terms_in_days charge_sales_tax",
    "sales_tax_registration_number active_projects_count account_balance uses_contact_invoice_sequence status",
    "created_at updated_at",
)
INVOICE = struct(
    "url reference dated_on due_on contact project contact_name net_value sales_tax_value total_value paid_value",
    "due_value currency exchange_rate net_value_in_base_currency status payment_terms_in_days sales_tax_status",
    "outside_of_sales_tax_scope initial_sales_tax_rate comments created_at updated_at",
)
BILL = struct(
    "url reference dated_on due_on contact project contact_name net_value sales_tax_value total_value paid_value",
    "due_value status sales_tax_status comments created_at updated_at",
)
CATEGORY = struct(
    "url description nominal_code category_type parent_category auto_sales_tax_rate allowable_for_tax is_visible",
    "group_description",
)
BANK_ACCOUNT = struct(
    "url name bank_name type account_number sort_code iban bic current_balance currency is_primary is_personal",
    "email_new_transactions default_bill_category opening_balance_date",
)
BANK_TRANSACTION = struct(
    "url bank_account dated_on amount description bank_reference transaction_type running_balance is_manual",
    "created_at updated_at",
)
EXPLANATION = struct(
    "url bank_transaction bank_account category invoice bill dated_on amount description category_name",
    "foreign_currency_amount foreign_currency_type gross_value sales_tax_rate sales_tax_value created_at updated_at",
)
LEDGER_TRANSACTION = struct(
    "url category dated_on description category_name nominal_code debit_value credit_value source_item_url",
    "foreign_currency_data created_at updated_at",
)
USER = struct(
    "url email first_name last_name ni_number unique_tax_reference role permission_level opening_mileage hidden",
    "current_payroll_profile created_at updated_at",
)
CHANGE = struct("url resource_type event_type dated_on created_at updated_at")

# Columns of a settlement report, by header name. Fixed values.
SETTLEMENT_HEADERS = (
    "settlement-id", "settlement-start-date", "settlement-end-date", "currency", "transaction-type", "order-id",
    "amount-type", "amount", "posted-date",
)
