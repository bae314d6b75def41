"""Sample payloads of every feed."""

STORE_ORDERS = {"orders": [
    {"id": 880010017, "name": "#A-17", "created_at": "2024-02-01T10:00:00Z", "updated_at": "2024-02-01T11:00:00Z",
     "total_price": "64.20", "currency": "USD", "financial_status": "paid", "fulfillment_status": "fulfilled",
     "customer": {"id": 70071, "email": "a@x.org"}, "tags": ["new", "gift"],
     "billing_address": {"city": "Leeds", "zip": "LS1"},
     "fulfillments": [{"tracking_number": "T1", "tracking_company": "UPS"}, {"tracking_number": None}],
     "line_items": [{"id": 1, "sku": "MUG-BLUE", "quantity": 2, "price": "32.10"}]},
    {"id": 880010018, "name": "#A-18", "created_at": "2024-02-02T10:00:00Z", "updated_at": "2024-02-02T11:00:00Z",
     "total_price": "18.75", "currency": "USD", "financial_status": "pending", "fulfillment_status": None,
     "customer": None, "tags": "a, b",
     "line_items": [{"id": 77, "sku": "", "quantity": 1, "price": "18.75"}]},
]}
STORE_CUSTOMERS = {"customers": [
    {"id": 1, "email": "v@x.org", "created_at": "2023-01-01T00:00:00Z", "updated_at": "2024-02-01T00:00:00Z",
     "total_spent": "412.80", "orders_count": 5, "state": "enabled", "tags": "wholesale,net30"},
    {"id": 2, "email": None, "created_at": "2023-01-01T00:00:00Z", "updated_at": "2024-02-01T00:00:00Z",
     "total_spent": "x", "orders_count": 0, "tags": ""},
    {"id": 3, "created_at": "2023-01-01T00:00:00Z", "updated_at": "2024-02-01T00:00:00Z", "orders_count": -1},
]}
STORE_PRODUCTS = {"products": [
    {"id": 10, "title": "A", "vendor": "V", "created_at": "2023-01-01", "updated_at": "2023-01-02",
     "variants": [
         {"id": 101, "sku": "A-1", "price": "9.99", "weight": 0.25, "inventory_item_id": 5,
          "created_at": "2023-01-01", "updated_at": "2023-01-02"},
         {"id": 102, "sku": "A-2", "price": "19.99", "created_at": "2023-01-01", "updated_at": "2023-01-02"}]},
    {"id": 20, "title": "B", "created_at": "2023-01-01", "updated_at": "2023-01-02",
     "variants": [{"id": 201, "price": "1.00", "created_at": "2023-01-01", "updated_at": "2023-01-02"}]},
]}
MARKET_ORDERS = {"payload": {"Orders": [
    {"AmazonOrderId": "M-501", "PurchaseDate": "2024-02-01T10:00:00Z", "LastUpdateDate": "2024-02-02T00:00:00Z",
     "OrderStatus": "Shipped", "BuyerEmail": "b@m.com", "MarketplaceId": "A1",
     "OrderTotal": {"Amount": "120.40", "CurrencyCode": "EUR"}},
    {"AmazonOrderId": "M-502", "PurchaseDate": "2024-02-01T12:00:00Z", "LastUpdateDate": "2024-02-03T00:00:00Z",
     "OrderStatus": "Pending", "MarketplaceId": "A1"},
    {"AmazonOrderId": "M-503", "PurchaseDate": "2024-02-01T12:00:00Z", "LastUpdateDate": "2024-02-03T00:00:00Z",
     "OrderStatus": "Draft"},
]}}
MARKET_ITEMS = {"payload": {"AmazonOrderId": "M-501", "OrderItems": [
    {"ASIN": "B01", "SellerSKU": "SKU-1", "QuantityOrdered": 2, "ItemPrice": {"Amount": "60.20"},
     "ItemTax": {"Amount": "9.63"}}]}}
MARKET_ITEMS_ORPHAN = {"payload": {"AmazonOrderId": "M-999", "OrderItems": [
    {"ASIN": "B02", "SellerSKU": "SKU-2", "QuantityOrdered": 1}]}}


def stock(sku, on_hand, reserved, inbound, center):
    return {"sellerSku": sku, "asin": "B01", "fnSku": "X01", "totalQuantity": on_hand,
            "fulfillmentCenterDetails": [{"fulfillmentCenterCode": center}],
            "inventoryDetails": {"fulfillableQuantity": on_hand, "reservedQuantity": reserved,
                                 "inboundWorkingQuantity": inbound}}


def stock_page(*summaries):
    return {"payload": {"inventorySummaries": list(summaries)}}


SETTLEMENT_HEADER = [
    "settlement-id", "settlement-start-date", "settlement-end-date", "currency", "transaction-type", "order-id",
    "amount-type", "amount", "posted-date"]
# One line per rule: what was sold, a fee, an income that is no principal, a refund, and a fee of no order.
_S = ["ST-2024-06", "2024-02-07T00:00:00Z", "2024-02-20T23:59:59Z", "EUR"]
SETTLEMENT_ROWS = [
    [*_S, "Order", "M-501", "Principal", "120.40", "2024-02-08T17:05:00Z"],
    [*_S, "Order", "M-501", "Commission", "-18.06", "2024-02-08T17:05:00Z"],
    [*_S, "Order", "M-501", "Shipping", "6.95", "2024-02-08T17:05:00Z"],
    [*_S, "Refund", "M-377", "Principal", "-42.00", "2024-02-11T08:40:00Z"],
    [*_S, "StorageFee", "", "Storage", "-7.30", "2024-02-19T00:00:00Z"],
]


def report(rows):
    return "\n".join("\t".join(r) for r in [SETTLEMENT_HEADER, *rows]) + "\n"


WAREHOUSE_INVENTORY = [
    {"inventory_id": 1, "sku": "TENT-2P", "total_on_hand_quantity": "61.0", "total_sellable_quantity": "70",
     "total_committed_quantity": None},
    {"inventory_id": 2, "sku": "TENT-4P", "total_on_hand_quantity": 36, "total_sellable_quantity": 33,
     "total_fulfillable_quantity": 31, "total_committed_quantity": 3, "total_awaiting_quantity": 0,
     "total_backordered_quantity": 7, "total_exception_quantity": 4, "total_internal_transfer_quantity": 0},
    {"inventory_id": 3, "sku": ""},
]
# Shipped with tracking, not shipped yet, and too old to be asked for.
WAREHOUSE_ORDERS = [
    {"id": 7101, "reference_id": "#A-17", "status": "Processing", "created_date": "2023-01-01T00:00:00Z",
     "last_updated_date": "2023-01-03T00:00:00Z",
     "shipments": [{"id": 1, "status": "Shipped", "shipped_date": "2023-01-02T00:00:00Z",
                    "tracking": {"carrier": "DHL", "carrier_name": "DHL Parcel", "tracking_number": "RX77-40",
                                 "tracking_url": "http://track/1"}, "location": {"id": 1}}],
     "recipient": {"name": "Ada", "email": "ada@x.org"}, "financials": {"total_price": 17.25}},
    {"id": 7102, "reference_id": "web-552", "status": "Processing",
     "created_date": "2023-01-04T00:00:00Z", "last_updated_date": "2023-01-04T00:00:00Z", "shipments": []},
    {"id": 7103, "reference_id": "web-553", "status": "Complete", "created_date": "2022-12-01T00:00:00Z",
     "last_updated_date": "2022-12-01T00:00:00Z"},
]
RETURNS = [
    {"id": 7301, "reference_id": "#A-17", "status": "Completed", "insert_date": "2023-03-04T08:15:00Z",
     "completed_date": "2023-03-09T16:45:00Z", "fulfillment_center": {"id": 1, "name": "Leeds (UK)"},
     "inventory": [{"id": 5001, "name": "Two-person tent", "quantity": 2,
                    "action_requested": {"action": "Quarantine", "instructions": "Check the poles"}}],
     "transactions": [{"amount": 3.4, "transaction_type": "LabelCharge"}]}]
RECEIVING = [
    {"id": 7401, "purchase_order_number": "PO-88", "status": "Completed",
     "insert_date": "2023-02-21T07:30:00Z", "fulfillment_center": {"id": 2, "name": "Ghent (BE)"},
     "inventory_quantities": [{"inventory_id": 5001, "sku": "TENT-2P", "expected_quantity": 40,
                               "received_quantity": 30, "stowed_quantity": 28}],
     "status_history": [{"status": "Arrived", "timestamp": "2023-02-21T07:30:00Z"}]}]
PRODUCTS = [
    {"id": 5001, "name": "Two-person tent", "sku": "TENT-2P", "category": "Camping", "is_case": False,
     "is_lot": True, "variant": {"is_active": True, "hazmat": {"is_hazmat": False}},
     "dimensions": {"length": 42.0, "unit": "cm"}, "value": {}}]
VARIANTS = [{"id": 5101, "product_id": 5001, "name": "Green", "is_active": True},
            {"id": 5102, "product_id": 8888, "name": "of no product"}]
CENTERS = [{"id": 1, "name": "Leeds (UK)", "state": "UK"}, {"id": 2, "name": "Ghent (BE)", "state": "BE"}]

API = "https://api.example.com/v2"
CONTACTS = {"contacts": [
    {"url": f"{API}/contacts/310", "organisation_name": "Harbour Bakery", "account_balance": "-72.30",
     "default_payment_terms_in_days": 30, "uses_contact_invoice_sequence": True,
     "created_at": "invalid-date", "updated_at": "2024-02-03T06:10:00Z"},
    {"url": "", "organisation_name": "No id"}]}
INVOICES = {"invoices": [
    {"url": f"{API}/invoices/611", "reference": "R-9", "dated_on": "2024-01-15", "due_on": "2024-02-14",
     "contact": f"{API}/contacts/310", "total_value": "840.00", "due_value": "840.00", "exchange_rate": "1.0",
     "status": "Sent", "initial_sales_tax_rate": "17.5", "outside_of_sales_tax_scope": False},
    {"url": f"{API}/invoices/612", "dated_on": "2024-01-20", "due_on": "2024-01-30", "total_value": "250.00",
     "due_value": "0", "status": "Paid", "project": f"{API}/projects/9"},
    {"url": f"{API}/invoices/613", "dated_on": "2024-02-20", "total_value": "65.00", "due_value": "65.00",
     "status": "Paid"}]}
CATEGORIES = {"categories": [
    {"url": f"{API}/categories/420", "description": "Postage", "nominal_code": "281",
     "parent_category": f"{API}/categories/400", "allowable_for_tax": True},
    {"url": f"{API}/categories/430", "description": "Repairs", "nominal_code": "290"}]}
BANK_ACCOUNTS = {"bank_accounts": [
    {"url": f"{API}/bank_accounts/1", "name": "Current", "current_balance": "10.00", "is_primary": True}]}
BANK_TRANSACTIONS = {"bank_transactions": [
    {"url": f"{API}/bank_transactions/1", "bank_account": f"{API}/bank_accounts/1", "dated_on": "2024-03-05",
     "amount": "250.00"},
    {"url": f"{API}/bank_transactions/2", "bank_account": f"{API}/bank_accounts/1", "dated_on": "2024-03-06",
     "amount": "-80.25"},
    {"url": f"{API}/bank_transactions/3", "bank_account": f"{API}/bank_accounts/2", "dated_on": "2024-03-06",
     "amount": "-1.00"}]}
BILLS = {"bills": [
    {"url": f"{API}/bills/1", "dated_on": "2024-03-01", "status": "Paid", "total_value": "80.00"},
    {"url": f"{API}/bills/2", "dated_on": "2024-03-02", "status": "Open", "total_value": "5.00"}]}
EXPLANATIONS = {"bank_transaction_explanations": [
    {"url": f"{API}/bank_transaction_explanations/{i}", "bank_transaction": f"{API}/bank_transactions/2",
     "dated_on": "2024-03-06", "category": f"{API}/categories/{c}", "bill": f"{API}/bills/1"}
    for i, c in ((1, 420), (2, 420), (3, 430))]}
TRANSACTIONS = {"transactions": [
    {"url": f"{API}/transactions/1", "nominal_code": "281", "debit_value": "1.00", "dated_on": "2024-03-01",
     "foreign_currency_data": {"currency": "USD", "rate": 1.1}},
    {"url": f"{API}/transactions/2", "nominal_code": "290", "foreign_currency_data": {}, "dated_on": "2024-03-01"}]}
USERS = {"users": [
    {"url": f"{API}/users/1", "role": "Owner", "permission_level": 8, "opening_mileage": "10.5"},
    {"url": f"{API}/users/2", "role": "Accountant", "hidden": True}]}
