"""Fixture rows of the reference's unit data, used for golden tests.

Fixed values: these rows must equal the reference's so the golden numbers
(FIXTURES.md §3) hold.
"""

TXN_COLUMNS = ["transaction_id", "amount", "status", "merchant_id", "customer_id", "transaction_date",
               "payment_method"]
TXN_DDL = ("transaction_id STRING, amount DOUBLE, status STRING, merchant_id STRING, customer_id STRING, "
           "transaction_date DATE, payment_method STRING")

# 14 clean transactions.
TRANSACTIONS_CLEAN = [
    ("TXN001", 450.00, "COMPLETED", "M001", "C001", "2024-01-15", "UPI"),
    ("TXN002", 1200.50, "COMPLETED", "M002", "C002", "2024-01-15", "CREDIT_CARD"),
    ("TXN003", 89.00, "FAILED", "M003", "C003", "2024-01-16", "DEBIT_CARD"),
    ("TXN004", 3200.00, "COMPLETED", "M004", "C001", "2024-01-16", "CREDIT_CARD"),
    ("TXN005", 250.00, "PENDING", "M001", "C004", "2024-01-17", "UPI"),
    ("TXN006", 175.50, "COMPLETED", "M005", "C002", "2024-01-17", "UPI"),
    ("TXN007", 540.00, "FAILED", "M006", "C005", "2024-01-18", "DEBIT_CARD"),
    ("TXN008", 890.00, "COMPLETED", "M002", "C003", "2024-01-18", "CREDIT_CARD"),
    ("TXN009", 65.00, "COMPLETED", "M007", "C006", "2024-01-19", "UPI"),
    ("TXN010", 1450.00, "COMPLETED", "M008", "C001", "2024-01-19", "CREDIT_CARD"),
    ("TXN012", 780.00, "COMPLETED", "M004", "C002", "2024-01-21", "CREDIT_CARD"),
    ("TXN014", 990.00, "COMPLETED", "M006", "C003", "2024-01-23", "DEBIT_CARD"),
    ("TXN016", 3400.00, "COMPLETED", "M008", "C006", "2024-01-25", "CREDIT_CARD"),
    ("TXN018", 560.00, "COMPLETED", "M001", "C007", "2024-01-31", "UPI"),
]

# 7 dirty transactions.
TRANSACTIONS_DIRTY = [
    (None, 320.00, "COMPLETED", "M001", "C004", "2024-01-20", "UPI"),
    ("TXN011", -50.00, "FAILED", "M003", "C007", "2024-01-20", "DEBIT_CARD"),
    ("TXN012", 780.00, "COMPLETED", "M004", "C002", "2024-01-21", "CREDIT_CARD"),
    ("TXN017", 145.00, "FAILED", "MXXX", "C009", "2024-01-28", "DEBIT_CARD"),
    ("TXN019", 0.00, "COMPLETED", "M002", "C001", "2024-01-29", "UPI"),
    ("TXN020", 99999.99, "COMPLETED", "M001", "C010", "2099-12-31", "CREDIT_CARD"),
    ("TXN015", 125.00, "PENDING", "M007", "C005", "2024-01-24", "UPI"),
]

# 8 merchants.
MERCHANTS = [
    ("M001", "Swiggy", "Food Delivery", "Bengaluru"),
    ("M002", "Amazon", "E-Commerce", "Bengaluru"),
    ("M003", "Zomato", "Food Delivery", "Bengaluru"),
    ("M004", "Ola", "Travel", "Bengaluru"),
    ("M005", "BigBasket", "Grocery", "Bengaluru"),
    ("M006", "BookMyShow", "Entertainment", "Mumbai"),
    ("M007", "MakeMyTrip", "Travel", "Gurugram"),
    ("M008", "Flipkart", "E-Commerce", "Bengaluru"),
]
MERCHANT_DDL = "merchant_id STRING, merchant_name STRING, category STRING, city STRING"

# The two days of the data-contract lab.
ORDERS_DDL = "order_id STRING, customer_id STRING, amount DOUBLE, status STRING"
DAY1_ORDERS = [
    ("ORD-001", "CUST-100", 150.00, "COMPLETED"),
    ("ORD-002", "CUST-101", 89.50, "PENDING"),
    ("ORD-003", "CUST-102", 210.00, "COMPLETED"),
    ("ORD-004", "CUST-103", 15.20, "FAILED"),
    ("ORD-005", "CUST-104", 500.00, "COMPLETED"),
]
DAY2_ORDERS = [
    ("ORD-006", "CUST-105", 120.00, "COMPLETED"),
    ("ORD-007", "CUST-106", -50.00, "COMPLETED"),
    ("ORD-008", "CUST-107", 300.00, "UNKNOWN"),
    ("ORD-009", None, 45.00, "PENDING"),
    ("ORD-006", "CUST-105", 120.00, "COMPLETED"),
]

# The Bronze schema and the three drifted columns.
SCHEMA_BRONZE = {c: "string" for c in ["transaction_id", "amount", "status", "merchant_id", "customer_id",
                                       "transaction_date", "payment_method", "ingestion_timestamp",
                                       "source_file", "pipeline_run_id"]}
DRIFTED_COLUMNS = {"payment_gateway": "string", "discount_amount": "float", "refund_flag": "boolean"}
