"""A small shop with known answers: seven receipts in the first days of May 2026."""

from __future__ import annotations

from datetime import date, datetime

from posmetrics import Engine
from posmetrics.sources.tables import FrameTables

AS_OF = date(2026, 5, 3)


def _t(text):
    return datetime.fromisoformat(text) if text else None


RECEIPTS = [
    ("RCPT-0001", "2026-05-01 09:00", "SALE", 250.0, 25.0, 10.0, "cust1", "emp1"),
    ("RCPT-0002", "2026-05-01 12:00", "SALE", 250.0, 0.0, 0.0, "cust2", "emp2"),
    ("RCPT-0003", "2026-05-01 15:00", "SALE", 250.0, 0.0, 10.0, "cust3", "emp1"),
    ("RCPT-0004", "2026-05-02 10:00", "SALE", 250.0, 0.0, 0.0, "cust1", "emp2"),
    ("RCPT-0005", "2026-05-02 14:00", "SALE", 250.0, 0.0, 10.0, "cust2", "emp1"),
    ("RCPT-0006", "2026-05-03 09:00", "SALE", 250.0, 0.0, 0.0, "cust3", "emp2"),
    ("RCPT-0007", "2026-05-03 16:00", "REFUND", -100.0, 0.0, 0.0, None, "emp1"),
]
LINES = [
    ("L1", "0001", "wash", 1, 100, 100, 30, 30), ("L2", "0001", "dry", 1, 125, 125, 40, 40),
    ("L3", "0001", "det", 1, 25, 25, 10, 10), ("L4", "0002", "wash", 2, 100, 200, 30, 60),
    ("L5", "0002", "det", 1, 50, 50, 10, 10), ("L6", "0003", "dry", 1, 125, 125, 40, 40),
    ("L7", "0003", "wash", 1, 100, 100, 30, 30), ("L8", "0003", "det", 1, 25, 25, 10, 10),
    ("L9", "0004", "dry", 1, 125, 125, 40, 40), ("L10", "0004", "det", 2, 25, 50, 10, 20),
    ("L11", "0005", "wash", 1, 100, 100, 30, 30), ("L12", "0005", "dry", 1, 125, 125, 40, 40),
    ("L13", "0006", "wash", 3, 100, 300, 30, 90), ("L14", "0007", "dry", 1, 100, -100, 40, -40),
]
NAMES = {"wash": "Wash", "dry": "Dry", "det": "Detergent"}


def tables(spark) -> FrameTables:
    def frame(rows, ddl):
        return spark.createDataFrame(rows, ddl.replace("TIME", "TIMESTAMP_NTZ"))

    receipts = [
        (n, n, kind, _t(at), _t(at), _t(at), None, None, money, off, tip, c, e, "store1", None)
        for n, at, kind, money, off, tip, c, e in RECEIPTS
    ]
    lines = [
        (i, f"RCPT-{r}", f"item-{x}", f"var-{x}", NAMES[x], *map(float, rest))
        for i, r, x, *rest in LINES
    ]
    return FrameTables(
        {
            "receipts": frame(
                receipts,
                "id STRING, receipt_number STRING, receipt_type STRING, receipt_date TIME, "
                "created_at TIME, updated_at TIME, deleted_at TIME, cancelled_at TIME, "
                "total_money DOUBLE, total_discount DOUBLE, tip DOUBLE, customer_id STRING, "
                "employee_id STRING, store_id STRING, dining_option STRING",
            ),
            "receipt_line_items": frame(
                lines,
                "id STRING, receipt_id STRING, item_id STRING, variant_id STRING, "
                "item_name STRING, quantity DOUBLE, price DOUBLE, total_money DOUBLE, "
                "cost DOUBLE, cost_total DOUBLE",
            ),
            "receipt_payments": frame(
                [("RCPT-0001", "cash", 100.0), ("RCPT-0001", "card", 150.0), ("RCPT-0002", "card", 250.0)],
                "receipt_id STRING, payment_type_id STRING, money_amount DOUBLE",
            ),
            "payment_types": frame(
                [("cash", "Cash"), ("card", "Card")], "id STRING, name STRING"
            ),
            "categories": frame(
                [("cat-svc", "Service"), ("cat-soap", "Soaps")], "id STRING, name STRING"
            ),
            "stores": frame([("store1", "Main Store")], "id STRING, name STRING"),
            "items": frame(
                [("item-wash", "Wash", "cat-svc"), ("item-dry", "Dry", "cat-svc"),
                 ("item-det", "Detergent", "cat-soap")],
                "id STRING, name STRING, category_id STRING",
            ),
            "employees": frame([("emp1", "Alice"), ("emp2", "Bob")], "id STRING, name STRING"),
            "customers": frame(
                [("cust1", "John Doe", "j@gmail.com", _t("2026-04-01"), _t("2026-05-15"), 3, 750.0),
                 ("cust2", "Jane Smith", None, _t("2026-05-15"), _t("2026-05-15"), 1, 200.0),
                 ("cust3", "Bob Wilson", "b@example.org", _t("2026-03-01"), _t("2026-04-01"), 1, 300.0)],
                "id STRING, name STRING, email STRING, first_visit TIME, last_visit TIME, "
                "total_visits INT, total_spent DOUBLE",
            ),
            "variants": frame(
                [("var-wash", "item-wash", "SKU-WASH", 30.0), ("var-dry", "item-dry", "SKU-DRY", 40.0),
                 ("var-det", "item-det", "SKU-DET", 10.0)],
                "id STRING, item_id STRING, sku STRING, cost DOUBLE",
            ),
            "inventory": frame(
                [("var-wash", "store1", 10), ("var-dry", "store1", 5), ("var-det", "store1", 3)],
                "variant_id STRING, store_id STRING, in_stock INT",
            ),
            "variant_store": frame(
                [("var-det", "store1", 5.0)],
                "variant_id STRING, store_id STRING, low_stock_threshold DOUBLE",
            ),
        }
    )


def engine(spark) -> Engine:
    return Engine(tables(spark), AS_OF)
